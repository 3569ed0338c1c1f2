import datetime as dt

from pyspark.sql import functions as F

from stockmap.operators import supply as sp
from stockmap.operators import conform as cf

SITES = "site_id string, site_type string, latitude double, longitude double, city string, pop bigint"


def _sites(spark):
    return spark.createDataFrame([
        ("98101", "REGIONAL_HUB", 47.6062, -122.3321, "Seattle", 28000),
        ("99201", "DISTRIBUTION_CENTER", 47.6588, -117.4260, "Spokane", 21000),
        ("98402", "DISTRIBUTION_CENTER", 47.2529, -122.4443, "Tacoma", 15000),
        ("98004", "LOCAL_DISTRIBUTION", 47.6101, -122.2015, "Bellevue", 35000),
        ("98501", "LOCAL_DISTRIBUTION", 47.0379, -122.9007, "Olympia", 25000),
        ("98661", "LOCAL_DISTRIBUTION", 45.6387, -122.6615, "Vancouver", 18000),
        ("98801", "LOCAL_DISTRIBUTION", 47.4235, -120.3103, "Wenatchee", 12000)], SITES)


def test_tier_stock(spark):
    got = {r.site_id: r.on_hand_inventory for r in sp.stock_allocation(_sites(spark), "2024-01-01").collect()}
    assert got == {"98101": 2800, "99201": 1050, "98402": 750, "98004": 700, "98501": 500, "98661": 360,
                   "98801": 240}


def test_demand_ramp(spark):
    f = sp.demand_forecast(_sites(spark), "2024-01-01")
    hub = [r.mean for r in f.where("site_id = '98101'").orderBy("forecast_start_dttm").collect()]
    assert hub[:7] == [100] * 7
    assert hub[7:14] == [100, 128, 157, 185, 214, 242, 271]
    assert hub[14:] == [300] * 16
    loc = [r.mean for r in f.where("site_id = '98004'").orderBy("forecast_start_dttm").collect()]
    assert loc[7:14] == [20, 25, 31, 37, 42, 48, 54] and loc[14] == 60


def test_calendar_holidays_and_iso_week(spark):
    d = spark.createDataFrame([(dt.date(2026, 12, 25),), (dt.date(2026, 12, 5),), (dt.date(2027, 1, 1),),
                               (dt.date(2026, 12, 7),)], "date date")
    r = {x.calendar_id: x for x in sp.calendar_dim(d).collect()}
    assert (r["CAL-20261225"].is_working, r["CAL-20261225"].is_holiday) == ("N", "Y")
    assert (r["CAL-20261205"].is_working, r["CAL-20261205"].is_holiday) == ("N", "N")
    assert (r["CAL-20270101"].is_holiday, r["CAL-20270101"].week) == ("Y", 53)
    assert r["CAL-20261207"].is_working == "Y"
    p = {x.id: x for x in sp.calendar_dim(d, cdm=False).collect()}
    assert p["CAL-20261225"].day_of_week == "Friday" and p["CAL-20261225"].holiday_name == "Christmas"


def test_parent_dc_is_true_nearest(spark):
    s = _sites(spark)
    locs = s.where(F.col("site_type") == sp.LOCAL)
    dcs = s.where(F.col("site_type") == sp.DC)
    got = {r.site_id: r.parent_site_id for r in sp.assign_parent(locs, dcs).collect()}
    assert got == {"98004": "98402", "98501": "98402", "98661": "98402", "98801": "98402"}
    ov = spark.createDataFrame([("98004", "99201")], "site_id string, parent_site_id string")
    got = {r.site_id: r.parent_site_id for r in sp.assign_parent(locs, dcs, override=ov).collect()}
    assert got["98004"] == "99201"


def test_lanes_shape(spark):
    s = _sites(spark).withColumn("geo_id", F.lit("USA-WA"))
    lanes = sp.transport_lanes(s).collect()
    kinds = {(r.from_site_id, r.to_site_id): (r.transit_time, r.cost_per_unit) for r in lanes}
    assert kinds[("98101", "99201")] == (1.0, 0.5) and kinds[("98101", "98402")] == (1.0, 0.5)
    assert kinds[("99201", "98402")] == (1.5, 0.75) and kinds[("98402", "99201")] == (1.5, 0.75)
    assert len(lanes) == 2 + 4 + 2


def test_site_description_and_dedupe(spark):
    s = _sites(spark).unionByName(spark.createDataFrame(
        [("98101", "LOCAL_DISTRIBUTION", 47.6, -122.3, "Seattle", 1)], SITES))
    geo = spark.createDataFrame([("USA-WA-SEATTLE", "Seattle")], "id string, city string")
    d = {r.id: r for r in sp.site_dimension(s, geo).collect()}
    assert d["98101"].site_type == "LOCAL_DISTRIBUTION"         # the later tier wins
    assert d["99201"].description == "Spokane Distribution Center - ZIP 99201"
    assert d["98101"].geo_id == "USA-WA-SEATTLE" and d["99201"].geo_id == "USA-WA"


def test_fulfilment_site_by_city_then_first_hub(spark):
    c = spark.createDataFrame([("H1", "Seattle", "HOSPITAL", 1), ("C2", "Bellevue", "CLINIC", 2),
                               ("C3", "Boston", "CLINIC", 3)], "id string, city string, customer_type string, seq long")
    got = {r.id: r.ship_from_site_id for r in sp.fulfilment_site(c, _sites(spark)).collect()}
    assert got == {"H1": "98101", "C2": "98004", "C3": "98101"}


def test_partner_type_is_kept(spark):
    df = spark.createDataFrame([("C1", "Clinic", "CUSTOMER", "Seattle")],
                               "id string, name string, tpartner_type string, city string")
    rec = cf.event_payload(df, "trading_partner").first().payload
    assert '"tpartner_type":"CUSTOMER"' in rec and '"description":"Clinic"' in rec


def test_payload_omits_nulls_and_stringifies(spark):
    df = spark.createDataFrame([("L1", "O1", "T", "P", None, 500, dt.date(2024, 1, 2))],
                               "id string, order_id string, tpartner_id string, product_id string, "
                               "to_site_id string, quantity_submitted long, expected_delivery_date date")
    rec = cf.event_payload(df, "inbound_order_line").first().payload
    assert rec == ('{"id":"L1","order_id":"O1","tpartner_id":"T","product_id":"P","quantity_submitted":"500",'
                   '"expected_delivery_date":"2024-01-02T00:00:00Z"}')


def test_hierarchy_closure(spark):
    g = spark.createDataFrame([("USA", None), ("WA", "USA"), ("SEA", "WA")], "id string, parent string")
    got = sorted(tuple(r) for r in sp.hierarchy_closure(spark, g, "id", "parent").collect())
    assert got == [("SEA", "SEA", 0), ("SEA", "USA", 2), ("SEA", "WA", 1), ("USA", "USA", 0), ("WA", "USA", 1),
                   ("WA", "WA", 0)]
