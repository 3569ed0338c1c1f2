import pytest
from pyspark.sql import functions as F

from stockmap.operators import coverage as cov
from stockmap.sources import files as fs

SITE = "id string, latitude double, longitude double, city string, state_prov string"
INV = "site_id string, product_id string, on_hand_inventory bigint"


def test_current_stocks_drops_unknown_sites_and_reports_orphans(spark):
    site = spark.createDataFrame([("S1", 1.0, 1.0, "X", "WA"), ("S2", None, 2.0, "Y", "WA")], SITE)
    inv = spark.createDataFrame([("S1", "p", 10), ("S1", None, 5), ("S2", "p", 7), ("S9", "p", 3)], INV)
    st = {r["site_id"]: r for r in cov.current_stocks(inv, site).collect()}
    assert set(st) == {"S1"}                      # S2 has a null key, S9 is unknown
    assert st["S1"]["total_doses"] == 15 and st["S1"]["product_count"] == 1   # count of non-null product rows
    orphans = {r["site_id"]: r["total_doses"] for r in cov.orphan_stock(inv, site).collect()}
    assert orphans == {"S9": 3}


def test_site_metrics_null_and_zero_population(spark):
    acc = spark.createDataFrame(
        [("z1", 1.0, 1.0, 100, "S1", "S1", 10.0, 6.2, 50), ("z2", 1.0, 1.0, None, "S1", "S1", 30.0, 18.6, 50),
         ("z3", 1.0, 1.0, 0, "S2", "S2", 5.0, 3.1, 10), ("z4", None, None, 10, None, None, None, None, None)],
        "zip_code string, latitude double, longitude double, population bigint, nearest_site_id string, "
        "nearest_site_zip string, distance_km double, distance_miles double, total_doses bigint")
    m = {r["nearest_site_id"]: r for r in cov.site_metrics(acc).collect()}
    assert set(m) == {"S1", "S2"}                 # ZIP without a site stays out
    assert m["S1"]["pop_weighted_distance_km"] == 10.0      # null weight excluded
    assert m["S1"]["zip_codes_served"] == 2                  # ... but the ZIP still counts
    assert m["S2"]["pop_weighted_distance_km"] is None and m["S2"]["doses_per_1000_people"] is None


def test_coercion(spark):
    df = spark.createDataFrame([("1",), ("-",), ("",), (None,), ("-5",)], "v string")
    got = [r["v"] for r in cov.coerce_numeric(df, ["v"]).collect()]
    assert got == [1.0, None, None, None, -5.0]
    got = [r["v"] for r in cov.coerce_numeric(df, ["v"], negatives_as_null=True).collect()]
    assert got[-1] is None


def test_derived_zips_are_looked_up_before_each_prefix_is_tried(spark):
    """Each ``startswith`` computes a derived ZIP again; of 23 prefixes most rows have none."""
    df = spark.createDataFrame([("98101",), ("1",), (None,), ("99",), ("12345",), ("9",)], "z string").select(F.concat("z", F.lit("-0")).alias("zip_code"))
    got = cov.zip_prefix_filter(df, prefixes=["98", "99", "123", "1-"])
    assert sorted(r[0] for r in got.collect()) == ["1-0", "12345-0", "98101-0", "99-0"]
    assert cov.zip_prefix_filter(df, prefixes=[]).count() == 0 and cov.zip_prefix_filter(df, prefixes=[""]).count() == 5
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("substring(") < plan.index("StartsWith(")


def test_padded_numbers_are_those_of_format_string(spark):
    from stockmap.functions.text import padded
    df = spark.createDataFrame([(0,), (7,), (999,), (1000,), (-5,), (None,), (123456,)], "n bigint")
    assert df.select(padded(F.col("n"), 3) == F.format_string("%03d", "n")).distinct().collect() == [(True,)]


def test_prefix_filter(spark):
    df = spark.createDataFrame([("98101",), ("99201",), ("97000",), ("10001",)], "zip_code string")
    assert sorted(r[0] for r in cov.zip_prefix_filter(df, ["WA"]).collect()) == ["98101", "99201"]
    assert sorted(r[0] for r in cov.zip_prefix_filter(df, ["WA", "NY"]).collect()) == ["10001", "98101", "99201"]


def test_leading_zeros_survive_csv(spark, tmp):
    from stockmap.schemas import spec
    cols = spec("site").columns
    row = tuple("01399" if c in ("id", "postal_code") else None for c in cols)
    df = spark.createDataFrame([row], spec("site").string_schema)
    fs.write_csv(df, f"{tmp}/site")
    back = fs.read_dataset(spark, "site", f"{tmp}/site").first()
    assert back["id"] == "01399" and back["postal_code"] == "01399"


def test_gazetteer_padded_header(spark, tmp):
    p = f"{tmp}/gaz.csv"
    with open(p, "w") as f:
        f.write("GEOID\tALAND\tINTPTLAT   \tINTPTLONG                 \n01399\t5\t42.1\t-72.5\n98101\t3\t47.6\t-122.3\n")
    g = fs.read_gazetteer(spark, p)
    rows = cov.zip_centroids(g, ["WA"]).collect()
    assert [(r.zip_code, r.latitude) for r in rows] == [("98101", 47.6)]


def test_json_matrix(spark, tmp):
    p = f"{tmp}/acs.json"
    with open(p, "w") as f:
        f.write('[["NAME","DP05_0001E","zip code tabulation area"],\n["ZCTA5 98101","1200","98101"],\n'
                '["ZCTA5 98102","-","98102"]]\n')
    df = fs.read_json_matrix(spark, p)
    assert df.columns == ["NAME", "DP05_0001E", "zip code tabulation area"]
    assert sorted(r["DP05_0001E"] for r in df.collect()) == ["-", "1200"]


def test_stock_class_boundaries(spark):
    df = spark.createDataFrame([("a", 100.0), ("b", 100.1), ("c", 50.0), ("d", 49.9), ("e", None)],
                               "nearest_site_id string, doses_per_1000_people double")
    got = {r[0]: r["stock_class"] for r in cov.stock_class(df).collect()}
    assert got == {"a": "BETWEEN", "b": "WELL_STOCKED", "c": "BETWEEN", "d": "UNDERSTOCKED", "e": None}


def test_candidate_gains_match_brute_force(spark):
    import random
    from geo_py import haversine_km_py
    rnd = random.Random(2)
    zones = [(f"z{i}", 47 + rnd.uniform(0, 2), -123 + rnd.uniform(0, 3), rnd.randint(1, 1000), rnd.uniform(1, 60))
             for i in range(200)]
    cands = [(f"c{i}", 47 + rnd.uniform(0, 2), -123 + rnd.uniform(0, 3)) for i in range(150)]
    acc = spark.createDataFrame(zones, "zip_code string, latitude double, longitude double, population bigint, "
                                       "distance_km double")
    cdf = spark.createDataFrame(cands, "candidate_id string, latitude double, longitude double")
    want = {}
    for _, zl, zo, pop, dn in zones:
        for cid, cl, co in cands:
            d = haversine_km_py(zl, zo, cl, co)
            if d < dn:
                want[cid] = want.get(cid, 0.0) + pop * (dn - d)
    got = {r.candidate_id: r.gain for r in cov.candidate_gains(acc, cdf).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-6 * max(1.0, want[k]) for k in want)


def test_far_zones_look_at_few_cells(spark):
    from geo_py import haversine_km_py
    zones = [(f"z{i}", 47 + i * 0.01, -123.0, 10, 0.5) for i in range(300)]
    zones += [("far", 20.0, -150.0, 7, 4000.0), ("pole", 89.5, 10.0, 3, 900.0), ("line", 0.0, 179.99, 5, 50.0), ("all", -80.0, 0.0, 2, 19000.0),
              ("same", 20.0, -150.0, 4, 4000.0), ("here", 10.0, 10.0, 1, 0.0)]
    acc = spark.createDataFrame(zones, "zip_code string, latitude double, longitude double, population bigint, distance_km double")
    from pyspark.sql import functions as F
    probes = cov.zone_probes(acc.select(F.col("latitude").alias("z_lat"), F.col("longitude").alias("z_lon"), F.col("distance_km").alias("d_now"), "zip_code"))
    assert max(r["count"] for r in probes.groupBy("zip_code").count().collect()) <= 20
    cands = [("a", 47.0, -123.0), ("b", 90.0, 0.0), ("c", 0.0, -179.99), ("d", -89.0, 100.0), ("e", 30.0, -140.0), ("f", 88.0, -170.0)]
    got = {r.candidate_id: (r.gain, r.zones_helped) for r in cov.candidate_gains(acc, spark.createDataFrame(cands, "candidate_id string, latitude double, longitude double")).collect()}
    for c, la, lo in cands:
        near = [(p, dn - haversine_km_py(zl, zo, la, lo)) for _, zl, zo, p, dn in zones if haversine_km_py(zl, zo, la, lo) < dn]
        assert (c in got) == bool(near)
        if near:
            assert abs(got[c][0] - sum(p * g for p, g in near)) < 1e-6 * max(1, got[c][0]) and got[c][1] == len(near)


def test_publish_replace_and_read_back(spark, tmp):
    from stockmap.schemas import spec
    s = spec("inbound_order")
    a = spark.createDataFrame([("O1", None, "T1", "PO", "OPEN")], s.schema)
    b = spark.createDataFrame([("O2", None, "T2", "PO", "OPEN"), ("O3", None, "T3", "PO", "OPEN")], s.schema)
    root = f"{tmp}/lake"
    assert fs.read_lake(spark, "inbound_order", root).count() == 0          # missing dataset → empty
    fs.publish(a, "inbound_order", root, "20240101_000000")
    fs.publish(b, "inbound_order", root, "20240102_000000")
    assert sorted(r.id for r in fs.read_lake(spark, "inbound_order", root, "all").collect()) == ["O1", "O2", "O3"]
    assert sorted(r.id for r in fs.read_lake(spark, "inbound_order", root, "latest").collect()) == ["O2", "O3"]
    fs.publish(a, "inbound_order", root, "20240103_000000", replace=True)
    back = fs.read_lake(spark, "inbound_order", root, "all").collect()
    assert [(r.id, r.load_ts) for r in back] == [("O1", "20240103_000000")]
    m = fs.manifest(spark, root).collect()
    assert {r.dataset for r in m} == {"inbound_order"} and all(r.file_name.endswith(".csv") for r in m)
    inv = {r.dataset: r for r in fs.file_inventory(spark, root).collect()}
    assert inv["inbound_order"].files == len(m) and inv["site"].files == 0 and inv["TOTAL"].files == len(m)
    assert inv["inbound_order"].latest_file is not None


def test_cached_reads_materialised_copy(spark, tmp):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    first = fs.cached(df, f"{tmp}/c")
    assert first.count() == 2
    again = fs.cached(spark.createDataFrame([(9,)], "x long"), f"{tmp}/c")
    assert sorted(r.x for r in again.collect()) == [1, 2]


def test_exact_cut_points_match_discrete_quantiles(spark):
    import math
    import random
    rnd = random.Random(4)
    for n in (1, 3, 7, 10, 11, 257):
        vals = [rnd.randint(0, 50) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x long")
        got = cov.exact_cut_points(df, "x", [0.25, 0.5, 0.75])
        srt = sorted(vals)
        assert got == [srt[max(1, math.ceil(n * p)) - 1] for p in (0.25, 0.5, 0.75)]
