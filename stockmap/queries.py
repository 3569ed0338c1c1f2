"""Registered queries: each maps the driver's tables to an operator's inputs and runs it.

Every query is ``(spark, sf_dir) -> DataFrame``. Its work grows with the
given tables; nothing here is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmap import fixtures as fx
from stockmap.functions.text import padded
from stockmap.operators import allocation as al
from stockmap.operators import coverage as cov

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round float outputs to 6 digits (summation order differs between engines)."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# ---------------------------------------------------------------- coverage inputs

def site_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site details as the coverage code reads them (id, …, state_prov)."""
    return fx.sites(spark, sf_dir).select(F.col("site_id").alias("id"), "site_type", "latitude", "longitude",
                                          "city", F.lit("WA").alias("state_prov"), "pop")


def stocks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cov.current_stocks(fx.inv_level(spark, sf_dir), site_table(spark, sf_dir))


def access_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cov.access_by_zip(fx.zones(spark, sf_dir), stocks_of(spark, sf_dir))


def metrics_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Site details travel through the nearest-site search: the stock
    # aggregate is computed once, not again for a details join.
    a = cov.access_by_zip(fx.zones(spark, sf_dir), stocks_of(spark, sf_dir), details=True)
    return cov.access_by_site(a)


# ---------------------------------------------------------------- coverage queries

@query("current_stocks")
def q_current_stocks(spark, sf_dir):
    return stocks_of(spark, sf_dir)


@query("orphan_stock")
def q_orphan_stock(spark, sf_dir):
    return cov.orphan_stock(fx.inv_level(spark, sf_dir), site_table(spark, sf_dir))


@query("access_by_zip")
def q_access_by_zip(spark, sf_dir):
    return _r6(access_of(spark, sf_dir), "distance_km", "distance_miles")


@query("access_by_site")
def q_access_by_site(spark, sf_dir):
    return _r6(metrics_of(spark, sf_dir), "pop_weighted_distance_km", "doses_per_1000_people")


# ---------------------------------------------------------------- zones, census

ALL_STATES = ("TX", "CA", "FL", "NY", "WA")


def _scratch(spark: SparkSession, label: str) -> str:
    from stockmap.session import scratch_dir
    from stockmap.sources.files import unique_dir
    return unique_dir(scratch_dir(spark, "stockmap/io"), label)


def census_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.census_raw(spark, sf_dir).withColumnRenamed("zcta", "zip code tabulation area")


@query("zip_prefix_filter")
def q_zip_prefix_filter(spark, sf_dir):
    z = fx.zones(spark, sf_dir).select("zip_code", "latitude", "longitude", "total_pop")
    return cov.zip_prefix_filter(z, ALL_STATES)


@query("zip_centroids")
def q_zip_centroids(spark, sf_dir):
    g = fx.zones(spark, sf_dir).select(F.col("zip_code").alias("GEOID"), F.col("latitude").alias("INTPTLAT"),
                                       F.col("longitude").alias("INTPTLONG"))
    return cov.zip_centroids(g, ("WA", "NY"))


@query("coerce_numeric")
def q_coerce_numeric(spark, sf_dir):
    return cov.coerce_numeric(fx.census_raw(spark, sf_dir), ["DP05_0001E", "DP03_0062E", "DP03_0128PE"])


@query("zip_population")
def q_zip_population(spark, sf_dir):
    cen = fx.zones(spark, sf_dir).select("zip_code", "latitude", "longitude")
    return cov.zip_population(census_table(spark, sf_dir), cen, ALL_STATES)


@query("gazetteer_scan")
def q_gazetteer_scan(spark, sf_dir):
    from stockmap.sources.files import read_gazetteer, write_gazetteer
    path = _scratch(spark, "gazetteer")
    g = fx.zones(spark, sf_dir).select(F.col("zip_code").alias("GEOID"), F.col("latitude").alias("INTPTLAT"),
                                       F.col("longitude").alias("INTPTLONG"))
    write_gazetteer(g, path)
    return cov.zip_centroids(read_gazetteer(spark, path), ALL_STATES)


@query("json_matrix_scan")
def q_json_matrix_scan(spark, sf_dir):
    from stockmap.sources.files import read_json_matrix, write_json_matrix
    path = _scratch(spark, "census-json")
    write_json_matrix(census_table(spark, sf_dir), path)
    cen = fx.zones(spark, sf_dir).select("zip_code", "latitude", "longitude")
    return cov.zip_population(read_json_matrix(spark, path), cen, ALL_STATES)


@query("json_matrix_files")
def q_json_matrix_files(spark, sf_dir):
    """One JSON document on one line for each pair of leading digits, those of odd ones with their columns reversed."""
    from stockmap.sources.files import read_json_matrix
    path, raw = _scratch(spark, "census-files"), census_table(spark, sf_dir)
    lead, names = F.substring("zip code tabulation area", 1, 2), raw.columns

    def matrix(columns):
        head = F.to_json(F.array(*[F.lit(c) for c in columns]))
        rows = F.collect_list(F.to_json(F.array(*[F.col(c).cast("string") for c in columns])))
        return F.concat(F.lit("["), head, F.lit(","), F.array_join(rows, ","), F.lit("]"))

    both = raw.groupBy(lead.alias("lead")).agg(matrix(names).alias("even"), matrix(names[::-1]).alias("odd"))
    docs = both.select(F.when(F.col("lead").cast("int") % 2 == 0, F.col("even")).otherwise(F.col("odd")).alias("value"))
    docs.write.option("maxRecordsPerFile", 1).mode("overwrite").text(path)
    cen = fx.zones(spark, sf_dir).select("zip_code", "latitude", "longitude")
    return cov.zip_population(read_json_matrix(spark, path, whole=True), cen, ALL_STATES)


@query("cached_raw")
def q_cached_raw(spark, sf_dir):
    from stockmap.sources.files import cached
    path = _scratch(spark, "census-cache")
    first = cached(fx.census_raw(spark, sf_dir), path)
    first.count()
    return cached(fx.census_raw(spark, sf_dir), path)  # second call finds the copy and reads it


# ---------------------------------------------------------------- summaries, ranks, decisions

@query("stock_summary")
def q_stock_summary(spark, sf_dir):
    return _r6(cov.stock_summary(stocks_of(spark, sf_dir)), "mean_doses")


@query("coverage_summary")
def q_coverage_summary(spark, sf_dir):
    return _r6(cov.coverage_summary(access_of(spark, sf_dir)), "mean_distance_miles", "max_distance_miles")


@query("site_summary")
def q_site_summary(spark, sf_dir):
    return _r6(cov.site_summary(metrics_of(spark, sf_dir)), "mean_population_served", "mean_doses_per_1000")


_METRIC_FLOATS = ("pop_weighted_distance_km", "doses_per_1000_people")


@query("best_stocked")
def q_best_stocked(spark, sf_dir):
    return _r6(cov.best_stocked(metrics_of(spark, sf_dir), 10), *_METRIC_FLOATS)


@query("most_understocked")
def q_most_understocked(spark, sf_dir):
    return _r6(cov.most_understocked(metrics_of(spark, sf_dir), 10), *_METRIC_FLOATS)


@query("stock_class")
def q_stock_class(spark, sf_dir):
    m = metrics_of(spark, sf_dir).select("nearest_site_id", "doses_per_1000_people")
    return _r6(cov.stock_class(m), "doses_per_1000_people")


@query("coverage_gaps")
def q_coverage_gaps(spark, sf_dir):
    a = access_of(spark, sf_dir).select("zip_code", "latitude", "longitude", "population", "nearest_site_id",
                                        "distance_km")
    return _r6(cov.coverage_gaps(a, max_km=30.0), "distance_km")


@query("restock_priority")
def q_restock_priority(spark, sf_dir):
    m = metrics_of(spark, sf_dir).select("nearest_site_id", "total_population_served", "total_doses")
    return _r6(cov.restock_priority(m, target_per_1000=100.0), "restock_need")


@query("equity_by_income")
def q_equity_by_income(spark, sf_dir):
    a = cov.access_by_zip(fx.zones(spark, sf_dir), stocks_of(spark, sf_dir), zone_cols=["median_income"])
    return _r6(cov.equity_by(a, "median_income"), "pop_weighted_distance_km")


@query("equity_by_poverty")
def q_equity_by_poverty(spark, sf_dir):
    a = cov.access_by_zip(fx.zones(spark, sf_dir), stocks_of(spark, sf_dir), zone_cols=["poverty_rate"])
    return _r6(cov.equity_by(a, "poverty_rate"), "pop_weighted_distance_km")


@query("transshipment_pairs")
def q_transshipment_pairs(spark, sf_dir):
    r = cov.transshipment_pairs(metrics_of(spark, sf_dir), target_per_1000=75.0, max_km=250.0)
    return _r6(r, "receiver_deficit", "donor_surplus", "distance_km", "transfer_qty")


@query("transshipment_allocation")
def q_transshipment_allocation(spark, sf_dir):
    return al.allocate_transfers(metrics_of(spark, sf_dir), target_per_1000=75.0, max_km=250.0)


# ---------------------------------------------------------------- supply tables

from stockmap.operators import conform as cf  # noqa: E402
from stockmap.operators import supply as sp  # noqa: E402

AS_OF = "2024-01-01"
GROUP_TS = "20240101000000"


def geo_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.geography(spark, sf_dir)
    return g.withColumn("city", F.when(F.col("level") == "metro", F.substring("id", 3, 1000)))


def site_dim_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.site_dimension(fx.sites(spark, sf_dir), geo_table(spark, sf_dir))


def sites_with_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = site_dim_of(spark, sf_dir).select(F.col("id").alias("site_id"), "geo_id")
    return fx.sites(spark, sf_dir).join(d, "site_id")


@query("calendar_dim")
def q_calendar_dim(spark, sf_dir):
    return sp.calendar_dim(sp.date_span(fx.table(spark, sf_dir, "orders"), "o_orderdate"), cdm=True)


@query("calendar_plain")
def q_calendar_plain(spark, sf_dir):
    return sp.calendar_dim(sp.date_span(fx.table(spark, sf_dir, "orders"), "o_orderdate"), cdm=False)


@query("demand_forecast")
def q_demand_forecast(spark, sf_dir):
    return sp.demand_forecast(fx.sites(spark, sf_dir), AS_OF)


@query("stock_allocation")
def q_stock_allocation(spark, sf_dir):
    return sp.stock_allocation(fx.sites(spark, sf_dir), AS_OF)


@query("inventory_policy")
def q_inventory_policy(spark, sf_dir):
    return sp.inventory_policy(fx.sites(spark, sf_dir))


@query("site_dimension")
def q_site_dimension(spark, sf_dir):
    return site_dim_of(spark, sf_dir)


@query("assign_parent_dc")
def q_assign_parent_dc(spark, sf_dir):
    s = fx.sites(spark, sf_dir)
    locs = s.where(F.col("site_type") == sp.LOCAL).select("site_id", "latitude", "longitude")
    dcs = s.where(F.col("site_type") == sp.DC)
    r = sp.assign_parent(locs, dcs, alias="parent_dc_id")
    return _r6(r.select("site_id", "parent_dc_id", "parent_distance_km"), "parent_distance_km")


@query("transport_lanes")
def q_transport_lanes(spark, sf_dir):
    return sp.transport_lanes(sites_with_geo(spark, sf_dir))


@query("inbound_orders")
def q_inbound_orders(spark, sf_dir):
    return sp.inbound_orders(fx.vendors(spark, sf_dir), fx.sites(spark, sf_dir))


@query("inbound_order_lines")
def q_inbound_order_lines(spark, sf_dir):
    return sp.inbound_order_lines(fx.vendors(spark, sf_dir), fx.sites(spark, sf_dir), AS_OF)


@query("fulfilment_site")
def q_fulfilment_site(spark, sf_dir):
    return sp.fulfilment_site(fx.customers(spark, sf_dir), fx.sites(spark, sf_dir))


@query("outbound_demand")
def q_outbound_demand(spark, sf_dir):
    return sp.outbound_demand(fx.customers(spark, sf_dir), fx.sites(spark, sf_dir), AS_OF)


@query("geography_closure")
def q_geography_closure(spark, sf_dir):
    return sp.hierarchy_closure(spark, fx.geography(spark, sf_dir), "id", "parent_geo_id")


@query("product_closure")
def q_product_closure(spark, sf_dir):
    return sp.hierarchy_closure(spark, fx.product_groups(spark, sf_dir), "id", "parent_product_group_id")


@query("geography_dim")
def q_geography_dim(spark, sf_dir):
    return sp.geography_dim(geo_table(spark, sf_dir))


def line_id(order_id: Column, line: Column) -> Column:
    """``{order}-LINE-{line}``, a missing order or line as ``null``."""
    return F.concat(F.coalesce(order_id, F.lit("null")), F.lit("-LINE-"), padded(line, 3))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    oid = F.col("l_orderkey").cast("string")
    return li.select(
        line_id(oid, F.col("l_linenumber")).alias("id"),
        oid.alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"),
        fx.code(F.col("l_suppkey"), 6151).alias("ship_from_site_id"))


@query("shipments")
def q_shipments(spark, sf_dir):
    return shipments_of(spark, sf_dir)


def shipments_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line goes to the site that serves the ordering customer."""
    to = sp.fulfilment_site(fx.customers(spark, sf_dir), fx.sites(spark, sf_dir)).select(
        F.col("id").alias("_cid"), F.col("ship_from_site_id").alias("to_site_id"))
    orders = fx.inbound_orders_raw(spark, sf_dir)
    served = orders.select(F.col("id").alias("order_id"), F.col("tpartner_id").alias("_cid")).join(to, "_cid", "left").drop("_cid")
    return sp.shipments(order_lines(spark, sf_dir).join(served, "order_id"), orders)


def _raw_partners(spark, sf_dir, kind):
    return fx.partners(spark, sf_dir).where(F.col("partner_type") == kind).select("id", "name", "city")


@query("trading_partners")
def q_trading_partners(spark, sf_dir):
    # Vendors carry their state (the region of their nation); every hub trades as a warehouse.
    states = fx.table(spark, sf_dir, "nation").join(fx.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    vendors = _raw_partners(spark, sf_dir, "SUPPLIER").join(states, "city", "left")
    hubs = fx.sites(spark, sf_dir).where(F.col("site_type") == sp.HUB)
    warehouses = hubs.select(F.concat(F.lit("WH-"), "site_id").alias("id"), F.concat("city", F.lit(" Warehouse")).alias("name"), "city")
    return sp.trading_partners(vendors, _raw_partners(spark, sf_dir, "CUSTOMER"), warehouses)


@query("cdm_rename")
def q_cdm_rename(spark, sf_dir):
    return cf.cdm_rename(fx.partners(spark, sf_dir), "trading_partner")


@query("conform_constants")
def q_conform_constants(spark, sf_dir):
    return cf.conform(fx.partners(spark, sf_dir), "trading_partner",
                      {"country": sp.COUNTRY, "geo_id": sp.NO_VALUE, "eff_start_date": sp.OPEN_START_TS,
                       "eff_end_date": sp.OPEN_END_TS})


# ---------------------------------------------------------------- event payloads

def product_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.lit(sp.CONNECTION_ID).alias("connection_id"),
                    F.col("p_name").alias("description"), F.lit("EA").alias("unit_of_measure"),
                    F.col("p_type").alias("product_type"), F.col("p_brand").alias("category"))


def inv_level_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = fx.inv_level(spark, sf_dir)
    return i.select("snapshot_date", "site_id", "product_id", F.lit(sp.CONNECTION_ID).alias("connection_id"),
                    "on_hand_inventory", F.lit("HEALTHY").alias("inv_condition"),
                    F.concat(F.lit("LOT-"), F.col("product_id")).alias("lot_number"),
                    F.date_add("snapshot_date", 365).alias("expiry_date"))


def site_event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = site_dim_of(spark, sf_dir)
    pop = fx.sites(spark, sf_dir).select(F.col("site_id").alias("id"), F.col("pop").alias("custom_total_pop"))
    return d.join(pop, "id")


def product_group_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.product_groups(spark, sf_dir)
    return g.select("id", F.lit(sp.CONNECTION_ID).alias("connection_id"), F.col("id").alias("description"),
                    "parent_product_group_id")


def inbound_order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.inbound_orders_raw(spark, sf_dir).select("id", F.lit(sp.CONNECTION_ID).alias("connection_id"),
                                                        "tpartner_id", "order_status")


def inbound_line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                     "l_shipdate", "l_linestatus")
    oid = F.col("l_orderkey").cast("string")
    return li.select(
        line_id(oid, F.col("l_linenumber")).alias("id"),
        oid.alias("order_id"), F.lit(sp.CONNECTION_ID).alias("connection_id"),
        F.lit(sp.INTERNAL_PARTNER).alias("tpartner_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity_submitted"),
        F.when(F.col("l_linestatus") == "O", "OPEN").alias("status"),
        F.col("l_shipdate").cast("date").alias("expected_delivery_date"))


EVENT_INPUTS = {
    "geography": lambda s, d: sp.geography_dim(geo_table(s, d)),
    "product_hierarchy": product_group_table,
    "product": product_table,
    "trading_partner": lambda s, d: fx.partners(s, d),
    "site": site_event_table,
    "inv_policy": lambda s, d: sp.inventory_policy(fx.sites(s, d)),
    "inv_level": inv_level_table,
    "inbound_order": inbound_order_table,
    "inbound_order_line": inbound_line_table,
}
EVENT_KEYS = {"inv_level": "lot_number"}


def event_payloads(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    df = EVENT_INPUTS[dataset](spark, sf_dir)
    key = EVENT_KEYS.get(dataset)
    if dataset == "inv_level":
        df = df.withColumn("lot_number", F.concat_ws("-", "lot_number", "site_id", F.date_format("snapshot_date", "yyyyMMdd")))
    return cf.event_payload(df, dataset, key)


def _payload_query(ds: str):
    def q(spark, sf_dir):
        return event_payloads(spark, sf_dir, ds)
    q.__name__ = f"q_event_payload_{ds}"
    return q


for _ds in EVENT_INPUTS:
    REGISTRY[f"event_payload_{_ds}"] = _payload_query(_ds)


@query("event_routing")
def q_event_routing(spark, sf_dir):
    parts = [site_dim_of(spark, sf_dir).select(F.lit("site").alias("dataset")),
             sp.demand_forecast(fx.sites(spark, sf_dir), AS_OF).select(F.lit("forecast").alias("dataset")),
             inv_level_table(spark, sf_dir).select(F.lit("inv_level").alias("dataset")),
             sp.transport_lanes(sites_with_geo(spark, sf_dir)).select(F.lit("transportation_lane").alias("dataset")),
             inbound_order_table(spark, sf_dir).select(F.lit("inbound_order").alias("dataset"))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counted = u.groupBy("dataset").agg(F.count(F.lit(1)).alias("records"))
    return cf.route_events(counted)


@query("event_batches")
def q_event_batches(spark, sf_dir):
    u = event_payloads(spark, sf_dir, "inv_level").unionByName(event_payloads(spark, sf_dir, "site")) \
        .unionByName(event_payloads(spark, sf_dir, "inbound_order"))
    return cf.event_batches(u, GROUP_TS)


# ---------------------------------------------------------------- remaining coverage

@query("candidate_sites")
def q_candidate_sites(spark, sf_dir):
    a = access_of(spark, sf_dir)
    cand = (fx.zones(spark, sf_dir).where(F.col("latitude").isNotNull())
            .groupBy("latitude", "longitude").agg(F.min("zip_code").alias("candidate_id")))
    r = cov.candidate_sites(a, cand, k=5)
    # gain is ~1e8: one decimal is what summation order keeps stable across engines
    return _r6(r, "new_pop_weighted_distance_km").withColumn("gain", F.round("gain", 1))


@query("candidate_sites_joint")
def q_candidate_sites_joint(spark, sf_dir):
    cand = (fx.zones(spark, sf_dir).where(F.col("latitude").isNotNull())
            .groupBy("latitude", "longitude").agg(F.min("zip_code").alias("candidate_id")))
    r = al.joint_candidate_sites(access_of(spark, sf_dir), cand, k=3)
    return _r6(r, "new_pop_weighted_distance_km").withColumn("gain", F.round("gain", 1))


@query("haversine_pairs")
def q_haversine_pairs(spark, sf_dir):
    """Delivery distance per order: customer zone → supplier site of every line."""
    from stockmap.functions.geo import haversine_km
    # Lines meet their site (by supplier) and orders meet their zone (by
    # customer) separately; the two then join on the order key, and the
    # per-order aggregate reuses that partitioning (no further shuffle).
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    lines = li.join(fx.site_points(spark, sf_dir), F.col("l_suppkey") == F.col("suppkey")).select(
        "l_orderkey", "s_lat", "s_lon")
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders = o.join(fx.zone_points(spark, sf_dir), F.col("o_custkey") == F.col("custkey")).select(
        "o_orderkey", "z_lat", "z_lon")
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    d = haversine_km("z_lat", "z_lon", "s_lat", "s_lon")
    return j.groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum(d), 6).alias("total_km"), F.round(F.max(d), 6).alias("max_km"))


# ---------------------------------------------------------------- validation (V1–V6)

from stockmap.operators import validate as va  # noqa: E402
from stockmap.session import run_side_by_side  # noqa: E402


def validation_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The derived datasets as they are published for validation: all but ``company``, one of them empty."""
    inv = inv_level_table(spark, sf_dir).withColumn("site_id", F.nullif(F.col("site_id"), F.lit("UNKNOWN")))
    return {
        "geography": sp.geography_dim(geo_table(spark, sf_dir)),
        "calendar": sp.calendar_dim(sp.date_span(fx.table(spark, sf_dir, "orders"), "o_orderdate")),
        "product_hierarchy": product_group_table(spark, sf_dir),
        "product": product_table(spark, sf_dir),
        "site": site_dim_of(spark, sf_dir),
        "transportation_lane": sp.transport_lanes(sites_with_geo(spark, sf_dir)),
        "trading_partner": fx.partners(spark, sf_dir),
        "inv_policy": sp.inventory_policy(fx.sites(spark, sf_dir).where(F.col("site_type") == "CLOSED")),
        "forecast": sp.demand_forecast(fx.sites(spark, sf_dir), AS_OF),
        "inv_level": inv,
        "inbound_order": inbound_order_table(spark, sf_dir),
        "inbound_order_line": inbound_line_table(spark, sf_dir),
        "shipment": shipments_of(spark, sf_dir),
        "outbound_order_line": sp.outbound_demand(fx.customers(spark, sf_dir), fx.sites(spark, sf_dir), AS_OF),
    }


def publish_for_validation(spark: SparkSession, sf_dir: str) -> str:
    """The derived datasets written as header CSV: the lake's folder. Compressed, as their text is long and repetitive."""
    root = _scratch(spark, "validate")
    frames = validation_frames(spark, sf_dir)
    run_side_by_side(spark, *[lambda n=n, df=df: fs.publish(df, n, root, "20240101_000000", gzip=True) for n, df in frames.items()])
    return root


def published_for_validation(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    """The derived datasets, opened again from the files they were published as."""
    return va.open_datasets(spark, publish_for_validation(spark, sf_dir))


@query("validate_datasets")
def q_validate_datasets(spark, sf_dir):
    return va.validate_all(spark, published_for_validation(spark, sf_dir))


@query("validate_nulls")
def q_validate_nulls(spark, sf_dir):
    out = None
    for name, df in published_for_validation(spark, sf_dir).items():
        if df is None:
            continue
        n = va.null_counts(df, name)
        out = n if out is None else out.unionByName(n)
    return out


@query("validate_summary")
def q_validate_summary(spark, sf_dir):
    """From the counts of the publishing jobs; ``validate_datasets`` reads the files."""
    return va.validate_summary(spark, va.validate_published(spark, publish_for_validation(spark, sf_dir)))


@query("dataset_profile")
def q_dataset_profile(spark, sf_dir):
    return va.dataset_profile(spark, published_for_validation(spark, sf_dir))


@query("key_duplicates")
def q_key_duplicates(spark, sf_dir):
    return va.key_duplicates(inv_level_table(spark, sf_dir), "inv_level")


# ---------------------------------------------------------------- files: publish, manifest, lake

from stockmap.sources import files as fs  # noqa: E402


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    path = _scratch(spark, "site-csv")
    fs.write_csv(site_dim_of(spark, sf_dir), path)
    return fs.read_dataset(spark, "site", path)


def _inv_for_lake(spark, sf_dir):
    return inv_level_table(spark, sf_dir).withColumn("lot_number", F.concat_ws(
        "-", "lot_number", "site_id", F.date_format("snapshot_date", "yyyyMMdd")))


def _inv_update(inv: DataFrame) -> DataFrame:
    """A later full snapshot of the same stock rows (every quantity one higher)."""
    return inv.withColumn("on_hand_inventory", F.col("on_hand_inventory") + 1)


@query("publish_append")
def q_publish_append(spark, sf_dir):
    root = _scratch(spark, "lake")
    inv = _inv_for_lake(spark, sf_dir)
    fs.publish(inv, "inv_level", root, "20240101_000000")
    fs.publish(_inv_update(inv), "inv_level", root, "20240102_000000")
    back = fs.read_lake(spark, "inv_level", root, "all")
    return back.groupBy("load_ts").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("on_hand_inventory").cast("bigint").alias("on_hand"))


@query("publish_replace")
def q_publish_replace(spark, sf_dir):
    root = _scratch(spark, "lake")
    inv = _inv_for_lake(spark, sf_dir)
    fs.publish(inv, "inv_level", root, "20240101_000000", replace=True)
    fs.publish(_inv_update(inv), "inv_level", root, "20240102_000000", replace=True)
    back = fs.read_lake(spark, "inv_level", root, "all")
    return back.groupBy("load_ts").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("on_hand_inventory").cast("bigint").alias("on_hand"))


@query("lake_latest")
def q_lake_latest(spark, sf_dir):
    root = _scratch(spark, "lake")
    inv = _inv_for_lake(spark, sf_dir)
    fs.publish(inv, "inv_level", root, "20240101_000000")
    fs.publish(_inv_update(inv), "inv_level", root, "20240102_000000")
    return fs.read_lake(spark, "inv_level", root, "latest").drop("connection_id")


def _published_root(spark, sf_dir):
    root = _scratch(spark, "lake")
    inv = _inv_for_lake(spark, sf_dir)
    fs.publish(site_dim_of(spark, sf_dir), "site", root, "20240101_000000")
    fs.publish(inv, "inv_level", root, "20240101_000000")
    fs.publish(_inv_update(inv), "inv_level", root, "20240102_000000")
    fs.publish(product_table(spark, sf_dir), "product", root, "20240101_000000")
    return root


@query("publish_manifest")
def q_publish_manifest(spark, sf_dir):
    root = _published_root(spark, sf_dir)
    m = fs.manifest(spark, root)
    rows = (spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .csv(root).select(F.col("_metadata.file_path").alias("path")))
    per_file = rows.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    j = m.join(per_file, "path", "left")
    # How many part files Spark writes depends on the partitioning; the rows
    # per published load and the file checks do not.
    return j.groupBy("dataset", "load_ts").agg(
        F.sum("rows").cast("bigint").alias("rows"),
        (F.min("bytes") > 0).alias("nonempty"), F.min(F.col("file_name").endswith(".csv")).alias("csv"))


@query("file_inventory")
def q_file_inventory(spark, sf_dir):
    root = _published_root(spark, sf_dir)
    inv = fs.file_inventory(spark, root)
    # How many files Spark writes depends on the partitioning, so the inventory is held against what the
    # reader says of each line's file, header lines too, since a file may have no rows; the rows themselves do not depend on it.
    seen = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
            .select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"), F.col("_metadata.file_name").alias("f")))
    per_file = seen.groupBy("p", "s", "f").agg((F.count(F.lit(1)) - 1).alias("n")).withColumn("dataset", F.regexp_extract("p", "/wa_([^/]+)/", 1))
    newest = F.regexp_extract("p", "load_ts=([^/]+)/", 1)
    sums = [F.count(F.lit(1)).alias("f"), F.sum("s").alias("b"), F.sum("n").alias("rows"), F.max(F.struct(newest, "f")).alias("m")]
    per = per_file.groupBy("dataset").agg(*sums).unionByName(per_file.agg(F.lit("TOTAL").alias("dataset"), *sums))
    j = inv.join(per, "dataset", "left")
    zero = F.lit(0)
    return j.select("dataset", "ord", F.coalesce("rows", zero).cast("bigint").alias("rows"),
                    (F.col("files") == F.coalesce("f", zero)).alias("files_agree"), (F.col("bytes") == F.coalesce("b", zero)).alias("bytes_agree"),
                    F.col("latest_file").isNotNull().alias("has_latest_file"))


# ---------------------------------------------------------------- streaming

from stockmap.streaming import batching as ba  # noqa: E402
from stockmap.streaming import flows as fl  # noqa: E402
from stockmap.streaming import upsert as up  # noqa: E402

_FLOW_SQL = "SELECT site_id, product_id, on_hand_inventory, snapshot_date, lot_number FROM {source}"


def _flow_run(spark, sf_dir):
    base = _scratch(spark, "flow")
    src, tgt, ck, log = f"{base}/src", f"{base}/target", f"{base}/ckpt", f"{base}/log"
    inv = _inv_for_lake(spark, sf_dir)
    from stockmap.schemas import spec
    schema = spec("inv_level").schema
    # Two files arriving one after the other: older stock rows first, then the rest.
    fs.write_csv(inv.where(F.col("snapshot_date") < F.lit("1996-01-01").cast("date")), f"{src}/load=a")
    fl.run_flow(spark, flow_name="wa-inv-level", source_dir=src, schema=schema, target_dir=tgt,
                checkpoint_dir=ck, log_dir=log, sql=_FLOW_SQL, source=fl.source_name("inv_level"))
    fs.write_csv(inv.where(F.col("snapshot_date") >= F.lit("1996-01-01").cast("date")), f"{src}/load=b")
    for _ in range(2):  # the second run finds nothing new
        fl.run_flow(spark, flow_name="wa-inv-level", source_dir=src, schema=schema, target_dir=tgt,
                    checkpoint_dir=ck, log_dir=log, sql=_FLOW_SQL, source=fl.source_name("inv_level"))
    return tgt, log


@query("flow_incremental")
def q_flow_incremental(spark, sf_dir):
    tgt, _ = _flow_run(spark, sf_dir)
    return fl.read_loaded(spark, tgt)


@query("flow_log")
def q_flow_log(spark, sf_dir):
    _, log = _flow_run(spark, sf_dir)
    return fl.read_log(spark, log).select("flow_name", "execution_id", "status", "records_processed",
                                          "records_failed", (F.col("bytes_processed") > 0).alias("has_bytes"),
                                          (F.col("end_time") >= F.col("start_time")).alias("ordered_times"))


@query("flow_rejects")
def q_flow_rejects(spark, sf_dir):
    """Records that do not fit their schema, by reason, beside the number that the run has logged as failed."""
    base = _scratch(spark, "flow-rejects")
    from stockmap.schemas import spec
    schema = spec("inv_level").schema
    part = F.col("product_id").cast("long")
    bad = _inv_for_lake(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in schema.names]).withColumns({
        "on_hand_inventory": F.when(part % 7 == 0, F.concat("on_hand_inventory", F.lit(" boxes"))).otherwise(F.col("on_hand_inventory")),
        "expiry_date": F.when(part % 21 == 0, F.lit("soon")).otherwise(F.col("expiry_date"))})
    fs.write_csv(bad, f"{base}/src")
    fl.run_flow(spark, flow_name="wa-inv-level", source_dir=f"{base}/src", schema=schema, target_dir=f"{base}/target", checkpoint_dir=f"{base}/ckpt",
                log_dir=f"{base}/log", rejects_dir=f"{base}/rejects", sql=_FLOW_SQL, source=fl.source_name("inv_level"))
    kept = fl.read_rejects(spark, f"{base}/rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    log = fl.read_log(spark, f"{base}/log").agg(F.sum("records_failed").cast("bigint").alias("logged_failed"))
    return kept.crossJoin(F.broadcast(log))  # one row of sums


@query("event_upsert")
def q_event_upsert(spark, sf_dir):
    base = _scratch(spark, "upsert")
    ev = fx.upsert_events(spark, sf_dir)
    # Two change sources arriving one after the other (browsing events, then
    # the rest); the stream runs after each arrival, one micro-batch each.
    browse = F.col("status").isin("click", "view")
    for part, cond in (("p0", browse), ("p1", ~browse)):
        ev.where(cond).write.mode("overwrite").parquet(f"{base}/src/{part}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(f"{base}/src")
        up.upsert_stream(stream, f"{base}/target", f"{base}/ckpt", key=["id"], order=["event_ts", "seq"],
                         buckets=16)
    return up.read_target(spark, f"{base}/target")


@query("event_batches_arriving")
def q_event_batches_arriving(spark, sf_dir):
    """Records that arrive in three loads (by the last digit of their key), the stream resumed after each."""
    base = _scratch(spark, "batches")
    u = event_payloads(spark, sf_dir, "inv_level").unionByName(event_payloads(spark, sf_dir, "site")) \
        .unionByName(event_payloads(spark, sf_dir, "inbound_order"))
    load = F.ascii(F.substring("record_key", -1, 1)) % 3
    for n in range(3):
        u.where(load == n).write.parquet(f"{base}/src/p{n}")
        stream = spark.readStream.schema(u.schema).option("recursiveFileLookup", True).parquet(f"{base}/src")
        ba.batch_stream(stream, f"{base}/target", f"{base}/ckpt", order=["record_key", "payload"], reread=True)
    return ba.read_batches(spark, f"{base}/target", GROUP_TS)


@query("events_daily")
def q_events_daily(spark, sf_dir):
    base = _scratch(spark, "events-daily")
    ev = fx.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # A bounded replay of the whole table: every window is wanted at the end, so none is closed by a watermark.
    fl.run_to_table(fl.events_daily_stream(stream, watermark=None), f"{base}/ckpt", f"{base}/out", mode="complete")
    return spark.read.parquet(f"{base}/out")


@query("events_daily_append")
def q_events_daily_append(spark, sf_dir):
    """Windows as the watermark closes them: older events, newer ones, then every twentieth event late."""
    base = _scratch(spark, "events-append")
    ev, late = fx.table(spark, sf_dir, "events"), F.col("event_id") % 20 == 3
    newer = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for n, arrived in enumerate((~late & ~newer, ~late & newer, late)):
        ev.where(arrived).write.parquet(f"{base}/src/p{n}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(f"{base}/src")
        fl.run_to_table(fl.events_daily_stream(stream), f"{base}/ckpt", f"{base}/out", mode="append")
    return spark.read.schema("day date, event_type string, events bigint").parquet(f"{base}/out").select("day", "event_type", "events")


# ---------------------------------------------------------------- monitoring

from stockmap.operators import monitor as mo  # noqa: E402


def flow_catalog(spark: SparkSession, n: int = 20) -> DataFrame:
    return spark.range(n).select(F.format_string("s3-%d-flow", F.col("id")).alias("flow_name"))


def executions_with_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.executions(spark, sf_dir)
    msgs = F.array(*[F.struct(F.lit("ERROR" if i == 1 else "INFO").alias("type"),
                              F.format_string(f"execution %d message {i}", F.col("execution_id")).alias("message"))
                     for i in range(1, 5)])
    return e.withColumn("messages", F.when(F.col("status") == "FAILED", msgs))


@query("execution_stats")
def q_execution_stats(spark, sf_dir):
    return mo.execution_stats(flow_catalog(spark), fx.executions(spark, sf_dir))


@query("recent_executions")
def q_recent_executions(spark, sf_dir):
    return mo.recent_executions(fx.executions(spark, sf_dir), 3)


@query("recent_events")
def q_recent_events(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(F.col("event_id"), F.col("event_type"),
                                                   F.col("ts").alias("event_timestamp"))
    return mo.recent_events(ev, 20)


@query("failed_executions")
def q_failed_executions(spark, sf_dir):
    return mo.failed_executions(executions_with_messages(spark, sf_dir))


@query("failed_executions_top3")
def q_failed_executions_top3(spark, sf_dir):
    return mo.failed_executions(executions_with_messages(spark, sf_dir), 3)


@query("event_rejects")
def q_event_rejects(spark, sf_dir):
    """Records of datasets that are not sent as events, each with its key."""
    parts = [(sp.demand_forecast(fx.sites(spark, sf_dir), AS_OF), "forecast", F.concat_ws("/", "site_id", "snapshot_date")),
             (shipments_of(spark, sf_dir), "shipment", F.col("id")),
             (inbound_order_table(spark, sf_dir), "inbound_order", F.col("id")),
             (site_dim_of(spark, sf_dir), "site", F.col("id"))]
    u = None
    for df, name, key in parts:
        p = df.select(F.lit(name).alias("dataset"), key.alias("record_key"))
        u = p if u is None else u.unionByName(p)
    return cf.split_routed(u)[1].select("dataset", "record_key")


@query("flow_throughput")
def q_flow_throughput(spark, sf_dir):
    return mo.flow_throughput(fx.executions(spark, sf_dir))
