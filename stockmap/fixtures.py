"""Input views over the driver's generated tables.

The driver supplies TPC-H-like tables; these functions map them onto the
inputs the stock/coverage operators expect (zones, sites, stock rows, partners,
orders, hierarchies, flow executions, upsert events). Integer arithmetic keeps
keys and coordinates deterministic, so the same view can be written in SQL for
the oracle (``stockmap.testing.oracle``).

All functions are lazy and read only the columns they need (pruned at the
Parquet scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmap.functions.text import padded

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def code(key, mult: int) -> F.Column:
    """Five characters spread over all prefixes, and from key 100,000 on ``-{key div 100000}``: unique at any size.

    ``mult`` has no factor in common with 100,000, so keys below it never share the five characters.
    """
    k = key.cast("bigint")
    five = padded((k * F.lit(mult)) % 100000, 5)
    return F.when(k < 100000, five).otherwise(F.concat(five, F.lit("-"), F.floor(k / 100000).cast("string")))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZIP-like zones: zip_code, latitude, longitude, total_pop, median_income, poverty_rate.

    Keys with c_custkey % 101 = 0 have no centroid, % 97 = 0 no population.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    has_pt = (k % 101) != 0
    return c.select(
        code(k, 7919).alias("zip_code"),
        F.when(has_pt, F.lit(45.5) + ((k * 37) % 350).cast("double") / 100).alias("latitude"),
        F.when(has_pt, F.lit(-124.5) + ((k * 91) % 760).cast("double") / 100).alias("longitude"),
        F.when((k % 97) != 0, (F.col("c_nationkey") * 500 + (k * 13) % 20000).cast("bigint")).alias("total_pop"),
        (F.lit(20000) + (k * 1009) % 130000).cast("bigint").alias("median_income"),
        (((k * 17) % 300).cast("double") / 10).alias("poverty_rate"),
    )


def census_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census-style all-string rows; missing population is the code '-'."""
    z = zones(spark, sf_dir)
    return z.select(
        F.col("zip_code").alias("zcta"),
        F.coalesce(F.col("total_pop").cast("string"), F.lit("-")).alias("DP05_0001E"),
        F.col("median_income").cast("string").alias("DP03_0062E"),
        F.col("poverty_rate").cast("string").alias("DP03_0128PE"),
    )


def _supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is bounded.
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)


def _customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites: site_id, site_type, latitude, longitude, city, pop."""
    k = F.col("s_suppkey")
    return _supplier_nation(spark, sf_dir).select(
        code(k, 6151).alias("site_id"),
        F.when(k % 10 == 0, "REGIONAL_HUB").when(k % 10 <= 3, "DISTRIBUTION_CENTER")
        .otherwise("LOCAL_DISTRIBUTION").alias("site_type"),
        (F.lit(45.5) + ((k * 53) % 350).cast("double") / 100).alias("latitude"),
        (F.lit(-124.5) + ((k * 113) % 760).cast("double") / 100).alias("longitude"),
        F.col("n_name").alias("city"),
        (F.lit(10000) + (k * 271) % 30000).cast("bigint").alias("pop"),
    )


def inv_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock rows: site_id, product_id, on_hand_inventory, snapshot_date.

    Rows with l_partkey % 50 = 0 point at an unknown site.
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return li.select(
        F.when(F.col("l_partkey") % 50 == 0, F.lit("UNKNOWN"))
        .otherwise(code(F.col("l_suppkey"), 6151)).alias("site_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("on_hand_inventory"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw partners (pre-CDM names): id, name, partner_type, city."""
    sup = _supplier_nation(spark, sf_dir).select(
        F.concat(F.lit("SUP-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("name"), F.lit("SUPPLIER").alias("partner_type"), F.col("n_name").alias("city"))
    cus = _customer_nation(spark, sf_dir).select(
        F.concat(F.lit("CUS-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"), F.lit("CUSTOMER").alias("partner_type"), F.col("n_name").alias("city"))
    return sup.unionByName(cus)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: id, city, customer_type (HOSPITAL / CLINIC), seq."""
    return _customer_nation(spark, sf_dir).select(
        F.concat(F.lit("CUS-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "HOSPITAL").otherwise("CLINIC")
        .alias("customer_type"),
        F.col("c_custkey").alias("seq"),
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors: id, seq, lead_time_days."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return s.select(
        F.concat(F.lit("SUP-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_suppkey").alias("seq"),
        (F.lit(7) + F.col("s_suppkey") % 8).cast("int").alias("lead_time_days"),
    )


def inbound_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: id, tpartner_id, order_status, order_date."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("CUS-"), F.col("o_custkey").cast("string")).alias("tpartner_id"),
        F.when(F.col("o_orderstatus") == "F", "APPROVED").when(F.col("o_orderstatus") == "O", "IN_TRANSIT")
        .otherwise("PENDING").alias("order_status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent-pointer geography: id, parent_geo_id, level (country/state/metro)."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    root = r.select(F.lit("USA").alias("id"), F.lit(None).cast("string").alias("parent_geo_id"),
                    F.lit("country").alias("level")).distinct()
    states = r.select(F.concat(F.lit("R-"), "r_name").alias("id"), F.lit("USA").alias("parent_geo_id"),
                      F.lit("state").alias("level"))
    metros = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("N-"), "n_name").alias("id"), F.concat(F.lit("R-"), "r_name").alias("parent_geo_id"),
        F.lit("metro").alias("level"))
    return root.unionByName(states).unionByName(metros)


def product_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent-pointer product hierarchy: id, parent_product_group_id."""
    p = table(spark, sf_dir, "part").select("p_type", "p_brand")
    root = p.select(F.lit("ALL").alias("id"),
                    F.lit(None).cast("string").alias("parent_product_group_id")).distinct()
    types = p.select(F.col("p_type").alias("id"), F.lit("ALL").alias("parent_product_group_id")).distinct()
    brands = p.select(F.concat_ws("/", "p_type", "p_brand").alias("id"),
                      F.col("p_type").alias("parent_product_group_id")).distinct()
    return root.unionByName(types).unionByName(brands)


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow execution log: flow_name, execution_id, start_time, end_time (null while it runs), status, records and bytes."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    et = F.col("event_type")
    return e.select(
        F.concat(F.lit("s3-"), (F.col("user_id") % 15).cast("string"), F.lit("-flow")).alias("flow_name"),
        F.col("event_id").alias("execution_id"),
        F.col("ts").alias("start_time"),
        F.when(et == "error", "FAILED").when(et == "click", "RUNNING").when(et == "signup", "QUEUED")
        .otherwise("SUCCEEDED").alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("records_processed"),
        F.when(et == "error", (F.col("event_id") % 7).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        .alias("records_failed"),
        F.when(et != "click", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 600).cast("decimal(18,6)"))).alias("end_time"),
        (F.round(F.col("value") * 100).cast("bigint") * 64 + F.col("event_id") % 1000).cast("bigint").alias("bytes_processed"),
    )


def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed change events: id, event_ts, seq, status, value."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.concat(F.lit("K"), F.col("user_id").cast("string")).alias("id"),
        F.col("ts").alias("event_ts"), F.col("event_id").alias("seq"),
        F.col("event_type").alias("status"), F.col("value"),
    )


def zone_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key → zone centroid (same rule as :func:`zones`)."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    has_pt = (k % 101) != 0
    return c.select(k.alias("custkey"),
                    F.when(has_pt, F.lit(45.5) + ((k * 37) % 350).cast("double") / 100).alias("z_lat"),
                    F.when(has_pt, F.lit(-124.5) + ((k * 91) % 760).cast("double") / 100).alias("z_lon"))


def site_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier key → site location (same rule as :func:`sites`)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    return s.select(k.alias("suppkey"),
                    (F.lit(45.5) + ((k * 53) % 350).cast("double") / 100).alias("s_lat"),
                    (F.lit(-124.5) + ((k * 113) % 760).cast("double") / 100).alias("s_lon"))
