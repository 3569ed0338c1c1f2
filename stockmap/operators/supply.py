"""Derived supply-chain tables, computed from input tables.

Inputs are DataFrames of sites (site_id, site_type, latitude, longitude, city,
pop), vendors (id, seq, lead_time_days), customers (id, city, customer_type,
seq), partners, orders and parent-pointer hierarchies. "Now" is always an
explicit ``as_of`` date, so every output is reproducible.

Tiers: REGIONAL_HUB → DISTRIBUTION_CENTER → LOCAL_DISTRIBUTION.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.functions.geo import haversine_km, km_to_miles
from stockmap.functions.text import padded
from stockmap.plans.nearest import nearest_site
from stockmap.operators.conform import NO_VALUE, OPEN_END_TS, OPEN_START_TS
from stockmap.plans.numbering import row_number_global

# Fixed values shared by every derived table.
CONNECTION_ID = "WA-PHARMA-DIST"
PRODUCT_ID = "ANTIVIR-WA-01"
PRODUCT_TAG = "ANTIVIR"
ID_PREFIX = "WA"
STATE = "WA"
COUNTRY = "US"
STATE_GEO_ID = "USA-WA"
INTERNAL_PARTNER = "INTERNAL-TRANSFER"
UOM = "EA"

HUB, DC, LOCAL = "REGIONAL_HUB", "DISTRIBUTION_CENTER", "LOCAL_DISTRIBUTION"
TIER_RANK = {HUB: 1, DC: 2, LOCAL: 3}

# Holidays (month, day, name).
HOLIDAYS = ((12, 25, "Christmas"), (1, 1, "New Year"))
# Daily base demand per tier; stock share of population per tier.
BASE_DEMAND = {HUB: 100, DC: 50, LOCAL: 20}
STOCK_SHARE = {HUB: 0.10, DC: 0.05, LOCAL: 0.02}
# Inventory policy per tier (min safety, max safety, target, min order, max order).
POLICY = {
    HUB: (2000, 10000, 5000, 1000, 10000),
    DC: (500, 3000, 1500, 500, 5000),
    LOCAL: (100, 1000, 500, 100, 2000),
}
# Lane kinds (transit days, cost per unit).
LANE_HUB_DC = (1.0, 0.50)
LANE_DC_LOCAL = (0.5, 0.25)
LANE_DC_DC = (1.5, 0.75)
# Order quantities and lead days.
PO_BASE_QTY, PO_STEP_QTY = 5000, 1000
DC_TRANSFER_QTY, DC_TRANSFER_DAYS = 2000, 2
LOCAL_TRANSFER_QTY, LOCAL_TRANSFER_DAYS = 500, 1
# Outbound demand (normal qty, spike qty) per customer type.
DEMAND_QTY = {"HOSPITAL": (500, 1500)}
DEMAND_QTY_OTHER = (200, 600)


def _by_tier(col: Column, values: dict, default=None) -> Column:
    e = None
    for tier, v in values.items():
        e = F.when(col == tier, F.lit(v)) if e is None else e.when(col == tier, F.lit(v))
    return e.otherwise(F.lit(default)) if default is not None else e


def _date(as_of) -> Column:
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))


def _iso_start(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


# ---------------------------------------------------------------- G1 calendar

def calendar_dim(dates: DataFrame, cdm: bool = True) -> DataFrame:
    """Calendar rows for each date in ``dates`` (column ``date``).

    Working day = not weekend (Sat/Sun) and not a holiday; ISO week numbers.
    CDM layout: calendar_id, connection_id, date (ISO instant text), year,
    month, week, day, is_working, is_holiday, eff_start_date, eff_end_date.
    Plain layout: id, calendar_date, day_of_week, is_weekend, is_holiday,
    holiday_name, is_working_day, fiscal_year, fiscal_quarter, fiscal_month.
    """
    d = F.col("date")
    weekend = F.weekday(d) >= 5
    name = None
    for m, day, label in HOLIDAYS:
        cond = (F.month(d) == m) & (F.dayofmonth(d) == day)
        name = F.when(cond, F.lit(label)) if name is None else name.when(cond, F.lit(label))
    holiday = name.isNotNull()
    cal_id = F.concat(F.lit("CAL-"), F.date_format(d, "yyyyMMdd"))
    if cdm:
        return dates.select(
            cal_id.alias("calendar_id"), F.lit(CONNECTION_ID).alias("connection_id"), _iso_start(d).alias("date"),
            F.year(d).alias("year"), F.month(d).alias("month"), F.weekofyear(d).alias("week"),
            F.dayofmonth(d).alias("day"),
            F.when(weekend | holiday, "N").otherwise("Y").alias("is_working"),
            F.when(holiday, "Y").otherwise("N").alias("is_holiday"),
            F.lit(OPEN_START_TS).alias("eff_start_date"), F.lit(OPEN_END_TS).alias("eff_end_date"))
    return dates.select(
        cal_id.alias("id"), d.alias("calendar_date"), F.date_format(d, "EEEE").alias("day_of_week"),
        weekend.alias("is_weekend"), holiday.alias("is_holiday"), name.alias("holiday_name"),
        (~(weekend | holiday)).alias("is_working_day"), F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"), F.month(d).alias("fiscal_month"))


def date_span(df: DataFrame, col: str) -> DataFrame:
    """One row per day from min(col) to max(col): a single aggregate, then a bounded explode."""
    b = df.agg(F.min(F.col(col).cast("date")).alias("a"), F.max(F.col(col).cast("date")).alias("b"))
    return b.select(F.explode(F.sequence("a", "b")).alias("date"))


# ---------------------------------------------------------------- G2 demand forecast

def demand_multiplier_base(day: Column, base: Column) -> Column:
    """Days 0–6 base; 7–13 trunc(base·(1 + 2(d−7)/7)); from 14 on base·3."""
    ramp = (base * (F.lit(1.0) + (F.lit(2) * (day - 7)) / F.lit(7.0))).cast("bigint")
    return F.when(day < 7, base.cast("bigint")).when(day < 14, ramp).otherwise((base * 3).cast("bigint"))


def demand_forecast(sites: DataFrame, as_of, horizon: int = 30) -> DataFrame:
    """Daily demand per site for ``horizon`` days from ``as_of``: one row per (site, day)."""
    base = _by_tier(F.col("site_type"), BASE_DEMAND)
    s = sites.select("site_id", base.alias("_base"), F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("_d"))
    start = F.date_add(_date(as_of), F.col("_d"))
    return s.select(
        _date(as_of).alias("snapshot_date"), F.lit(CONNECTION_ID).alias("connection_id"),
        F.lit(PRODUCT_ID).alias("product_id"), "site_id", F.lit(STATE_GEO_ID).alias("region_id"),
        F.lit(NO_VALUE).alias("product_group_id"),
        _iso_start(start).alias("forecast_start_dttm"), _iso_start(F.date_add(start, 1)).alias("forecast_end_dttm"),
        demand_multiplier_base(F.col("_d"), F.col("_base")).alias("mean"))


# ---------------------------------------------------------------- G3 stock allocation

def stock_allocation(sites: DataFrame, as_of, shelf_days: int = 365) -> DataFrame:
    """Initial stock per site: trunc(pop × tier share); HEALTHY; expires as_of + shelf_days."""
    share = _by_tier(F.col("site_type"), STOCK_SHARE)
    year = _date(as_of).cast("string").substr(1, 4)
    return sites.select(
        _date(as_of).alias("snapshot_date"), "site_id", F.lit(PRODUCT_ID).alias("product_id"),
        F.lit(CONNECTION_ID).alias("connection_id"),
        (F.col("pop") * share).cast("bigint").alias("on_hand_inventory"),
        F.lit("HEALTHY").alias("inv_condition"),
        F.concat(F.lit("LOT-"), year, F.lit("-"), F.col("site_id")).alias("lot_number"),
        F.date_add(_date(as_of), shelf_days).alias("expiry_date"))


# ---------------------------------------------------------------- G4 inventory policy

def inventory_policy(sites: DataFrame) -> DataFrame:
    """Per-site policy by tier (min/max safety, target, min/max order)."""
    t = F.col("site_type")
    names = ("min_safety_stock", "max_safety_stock", "target_inventory_qty", "min_order_qty", "max_order_qty")
    vals = [_by_tier(t, {k: v[i] for k, v in POLICY.items()}).cast("bigint").alias(n) for i, n in enumerate(names)]
    return sites.where(t.isin(*POLICY)).select(
        F.concat(F.lit("POLICY-"), F.col("site_id"), F.lit(f"-{PRODUCT_TAG}")).alias("id"), "site_id",
        F.lit(PRODUCT_ID).alias("product_id"), F.lit(CONNECTION_ID).alias("connection_id"),
        F.lit(NO_VALUE).alias("product_group_id"), F.lit(NO_VALUE).alias("dest_geo_id"),
        F.lit(NO_VALUE).alias("vendor_tpartner_id"), F.lit("abs_level").alias("ss_policy"), *vals,
        F.lit(dt.date(1900, 1, 1)).alias("eff_start_date"), F.lit(dt.date(9999, 12, 31)).alias("eff_end_date"))


# ---------------------------------------------------------------- J7 parent assignment, G5 lanes

def assign_parent(children: DataFrame, parents: DataFrame, *, child_key: str = "site_id",
                  parent_key: str = "site_id", alias: str = "parent_site_id",
                  override: DataFrame | None = None, exclude_self: bool = False) -> DataFrame:
    """Each child gets its nearest parent (exact grid search). ``override``
    (child_key, parent) rows win over the computed choice."""
    p = parents.select(F.col(parent_key).alias("_pk"), "latitude", "longitude")
    r = nearest_site(children, p, site_key="_pk", key_alias=alias, distance_alias="parent_distance_km",
                     zone_key=child_key if exclude_self else None)
    if override is not None:
        o = override.select(F.col(child_key).alias("_ck"), F.col(alias).alias("_ov"))
        r = (r.join(o, r[child_key] == o["_ck"], "left")
             .withColumn(alias, F.coalesce("_ov", alias)).drop("_ck", "_ov"))
    return r


def _lane(frm: DataFrame, kind: tuple[float, float]) -> DataFrame:
    transit, cost = kind
    return frm.select(
        F.concat_ws("-", F.lit("LANE"), "from_site_id", "to_site_id").alias("id"),
        "from_site_id", "to_site_id", F.lit(CONNECTION_ID).alias("connection_id"),
        "from_geo_id", "to_geo_id", F.lit(NO_VALUE).alias("carrier_tpartner_id"),
        F.lit("TRUCK").alias("trans_mode"), F.lit("STANDARD").alias("service_type"),
        F.lit(NO_VALUE).alias("product_group_id"), F.lit(transit).alias("transit_time"),
        F.lit("DAY").alias("time_uom"), F.round(km_to_miles("_km"), 1).alias("distance"),
        F.lit("MI").alias("distance_uom"), F.lit(cost).alias("cost_per_unit"),
        F.lit(dt.date(1900, 1, 1)).alias("eff_start_date"), F.lit(dt.date(9999, 12, 31)).alias("eff_end_date"))


def transport_lanes(sites: DataFrame) -> DataFrame:
    """Lanes: nearest hub → each DC; nearest DC → each local site; each DC ↔ its nearest other DC.

    Geo ids come from the site table (``geo_id``), distance from the
    coordinates (miles, 1 decimal). Each child picks one parent by exact
    nearest search, so the lane count is linear in the sites, not pairwise.
    """
    from stockmap.session import materialize, run_side_by_side
    # Read by three searches and three lookups: written once (lineage cut)
    # instead of being derived again for each.
    s = materialize(sites.select("site_id", "site_type", "latitude", "longitude", "geo_id"), "lane-sites")
    hubs = s.where(F.col("site_type") == HUB)
    dcs = s.where(F.col("site_type") == DC)
    locs = s.where(F.col("site_type") == LOCAL)
    geo = s.select(F.col("site_id").alias("_gid"), F.col("geo_id").alias("_geo"))

    def edges(children, parents, exclude_self=False):
        r = assign_parent(children, parents, alias="from_site_id", exclude_self=exclude_self)
        r = r.where(F.col("from_site_id").isNotNull()).select(
            "from_site_id", F.col("site_id").alias("to_site_id"), F.col("geo_id").alias("to_geo_id"),
            F.col("parent_distance_km").alias("_km"))
        return r.join(geo, r.from_site_id == geo._gid, "left").withColumnRenamed("_geo", "from_geo_id").drop("_gid")

    # The three searches are independent: submitted from threads, their jobs
    # run side by side on the cluster instead of one after another.
    found = run_side_by_side(s.sparkSession, lambda: edges(dcs, hubs), lambda: edges(locs, dcs), lambda: edges(dcs, dcs, True))
    hub_dc, dc_loc, near = _lane(found[0], LANE_HUB_DC), _lane(found[1], LANE_DC_LOCAL), found[2]
    both = near.unionByName(near.select(
        F.col("to_site_id").alias("from_site_id"), F.col("from_site_id").alias("to_site_id"),
        F.col("from_geo_id").alias("to_geo_id"), F.col("to_geo_id").alias("from_geo_id"), "_km"))
    dc_dc = _lane(both.dropDuplicates(["from_site_id", "to_site_id"]), LANE_DC_DC)
    return hub_dc.unionByName(dc_loc).unionByName(dc_dc)


# ---------------------------------------------------------------- G9, J8, P11, U1 site dimension

def site_description(city: Column, site_type: Column, zip_code: Column) -> Column:
    """'{city} {Type In Title Case} - ZIP {zip}'."""
    return F.concat(city, F.lit(" "), F.initcap(F.replace(site_type, F.lit("_"), F.lit(" "))),
                    F.lit(" - ZIP "), zip_code)


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, lkey: str, value: str, alias: str,
                        default: str) -> DataFrame:
    """Left join on key → value, else ``default``. The lookup side is reduced to
    one row per key first (smallest value), so duplicates cannot multiply rows."""
    lk = lookup.where(F.col(lkey).isNotNull()).groupBy(F.col(lkey).alias("_lk")).agg(F.min(value).alias("_lv"))
    return (df.join(lk, df[key] == lk["_lk"], "left")
            .withColumn(alias, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv"))


def site_dimension(sites: DataFrame, geography: DataFrame) -> DataFrame:
    """CDM site table. One row per id; when tiers list the same id, the later
    tier wins (local over DC over hub), within a tier the largest row. geo_id: the geography row whose city
    matches, else the state id."""
    rank = _by_tier(F.col("site_type"), TIER_RANK, 0)
    cols = ["site_id", "site_type", "latitude", "longitude", "city"]
    dedup = (sites.select(*cols, rank.alias("_r")).groupBy("site_id")
             .agg(F.max(F.struct(F.col("_r"), *cols[1:])).alias("_s"))
             .select("site_id", *[F.col(f"_s.{c}").alias(c) for c in cols[1:]]))
    geo = geography.where(F.col("city").isNotNull()).select("city", F.col("id").alias("_geo_id"))
    j = lookup_with_default(dedup, geo.withColumnRenamed("city", "_city"), "city", "_city", "_geo_id",
                            "geo_id", STATE_GEO_ID)
    return j.select(
        F.col("site_id").alias("id"), F.lit(CONNECTION_ID).alias("connection_id"),
        site_description(F.col("city"), F.col("site_type"), F.col("site_id")).alias("description"),
        "site_type", "geo_id", "latitude", "longitude", "city", F.lit(STATE).alias("state_prov"),
        F.col("site_id").alias("postal_code"), F.lit(COUNTRY).alias("country"))


# ---------------------------------------------------------------- G10, G11 hierarchies

def hierarchy_closure(spark, nodes: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """(id, ancestor_id, distance) for every node and each of its ancestors, itself at 0.

    Path doubling: with the closure up to distance 2^k - 1 and the jumps of
    exactly 2^k, one join gives the closure up to 2^(k+1) - 1 and one the next
    jumps. A tree of any depth takes a logarithmic number of rounds, each
    written to the shared folder; rows and depth have no limit. A cycle raises
    ``ValueError``: no path is longer than there are distinct ids.
    """
    from stockmap.session import materialize
    rows = [F.count(F.lit(1)).alias("rows")]
    known = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent_id"))
    closure, m = materialize(known.select("id", F.col("id").alias("ancestor_id"), F.lit(0).alias("distance")), "closure", rows)
    longest = 2 * m["rows"]  # a parent may be missing from the table
    jumps, m = materialize(known.where("parent_id IS NOT NULL").select("id", F.col("parent_id").alias("to_id")), "jumps", rows)
    present = known.select(F.col("id").alias("to_id")).distinct()
    step = 1
    while m["rows"]:
        if step > longest:
            raise ValueError(f"the hierarchy of {id_col} and {parent_col} has a cycle")
        far = closure.select(F.col("id").alias("to_id"), "ancestor_id", (F.col("distance") + step).alias("distance"))
        more = jumps.join(far, "to_id").select("id", "ancestor_id", "distance")
        lone = jumps.join(present, "to_id", "left_anti").select("id", F.col("to_id").alias("ancestor_id"), F.lit(step).alias("distance"))
        closure = materialize(closure.unionByName(more).unionByName(lone), "closure")
        onward = jumps.select(F.col("id").alias("to_id"), F.col("to_id").alias("end_id"))
        jumps, m = materialize(jumps.join(onward, "to_id").select("id", F.col("end_id").alias("to_id")), "jumps", rows)
        step *= 2
    return closure


# ---------------------------------------------------------------- G13, U2 trading partners

def trading_partners(vendors: DataFrame, customers: DataFrame, warehouses: DataFrame | None = None,
                     cdm: bool = True) -> DataFrame:
    """Suppliers, warehouses, the internal transfer partner and customers, tagged by type.

    Inputs carry (id, description, city[, state_prov]); old field names
    (name, state) are mapped first.
    """
    from stockmap.operators.conform import cdm_rename

    def part(df, tag, geo, default_state):
        d = cdm_rename(df, "trading_partner")
        st = F.col("state_prov") if "state_prov" in d.columns else F.lit(default_state)
        out = d.select("id", "description", F.lit(tag).alias("tpartner_type"), "city",
                       st.cast("string").alias("state_prov"), F.lit(COUNTRY).alias("country"))
        if cdm:
            out = out.select("*", F.lit(geo).alias("geo_id"), F.lit(OPEN_START_TS).alias("eff_start_date"),
                             F.lit(OPEN_END_TS).alias("eff_end_date"))
        return out

    parts = [part(vendors, "SUPPLIER", "GEO-US", None)]
    if warehouses is not None:
        parts.append(part(warehouses, "WAREHOUSE", "GEO-US", None))
    spark = vendors.sparkSession
    internal = spark.createDataFrame([(INTERNAL_PARTNER, "Internal Stock Transfer", "Seattle", STATE)],
                                     "id string, description string, city string, state_prov string")
    parts.append(part(internal, "INTERNAL", "GEO-US-WA", STATE))
    parts.append(part(customers, "CUSTOMER", "GEO-US-WA", STATE))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- G6, G7, T7, U3 inbound orders

def _numbered(df: DataFrame, order_col: str, name: str = "_i") -> DataFrame:
    return row_number_global(df, [order_col], name)


def first_hub(sites: DataFrame) -> str | None:
    """The hub with the smallest id: one aggregate, one value to the driver."""
    return sites.where(F.col("site_type") == HUB).agg(F.min("site_id").alias("hub_id")).first()["hub_id"]


def inbound_orders(vendors: DataFrame, sites: DataFrame) -> DataFrame:
    """Vendor POs (first IN_TRANSIT, rest PENDING), one hub→DC transfer per DC
    (APPROVED), one DC→local transfer per local site (PENDING)."""
    v = _numbered(vendors.select("id", "seq"), "seq")
    po = v.select(F.format_string(f"{ID_PREFIX}-VENDOR-PO-%03d", "_i").alias("id"),
                  F.col("id").alias("tpartner_id"), F.lit("PURCHASE_ORDER").alias("order_type"),
                  F.when(F.col("_i") == 1, "IN_TRANSIT").otherwise("PENDING").alias("order_status"))
    dcs = _numbered(sites.where(F.col("site_type") == DC).select("site_id"), "site_id")
    to_dc = dcs.select(F.format_string(f"{ID_PREFIX}-TRANSFER-TO-%03d", "_i").alias("id"),
                       F.lit(INTERNAL_PARTNER).alias("tpartner_id"), F.lit("STOCK_TRANSFER").alias("order_type"),
                       F.lit("APPROVED").alias("order_status"))
    locs = _numbered(sites.where(F.col("site_type") == LOCAL).select("site_id"), "site_id")
    to_loc = locs.select(F.format_string(f"{ID_PREFIX}-LOCAL-TO-%03d", "_i").alias("id"),
                         F.lit(INTERNAL_PARTNER).alias("tpartner_id"), F.lit("STOCK_TRANSFER").alias("order_type"),
                         F.lit("PENDING").alias("order_status"))
    out = po.unionByName(to_dc).unionByName(to_loc)
    return out.select("id", F.lit(CONNECTION_ID).alias("connection_id"), "tpartner_id", "order_type", "order_status")


def inbound_order_lines(vendors: DataFrame, sites: DataFrame, as_of) -> DataFrame:
    """One line per order: PO qty 5000+1000·i to the first hub, due as_of + lead time;
    DC transfers 2000 due +2 days; local transfers 500 due +1 day."""
    d0 = _date(as_of)
    hub = first_hub(sites)
    v = _numbered(vendors.select("id", "seq", "lead_time_days"), "seq").withColumn("hub_id", F.lit(hub).cast("string"))
    po = v.select(F.format_string(f"{ID_PREFIX}-VENDOR-PO-%03d", "_i").alias("order_id"),
                  F.col("id").alias("tpartner_id"), (F.lit(PO_BASE_QTY) + F.lit(PO_STEP_QTY) * F.col("_i"))
                  .cast("bigint").alias("quantity_submitted"), F.col("hub_id").alias("to_site_id"),
                  F.date_add(d0, F.col("lead_time_days")).alias("expected_delivery_date"))
    dcs = _numbered(sites.where(F.col("site_type") == DC).select("site_id"), "site_id")
    to_dc = dcs.select(F.format_string(f"{ID_PREFIX}-TRANSFER-TO-%03d", "_i").alias("order_id"),
                       F.lit(INTERNAL_PARTNER).alias("tpartner_id"), F.lit(DC_TRANSFER_QTY).cast("bigint")
                       .alias("quantity_submitted"), F.col("site_id").alias("to_site_id"),
                       F.date_add(d0, DC_TRANSFER_DAYS).alias("expected_delivery_date"))
    locs = _numbered(sites.where(F.col("site_type") == LOCAL).select("site_id"), "site_id")
    to_loc = locs.select(F.format_string(f"{ID_PREFIX}-LOCAL-TO-%03d", "_i").alias("order_id"),
                         F.lit(INTERNAL_PARTNER).alias("tpartner_id"), F.lit(LOCAL_TRANSFER_QTY).cast("bigint")
                         .alias("quantity_submitted"), F.col("site_id").alias("to_site_id"),
                         F.date_add(d0, LOCAL_TRANSFER_DAYS).alias("expected_delivery_date"))
    out = po.unionByName(to_dc).unionByName(to_loc)
    return out.select(
        F.concat("order_id", F.lit("-LINE-001")).alias("id"), "order_id", F.lit(CONNECTION_ID).alias("connection_id"),
        "tpartner_id", F.lit(PRODUCT_ID).alias("product_id"), "quantity_submitted", "to_site_id",
        F.lit(UOM).alias("quantity_uom"), F.lit("OPEN").alias("status"), "expected_delivery_date")


# ---------------------------------------------------------------- J6, G8 outbound demand

def fulfilment_site(customers: DataFrame, sites: DataFrame) -> DataFrame:
    """Customer → first site in the same city (hub, then DC, then local; then smallest id), else the first hub.

    Sites are reduced to one candidate per city before the join, so a city
    holding many sites never multiplies the customer rows.
    """
    rank = _by_tier(F.col("site_type"), TIER_RANK, 9)
    per_city = (sites.where(F.col("city").isNotNull())
                .groupBy(F.col("city").alias("_city"))
                .agg(F.min(F.struct(rank.alias("r"), F.col("site_id").alias("s"))).alias("_b"))
                .select("_city", F.col("_b.s").alias("_site")))
    hub = first_hub(sites)
    j = customers.join(per_city, customers["city"] == per_city["_city"], "left")
    return j.withColumn("ship_from_site_id", F.coalesce("_site", F.lit(hub).cast("string"))).drop("_city", "_site")


def outbound_demand(customers: DataFrame, sites: DataFrame, as_of) -> DataFrame:
    """Two lines per customer: NORMAL (ordered 30 days ago, due −28, FULFILLED)
    and SPIKE (ordered as_of, due +1, PENDING); quantities by customer type."""
    d0 = _date(as_of)
    c = fulfilment_site(customers, sites)
    hosp = F.col("customer_type") == "HOSPITAL"
    normal_q = F.when(hosp, DEMAND_QTY["HOSPITAL"][0]).otherwise(DEMAND_QTY_OTHER[0])
    spike_q = F.when(hosp, DEMAND_QTY["HOSPITAL"][1]).otherwise(DEMAND_QTY_OTHER[1])
    kinds = F.array(
        F.struct(F.lit("NORMAL").alias("k"), normal_q.alias("q"), F.date_sub(d0, 30).alias("od"),
                 F.date_sub(d0, 28).alias("rd"), F.lit("FULFILLED").alias("st")),
        F.struct(F.lit("SPIKE").alias("k"), spike_q.alias("q"), d0.alias("od"),
                 F.date_add(d0, 1).alias("rd"), F.lit("PENDING").alias("st")))
    e = c.select("id", "seq", "ship_from_site_id", F.explode(kinds).alias("_o"))
    n = padded(F.col("seq"), 3)  # pads, never cuts
    return e.select(
        F.concat(F.lit("OUT-"), "id", F.lit("-"), "_o.k", F.lit("-"), n).alias("id"),
        F.concat(F.lit("CUST-ORDER-"), n, F.lit("-"), "_o.k").alias("cust_order_id"),
        F.lit(CONNECTION_ID).alias("connection_id"), F.lit(PRODUCT_ID).alias("product_id"),
        F.col("id").alias("customer_tpartner_id"), F.col("_o.q").cast("bigint").alias("init_quantity_requested"),
        F.lit(UOM).alias("quantity_uom"), F.col("_o.od").alias("order_date"),
        F.col("_o.rd").alias("requested_delivery_date"), F.col("_o.st").alias("status"), "ship_from_site_id")


# ---------------------------------------------------------------- G12 shipments

def shipments(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """A shipment per line of an IN_TRANSIT or APPROVED order.

    IN_TRANSIT: shipped order_date − 1, due + 2, no actual date. APPROVED:
    DELIVERED, shipped − 2, planned and actual − 1. Lines and orders meet in
    one shuffle join on order id.
    """
    o = orders.select(F.col("id").alias("order_id"), F.col("tpartner_id").alias("supplier_tpartner_id"),
                      "order_status", "order_date").where(F.col("order_status").isin("IN_TRANSIT", "APPROVED"))
    j = lines.join(o, "order_id")
    delivered = F.col("order_status") == "APPROVED"
    d = F.col("order_date")
    return j.select(
        F.concat(F.lit("SHIP-"), F.col("id")).alias("id"), "supplier_tpartner_id",
        F.lit(CONNECTION_ID).alias("connection_id"), "product_id", "order_id", F.col("id").alias("order_line_id"),
        F.concat(F.lit("PKG-"), F.col("id")).alias("package_id"), "ship_from_site_id",
        F.col("to_site_id").alias("ship_to_site_id"),
        F.when(delivered, F.date_sub(d, 2)).otherwise(F.date_sub(d, 1)).alias("planned_ship_date"),
        F.when(delivered, F.date_sub(d, 1)).otherwise(F.date_add(d, 2)).alias("planned_delivery_date"),
        F.when(delivered, F.date_sub(d, 1)).alias("actual_delivery_date"),
        F.when(delivered, "DELIVERED").otherwise("IN_TRANSIT").alias("shipment_status"))


def geography_dim(geography: DataFrame) -> DataFrame:
    """CDM geography: rows of different shapes unioned by name (missing → null)."""
    country = geography.where(F.col("level") == "country").select(
        "id", F.lit(CONNECTION_ID).alias("connection_id"), F.col("id").alias("description"), "parent_geo_id",
        F.lit(COUNTRY).alias("country"))
    state = geography.where(F.col("level") == "state").select(
        "id", F.lit(CONNECTION_ID).alias("connection_id"), F.col("id").alias("description"), "parent_geo_id",
        F.lit(STATE).alias("state_prov"), F.lit(COUNTRY).alias("country"))
    metro = geography.where(F.col("level") == "metro").select(
        "id", F.lit(CONNECTION_ID).alias("connection_id"),
        F.concat(F.col("city"), F.lit(" Metro Area")).alias("description"), "parent_geo_id", "city",
        F.lit(STATE).alias("state_prov"), F.lit(COUNTRY).alias("country"))
    return country.unionByName(state, allowMissingColumns=True).unionByName(metro, allowMissingColumns=True) \
        .select("id", "connection_id", "description", "parent_geo_id", "country", "state_prov", "city")
