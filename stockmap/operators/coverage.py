"""Coverage analysis: who can reach stock, how far, and how much per head.

Inputs (DataFrames):
  centroids   zip_code, latitude, longitude
  census      zip_code plus numeric-as-string columns
  zone_pop    zip_code, latitude, longitude, total_pop, [median_income, poverty_rate]
  inv_level   site_id, product_id, on_hand_inventory
  site        id (or site_id), latitude, longitude, city, state_prov

Every function is lazy. Aggregations pre-aggregate before their joins, so the
large stock table is reduced to one row per site before it meets anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmap.functions.geo import haversine_km, km_to_miles
from stockmap.plans.nearest import nearest_site
from stockmap.plans.numbering import running_total
from stockmap.session import materialize
from stockmap.sources.files import finite_or_null

# Two-digit ZIP prefixes per state (coarse; no state boundary test).
STATE_ZIP_PREFIXES = {
    "TX": ("75", "76", "77", "78", "79"),
    "CA": ("90", "91", "92", "93", "94", "95", "96"),
    "FL": ("32", "33", "34"),
    "NY": ("10", "11", "12", "13", "14"),
    "WA": ("98", "99"),
}
# Stock classes in doses per 1,000 people.
WELL_STOCKED_ABOVE = 100.0
UNDERSTOCKED_BELOW = 50.0

SITE_DETAIL_COLS = ("zip_code", "latitude", "longitude", "city", "state_prov")


# ---------------------------------------------------------------- zones

def prefixes_for(states: Iterable[str], table: dict[str, Sequence[str]] | None = None) -> list[str]:
    table = table or STATE_ZIP_PREFIXES
    return [p for s in states for p in table[s]]


def zip_prefix_filter(df: DataFrame, states: Iterable[str] = ("WA",), zip_col: str = "zip_code",
                      prefixes: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose ZIP starts with a prefix of the chosen states.

    One ``startswith`` for each prefix: where the ZIP is a column of the file,
    the scan gets them as ``StringStartsWith`` filters and skips row groups.
    A derived ZIP would be computed anew for each of them; so its start is
    looked up in the set of prefixes before, once for each length.
    """
    prefixes = list(prefixes) if prefixes is not None else prefixes_for(states)
    cond, found = F.lit(False), F.lit(False)
    for p in sorted(set(prefixes)):
        cond = cond | F.col(zip_col).startswith(p)
    for n in sorted({len(p) for p in prefixes}):
        found = found | F.substring(zip_col, 1, n).isin(*sorted({p for p in prefixes if len(p) == n}))
    return df.where(found).where(cond)


def zip_centroids(gazetteer: DataFrame, states: Iterable[str] = ("WA",),
                  prefixes: Sequence[str] | None = None) -> DataFrame:
    """Gazetteer rows → (zip_code, latitude, longitude) for the chosen states."""
    g = gazetteer.select(F.col("GEOID").cast("string").alias("zip_code"),
                         F.col("INTPTLAT").cast("double").alias("latitude"),
                         F.col("INTPTLONG").cast("double").alias("longitude"))
    return zip_prefix_filter(g, states, prefixes=prefixes)


def coerce_numeric(df: DataFrame, cols: Sequence[str], negatives_as_null: bool = False) -> DataFrame:
    """Strings → double; anything unparsable ('-', '', junk) and the text ``NaN`` → null. Never raises."""
    out = {}
    for c in cols:
        v = finite_or_null(F.col(c).cast("string").try_cast("double"))
        if negatives_as_null:
            v = F.when(v >= 0, v)
        out[c] = v
    return df.withColumns(out)


# Census field codes.
CENSUS_RENAMES = {
    "DP03_0062E": "median_income",
    "DP03_0128PE": "poverty_rate",
    "DP03_0001E": "labor_force",
    "DP05_0001E": "total_pop",
    "zip code tabulation area": "zip_code",
}


def zip_population(census: DataFrame, centroids: DataFrame, states: Iterable[str] = ("WA",),
                   prefixes: Sequence[str] | None = None, negatives_as_null: bool = False) -> DataFrame:
    """Census ⟕ centroids on zip_code → zip_code, latitude, longitude, total_pop, median_income, poverty_rate.

    The state filter runs on both sides before the join; the centroid side is
    pruned to three columns. ZIPs without a centroid keep null coordinates.
    """
    c = census.withColumnsRenamed({k: v for k, v in CENSUS_RENAMES.items() if k in census.columns})
    c = zip_prefix_filter(c, states, prefixes=prefixes)
    num = [x for x in ("median_income", "poverty_rate", "labor_force", "total_pop") if x in c.columns]
    c = coerce_numeric(c, num, negatives_as_null)
    cen = zip_prefix_filter(centroids.select("zip_code", "latitude", "longitude"), states, prefixes=prefixes)
    j = c.join(cen, "zip_code", "left")
    return j.select("zip_code", "latitude", "longitude", "total_pop", "median_income", "poverty_rate")


# ---------------------------------------------------------------- stock

def _site_details(site: DataFrame) -> DataFrame:
    key = "site_id" if "site_id" in site.columns else "id"
    s = site.select(F.col(key).cast("string").alias("site_id"), "latitude", "longitude", "city", "state_prov")
    return s


def current_stocks(inv_level: DataFrame, site: DataFrame) -> DataFrame:
    """Stock per site: site_id, zip_code, latitude, longitude, city, state_prov, total_doses, product_count.

    Stock rows are summed per site_id first (map-side partial aggregate, so
    a hot site costs one row per task), then joined to the site details. Groups
    with any null key are dropped, as a group-by on null keys would drop them:
    unknown sites and sites without coordinates, city or state. See
    :func:`orphan_stock`. ``product_count`` counts non-null product rows.
    """
    per_site = (inv_level.where(F.col("site_id").isNotNull())
                .groupBy(F.col("site_id").cast("string").alias("site_id"))
                .agg(F.sum("on_hand_inventory").cast("bigint").alias("total_doses"),
                     F.count("product_id").alias("product_count")))
    det = _site_details(site)
    j = per_site.join(det, "site_id")
    j = j.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                & F.col("city").isNotNull() & F.col("state_prov").isNotNull())
    return j.select("site_id", F.col("site_id").alias("zip_code"), "latitude", "longitude", "city",
                    "state_prov", "total_doses", "product_count")


def orphan_stock(inv_level: DataFrame, site: DataFrame) -> DataFrame:
    """Stock whose site_id has no site row: site_id, total_doses, product_count (per unknown site).

    Pre-aggregated per site before the anti join, so its shuffle carries one
    row per (task, site) instead of every stock row.
    """
    per_site = (inv_level.groupBy(F.col("site_id").cast("string").alias("site_id"))
                .agg(F.sum("on_hand_inventory").cast("bigint").alias("total_doses"),
                     F.count("product_id").alias("product_count")))
    known = _site_details(site).select("site_id")
    return per_site.join(known, "site_id", "left_anti")


# ---------------------------------------------------------------- access

def access_by_zip(zone_pop: DataFrame, stocks: DataFrame, *, levels=None, details: bool = False,
                  zone_cols: Sequence[str] = ()) -> DataFrame:
    """Nearest stocked site per ZIP.

    Columns: zip_code, latitude, longitude, population, nearest_site_id,
    nearest_site_zip, distance_km, distance_miles, total_doses. A ZIP without
    coordinates is kept with null site and distance. The site's doses travel
    inside the nearest-site search, so there is no second join. With
    ``details`` the site's latitude, longitude, city and state also travel
    (as ``site_*`` columns), so per-site metrics need no join back to the
    stock table (which would recompute it). ``zone_cols`` are zone columns
    kept on each row (the search keeps every zone row as it is).
    """
    z = zone_pop.select("zip_code", "latitude", "longitude", F.col("total_pop").alias("population"), *zone_cols)
    extra = ("site_latitude", "site_longitude", "site_city", "site_state_prov") if details else ()
    s = stocks.select("site_id", F.col("zip_code").alias("site_zip"), "latitude", "longitude", "total_doses",
                      *([F.col("latitude").alias("site_latitude"), F.col("longitude").alias("site_longitude"),
                         F.col("city").alias("site_city"), F.col("state_prov").alias("site_state_prov")]
                        if details else []))
    r = nearest_site(z, s, site_key="site_id", carry=("site_zip", "total_doses", *extra), levels=levels)
    return r.select("zip_code", "latitude", "longitude", "population", "nearest_site_id",
                    F.col("site_zip").alias("nearest_site_zip"), "distance_km",
                    km_to_miles("distance_km").alias("distance_miles"), "total_doses", *extra, *zone_cols)


def site_metrics(access: DataFrame) -> DataFrame:
    """Per nearest site: total_population_served, pop_weighted_distance_km, zip_codes_served,
    total_doses, doses_per_1000_people (+ site details when the access rows carry them).

    ZIPs without a site are left out. Null populations add nothing to the weights
    but the ZIP still counts. A zero population gives null ratios, not an error.
    """
    a = access.where(F.col("nearest_site_id").isNotNull())
    w = F.col("population")
    carried = [c for c in ("nearest_site_zip", "site_latitude", "site_longitude", "site_city", "site_state_prov")
               if c in access.columns]
    g = a.groupBy("nearest_site_id").agg(
        F.sum(w).cast("bigint").alias("total_population_served"),
        F.sum(F.when(w.isNotNull(), F.col("distance_km") * w)).alias("_wd"),
        F.sum(F.when(w.isNotNull() & F.col("distance_km").isNotNull(), w)).alias("_w"),
        F.count("zip_code").alias("zip_codes_served"),
        F.min("total_doses").alias("total_doses"),
        *[F.min(c).alias(c) for c in carried],  # constant per site
    )
    return g.select(
        "nearest_site_id", "total_population_served",
        F.try_divide(F.col("_wd"), F.nullif(F.col("_w").cast("double"), F.lit(0.0))).alias("pop_weighted_distance_km"),
        "zip_codes_served", "total_doses",
        (F.try_divide(F.col("total_doses").cast("double"),
                      F.nullif(F.col("total_population_served").cast("double"), F.lit(0.0))) * 1000)
        .alias("doses_per_1000_people"), *carried,
    )


def access_by_site(access: DataFrame, stocks: DataFrame | None = None) -> DataFrame:
    """Site metrics with site details (zip_code, latitude, longitude, city, state_prov).

    When ``access`` came from ``access_by_zip(..., details=True)`` the details
    are already on every row and no join is needed. Otherwise they are joined
    from ``stocks`` (left join, one row per site).
    """
    m = site_metrics(access)
    out_cols = ["nearest_site_id", "total_population_served", "pop_weighted_distance_km", "zip_codes_served",
                "total_doses", "doses_per_1000_people", F.col("nearest_site_id").alias("site_id")]
    if "site_latitude" in m.columns:
        return m.select(*out_cols, F.col("nearest_site_zip").alias("zip_code"),
                        F.col("site_latitude").alias("latitude"), F.col("site_longitude").alias("longitude"),
                        F.col("site_city").alias("city"), F.col("site_state_prov").alias("state_prov"))
    det = stocks.select(F.col("site_id").alias("nearest_site_id"), *SITE_DETAIL_COLS)
    return m.drop("nearest_site_zip").join(det, "nearest_site_id", "left").select(*out_cols, *SITE_DETAIL_COLS)


# ---------------------------------------------------------------- summaries

def stock_summary(stocks: DataFrame) -> DataFrame:
    return stocks.agg(
        F.count(F.lit(1)).alias("sites"),
        F.sum("total_doses").cast("bigint").alias("total_doses"),
        F.avg("total_doses").alias("mean_doses"),
        F.min("total_doses").alias("min_doses"),
        F.max("total_doses").alias("max_doses"),
    )


def coverage_summary(access: DataFrame) -> DataFrame:
    return access.agg(
        F.count(F.lit(1)).alias("zip_codes"),
        F.sum("population").cast("bigint").alias("total_population"),
        F.avg("distance_miles").alias("mean_distance_miles"),
        F.max("distance_miles").alias("max_distance_miles"),
    )


def site_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("sites"),
        F.sum("total_doses").cast("bigint").alias("total_doses"),
        F.avg("total_population_served").alias("mean_population_served"),
        F.avg("doses_per_1000_people").alias("mean_doses_per_1000"),
    )


# ---------------------------------------------------------------- top-N

def _ranked(metrics: DataFrame, n: int, ascending: bool) -> DataFrame:
    v = F.col("doses_per_1000_people")
    order = [v.asc_nulls_last() if ascending else v.desc_nulls_last(), F.col("nearest_site_id").asc()]
    # Top-k is the feature here: a global order plus limit plans as
    # TakeOrderedAndProject (per-task top-k, then merge of k rows per task).
    top = metrics.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def best_stocked(metrics: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(metrics, n, ascending=False)


def most_understocked(metrics: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(metrics, n, ascending=True)


# ---------------------------------------------------------------- decisions

def stock_class(metrics: DataFrame, well_above: float = WELL_STOCKED_ABOVE,
                under_below: float = UNDERSTOCKED_BELOW) -> DataFrame:
    v = F.col("doses_per_1000_people")
    return metrics.withColumn(
        "stock_class",
        F.when(v > well_above, "WELL_STOCKED").when(v < under_below, "UNDERSTOCKED")
        .when(v.isNotNull(), "BETWEEN"))


def coverage_gaps(access: DataFrame, max_km: float = 80.0) -> DataFrame:
    """ZIPs whose nearest stock is farther than ``max_km`` or unknown."""
    d = F.col("distance_km")
    return access.where(d.isNull() | (d > max_km)).withColumn(
        "gap_reason", F.when(finite_or_null(F.col("latitude")).isNull() | finite_or_null(F.col("longitude")).isNull(), "NO_LOCATION")
        .when(d.isNull(), "NO_SITE").otherwise("TOO_FAR"))


def restock_priority(metrics: DataFrame, target_per_1000: float = 100.0) -> DataFrame:
    """need = max(0, target·population/1000 − doses); priority 1, 2, … by need desc, site_id.

    The ranking covers every site, so it uses the range-sorted global
    numbering rather than a window without partitions (one task).
    """
    from stockmap.plans.numbering import row_number_global
    need = F.greatest(F.lit(0.0), F.lit(target_per_1000) * F.col("total_population_served") / 1000
                      - F.coalesce(F.col("total_doses"), F.lit(0)))
    m = metrics.withColumn("restock_need", need)
    return row_number_global(m, [F.col("restock_need").desc(), F.col("nearest_site_id")], "priority")


def exact_cut_points(df: DataFrame, col: str, probs: Sequence[float]) -> list:
    """Exact discrete quantiles: for each p, the value at rank ceil(n·p) in sorted order.

    Distributed and exact at any size: equal values are counted first, the
    distinct ones are range-sorted with running counts (``plans.numbering``),
    and only the wanted ones reach the driver. No task holds all the values
    (unlike an exact percentile aggregate), and nothing is approximated
    (unlike a sketch).
    """
    import math
    v = materialize(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "cut-values")
    n = v.agg(F.sum("_n")).first()[0]
    if not n:
        return [None for _ in probs]
    ranks = [max(1, math.ceil(n * p)) for p in probs]
    upto = running_total(v, ["_v"], "_n", "_upto")
    got = upto.agg(*[F.min(F.when(F.col("_upto") >= r, F.col("_v"))).alias(f"c{i}") for i, r in enumerate(ranks)]).first()
    return list(got)


def _quantile_band(df: DataFrame, col: str, n: int = 4) -> Column:
    """Band 1..n from exact quantile cut points (value ≤ cut i → band i)."""
    cuts = exact_cut_points(df, col, [i / n for i in range(1, n)])
    band = F.lit(n)
    for i in reversed(range(n - 1)):
        band = F.when(F.col(col) <= F.lit(cuts[i]), F.lit(i + 1)).otherwise(band)
    return F.when(F.col(col).isNotNull(), band)


def equity_by(access: DataFrame, by: str, bands: int = 4) -> DataFrame:
    """Zones, population and population-weighted distance per quantile band of ``by``.

    ``by`` (median income, poverty rate) must be on the access rows: pass it
    through ``access_by_zip(..., zone_cols=[by])``. Each zone row then keeps its
    own value, with no join on ZIP codes that might repeat.
    """
    a = access.withColumn("band", _quantile_band(access, by, bands))
    w = F.col("population")
    g = a.where(F.col("band").isNotNull()).groupBy("band").agg(
        F.count("zip_code").alias("zip_codes"),
        F.sum(w).cast("bigint").alias("population"),
        F.try_divide(F.sum(F.when(w.isNotNull(), F.col("distance_km") * w)),
                     F.nullif(F.sum(F.when(F.col("distance_km").isNotNull(), w)).cast("double"), F.lit(0.0)))
        .alias("pop_weighted_distance_km"),
    )
    return g


def transshipment_pairs(metrics: DataFrame, stocks: DataFrame | None = None, target_per_1000: float = 75.0,
                        max_km: float = 250.0) -> DataFrame:
    """Nearest surplus site for each deficit site, within ``max_km``.

    surplus = doses − target·pop/1000 (> 0 donors), deficit = the opposite.
    Donor search is the grid nearest-site plan, not an all-pairs join. Each
    receiver is looked at alone: several may name the same donor, whose surplus
    does not last for all (``allocation.allocate_transfers`` shares it out).
    """
    if "latitude" in metrics.columns and stocks is None:
        m = metrics
    else:
        m = metrics.drop("latitude", "longitude").join(
            stocks.select(F.col("site_id").alias("nearest_site_id"), "latitude", "longitude"), "nearest_site_id")
    bal = m.withColumn("balance", F.col("total_doses") - F.lit(target_per_1000) * F.col("total_population_served") / 1000)
    # One row per site, read by both sides of the search: written once.
    bal = materialize(bal.select("nearest_site_id", "latitude", "longitude", "balance"), "transship-balance")
    donors = bal.where(F.col("balance") > 0).select(
        F.col("nearest_site_id").alias("donor_site_id"), "latitude", "longitude",
        F.col("balance").alias("donor_surplus"))
    receivers = bal.where(F.col("balance") < 0).select(
        F.col("nearest_site_id").alias("receiver_site_id"), "latitude", "longitude",
        (-F.col("balance")).alias("receiver_deficit"))
    r = nearest_site(receivers, donors, site_key="donor_site_id", carry=("donor_surplus",),
                     key_alias="donor_site_id", distance_alias="distance_km")
    r = r.where(F.col("distance_km") <= max_km)
    return r.select("receiver_site_id", "receiver_deficit", "donor_site_id", "donor_surplus", "distance_km",
                    F.least("receiver_deficit", "donor_surplus").alias("transfer_qty"))


#: Cells of the radius join: 360 / 2**level degrees, from 90 degrees to about 2 m.
_COARSEST, _FINEST = 2, 24


def zone_probes(zones: DataFrame) -> DataFrame:
    """``zones`` (z_lat, z_lon, d_now, …) with the cells (level, ci, cj) each has to look at.

    A zone's level follows its own radius: the finest whose cells are no
    smaller than the half-widths of its circle, so it looks at nine cells at
    most. A circle that holds a pole takes the 90-degree cells (at most twenty).
    """
    r_rad = F.col("d_now") / F.lit(6371.0)
    r = F.degrees(r_rad)
    # Exact longitude half-width of a spherical cap: asin(sin r / cos φ); the
    # cap holds a pole (whole band) when that ratio reaches 1.
    ratio = F.sin(r_rad) / F.cos(F.radians(F.col("z_lat")))
    z = zones.withColumns({"_r": r, "_whole": (ratio >= 1) | (F.abs(F.col("z_lat")) + r >= 90),
                           "_rl": F.degrees(F.asin(F.least(F.lit(1.0), ratio)))})
    half = F.greatest("_r", "_rl", F.lit(360.0 / 2 ** _FINEST))
    level = F.when(F.col("_whole"), _COARSEST).otherwise(F.greatest(F.lit(_COARSEST), F.least(
        F.lit(_FINEST), F.floor(F.log2(F.lit(360.0) / half)).cast("int"))))
    z = z.withColumn("level", level).withColumn("_c", F.lit(360.0) / F.pow(F.lit(2.0), F.col("level")))
    n = F.pow(F.lit(2.0), F.col("level")).cast("int")
    south, north = F.greatest(F.lit(-90.0), F.col("z_lat") - F.col("_r")), F.least(F.lit(90.0), F.col("z_lat") + F.col("_r"))
    lon_lo = F.when(F.col("_whole"), F.lit(0)).otherwise(F.floor((F.col("z_lon") - F.col("_rl")) / F.col("_c")).cast("int"))
    lon_hi = F.when(F.col("_whole"), n - 1).otherwise(F.floor((F.col("z_lon") + F.col("_rl")) / F.col("_c")).cast("int"))
    z = z.withColumn("ci", F.explode(F.sequence(F.floor(south / F.col("_c")).cast("int"), F.floor(north / F.col("_c")).cast("int"))))
    z = z.withColumn("_j", F.explode(F.sequence(lon_lo, lon_hi)))
    return z.withColumn("cj", F.pmod(F.col("_j"), n)).drop("_r", "_whole", "_rl", "_c", "_j")


def located_zones(access: DataFrame) -> DataFrame:
    """One row for each location and distance of zones that have people and a site: z_lat, z_lon, d_now, pop, zones."""
    return access.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                        & F.col("distance_km").isNotNull() & (F.col("population") > 0)).groupBy(
        F.col("latitude").alias("z_lat"), F.col("longitude").alias("z_lon"), F.col("distance_km").alias("d_now")).agg(
        F.sum("population").alias("pop"), F.count(F.lit(1)).alias("zones"))


def cell_levels(points: DataFrame, lat: str, lon: str, levels: Sequence[int] | None = None) -> DataFrame:
    """``points`` with their cell (level, ci, cj) on each of ``levels`` (all by default)."""
    levels = list(range(_COARSEST, _FINEST + 1)) if levels is None else list(levels) or [_COARSEST]
    c = F.lit(360.0) / F.pow(F.lit(2.0), F.col("level"))
    return points.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]))).withColumns({
        "ci": F.floor(F.col(lat) / c).cast("int"),
        "cj": F.pmod(F.floor(F.col(lon) / c).cast("int"), F.pow(F.lit(2.0), F.col("level")).cast("int"))})


def gains_near(probes: DataFrame, candidates: DataFrame, levels: Sequence[int], chosen: Sequence[tuple[float, float]] = ()) -> DataFrame:
    """Gain of each candidate over the zones in its reach, where sites also stand at the ``chosen`` (latitude, longitude)."""
    cand = cell_levels(candidates.select("candidate_id", F.col("latitude").alias("c_lat"), F.col("longitude").alias("c_lon")), "c_lat", "c_lon", levels)
    now = F.col("d_now")
    if chosen:
        now = F.least(now, *[haversine_km("z_lat", "z_lon", F.lit(la), F.lit(lo)) for la, lo in chosen])
    pairs = probes.join(cand, ["level", "ci", "cj"]).withColumns({"d": haversine_km("z_lat", "z_lon", "c_lat", "c_lon"), "now": now})
    pairs = pairs.where(F.col("d") < F.col("now"))
    return pairs.groupBy("candidate_id", "c_lat", "c_lon").agg(
        F.sum("zones").alias("zones_helped"),
        F.sum("pop").cast("bigint").alias("population_helped"),
        F.sum(F.col("pop") * (F.col("now") - F.col("d"))).alias("gain"))


def candidate_gains(access: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per candidate location: zones it would bring closer and the population-weighted gain.

    For a zone at current distance d_now, a candidate at distance d < d_now
    gains pop·(d_now − d). Zones at one location are one row. Pairs come from
    a grid join: each zone looks at the few cells that its own circle touches,
    on the level that fits its radius, and each candidate stands in one cell
    of every level in use (at most 23), so one far zone costs no more cells
    than a near one.
    """
    probes = materialize(zone_probes(located_zones(access)), "candidate-probes")
    levels = sorted(r["level"] for r in probes.select("level").distinct().collect())  # 23 values at most
    return gains_near(probes, candidates, levels)


def candidate_sites(access: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """Top-k candidate locations by reduction of the population-weighted distance.

    new_wd = (Σ pop·d_now − gain) / Σ pop over zones with a site and population.
    """
    # Read twice below (gains, baseline): written once.
    access = materialize(access.select("zip_code", "latitude", "longitude", "population", "distance_km"),
                         "candidate-access")
    g = candidate_gains(access, candidates)
    base = access.where(F.col("distance_km").isNotNull() & (F.col("population") > 0)).agg(
        F.sum(F.col("population") * F.col("distance_km")).alias("_wd"),
        F.sum("population").cast("double").alias("_w")).first()
    order = [F.col("gain").desc(), F.col("candidate_id")]
    top = g.orderBy(*order).limit(k)
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    wd, w = base["_wd"], base["_w"]
    return top.select(
        "rank", "candidate_id", F.col("c_lat").alias("latitude"), F.col("c_lon").alias("longitude"),
        "zones_helped", "population_helped", "gain",
        ((F.lit(wd) - F.col("gain")) / F.lit(w)).alias("new_pop_weighted_distance_km") if w else
        F.lit(None).cast("double").alias("new_pop_weighted_distance_km"))
