"""Decisions over many sites at once: who gives how much to whom, and where several new sites go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockmap.functions.geo import haversine_km
from stockmap.operators.coverage import cell_levels, gains_near, located_zones, zone_probes
from stockmap.session import materialize

#: Candidate pairs that one ring of distances may have (see ``allocate_transfers``).
RING_PAIRS = 20_000_000
#: Candidate pairs that a ring should have for each site that still needs or gives, but for small rings of ``RING_LEAST``.
RING_PAIRS_PER_SITE, RING_LEAST = 64, 400_000
#: Rounds between two writes of the open pairs.
ROUNDS_PER_WRITE = 2
#: Rings are not made narrower than this many km.
NARROWEST = 1.0

_TRANSFERS = "receiver_site_id string, donor_site_id string, distance_km double, quantity bigint, receiver_need bigint, donor_surplus bigint"


def _meeting(receivers: DataFrame, donors: DataFrame, radius: float, counted: bool) -> DataFrame:
    """Receivers and donors that share a cell of the grid for ``radius``: the pairs, or (``counted``) only their number."""
    probes = zone_probes(receivers.withColumnsRenamed({"r_lat": "z_lat", "r_lon": "z_lon"}).withColumn("d_now", F.lit(radius)))
    cells = ["level", "ci", "cj"]
    if counted:
        # A pole's wide cells and the finest level bound the levels in use; all are tried, as only counts are joined.
        here = cell_levels(donors, "d_lat", "d_lon").groupBy(*cells).agg(F.count(F.lit(1)).alias("nd"))
        return probes.groupBy(*cells).agg(F.count(F.lit(1)).alias("nr")).join(here, cells).agg(F.sum(F.col("nr") * F.col("nd")).alias("pairs"))
    levels = sorted(r["level"] for r in probes.select("level").distinct().collect())  # 23 values at most
    return probes.join(cell_levels(donors, "d_lat", "d_lon", levels), cells).drop(*cells)


def _half(pairs: DataFrame, own: str, other: str) -> DataFrame:
    """One half round, seen from side ``own``: its leading pairs that come first for their ``other`` are final.

    Rows: receiver, donor, distance_km, need, surplus (before any of ``pairs``),
    quantity (null until final) and what the half before has left in ``left``
    and ``first`` about the other side.
    """
    whole = Window.partitionBy(own).orderBy("distance_km", other)
    upto, earlier = (whole.rowsBetween(Window.unboundedPreceding, n) for n in (0, -1))
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, none = F.col("need" if own == "receiver" else "surplus"), F.lit(0).cast("bigint")
    p = pairs.withColumn("_left", total - F.coalesce(F.sum("quantity").over(every), none))
    p = p.withColumn("_live", F.col("quantity").isNull() & (F.col("_left") > 0) & (F.col("left") > 0))
    p = p.withColumn("_now", F.col("_live") & (F.count_if(F.col("_live") & ~F.col("first")).over(upto) == 0))
    before = F.coalesce(F.sum(F.when(F.col("_now"), F.col("left"))).over(earlier), none)
    p = p.withColumn("_q", F.when(F.col("_now"), F.greatest(none, F.least("left", F.col("_left") - before))))
    p = p.withColumn("_left", F.col("_left") - F.coalesce(F.sum("_q").over(every), none))
    p = p.withColumn("_live", F.col("_live") & ~F.col("_now") & (F.col("_left") > 0))
    p = p.withColumn("_first", F.col("_live") & (F.count_if("_live").over(upto) == 1))
    p = p.withColumn("quantity", F.coalesce("quantity", "_q")).where(F.col("_live") | (F.col("quantity") > 0))
    return p.select("receiver", "donor", "distance_km", "need", "surplus", "quantity", F.col("_left").alias("left"), F.col("_first").alias("first"))


def _settle(pairs: DataFrame) -> DataFrame:
    """Final quantities over ``pairs`` (receiver, donor, distance_km, need, surplus): the closest pairs first.

    A pair is final once all closer pairs of its receiver and of its donor are.
    Half rounds take turns: a donor gives to its closest receivers as long as
    each of them has no closer pair left, then receivers take from their
    closest donors that have no closer pair left. Either may settle many pairs
    at once, and a settled pair ends one of its sides with all other pairs of
    that side, so few pairs are left after some rounds. What a half round does
    not know yet of the other side only delays a pair. It is what a single pass
    over all pairs by distance would give.
    """
    state = pairs.withColumns({"quantity": F.lit(None).cast("bigint"), "left": F.col("surplus"), "first": F.lit(False)})
    while True:
        for _ in range(ROUNDS_PER_WRITE):
            state = _half(_half(state, "receiver", "donor"), "donor", "receiver")
        state, seen = materialize(state, "transfer-round", [F.count_if(F.col("quantity").isNull()).alias("open")])
        if not seen["open"]:
            return state.select("receiver", "donor", "distance_km", "quantity")


def allocate_transfers(metrics: DataFrame, target_per_1000: float = 75.0, max_km: float = 250.0, ring_pairs: int = RING_PAIRS) -> DataFrame:
    """Transfers of whole doses from sites above the target to sites below it, no donor beyond its surplus.

    A site needs what it lacks to the target (rounded up) or can give what it
    has above it (rounded down). Rule: pairs within ``max_km`` in order of
    (distance to the millimetre, receiver id, donor id); each moves the lesser
    of what the receiver still needs and the donor still has. So no receiver
    and donor could both do better with one another than with what they got.

    Columns: receiver_site_id, donor_site_id, distance_km, quantity,
    receiver_need, donor_surplus (both before any transfer). Pairs come from a
    grid join in rings of distance: what the rule does up to some distance does
    not depend on pairs beyond it, and after a ring one side of each of its
    pairs is done. So sites that find enough nearby meet nobody further away:
    a ring ends where its candidate pairs, counted per cell beforehand, reach
    ``RING_PAIRS_PER_SITE`` for each site still open (at least ``RING_LEAST``,
    at most ``ring_pairs``; rings are at least ``NARROWEST`` km wide). The pairs
    written at once follow from the open sites and not from all sites in reach.
    Sites without coordinates or stock figures neither give nor get.
    """
    gap = F.col("total_doses") - F.lit(target_per_1000) * F.col("total_population_served") / 1000
    sites = materialize(metrics.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude")).select(
        "nearest_site_id", "latitude", "longitude", F.ceil(-gap).cast("bigint").alias("need"), F.floor(gap).cast("bigint").alias("surplus")), "transfer-sites")
    receivers = sites.where(F.col("need") > 0).select(F.col("nearest_site_id").alias("receiver"), F.col("latitude").alias("r_lat"), F.col("longitude").alias("r_lon"),
                                                      "need", F.col("need").alias("receiver_need"))
    donors = sites.where(F.col("surplus") > 0).select(F.col("nearest_site_id").alias("donor"), F.col("latitude").alias("d_lat"), F.col("longitude").alias("d_lon"),
                                                      "surplus", F.col("surplus").alias("donor_surplus"))
    spark, done, inner = metrics.sparkSession, None, -1.0
    while inner < max_km:
        outer = min(max_km, 4 * inner) if inner > 0 else max_km
        aim = min(ring_pairs, max(RING_LEAST, RING_PAIRS_PER_SITE * (receivers.count() + donors.count())))
        while (n := _meeting(receivers, donors, outer, counted=True).first()["pairs"] or 0) > aim and outer - max(inner, 0.0) > NARROWEST:
            outer = max(inner, 0.0) + max(NARROWEST, (outer - max(inner, 0.0)) / 2)
        if not n and outer == max_km:
            break
        far = F.round(haversine_km("z_lat", "z_lon", "d_lat", "d_lon"), 6)
        pairs = _meeting(receivers, donors, outer, counted=False).withColumn("distance_km", far).where(
            (F.col("distance_km") > inner) & (F.col("distance_km") <= outer))
        given = _settle(materialize(pairs.select("receiver", "donor", "distance_km", "need", "surplus"), "transfer-pairs"))
        got = materialize(given.join(receivers.select("receiver", "receiver_need"), "receiver").join(donors.select("donor", "donor_surplus"), "donor"), "transfer-ring")
        done = got if done is None else done.unionByName(got)
        inner = outer
        if inner < max_km:
            taken = got.groupBy("receiver").agg(F.sum("quantity").alias("q"))
            receivers = materialize(receivers.join(taken, "receiver", "left").withColumn("need", F.col("need") - F.coalesce("q", F.lit(0))).where("need > 0").drop("q"), "transfer-needs")
            sent = got.groupBy("donor").agg(F.sum("quantity").alias("q"))
            donors = materialize(donors.join(sent, "donor", "left").withColumn("surplus", F.col("surplus") - F.coalesce("q", F.lit(0))).where("surplus > 0").drop("q"), "transfer-surplus")
    if done is None:
        return spark.createDataFrame([], _TRANSFERS)
    return done.select(F.col("receiver").alias("receiver_site_id"), F.col("donor").alias("donor_site_id"), "distance_km", "quantity", "receiver_need", "donor_surplus")


def joint_candidate_sites(access: DataFrame, candidates: DataFrame, k: int = 5, look: int = 64) -> DataFrame:
    """``k`` new sites chosen together: each is the best one given those before it.

    Greedy on the population-weighted distance (within 1 - 1/e of the best
    choice). A candidate's gain can only fall as sites are added, so its gain
    from an earlier round is a bound. The bounds lie in a written table; a round
    takes up its ``look`` best, computes their gains anew from the zones in
    their reach alone, and goes on with the next ``look`` only while the best
    gain found is below the next bound. What a zone has gained from the chosen
    sites is their distance, an expression of at most ``k`` terms.

    Columns: rank, candidate_id, latitude, longitude, zones_helped,
    population_helped and gain over the sites chosen before, and the
    new_pop_weighted_distance_km with all sites up to this one. Ties go to the
    smaller id; fewer than ``k`` rows if nothing more helps.
    """
    zones = materialize(located_zones(access), "joint-zones")
    probes = materialize(zone_probes(zones), "joint-probes")
    levels = sorted(r["level"] for r in probes.select("level").distinct().collect())  # 23 values at most
    base = zones.agg(F.sum(F.col("pop") * F.col("d_now")).alias("wd"), F.sum("pop").cast("double").alias("w")).first()
    spark, chosen, rows, wd = access.sparkSession, [], [], base["wd"]
    order = [F.desc("gain"), F.col("candidate_id")]
    columns = ["candidate_id", "c_lat", "c_lon", "zones_helped", "population_helped", "gain"]
    bounds = materialize(gains_near(probes, candidates, levels).withColumn("round", F.lit(0)), "joint-bounds")
    for n in range(k):
        while True:
            best = bounds.orderBy(*order).limit(look).collect()
            stale = [r for r in best if r["round"] < n]
            # The first row decides once it is from this round.
            if not best or best[0]["round"] == n:
                break
            asked = spark.createDataFrame([(r.candidate_id, r.c_lat, r.c_lon) for r in stale], "candidate_id string, latitude double, longitude double")
            fresh = gains_near(probes, asked, levels, chosen)
            names = F.broadcast(asked.select("candidate_id"))  # at most `look` rows
            bounds = materialize(bounds.join(names, "candidate_id", "left_anti").select(*columns, "round").unionByName(fresh.select(*columns, F.lit(n).alias("round"))), "joint-bounds")
        if not best:
            break
        top = best[0]
        chosen.append((top.c_lat, top.c_lon))
        wd -= top.gain
        rows.append((n + 1, top.candidate_id, top.c_lat, top.c_lon, top.zones_helped, top.population_helped, top.gain, wd / base["w"]))
    return spark.createDataFrame(rows, "rank int, candidate_id string, latitude double, longitude double, zones_helped bigint, population_helped bigint, "
                                       "gain double, new_pop_weighted_distance_km double")
