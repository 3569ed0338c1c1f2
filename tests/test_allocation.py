import math
import random

import pytest

from geo_py import haversine_km_py
from stockmap.operators import allocation as al

SITES = "nearest_site_id string, latitude double, longitude double, total_doses bigint, total_population_served bigint"


def one_pass(rows, target, max_km):
    """All pairs in order of (distance, receiver, donor), each as much as both sides allow."""
    need, give, at = {}, {}, {}
    for i, la, lo, doses, pop in rows:
        if None in (la, lo, doses, pop) or math.isnan(la) or math.isnan(lo):
            continue
        gap = doses - target * pop / 1000
        at[i] = (la, lo)
        if math.ceil(-gap) > 0:
            need[i] = math.ceil(-gap)
        if math.floor(gap) > 0:
            give[i] = math.floor(gap)
    pairs = sorted((round(haversine_km_py(*at[r], *at[d]), 6), r, d) for r in need for d in give)
    left, rest, out = dict(need), dict(give), []
    for km, r, d in pairs:
        q = min(left[r], rest[d])
        if km <= max_km and q:
            left[r] -= q
            rest[d] -= q
            out.append((r, d, km, q, need[r], give[d]))
    return sorted(out), give


@pytest.mark.parametrize("seed,ring_pairs", [(1, al.RING_PAIRS), (2, 250)])
def test_allocation_equals_one_pass_over_all_pairs(spark, seed, ring_pairs):
    r = random.Random(seed)
    rows = []
    for k in range(60):
        la, lo = (r.choice([47.0, 47.5]), r.choice([-122.0, -121.5])) if k % 3 == 0 else (r.uniform(45, 49), r.uniform(-124, -117))
        rows.append((f"S{k:03d}", la, lo, r.randrange(0, 4000), r.randrange(0, 40_000)))
    rows += [("N1", None, -120.0, 10, 10_000), ("N2", 47.0, float("nan"), 9000, 1), ("N3", 47.0, -120.0, None, 10_000), ("N4", 47.0, -120.0, 5, None),
             ("E1", 47.0, 179.9, 0, 20_000), ("E2", 47.0, -179.9, 9000, 0)]
    got = sorted(tuple(x) for x in al.allocate_transfers(spark.createDataFrame(rows, SITES), 75.0, 250.0, ring_pairs).collect())
    want, give = one_pass(rows, 75.0, 250.0)
    assert got == want and ("E1", "E2") in {(x[0], x[1]) for x in got}
    for d, has in give.items():
        assert sum(x[3] for x in got if x[1] == d) <= has


@pytest.mark.parametrize("near", [al.RING_LEAST, 400])
def test_many_sites_are_settled_in_few_rounds(spark, monkeypatch, near):
    """Scarce donors: cutting bids one after another took a round for each link of a chain of sites."""
    written, write = [], al.materialize
    monkeypatch.setattr(al, "materialize", lambda df, name, *a: (written.append(name), write(df, name, *a))[1])
    monkeypatch.setattr(al, "RING_LEAST", near)
    monkeypatch.setattr(al, "RING_PAIRS_PER_SITE", 1, raising=False)
    r = random.Random(11)
    rows = [(f"S{k:03d}", r.uniform(45.5, 49), r.uniform(-124.5, -117), r.randrange(0, 4000), r.randrange(0, 40_000)) for k in range(300)]
    got = sorted(tuple(x) for x in al.allocate_transfers(spark.createDataFrame(rows, SITES), 75.0, 250.0).collect())
    assert got == one_pass(rows, 75.0, 250.0)[0]
    assert written.count("transfer-round") <= 5 * written.count("transfer-ring")


def test_a_receiver_goes_on_to_the_next_donor(spark):
    """B is nearest to both receivers and has 10; the further receiver goes on to C, and then to nobody."""
    rows = [("A1", 0.0, 0.1, 0, 100_000), ("A2", 0.0, 0.2, 0, 200_000), ("B", 0.0, 0.0, 10_010 - 2510, 0), ("C", 0.0, 1.0, 9000, 0)]
    got = {(x.receiver_site_id, x.donor_site_id): x.quantity for x in al.allocate_transfers(spark.createDataFrame(rows, SITES)).collect()}
    assert got == {("A1", "B"): 7500, ("A2", "C"): 9000}


def test_nothing_to_move(spark):
    for rows in ([], [("A", 0.0, 0.0, 10_000, 0), ("B", 40.0, 0.0, 0, 10_000)]):
        out = al.allocate_transfers(spark.createDataFrame(rows, SITES))
        assert out.count() == 0 and out.columns[:4] == ["receiver_site_id", "donor_site_id", "distance_km", "quantity"]


ACCESS = "zip_code string, latitude double, longitude double, population bigint, distance_km double"


def plain_greedy(zones, cands, k):
    now, out = [z[4] for z in zones], []
    for n in range(k):
        gains = []
        for c, la, lo in cands:
            near = [(i, haversine_km_py(z[1], z[2], la, lo)) for i, z in enumerate(zones)]
            helped = [(i, d) for i, d in near if d < now[i]]
            if helped:
                gains.append((-sum(zones[i][3] * (now[i] - d) for i, d in helped), c, len(helped), near))
        if not gains:
            break
        gain, c, helped, near = min(gains, key=lambda g: g[:2])
        now = [min(a, d) for a, (_, d) in zip(now, near, strict=True)]
        out.append((n + 1, c, helped, -gain, sum(z[3] * d for z, d in zip(zones, now, strict=True)) / sum(z[3] for z in zones)))
    return out


def test_joint_sites_equal_plain_greedy(spark):
    r = random.Random(7)
    zones = [(f"Z{k}", r.uniform(45, 49), r.uniform(-124, -117), r.randrange(1, 5000), r.uniform(5, 300)) for k in range(200)]
    cands = [(f"C{k:02d}", r.uniform(45, 49), r.uniform(-124, -117)) for k in range(60)]
    acc = spark.createDataFrame([*zones, ("N", None, 1.0, 5, 10.0), ("M", 47.0, -120.0, None, 10.0), ("O", 47.0, -120.0, 3, None)], ACCESS)
    got = al.joint_candidate_sites(acc, spark.createDataFrame(cands, "candidate_id string, latitude double, longitude double"), k=4, look=5).collect()
    want = plain_greedy(zones, cands, 4)
    assert [(x["rank"], x.candidate_id, x.zones_helped) for x in got] == [w[:3] for w in want]
    for x, w in zip(got, want, strict=True):
        assert x.gain == pytest.approx(w[3], rel=1e-9) and x.new_pop_weighted_distance_km == pytest.approx(w[4], rel=1e-9)


def test_joint_sites_stop_when_nothing_helps(spark):
    acc = spark.createDataFrame([("Z", 47.0, -120.0, 10, 50.0)], ACCESS)
    cands = spark.createDataFrame([("A", 47.0, -120.0), ("B", 47.0, -120.0), ("C", 10.0, 10.0)], "candidate_id string, latitude double, longitude double")
    got = al.joint_candidate_sites(acc, cands, k=3).collect()
    assert [(x["rank"], x.candidate_id, x.new_pop_weighted_distance_km) for x in got] == [(1, "A", 0.0)]
    assert al.joint_candidate_sites(acc.limit(0), cands, k=3).count() == 0
