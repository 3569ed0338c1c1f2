import math
import random

from pyspark.sql import functions as F

from geo_py import haversine_km_py
from stockmap.plans.nearest import choose_levels, nearest_site, nearest_site_bruteforce


def _brute(zones, sites):
    out = {}
    for zid, zl, zo in zones:
        if zl is None:
            out[zid] = None
            continue
        best = min(((haversine_km_py(zl, zo, sl, so), sid) for sid, sl, so in sites))
        out[zid] = best[1]
    return out


def test_tie_goes_to_smaller_site_id(spark):
    z = spark.createDataFrame([("z1", 0.0, 0.0)], "zip string, latitude double, longitude double")
    s = spark.createDataFrame([("B", 0.0, 1.0), ("A", 0.0, -1.0), ("C", 5.0, 5.0)],
                              "site_id string, latitude double, longitude double")
    r = nearest_site(z, s).collect()[0]
    assert r["nearest_site_id"] == "A"


def test_zone_without_coordinates_is_kept(spark):
    z = spark.createDataFrame([("z1", None, None), ("z2", 1.0, 1.0)], "zip string, latitude double, longitude double")
    s = spark.createDataFrame([("A", 1.0, 1.1)], "site_id string, latitude double, longitude double")
    rows = {r["zip"]: r for r in nearest_site(z, s).collect()}
    assert rows["z1"]["nearest_site_id"] is None and rows["z1"]["distance_km"] is None
    assert rows["z2"]["nearest_site_id"] == "A"


def test_colocated_sites_collapse_to_smallest_key(spark):
    z = spark.createDataFrame([("z", 10.0, 10.0)], "zip string, latitude double, longitude double")
    s = spark.createDataFrame([("S9", 10.5, 10.5), ("S1", 10.5, 10.5), ("S5", 10.5, 10.5)],
                              "site_id string, latitude double, longitude double")
    assert nearest_site(z, s).collect()[0]["nearest_site_id"] == "S1"


def test_grid_equals_brute_force_on_the_globe(spark):
    rnd = random.Random(7)
    def pt():
        return rnd.uniform(-90, 90), rnd.uniform(-180, 180)
    sites = [(f"S{i:04d}",) + pt() for i in range(150)]
    # include poles and antimeridian neighbours
    sites += [("SPOLE", 89.99, 10.0), ("SANTI", 0.0, 179.99)]
    zones = [(f"Z{i:04d}",) + pt() for i in range(400)] + [("ZPOLE", -89.9, 0.0), ("ZANTI", 0.5, -179.99)]
    zdf = spark.createDataFrame(zones, "zip string, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "site_id string, latitude double, longitude double")
    got = {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf).collect()}
    assert got == _brute(zones, sites)
    assert got["ZANTI"] == "SANTI"


def test_grid_equals_bruteforce_plan_on_clusters(spark):
    rnd = random.Random(3)
    sites = [(f"S{i:03d}", 47 + rnd.gauss(0, 0.05), -122 + rnd.gauss(0, 0.05)) for i in range(300)]
    sites += [(f"R{i:03d}", rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(20)]
    zones = [(f"Z{i:03d}", rnd.uniform(40, 55), rnd.uniform(-130, -110)) for i in range(300)]
    zdf = spark.createDataFrame(zones, "zip string, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "site_id string, latitude double, longitude double")
    a = {r["zip"]: (r["nearest_site_id"], round(r["distance_km"], 9)) for r in nearest_site(zdf, sdf).collect()}
    b = {r["zip"]: (r["nearest_site_id"], round(r["distance_km"], 9))
         for r in nearest_site_bruteforce(zdf, sdf).collect()}
    assert a == b


def test_nearest_other_excludes_self(spark):
    s = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", 0.0, 3.0)],
                              "site_id string, latitude double, longitude double")
    r = {x["site_id"]: x["nearest_site_id"] for x in nearest_site(s, s, zone_key="site_id").collect()}
    assert r == {"A": "B", "B": "A", "C": "B"}


def test_levels_divide_360_and_end_global():
    lv = choose_levels(1000, 3.5, 7.6)
    assert lv[-1] == 120.0
    for c in lv:
        assert abs(360 / c - round(360 / c)) < 1e-9
    assert lv == sorted(lv)


def test_haversine_column_matches_python(spark):
    from stockmap.functions.geo import haversine_km
    df = spark.createDataFrame([(47.6062, -122.3321, 47.6588, -117.4260)], "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d").alias("d")).first()["d"]
    assert math.isclose(got, haversine_km_py(47.6062, -122.3321, 47.6588, -117.4260), rel_tol=1e-12)


def test_descent_equals_brute_force_on_the_globe(spark):
    rnd = random.Random(11)
    sites = [(f"S{i:04d}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)]
    zones = [(f"Z{i:04d}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    zdf = spark.createDataFrame(zones, "zip string, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "site_id string, latitude double, longitude double")
    got = {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf, descent=True).collect()}
    assert got == _brute(zones, sites)


def test_hot_cluster_is_exact_and_pruned(spark):
    """A third of all sites in one tight cluster: zones inside and around it stay exact."""
    rnd = random.Random(5)
    cluster = [(f"C{i:05d}", 47.6 + rnd.uniform(-0.01, 0.01), -122.3 + rnd.uniform(-0.01, 0.01))
               for i in range(1500)]
    spread = [(f"S{i:05d}", rnd.uniform(40, 50), rnd.uniform(-130, -115)) for i in range(3000)]
    sites = cluster + spread
    zones = [(f"Z{i:04d}", 47.6 + rnd.gauss(0, 0.3), -122.3 + rnd.gauss(0, 0.3)) for i in range(300)]
    zdf = spark.createDataFrame(zones, "zip string, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "site_id string, latitude double, longitude double")
    got = {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf, descent=True).collect()}
    assert got == _brute(zones, sites)
    auto = {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf).collect()}
    assert auto == got


def test_descent_nearest_other(spark):
    s = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", 0.0, 3.0)],
                              "site_id string, latitude double, longitude double")
    r = {x["site_id"]: x["nearest_site_id"]
         for x in nearest_site(s, s, zone_key="site_id", descent=True).collect()}
    assert r == {"A": "B", "B": "A", "C": "B"}


def test_descent_exact_across_antimeridian_and_pole(spark):
    rnd = random.Random(21)
    sites = [(f"A{i:04d}", rnd.uniform(-1, 1), rnd.choice([179.0, -179.0]) + rnd.uniform(-0.99, 0.99))
             for i in range(600)]
    sites += [(f"P{i:04d}", 89.0 + rnd.uniform(0, 0.99), rnd.uniform(-180, 180)) for i in range(400)]
    sites += [(f"R{i:04d}", rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(30)]
    zones = [(f"Z{i:04d}", rnd.uniform(-5, 5), rnd.choice([175.0, -175.0]) + rnd.uniform(-5, 5)) for i in range(150)]
    zones += [(f"Q{i:04d}", rnd.uniform(80, 90), rnd.uniform(-180, 180)) for i in range(100)]
    zdf = spark.createDataFrame(zones, "zip string, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "site_id string, latitude double, longitude double")
    want = _brute(zones, sites)
    assert {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf).collect()} == want
    assert {r["zip"]: r["nearest_site_id"] for r in nearest_site(zdf, sdf, descent=True).collect()} == want
