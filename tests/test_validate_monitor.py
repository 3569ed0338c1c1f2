from pyspark.sql import functions as F

from stockmap.operators import monitor as mo
from stockmap.operators import validate as va
from stockmap.plans.numbering import row_number_global
from stockmap.sources import files as fs


def test_validation_cases(spark):
    site = spark.createDataFrame([("S1", "d", "WA")], "id string, description string, state string")
    product = spark.createDataFrame([("P1", "x"), (None, "y")], "id string, description string")
    inv = spark.createDataFrame([], "snapshot_date date, site_id string, product_id string, on_hand_inventory long")
    frames = {"site": site, "product": product, "inv_level": inv}
    rows = va.validate_all(spark, frames, datasets=["site", "product", "inv_level", "company"]).collect()
    got = sorted((r.dataset, r.check, r.field) for r in rows)
    assert got == [("company", "unreadable", None), ("inv_level", "empty", None),
                   ("product", "nulls", "id"), ("site", "forbidden_present", "state")]
    msg = [r.message for r in rows if r.check == "nulls"][0]
    assert msg == "Field 'id' has 1 null values"


def failures(df):
    return sorted((r.dataset, r.check, r.field or "", r.message) for r in df.collect())


def test_counts_of_the_writing_job_equal_those_of_its_files(spark, tmp, monkeypatch):
    names = ["site", "product", "inv_policy", "inv_level", "company", "trading_partner"]
    site = spark.createDataFrame([("S1", "d", "WA"), ("", "  ", None), (None, "a,b", "")], "id string, description string, state string")
    product = spark.createDataFrame([("P1", "x"), (None, "y"), (None, None), ("", " ")], "id string, description string")
    policy = spark.createDataFrame([], "site_id string, id string")
    fs.publish(site, "site", tmp, "20240101_000000")
    fs.publish(product, "product", tmp, "20240101_000000")
    fs.publish(product, "product", tmp, "20240102_000000")
    fs.publish(policy, "inv_policy", tmp, "20240101_000000")
    fs.publish(policy.where("false"), "inv_level", tmp, "20240101_000000")
    # Two loads of different fields, and a dataset that was never published.
    fs.publish(spark.createDataFrame([("T1",)], "id string"), "trading_partner", tmp, "20240101_000000")
    fs.publish(spark.createDataFrame([("T2", "x")], "id string, description string"), "trading_partner", tmp, "20240102_000000")

    def check():
        return failures(va.validate_published(spark, tmp, names)), failures(va.validate_all(spark, va.open_datasets(spark, tmp, names), names))

    got, want = check()
    assert got == want
    assert ("product", "nulls", "id", "Field 'id' has 6 null values") in got
    assert ("inv_policy", "empty", "", "Dataset is empty") in got
    assert ("company", "unreadable", "", "File not found") in got
    opened = []
    monkeypatch.setattr(va, "read_loads_as_text", lambda s, n, r: opened.append(n) or fs.read_loads_as_text(s, n, r))
    va.validate_published(spark, tmp, names)
    assert opened == ["trading_partner"]
    # A file that came later, or was cut, is not what the job counted: the files are read.
    fs.write_csv(product.limit(1), f"{tmp}/wa_product/load_ts=20240102_000000", mode="append")
    fs.publish(product.limit(1), "product", tmp, "20240103_000000", replace=True)
    assert fs.load_profiles(spark, "product", tmp)[0]["counts"]["rows"] == 1
    fs.write_csv(product, f"{tmp}/wa_product/load_ts=20240103_000000", mode="append")
    assert fs.load_profiles(spark, "product", tmp) is None
    got, want = check()
    assert got == want and "product" in opened


def test_key_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert [(r.id, r.occurrences) for r in va.key_duplicates(df, "site").collect()] == [("a", 2)]


def test_execution_stats_empty_flow_and_rate(spark):
    flows = spark.createDataFrame([("f1",), ("f2",)], "flow_name string")
    ex = spark.createDataFrame([("f1", 1, "SUCCEEDED"), ("f1", 2, "FAILED"), ("f1", 3, "IN_PROGRESS")],
                               "flow_name string, execution_id long, status string")
    r = mo.execution_stats(flows, ex).first()
    assert (r.flows_with_executions, r.flows_without_executions, r.running, r.other) == (1, 1, 1, 0)
    assert abs(r.success_rate_pct - 100 / 3) < 1e-4
    none = mo.execution_stats(flows, ex.limit(0)).first()
    assert none.success_rate_pct is None


def test_row_number_global_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"), "id")
    a = {r.id: r.rn for r in row_number_global(df.repartition(7), ["k", "id"], "rn").collect()}
    b = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id"))).collect()}
    assert a == b
    c = {r.id: r.rn for r in row_number_global(df.repartition(5), ["k", "id"], "rn", within="g").collect()}
    d = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy("k", "id"))).collect()}
    assert c == d


def test_compressed_loads_are_read_counted_and_listed_like_plain_ones(spark, tmp, monkeypatch):
    import os
    monkeypatch.setattr(fs, "GZIP_ROWS", 40)
    df = spark.range(100, numPartitions=1).selectExpr("concat('P', id) AS id", "CASE WHEN id % 9 > 0 THEN 'some long text, of many rows' END AS description")
    sizes = {}
    for gz in (False, True):
        root = f"{tmp}/{gz}"
        folder = fs.publish(df, "product", root, "20240101_000000", gzip=gz)
        sizes[gz] = [os.path.getsize(f"{folder}/{x}") for x in os.listdir(folder) if x.endswith(".csv.gz" if gz else ".csv")]
        assert sorted(map(tuple, fs.read_loads_as_text(spark, "product", root).select("id", "description").collect())) == sorted(map(tuple, df.collect()))
        assert fs.load_profiles(spark, "product", root)[0]["counts"]["rows"] == 100 and fs.manifest(spark, root).count() == len(sizes[gz])
        assert failures(va.validate_published(spark, root, ["product"])) == [("product", "nulls", "description", "Field 'description' has 12 null values")]
        assert [tuple(r) for r in va.dataset_profile(spark, va.open_datasets(spark, root), ["product"]).collect()] == [("product", 100, 2, "id", 0)]
    assert len(sizes[True]) == 3 and sum(sizes[True]) < sum(sizes[False]) / 2


def test_datasets_are_published_for_validation_in_few_bytes(spark):
    import os

    from conftest import SF
    from stockmap import queries as q
    root = q.publish_for_validation(spark, SF).removeprefix("file:")
    found = [x for _, _, files in os.walk(root) for x in files if x.startswith("part-")]
    assert found and all(x.endswith(".csv.gz") for x in found)
