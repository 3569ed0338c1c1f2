import random

import numpy as np

import __spark_entry__ as E
from stockmap.llm import posting_lists as pl
from test_text_operators import linked_components, shingles

SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string")


def brute(rows, top=20):
    ok = {(i, tuple(v)) for i, v in rows if v is not None and i is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array([i for i, _ in ok])
    x = np.array([v for _, v in ok], np.float32).astype(float)
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        order = [j for j in np.lexsort((ids, -np.round(s, 9))) if j != k and ids[j] != ids[k]][:top]
        out[int(ids[k])] = [(int(ids[j]), round(float(s[j]), 5)) for j in order]
    return out


def test_recall_ties_and_bad_vectors(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + r.normal(size=8) * 0.3).astype(np.float32).tolist()) for i in range(2500)]
    hot = [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5]
    rows += [(10_000 + i, hot) for i in range(1500)] + [(20_000, None), (20_020, [0.0] * 8), (20_040, [1.0, None] + [0.0] * 6), (20_060, [float("nan")] * 8),
             (20_080, [float("inf")] + [0.0] * 7), (20_100, [1.0, 2.0]), (10_020, hot), (None, hot)]
    got = {}
    for q in pl.nearest(vectors(spark, rows)).collect():
        got.setdefault(q.query_id, []).append((q.rank, q.vec_id, round(q.score, 5)))
    want = brute(rows)
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 21))
        hit += len({x[1] for x in found} & {x[0] for x in want[q]})
        assert [x[2] for x in found] == sorted((x[2] for x in found), reverse=True)
    assert hit >= 0.9 * 20 * len(want)
    same = [x[1] for x in got[10_020]]
    assert same[:19] == [i for i in range(10_000, 10_021) if i != 10_020][:19]


def test_few_and_no_candidates(spark):
    few = [(i, [float(i + 1)] + [1.0] * 7) for i in range(5)]
    out = pl.nearest(vectors(spark, few)).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(out, key=lambda r: r["rank"])] == [(0, 1, 4), (0, 2, 3), (0, 3, 2), (0, 4, 1)]
    assert pl.nearest(vectors(spark, [(0, [1.0] * 8)])).count() == 0
    assert pl.nearest(vectors(spark, [])).count() == 0


def test_lists_are_balanced_and_reachable():
    x = np.random.default_rng(1).normal(size=(4000, 6))
    c = pl.balanced_means(x, 64)
    assert len(c) == 64
    index = pl.Lists(c, pl.neighbour_graph(c), 0, 9.0, np.full(len(c), 60))
    for q in x[:50]:
        nearest = int(((c - q) ** 2).sum(axis=1).argmin())
        assert nearest in index.probe(q)


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages_over_planted_documents(spark, tmp):
    import corpus_pipeline as cp
    r = random.Random(11)
    words = [f"w{k}" for k in range(500)]
    def text(n=80):
        return " ".join(r.choice(words) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        t, y = text(), int(i % 5 == 0)
        if y:
            t += " scumbag moronic trashy scumbag"
        rows.append((i, t, "en", "abc"[i % 3], len(t)))
        labels.append((i, 1, y))
    base = text(200)
    for k in range(30):
        w = base.split()
        w[r.randrange(200)] = f"q{k}"
        rows.append((1000 + k, " ".join(w), "en", "a", 1))
    rows += [(2000 + k, "Same Text " + base[:300], "en", "b", 1) for k in range(20)] + [(3000, None, "en", None, 0), (3001, "", None, "c", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp}/documents.parquet"), {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, tmp)
        if name != "pack":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp}/stage{k}")
        before, docs = docs, spark.read.parquet(f"{tmp}/stage{k}")
        seen[name] = (before.collect(), docs.collect())
    gone = {x.doc_id for x in seen["toxicity"][0]} - {x.doc_id for x in seen["toxicity"][1]}
    assert gone == {i for i, _, y in labels if y}
    ids = {x.doc_id for x in seen["exact_dedup"][1]}
    assert 2019 in ids and not ids & set(range(2000, 2019)) and 3001 in ids and 3000 not in ids
    into, out = seen["near_dedup"]
    comp = linked_components([(x.doc_id, shingles(x.text, 5)) for x in into])
    want = {c for c, x in zip(comp, into, strict=True) if x.text} | {x.doc_id for x in into if not x.text}
    assert sorted(x.doc_id for x in out) == sorted(want)
    into, out = seen["mix_sources"]
    total = sum(len((x.text or "").split()) for x in into)
    assert abs(sum(len(x.text.split()) for x in out) - 1.5 * total) < 0.05 * total
    pieces = seen["pack"][1]
    assert {x.doc_id for x in pieces} == {x.doc_id for x in out}


def test_run_equals_its_stages(spark):
    import corpus_pipeline as cp
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.filter("length <= 0 OR offset < 0").isEmpty() and out.count() > 0


def test_every_operator_is_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
