import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockmap.llm import embedding_whitening as ew
from stockmap.llm import impact_search as im
from stockmap.llm import quality_ftrl as qf
from test_text_operators import frame


# ---------------------------------------------------------------- whitening

def vectors(spark, rows):
    """Vectors with further columns whose names clash with those of the operator."""
    return spark.createDataFrame([(i, v, 1, "c", 2, 0.5) for i, v in rows], "vec_id long, embedding array<float>, copies int, x string, n int, whitened double")


def plain_white(rows, k=8, by_copies=True):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows], dtype=object)
    fit = x if by_copies else np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    deviation = [sum(int(d) ** 2 for d in n * r - s) for r in x]
    c = (fit - s / n).astype(float)
    v = c.T @ c / n
    e, p = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return n, deviation, (x - s / n).astype(float) @ p[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


@pytest.mark.parametrize("by_copies", [True, False])
def test_whitening_equals_plain_numpy(spark, by_copies):
    r = np.random.default_rng(3)
    base = (r.normal(size=(400, 12)) @ r.normal(size=(12, 12)) * 0.1).astype(np.float32)
    good = [(i, base[i].tolist()) for i in range(400)] + [(1000 + i, base[7].tolist()) for i in range(300)] + [(5, base[5].tolist()), (None, base[9].tolist())]
    bad = [(2000, None), (2001, []), (2002, [None] + [0.0] * 11), (2003, [float("nan")] * 12), (2004, [float("inf")] + [0.0] * 11), (2005, [1.0, 2.0]), (2006, [1e30] * 12)]
    out = ew.whiten(vectors(spark, good + bad), by_copies=by_copies).collect()
    n, deviation, white, explained = plain_white(good, by_copies=by_copies)
    assert len(out) == 8 * len(good) and {x.n for x in out} == {n} and len({x.identity_error for x in out}) == 1
    assert out[0].identity_error < 1e-9
    want = defaultdict(list)
    for k, (i, _) in enumerate(good):
        for j in range(8):
            want[i, j + 1].append((deviation[k], round(abs(white[k, j]), 6)))
    got = defaultdict(list)
    for x in out:
        got[x.vec_id, x.component].append((x.deviation, round(abs(x.whitened), 6)))
        assert x.explained == pytest.approx(explained[x.component - 1], rel=1e-9) and x.deviation == int(x.deviation_exact)
        assert x.copies == (301 if x.vec_id is not None and (x.vec_id == 7 or 1000 <= x.vec_id < 1300) else 2 if x.vec_id in (5, 9, None) else 1)
    assert set(got) == set(want)
    for key, found in got.items():
        found, wanted = sorted(found), sorted(want[key])
        assert [a for a, _ in found] == [a for a, _ in wanted] and [b for _, b in found] == pytest.approx([b for _, b in wanted], abs=2e-6)
    # One sign for each component, whatever the row.
    signs = defaultdict(set)
    first = {i: k for k, (i, _) in reversed(list(enumerate(good)))}
    for x in out:
        if abs(x.whitened) > 0.01:
            signs[x.component].add(np.sign(x.whitened) == np.sign(white[first[x.vec_id], x.component - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_without_variance_or_rows(spark):
    assert ew.whiten(vectors(spark, [])).count() == 0 and ew.whiten(vectors(spark, [(1, None)])).count() == 0
    out = ew.whiten(vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(x.vec_id, x.component, x.n, x.deviation, x.whitened, x.explained, x.identity_error) for x in sorted(out, key=lambda x: (x.vec_id, x.component))] == [
        (i, c, 2, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = ew.whiten(vectors(spark, [(i, [0.5 * i, 1.0]) for i in range(4)])).collect()
    assert all((x.whitened is None) == (x.component == 2) for x in line) and line[0].identity_error < 1e-9


def test_deviation_beyond_64_bits_is_exact():
    x = np.array([[0, 1 << 45], [1 << 46, 5]], np.int64)
    c = ew.Centre([int(v) for v in x.sum(axis=0)], 2)
    assert c.deviation(x) == [sum((2 * int(a) - s) ** 2 for a, s in zip(row, c.sums, strict=True)) for row in x]


# ---------------------------------------------------------------- ranked search

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in PATTERN.findall(text or "")]


def plain_search(docs, items, top=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in plain_terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [(1 << 20, 256, 4096, 1024), (30, 3, 4, 16)])
def test_search_equals_brute_force(spark, monkeypatch, limits):
    group, monkeypatched = limits[0], dict(zip(("TILE_ITEMS", "TILE_TERMS", "BLOCK"), limits[1:], strict=True))
    for name, value in monkeypatched.items():
        monkeypatch.setattr(im, name, value)
    r = random.Random(2)
    words = ["Apfel", "été", "x1", "ÉTÉ", "zwei", "3", "the", "The", "naïve", "日本"] + [f"w{k}" for k in range(60)]
    docs = [(i, r.choice([" ", "-", "  ", "\n"]).join(r.choices(words, k=r.randrange(1, 60)))) for i in range(200)]
    docs += [(500 + i, "the same text w1 w2") for i in range(40)] + [(None, "the same text w1 w2"), (501, "the same text w1 w2"), (700, None), (701, ""), (702, "!!! ..."),
             (703, "w3 " * 50_000)]
    items = [(i, " ".join(r.choices(words, k=r.randrange(1, 30)))) for i in range(12)]
    items += [(50, "same text"), (50, "same text"), (50, "w1"), (51, None), (52, "?!"), (53, "unknown"), (54, "w3 w3 w3 the"), (None, "w5 w6"), (55, "été")]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score int")
    d = frame(spark, docs).repartition(5)
    got = sorted(((x.item_id, x.rank, x.doc_id, x.score) for x in im.search(d, asked, group_terms=group).collect()), key=str)
    assert got == plain_search(docs, items)
    assert im.search(d.limit(0), asked).count() == 0 and im.search(d, asked.limit(0)).count() == 0


def test_parts_bound_partial_sums():
    owner, term = np.repeat([0, 1], 40), np.tile(np.arange(40), 2)
    times, weight = np.full(80, 30_000), np.full(40, 20_000)
    tiles = im.make_tiles(owner, term, times, weight, 2)
    parts = [p for t in tiles for p in t.parts]
    assert sum(len(v) for v, _ in parts) == 40 and len(parts) > 1
    assert all((w * im.MOST_QUOTIENT).sum(axis=1).max() < im.EXACT for _, w in parts)


# ---------------------------------------------------------------- quality

def plain_features(text):
    """The features by plain Python integers."""
    mask = (1 << 64) - 1

    def mixed(h, k):
        h = ((h ^ h >> 31) * qf._MIX[k]) & mask
        return h ^ h >> 29

    found, last = [], None
    for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", text.encode()):
        t = m.group()
        h = mixed(sum((c + 1) * pow(qf._BASE, k + 1, 1 << 64) for k, c in enumerate(t)) & mask, 0)
        word = bool(re.match(rb"[0-9A-Za-z\x80-\xff]", t))
        letters = re.sub(rb"[^A-Za-z]", b"", t)
        shape = (h if not word else qf.AGAIN if h == last else qf.CAPITALS if letters and letters.isupper() and len(t) > 1
                 else qf.FIRST_CAPITAL if t[:1].isupper() else qf.DIGITS if t.isdigit() else qf.LOWER)
        found.append((h, shape))
        last = h
    c = Counter()
    for h, _ in found:
        c[mixed(h, 3) >> 64 - qf.BITS] += 1
    for (a, _), (b, _) in zip(found, found[1:], strict=False):
        c[mixed(mixed((mixed(a, 1) + b) & mask, 2), 3) >> 64 - qf.BITS] += 1
    for (_, a), (_, b), (_, d) in zip(found, found[1:], found[2:], strict=False):
        c[mixed(mixed((mixed((mixed(a, 1) + b) & mask, 2) + d) & mask, 3), 3) >> 64 - qf.BITS] += 1
    values = {k: math.log1p(v) for k, v in c.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {k: v / length for k, v in values.items()}


def test_features_equal_plain_python():
    texts = ["", "Hello world, HELLO WORLD!! hello hello", "été Ünï 123 4x", "...", " \n\t", "a" * 5000, "A b\x00c", "one", "two words"]
    owner, place, value = qf.features([t.encode() for t in texts])
    for k, t in enumerate(texts):
        got = dict(zip(place[owner == k].tolist(), value[owner == k].tolist(), strict=True))
        assert got == pytest.approx(plain_features(t))


def quality_corpus(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(r.choices("abcdefgh", k=r.randrange(2, 8))) for _ in range(r.randrange(5, 80))]
        y = int(r.random() < 0.8)
        if not y:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + r.choice(["###", "***"]) for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, y, 0))
    return rows, labels


def logistic(z):
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def test_scores_equal_plain_ftrl(spark):
    """The whole operator against dictionaries: one shard, two rounds."""
    rows, labels = quality_corpus(120, 3)
    rows += [(300, None), (301, "")]
    lab = spark.createDataFrame(labels + [(None, 1, 0), (400, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    d = frame(spark, rows)
    model = qf.train(d, lab, shards=1, rounds=2)
    learn = [(i, t, y) for (i, t), (_, y, _) in zip(rows, labels, strict=False) if zlib.crc32(str(i).encode()) % 5]
    order = {r.doc_id: r.h for r in d.selectExpr("doc_id", "xxhash64(doc_id, 'order') AS h").collect()}
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= qf.L1 else -(z[k] - math.copysign(qf.L1, z[k])) / ((qf.BETA + math.sqrt(n[k])) / qf.ALPHA + qf.L2)
    for _ in range(2):
        for _, t, y in sorted(learn, key=lambda x: order[x[0]]):
            f = {**plain_features(t), "bias": 1.0}
            w = {k: weight(k) for k in f}
            g = logistic(sum(w[k] * v for k, v in f.items())) - y
            for k, v in f.items():
                z[k] += g * v - (math.sqrt(n[k] + (g * v) ** 2) - math.sqrt(n[k])) / qf.ALPHA * w[k]
                n[k] += (g * v) ** 2
    got = model.score([(t or "").encode() for _, t in rows])
    want = [logistic(sum(weight(k) * v for k, v in {**plain_features(t or ""), "bias": 1.0}.items())) for _, t in rows]
    assert np.allclose(got, want, atol=1e-6)


def test_quality_held_out_accuracy_and_rows(spark):
    rows, labels = quality_corpus(1500, 1)
    rows += [(None, "x"), (5000, None), (5001, ""), (5002, "word " * 300_000), (5, rows[5][1])]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = qf.scored(frame(spark, rows), lab).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    truth = {i: y for i, y, _ in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    bounded = {r.doc_id: r.score for r in qf.scored(frame(spark, rows), lab).collect() if r.doc_id != 5}
    assert bounded == {r.doc_id: r.score for r in out if r.doc_id != 5}  # reruns agree


def test_quality_without_both_classes(spark):
    d = frame(spark, [(1, "a b"), (2, "c")])
    for lab in ([], [(1, 1, 0), (2, 1, 0)], [(2, 0, 0)]):
        out = qf.scored(d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")).collect()
        assert len(out) == 2 and len({r.score for r in out}) == 1
    assert qf.scored(d.limit(0), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).count() == 0
