import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockmap.llm import class_ngrams as lm
from stockmap.llm import license_scan as lic
from stockmap.llm import near_dedup as nd
from stockmap.llm import pack_windows as pw
from stockmap.llm import toxicity as tx
from stockmap.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score int, key string, cls int, word string"


def frame(spark, rows):
    """Documents with further columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "en", "a", 1, 2, "k", 3, "w") for i, t in rows], DOCS)


# ---------------------------------------------------------------- near-dedup

def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def linked_components(sets):
    """Brute force over all pairs; ``sets``: list of (id, set)."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        low[find(i)].append(d)
    known = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return [known[find(i)] for i in range(len(sets))]


def near_corpus(seed):
    r = random.Random(seed)
    def words(n):
        return [f"w{r.randrange(4000)}" for _ in range(n)]
    rows, i = [], 0
    for size in (2, 3, 8, 40):
        base = words(r.randrange(30, 200))
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 8))):
                w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i + k, " ".join(words(r.randrange(1, 60)))) for k in range(60)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "a b"), (906, "A B"), (907, "a\x0bb")]
    rows += [rows[0], rows[0], (None, rows[5][1]), (None, "lonely words here")]
    rows.append((5000, " ".join(f"v{k}" for k in range(30_000))))
    rows.append((5001, " ".join(f"v{k}" for k in range(2_000, 30_000))))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = near_corpus(width)
    out = nd.near_groups(frame(spark, rows), width).collect()
    assert len(out) == len(rows)
    sets = [(i, shingles(t, width)) for i, t in rows]
    want = Counter((i, len(s), c) for (i, s), c in zip(sets, linked_components(sets), strict=True))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in out)
    assert {k: v for k, v in got.items() if k[1]} == {k: v for k, v in want.items() if k[1]}
    assert all(r.component_id == r.doc_id and r.kept for r in out if not r.n_shingles)
    kept = Counter(r.component_id for r in out if r.kept and r.component_id is not None and r.n_shingles)
    assert set(kept.values()) == {1} and set(kept) == {c for _, n, c in want if n and c is not None}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_pairs_without_ids_of_their_own(spark, doc_id):
    r = random.Random(3)
    rows = []
    for _ in range(800):  # 1,600 rows under one id, near in pairs
        w = [f"w{r.randrange(10**6)}" for _ in range(30)]
        rows += [(doc_id, " ".join(w)), (doc_id, " ".join(w[:-1]))]
    rows += rows[:20]
    df = frame(spark, rows).repartition(8)
    assert sum(r.kept for r in nd.near_groups(df, 5).collect()) == 800
    assert nd.drop_near(df, 5).count() == 800


def test_near_rows_keep_their_columns(spark):
    d = frame(spark, near_corpus(9))
    out = nd.drop_near(d, 5)
    assert out.columns == d.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(0) <= 1 and {900, 901, 902} <= set(ids)
    assert nd.drop_near(d.limit(0), 5).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.floats(0.3, 1.0))
def test_estimate_is_near_the_similarity(seed, share):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 2**64, 800, dtype=np.uint64))
    same = int(len(a) * share)
    b = np.unique(np.concatenate([a[:same], r.integers(0, 2**64, len(a) - same, dtype=np.uint64)]))
    sig = [np.frombuffer(nd.pack(nd.minima(x)), np.uint64)[None, :] for x in (a, b)]
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(float(nd.estimate(*sig)[0]) - true) < 0.2


def test_components_of_paths_hubs_and_nothing(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 300)] + [(7, 7), (5000, 4000)]
    random.Random(1).shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 300)}, 5000: 4000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- packing

TEXTS = ["Hello world. This is it!\nNew line? Yes", "", "  \n\n ", "a" * 5000, "é" * 300 + ".", "x. " * 3000, "<|endoftext|> no",
         " tabs\t\ttabs", "1234567890 " * 700, "don't we'll  I'm", "日本語。テスト", "word " * 9000, "\r\n" * 50, "😀 ok"]


@pytest.fixture(scope="module")
def slow_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_those_of_tokenizers(slow_tokenizer):
    encode = pw.encoder()
    for t in TEXTS:
        assert encode(t).tolist() == slow_tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_on_any_text(text):
    if not hasattr(test_ids_equal_on_any_text, "pair"):
        import public_tokenizers
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        t.encode_special_tokens = True
        test_ids_equal_on_any_text.pair = pw.encoder(), t
    fast, slow = test_ids_equal_on_any_text.pair
    assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_pieces_give_back_every_id(spark, slow_tokenizer):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(3, "again"), (None, None), (3, "again")]
    out = pw.pack(frame(spark, rows).coalesce(2)).collect()
    ids = [(i, [*slow_tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert any(i == r.doc_id and len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for i, x in ids)
    assert sum(r.length for r in out) == sum(len(x) for _, x in ids)
    for i, pieces in by_doc.items():
        if i != 3 and i is not None:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at
                at += r.length
            assert at == pieces[0].doc_tokens
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
    assert pw.pack(frame(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 6)), min_size=1, max_size=9))
def test_cuts_are_the_cheapest(steps):
    points = np.cumsum([s for s, _ in steps])
    penalty = np.array([p for _, p in steps])
    cuts = pw.best_cuts(points, penalty, window=12)

    def cost(chosen):
        at, total = 0, 0
        for c in chosen:
            if c - at > 12:
                return math.inf
            total += 12 - (c - at) + int(penalty[list(points).index(c)])
            at = c
        return total
    inner = points[:-1].tolist()
    best = min(cost([p for b, p in enumerate(inner) if m >> b & 1] + [int(points[-1])]) for m in range(1 << len(inner)))
    assert cuts[-1] == points[-1] and cost(cuts) == best


def test_windows_are_nearly_full(spark):
    r = random.Random(3)
    rows = [(k, " ".join("".join(r.choice("abcdefg") for _ in range(5)) + ("." if r.random() < 0.08 else "") for _ in range(r.randrange(5, 900)))) for k in range(400)]
    out = pw.pack(frame(spark, rows).coalesce(1)).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(x.n for x in out) / (2048 * len(out)) > 0.98


# ---------------------------------------------------------------- toxicity

def toxic_corpus(n, seed):
    r = random.Random(seed)
    plain, bad = [f"word{k}" for k in range(300)], ["scumbag", "moronic", "trashy"]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.randrange(20, 200))]
        y = int(r.random() < 0.2)
        if y:
            for _ in range(r.randrange(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_held_out_accuracy(spark):
    rows, labels = toxic_corpus(900, 1)
    rows += [(None, "moronic scumbag"), (2000, None), (2001, ""), (2002, "word1 " * 30_000 + "scumbag moronic trashy"), (5, rows[5][1])]
    lab = spark.createDataFrame(labels + [(5, 1, labels[5][2]), (None, 0, 1), (3000, 0, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    out = tx.scored(frame(spark, rows), lab).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = {i: y for i, _, y in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert {r.predicted for r in out if r.doc_id in (2000, 2001)} == {0}


def test_toxic_words_of_unsampled_rows_have_weight(spark):
    """700 toxic words of 18 n-grams each, counted over all labelled rows: 8,192 n-grams do not hold them."""
    r = random.Random(3)
    plain, bad = ["".join(r.choices("abcdefghij", k=7)) for _ in range(1500)], ["".join(r.choices("klmnopqrst", k=8)) for _ in range(700)]
    rows, labels = [], []
    for i in range(14_000):
        w = r.choices(plain, k=12)
        if i % 2:
            w.insert(6, bad[i // 2 % len(bad)])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, i % 2))
    rows += [(5, rows[5][1]), (None, "x")]
    d, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    # By brute force: the documents of each class that hold an n-gram, over all rows outside the held-out fold.
    want, docs, every = np.zeros((2, 1 << tx.BITS), np.int64), [0, 0], np.ones(1 << tx.BITS, bool)
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5:
            want[i % 2, tx.ngrams([t.encode()], every)[1]] += 1
            docs[i % 2] += 1
    got = {x.gram: (x.clean, x.toxic) for x in tx.count(tx.labelled(d, lab)).collect()}
    assert got.pop(-1) == tuple(docs)
    assert got == {int(g): (want[0, g], want[1, g]) for g in np.flatnonzero(want.sum(0))}
    model = tx.train(d, lab, per_class=4000)
    learned = Counter(t.split()[6] for i, t in rows if i is not None and i % 2 and zlib.crc32(str(i).encode()) % 5)
    each = [(model.weights[tx.ngrams([w.encode()], every)[1]] > 0).sum() for w in bad if learned[w] >= tx.MIN_DOCS]
    assert len(each) > 600 and min(each) >= 10


def test_fit_equals_plain_gradients(monkeypatch):
    monkeypatch.setattr(tx, "_PIECE", 7)
    g = np.random.default_rng(1)
    dense = (g.random((40, 12)) < 0.3).astype(float)
    dense[3] = dense[:, 5] = 0
    y, r = (g.random(40) < 0.4).astype(float), g.normal(size=12)
    v, b = tx.fit_logistic([np.flatnonzero(x).astype("<u4") for x in dense], y, r)
    x = dense * r
    for _ in range(4000):
        e = 1 / (1 + np.exp(-(x @ v + b))) - y
        v, b = v - 0.02 * (x.T @ e + v), b - 0.02 * e.sum()
    again = tx.fit_logistic([np.flatnonzero(t).astype("<u4") for t in dense], y, r)
    assert np.allclose(again[0], v, atol=0.02) and again[1] == pytest.approx(b, abs=0.02)


def test_score_does_not_depend_on_batches():
    model = tx.Model(np.random.default_rng(0).normal(size=1 << tx.BITS).astype(np.float32), 0.3)
    texts = [b"", b"A", b"Hello  World", b"x" * 3_000_000, b"hello world"]
    whole, alone = model.score(texts), [float(model.score([t])[0]) for t in texts]
    assert np.allclose(whole, alone) and whole[0] == pytest.approx(1 / (1 + math.exp(-0.3)))


def test_toxicity_without_both_classes(spark):
    d = frame(spark, [(1, "a b"), (2, "c")])
    for lab in ([], [(1, 1, 0), (2, 1, 0)]):
        out = tx.scored(d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")).collect()
        assert len(out) == 2 and len({r.score for r in out}) == 1
    assert tx.scored(d.limit(0), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).count() == 0
    for lab in ([], [(1, 1, 0)], [(1, 1, 1), (2, 1, 1), (3, 0, 1)], [(1, 1, None)]):
        kept = tx.keep_clean(d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int"))
        assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_stages_keep_columns_of_any_name(spark):
    """The names that the stages use themselves, as further columns of the documents."""
    import corpus_pipeline as cp
    names = ["score", "_SCORE", "_score", "_copies", "_tag", "_k", "_times", "_kid", "_ktag", "_rows", "own", "times", "mark", "copies", "tag", "id", "rows", "a.b", "col"]
    names = [n for i, n in enumerate(names) if n.lower() not in [m.lower() for m in names[:i]]]
    rows, labels = toxic_corpus(120, 4)
    rows += [(500, rows[0][1]), (500, rows[0][1]), (None, None), (501, "")]
    d = spark.createDataFrame([(i, t, "en", "a", 1, *[f"{n}{k}" for n in names]) for k, (i, t) in enumerate(rows)],
                              "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    given = {tuple(r) for r in d.collect()}
    for out in (tx.keep_clean(d, lab), cp.drop_copies(d), cp.drop_near(d), cp.mix_documents(d, lab)):
        got = [tuple(r) for r in out.collect()]
        assert out.columns == d.columns and got and set(got) <= given
    assert cp.pack(d).count() > 0


# ---------------------------------------------------------------- class n-grams

def test_lm_base_scores_equal_brute_force(spark):
    r = random.Random(5)
    langs = [[f"{c}{k}" for k in range(200)] for c in "xyz"]
    rows = [(i, " ".join(r.choice(langs[i % 3][:20] if r.random() < 0.7 else langs[i % 3]) for _ in range(r.randrange(1, 80)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1001, "X1 x1\tx2\x0bnew"), (None, "x1 x2"), (5, rows[5][1]), (1002, "unseen " * 20_000)]
    out = lm.scored(frame(spark, rows)).collect()
    assert len(out) == len(rows)

    def toks(t):
        return [*(t or "").encode().lower().split(), b""]
    counts = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(toks(t))
    n = sum(counts.values())
    z = n + 0.5 * (len(counts) + 1)
    want = sorted(((i if i is not None else -1), len(w), sum(x in counts for x in w), round(sum(math.log10((counts[x] + 0.5) / z) for x in w), 6)) for i, w in ((i, toks(t)) for i, t in rows))
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out)
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-4)
    assert {r.train_tokens for r in out} == {n}
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.scored(frame(spark, [])).count() == 0
    only = lm.scored(frame(spark, [(None, "a b")])).collect()
    assert only[0].train_tokens == 0 and only[0].base_score == pytest.approx(0, abs=1e-9)


def lm_table(model, words):
    """Count and class of every training word."""
    head = {w: (int(c), int(k)) for w, c, k in zip(model.vocab.index, model.head_count, model.vocab.number, strict=True)}
    rest = {bytes(r.word): (r.c, r.cls) for r in words.collect()}
    assert not head.keys() & rest.keys()
    return head | rest


def test_lm_probabilities_sum_to_one(spark):
    rows = [(i, f"a{i % 7} b{i % 11} c{i % 3}") for i in range(120)]
    model, words = lm.train(frame(spark, rows))
    table = lm_table(model, words)
    for before in range(lm.SIZES.classes):
        total = 0.5 / model.total * 10 ** model.unseen[before]
        for c, cls in table.values():
            total += (c + 0.5) / model.total * 10 ** model.gain[before, cls]
        assert total == pytest.approx(1, abs=1e-6)


def test_lm_class_scores_equal_brute_force(spark):
    """Few own units and a small head: most words choose their class by gain, and many are scored through the join."""
    sizes = lm.Sizes(own_units=24, endings=10, classes=6, head=80)
    r = random.Random(9)
    kinds = [[f"{c}{k}{r.choice('pqrs')}" for k in range(60)] for c in "abcdef"]
    rows = [(i, " ".join(kinds[(i + j) % 6][min(int(r.expovariate(0.08)), 59)] for j in range(r.randrange(2, 60)))) for i in range(500)]
    rows += [(1000, None), (1001, "new " * 5 + rows[3][1].upper()), (5, rows[5][1]), (1002, "a1 a1 a1 zz zz")]
    d = frame(spark, rows)
    model, words = lm.train(d, sizes)
    table = lm_table(model, words)
    head = model.vocab.index
    assert 24 < len(head) <= 80 < len(table)

    def before(w):
        return table[w][1] if w in head else model.vocab.by_ending(w)

    def toks(t):
        return [b"", *(t or "").encode().lower().split(), b""]
    # Class bigrams, shares and lifts by plain counting.
    train = [toks(t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    n = np.zeros((6, 6))
    for line in train:
        for a, b in zip(line, line[1:]):
            n[before(a), table[b][1]] += 1
    once = np.array([sum(c == 1 and k == g for c, k in table.values()) for g in range(6)])
    pi = (once + 1 / 6) / (once.sum() + 1)
    share = (np.array([sum(c + 0.5 for c, k in table.values() if k == g) for g in range(6)]) + 0.5 * pi) / model.total
    lift = (n + lm.PRIOR * share) / (n.sum(axis=1, keepdims=True) + lm.PRIOR) / share
    assert np.allclose(np.log10(lift), model.gain)

    def score(t):
        line = toks(t)
        return sum(math.log10((table[b][0] + 0.5) / model.total * lift[before(a), table[b][1]]) if b in table
                   else math.log10(0.5 / model.total * float(lift[before(a)] @ pi)) for a, b in zip(line, line[1:]))
    want = sorted((i, round(score(t), 6)) for i, t in rows)
    got = sorted((x.doc_id, round(x.score, 6)) for x in lm.scored(d, sizes).collect())
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-4)
    # Words of one kind follow words of one other kind: those that chose by gain meet in few classes.
    often = [(w, k) for w, (c, k) in table.items() if c >= 30 and w]
    for kind in b"abcdef":
        cls = Counter(k for w, k in often if w[0] == kind)
        assert cls.most_common(1)[0][1] >= 0.8 * sum(cls.values())


def test_best_class_is_the_dense_exchange_step():
    r = np.random.default_rng(3)
    k, units = 5, 30
    for _ in range(40):
        n = np.where(r.random((units, units)) < 0.2, r.integers(1, 9, (units, units)), 0).astype(float)
        cls = r.integers(k, size=units)
        member = np.eye(k)[cls]
        u = int(r.integers(units))
        right, left = (n @ member)[u], (n.T @ member)[u]
        rest = n.copy()
        rest[u] = rest[:, u] = 0
        own_r, own_l = right.copy(), left.copy()
        own_r[cls[u]] -= n[u, u]
        own_l[cls[u]] -= n[u, u]
        base = member.T @ rest @ member
        x = lm._xlogx

        def value(g):
            p = base.copy()
            p[g] += own_r
            p[:, g] += own_l
            p[g, g] += n[u, u]
            after, before = base.sum(axis=1), base.sum(axis=0)
            return (x(p).sum() - x(after[g] + own_r.sum() + n[u, u]) + x(after[g]) - x(before[g] + own_l.sum() + n[u, u]) + x(before[g]))
        values = [value(g) for g in range(k)]
        new = lm.best_class(member.T @ n @ member, int(cls[u]), right, left, n[u, u])
        assert values[new] == pytest.approx(max(values), abs=1e-6)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 9), st.integers(1, 40))
def test_best_classes_are_those_of_the_dense_exchange_step(seed, k, words):
    """Many words at once, with equal and different counts, some next to themselves, some without words after them."""
    r = np.random.default_rng(seed)
    units = words + 5
    n = np.where(r.random((units, units)) < 0.3, r.integers(1, 4, (units, units)), 0).astype(float)
    n[r.integers(units, size=units // 3)] = 0
    cls = r.integers(k, size=units)
    member = np.eye(k)[cls]
    pairs, right, left, own_n = member.T @ n @ member, n @ member, n.T @ member, np.diagonal(n)
    x = lm._xlogx

    def values(u):
        rest = n.copy()
        rest[u] = rest[:, u] = 0
        base, a, b = member.T @ rest @ member, right[u].copy(), left[u].copy()
        a[cls[u]] -= n[u, u]
        b[cls[u]] -= n[u, u]
        for g in range(k):
            p = base.copy()
            p[g] += a
            p[:, g] += b
            p[g, g] += n[u, u]
            after, before = base[g].sum(), base[:, g].sum()
            yield x(p).sum() - x(after + a.sum() + n[u, u]) + x(after) - x(before + b.sum() + n[u, u]) + x(before)
    for cells in (1, 1 << 22):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lm, "CELLS", cells)
            new = lm.best_classes(pairs, cls[:words], right[:words], left[:words], own_n[:words])
        for u in range(words):
            each = list(values(u))
            assert each[new[u]] == pytest.approx(max(each), abs=1e-6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbZ\u00c9\u0085 \t\n\x0b\x0c\r\x1c\x00", max_size=12), max_size=12), st.integers(1, 30))
def test_lines_are_the_words_between_two_ends(texts, piece):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lm, "PIECE", piece)
        got = list(lm.lines(pa.array(texts, pa.string())))
    tokens = [x for line in got for x in line.words.take(pa.array(line.word)).to_pylist()]
    assert tokens == [x for t in texts for x in [b"", *lm.words_of(t), b""]]
    assert sum(len(line.follow) for line in got) == sum(1 + len(lm.words_of(t)) for t in texts)
    counts = Counter()
    for b in lm._count([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])]):
        assert len(set(b.column("word").to_pylist())) == len(b)
        counts.update(dict(zip(b.column("word").to_pylist(), b.column("c").to_pylist(), strict=True)))
    assert counts == Counter(x for t in texts for x in [*lm.words_of(t), b""])


def test_words_are_looked_up_by_head_and_ending():
    vocab = lm.Vocabulary({b"": 0, b"abc": 1, b"x": 2}, np.array([5, 6, 7]), {b"abc": 8, b"x": 9, b"\xc3\xa9": 10}, 11)
    words = [b"x", b"zabc", b"abc", b"bc", b"", b"yx", b"\xc3\xa9", b"q\xc3\xa9"]
    number, head = vocab.look_up(pa.array(words, pa.binary()))
    assert head.tolist() == [vocab.index.get(w, -1) for w in words]
    assert number.tolist() == [vocab.number[vocab.index[w]] if w in vocab.index else vocab.by_ending(w) for w in words]
    empty = lm.Vocabulary({}, np.zeros(0, np.int64), {}, 3)
    assert [x.tolist() for x in empty.look_up(pa.array([b"", b"a"], pa.binary()))] == [[3, 3], [-1, -1]]


def test_no_python_call_for_each_token_or_word():
    """The work in tasks is done by numpy and Arrow: calls grow with pieces and batches, not with tokens and words."""
    words = [f"w{k}x{k % 7}" for k in range(3000)]
    texts = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(words * 10)])], names=["doc_id", "text"])
    vocab = lm.Vocabulary({w.encode(): k for k, w in enumerate(words[:1000])}, np.arange(1000) % 7, {f"{k}x1".encode(): 3 for k in range(9)}, 7)
    model = lm.Model(vocab, np.ones(1000), np.zeros(1000), np.zeros((8, 8)), np.zeros(8), 1, 1.0)
    r = np.random.default_rng(1)
    held = [[{"slot": int(k), "n": int(r.integers(1, 9))} for k in r.choice(8, 3, replace=False)] for _ in words]
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("n", pa.int64())]))
    tail = pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words]), pa.nulls(3000, pa.int32()), pa.array([9] * 3000), pa.array(held, kind)],
                                      names=["word", "pair", "c", "held"])

    def sent(value):
        return type("Sent", (), {"value": value})
    pairs = sent(r.integers(1, 99, (8, 8)).astype(float))
    for run, batch in ((lm._count, texts), (lm._bigrams(sent(vocab), 8), texts), (lm._neighbours(sent(vocab), 5, 8), texts),
                       (lm._class_pairs(sent(vocab), 8), texts), (lm._score(sent(model)), texts), (lm._tail_classes(sent(vocab), pairs), tail)):
        calls = Counter()
        sys.setprofile(lambda frame, event, arg, calls=calls: calls.update([event]))
        try:
            for _ in run([batch]):
                pass
        finally:
            sys.setprofile(None)
        assert 0 < sum(calls.values()) < 2500


def test_exchange_finds_planted_classes():
    r = np.random.default_rng(2)
    units, groups = 40, 4
    n = np.zeros((units, units))
    for _ in range(30_000):
        g = r.integers(groups)
        n[r.integers(10) + 10 * g, r.integers(10) + 10 * ((g + 1) % groups)] += 1
    cls = lm.exchange(n, classes=4, sweeps=20)
    assert all(len(set(cls[10 * g:10 * g + 10])) == 1 for g in range(groups)) and len(set(cls)) == 4


# ---------------------------------------------------------------- licences

def test_licence_variants(spark):
    mit = lic._MIT_GRANT
    rows = [(1, "Copyright (c) 2020 Ann\nCopyright 2021 Bob\n\n" + mit.upper().replace(" ", "  ")), (2, "THE MIT LICENSE (MIT)\n\n" + mit.replace('"', "'").replace("sublicense", "sub-license")),
            (3, mit + " extra"), (4, "Some prose.\nReleased under the MIT Licence\nmore\nlicensed under cc-by-nc 4.0"), (5, "Released under the MIT license!"),
            (6, None), (7, ""), (None, "Licensed under the ISC License."), (5, "Released under the MIT license!"), (8, "We took the license.\nLicensed under the Apache License, Version 2.0.")]
    out = lic.scan(frame(spark, rows), lic.known_texts(spark)).collect()
    got = sorted(((r.doc_id or 0), r.license or "", r.notices, r.n_notice_lines) for r in out)
    assert got == [(0, "ISC", "", 0), (1, "MIT", "", 0), (2, "MIT", "", 0), (3, "", "", 0), (4, "", "CC-BY-NC-4.0,MIT", 2), (5, "MIT", "", 0), (5, "MIT", "", 0),
                   (6, "", "", 0), (7, "", "", 0), (8, "", "Apache-2.0", 1)]
    assert {r.canonical_sha256 for r in out if r.doc_id in (6, 7)} == {hashlib.sha256(b"").hexdigest()}
    assert lic.scan(frame(spark, []), lic.known_texts(spark)).count() == 0


def test_wrapped_licences_at_any_width(spark):
    import textwrap
    want, rows = [], []
    for name, texts in lic.TEXTS.items():
        for t in texts:
            for width in (20, 40, *range(60, 81)):
                wrapped = "\n\n".join(textwrap.fill(p, width) for p in t.split("\n\n"))
                want.append((len(rows), name))
                rows.append((len(rows), ["", "Copyright (c) 2019, Ann B.\nAll rights reserved.\n\n", "Copyright Ann and others\n\n", "// © Ann\n(c) 2020 Bob\n"][width % 4] + wrapped))
    got = sorted((r.doc_id, r.license) for r in lic.scan(frame(spark, rows), lic.known_texts(spark)).collect())
    assert got == want


def test_long_licences_and_lines_without_cues(spark):
    import os
    import textwrap
    known = "/usr/share/common-licenses/"
    rows, want = [], {}
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")):
        if os.path.exists(known + file):
            t = open(known + file, encoding="utf-8").read()
            for text in (t, t.upper(), "\n\n".join(p if "Copyright (C)" in p else textwrap.fill(p, 61) for p in t.split("\n\n"))):
                want[len(rows)] = name
                rows.append((len(rows), text))
    lines = ["Released into the public-domain under CC0 1.0.", "Released  into the\tpublic domain under CC0 1.0."]
    notes = len(rows)
    rows += [(notes + k, "prose\n" + x) for k, x in enumerate(lines)] + [(notes + 2, "copyright notice of ours\nmine alone")]
    out = {r.doc_id: r for r in lic.scan(frame(spark, rows), lic.known_texts(spark)).collect()}
    assert {i: out[i].license for i in want} == want
    assert [out[notes + k].notices for k in range(2)] == ["CC0-1.0", "CC0-1.0"] and out[notes + 2].notices == ""
    own = spark.createDataFrame([("Ours", "Do as you please")], "license string, text string")
    assert [r.license for r in lic.scan(frame(spark, [(1, "do as\nyou  PLEASE!")]), own).collect()] == ["Ours"]
