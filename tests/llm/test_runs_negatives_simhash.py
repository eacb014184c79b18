"""Periodic runs, hard negatives and SimHash groups against brute force, with odd rows, ties, hot keys and clashing names."""

import hashlib
import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshlark.llm import hardneg, periodic, simhash

SCHEMA = "doc_id long, text string, runs string, fp int, component_id string, id string, anchor string, h int, n int, `odd name.x` int"
ODD = ("r", 1, "c", "i", "a", 1, 2, 3)


def brute_runs(w, least):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapse(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_words(r, n, kinds):
    w = [r.randrange(kinds) for _ in range(n)]
    if n and r.random() < 0.6:
        a = r.randrange(n)
        p = 1 + (n - a) // (3 + r.randrange(8))
        w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    return w


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(0, 90), st.sampled_from([1, 2, 3, 12]), st.sampled_from([2, 5, 12, 20]))
def test_runs_are_those_of_brute_force(r, n, kinds, least):
    w = periodic_words(r, n, kinds)
    assert periodic.runs(w, None, least) == brute_runs(w, least)
    text = " ".join(map(str, w))
    assert next(periodic._texts([text], least)) == (brute_runs(w, least), collapse(list(map(str, w)), brute_runs(w, least)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_z_function(s):
    assert periodic.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def run_corpus():
    r = random.Random(5)
    texts = [" \n".join(f"wörd{x}" for x in periodic_words(r, r.randint(0, 200), r.choice([2, 30]))) for _ in range(80)]
    texts += [None, "", " \t\r\n", "one", "x " * 40_000, "a b c d e f " * 5 + "tail", "a b c " * 20, texts[0]]
    return [(k, t, *ODD) for k, t in enumerate(texts)] + [(None, "q " * 30, *ODD), (3, "z z " * 20, *ODD), (3, "z z " * 20, *ODD)]


def test_periodic_runs_of_a_table(spark):
    rows = run_corpus()
    found = periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()

    def expected(t):
        w = [x.decode() for x in (t or "").encode().split()]
        f = brute_runs(w, 12) if len(w) < 1000 else [(0, len(w), 1)]
        return f, collapse(w, f)

    want = sorted(((r[0], *expected(r[1])) for r in rows), key=repr)
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=repr) == want
    assert periodic.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_run_columns_and_planted_texts(spark):
    rows = run_corpus()
    texts = {(r.doc_id, r.text) for r in periodic.planted(spark.createDataFrame(rows, SCHEMA)).collect()}

    def planted(i, t):
        w = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is None or h % 10 or not w:
            return t
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(w[a + (k - a) % p] if k >= a else x for k, x in enumerate(w)).decode()

    assert texts == {(r[0], planted(r[0], r[1])) for r in rows} and sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 3
    found = periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "runs", periodic.longest().alias("best"), periodic.runs_digest().alias("d")).collect()
    for r in found:
        best = min(r.runs, key=lambda x: (-x.length, x.start, x.period), default=None)
        assert r.best == best and r.d == hashlib.sha256("".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs).encode()).hexdigest()


# Hard negatives.

VECTORS = "vec_id long, embedding array<double>, label int, key int, part string, `positive score` int, n int"


def brute_negatives(rows, anchor, scale=256, positives=5, negatives=10):
    kept = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, label, tuple(math.floor(scale * x) for x in v))
        if row not in kept:
            kept.append(row)
    out = []
    for i, label, q in kept:
        if not anchor(i):
            continue
        score = [(-sum(x * y for x, y in zip(q, q2, strict=True)), j, l2) for j, l2, q2 in kept if len(q2) == len(q)]
        for p, j, _ in sorted(s for s in score if s[2] == label and s[1] != i)[:positives]:
            fits = sorted(s for s in score if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fits)]
    return sorted(out)


def vector_rows(seed, n, dim=6, clusters=7):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(clusters, dim))
    x = centers[r.integers(clusters, size=n)] + 0.3 * r.normal(size=(n, dim))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    rows = [(k, v.tolist(), int(r.integers(4))) for k, v in enumerate(x)]
    # One vector that a third of the rows has, with every label: ties.
    rows = [(k, x[0].tolist() if k % 3 == 0 else v, label) for k, v, label in rows]
    extra = [(None, x[1].tolist(), 1), (n, None, 1), (n + 1, x[1].tolist(), None), (n + 2, [*x[1].tolist()[1:], None], 1), (n + 3, [math.nan] * dim, 1), (n + 4, [-math.inf] * dim, 2)]
    extra += [(n + 5, [], 1), (n + 6, [], 2), (20, x[2].tolist(), 3), rows[40], (n + 7, [0.5] * (dim + 1), 1), (n + 8, [0.5] * (dim + 1), 1), (n + 9, [0.3] * (dim + 1), 2), (60, [0.5] * (dim + 1), 1)]
    return [(*r, 1, "p", 2, 3) for r in rows + extra]


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # many cells, blocks, groups and slices
        for name, value in (("BLOCK", 16), ("LEAF", 4), ("GROUP", 3), ("ANCHOR_LEAF", 2), ("SLICE", 3)):
            monkeypatch.setattr(hardneg, name, value)
    rows = vector_rows(1, 300)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = hardneg.hard_negatives(df, F.col("vec_id") % 10 == 0)
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and sorted(map(tuple, found.collect())) == want
    assert hardneg.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hardneg.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_hard_negatives_of_great_and_negative_scores(spark):
    r = random.Random(2)
    rows = [(k, [r.choice([-1, 1]) * 2.0 ** r.randint(0, 20) for _ in range(4)], k % 3, 1, "p", 2, 3) for k in range(60)]
    found = hardneg.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 5 == 0)
    with pytest.raises(Exception, match="does not fit a long"):
        hardneg.hard_negatives(spark.createDataFrame([(1, [1e30], 1, 1, "p", 2, 3)], VECTORS), F.lit(True)).collect()


def test_whole_groups_are_pruned():
    r = np.random.default_rng(4)
    far = lambda at, n: (r.normal(size=(n, 8)) + 1000 * np.eye(8)[at]).astype("<i4")
    group = hardneg.Tree(np.arange(40), np.zeros(40, np.int64), far(0, 40), 8)
    blocks = [hardneg.Tree(np.arange(100) + 100 * k, np.zeros(100, np.int64), far(k, 100), 16) for k in range(8)]
    tops, best, read = [np.array(x) for x in zip(*(b.top() for b in blocks), strict=True)], hardneg.Best(40, 1, 5), []
    hardneg.search(
        group, tops, lambda k: read.append(k) or blocks[k], lambda a, tree, c, low, high: high >= best.score[group.lo[a] : group.hi[a], 0, -1].min(),
        lambda rows, found, ids, labels: best.add(rows, 0, found, np.ones(found.shape, bool), ids),
    )
    assert read == [0]


# SimHash.


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fingerprints):
    """Component of each (id, fingerprint): smallest id reachable over at most three differing bits."""
    root = list(range(len(fingerprints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(fingerprints)), 2):
        if (fingerprints[a][1] ^ fingerprints[b][1]).bit_count() <= 3:
            root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(fingerprints):
        low.setdefault(find(k), []).append(i)
    return [min((x for x in low[find(k)] if x is not None), default=None) for k in range(len(fingerprints))]


def simhash_corpus():
    r = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(150, 400))) for _ in range(25)]
    for k in range(120):  # near copies, one word after another changed
        w = texts[r.randrange(10)].split()
        w[r.randrange(len(w))] = r.choice(words).upper()
        texts.append(" ".join(w))
    texts += [None, "", " \n\t", "One", "two words", "one two three", "x " * 30_000, "épsilon Épsilon " * 9, texts[0].upper(), texts[0], "a  b\tc d", "a b c d"]
    return [(k + 1, t, *ODD) for k, t in enumerate(texts)] + [(None, texts[0], *ODD), (None, "only this one has no id at all", *ODD), (4, texts[2], *ODD), (0, "q w e r t y", *ODD)]


@pytest.mark.parametrize("product", [None, ("golay", "hamming"), ("golay", "golay")])
def test_simhash_groups(spark, monkeypatch, product):
    if product == ("golay", "hamming"):  # every anchor in blocks
        monkeypatch.setattr(simhash, "BLOCK", 8)
    rows = simhash_corpus()
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), product=product).select("doc_id", simhash.as_hex().alias("x"), "component_id").collect()
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, brute_groups(prints), strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert len({c for *_, c in want}) < len(rows) - 60
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_codes_are_perfect_and_near_words_meet():
    for name, size in (("golay", 1 << 12), ("hamming", 1 << 4)):
        code = simhash.factor(name)
        assert 1 << code.k == size and (code.within[:, 0] == 1).all()
    r = np.random.default_rng(1)
    for product in simhash.PRODUCTS:
        x = r.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2)
        y = x.copy()
        for _ in range(3):  # some bits twice: none, one or three of them differ
            y ^= np.uint64(1) << r.integers(0, 64, 200).astype(np.uint64)
        (rows, home, is_home), (others, came, _) = simhash.anchors(x, product), simhash.anchors(y, product)
        homes, reached = dict(zip(rows[is_home], home[is_home], strict=True)), set(zip(others.tolist(), came.tolist(), strict=True))
        assert len(homes) == 200 and all((k, int(a)) in reached for k, a in homes.items())
        assert len(set(zip(rows.tolist(), home.tolist(), strict=True))) == len(rows)
    sizes = [simhash.product_for(n) for n in (10, 10**6, 10**7, 10**9)]
    assert sizes[0] == ("golay",) and len(set(sizes)) >= 3


def test_links_join_all_that_is_near_without_all_pairs():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 1, dtype=np.uint64)
    x = np.unique(base ^ (np.uint64(1) << r.integers(0, 20, 3000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 20, 3000).astype(np.uint64)))
    a, b = simhash.near(x, x)
    assert len(a) <= 2 * len(x)
    root = dict(zip(x.tolist(), x.tolist(), strict=True))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        root[find(p)] = find(q)
    assert len({find(k) for k in x.tolist()}) == 1
