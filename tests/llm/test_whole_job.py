"""Where an operator once did less than its whole job."""

import math
import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from meshlark.llm import htmltext, neardup, toxicity


def test_toxicity_counts_are_exact(spark, monkeypatch):
    """Features against models counted in plain dictionaries; `xjzh` and `vile` once shared a bucket, and pairs seen once had none."""
    r = random.Random(5)
    names = [a + b for a in "bcdfg" for b in "aeiou"] + ["vile", "xjzh"]
    docs = [(k, " ".join(r.choice(names[: 27 if k % 3 else 26]) for _ in range(r.randint(0, 60)))) for k in range(80)] + [(90, None), (3, "vile ba"), (None, "ba ba")]
    labels = {k: int(k % 3 == 0) for k in range(70)}
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 4
    cut = lambda t: (t or "").split()
    shared = Counter(w for _, t in docs for w in cut(t))
    pairs = [Counter(p for i, t in docs if labels.get(i) == c and fold(i) < 2 for p in zip(["", *cut(t)], cut(t))) for c in (0, 1)]
    d, kinds = [], []
    for c in (0, 1):
        m = Counter(pairs[c].values())
        d.append(m[1] / (m[1] + 2 * m[2]))
        kinds.append(Counter(w for _, w in pairs[c]))

    def word(c, w):
        total = sum(kinds[c].values())
        left = sum(min(x, toxicity.DISCOUNT) for x in kinds[c].values()) / total
        return max(kinds[c][w] - toxicity.DISCOUNT, 0) / total + left * (shared[w] + 1) / (sum(shared.values()) + len(shared))

    def pair(c, v, w):
        n, after = sum(x for (y, _), x in pairs[c].items() if y == v), sum(y == v for y, _ in pairs[c])
        return (max(pairs[c][v, w] - d[c], 0) + d[c] * after * word(c, w)) / n if n else word(c, w)

    def brute(t):
        w = cut(t)
        if not w:
            return [0.0] * 4
        low = [math.log(word(1, x) / word(0, x)) for x in w]
        runs = [sum(low[k : k + 4]) for k in range(max(1, len(w) - 3))]
        top = sorted({x: y for x, y in zip(w, low)}.values())[-3:]
        return [sum(math.log(pair(1, *p) / pair(0, *p)) for p in zip(["", *w], w)) / len(w), max(low), max(runs) / min(4, len(w)), sum(top) / 3]

    want = sorted((repr(i), brute(t)) for i, t in docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    for block_words, part_keys in ((2_000_000, 3_000_000), (150, 100)):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", block_words)
        monkeypatch.setattr(toxicity, "PART_KEYS", part_keys)
        got = sorted((repr(x["id"]), list(x["f"])) for x in toxicity.measure(frame, marks).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        for (_, a), (_, b) in zip(got, want, strict=True):
            assert a == pytest.approx(b, abs=1e-9)


def test_html_text_is_the_same_at_any_group_size(spark):
    r = random.Random(2)
    pages = []
    for k in range(120):
        section = f"s{k % 12}"
        lines = ["Site", f"Section {section}", *(f"own {k} {j}" for j in range(3)), f"End of {section}"]
        if k % 10 == 3:
            section, lines = "t", ["copied one", "copied two", "copied three"]
        pages.append((k, f"http://h.example/{section}/{r.randrange(1000)}", "".join(f"<p>{x}</p>" for x in lines)))
    pages += [(200 + k, f"http://h.example/s5/x{k}", pages[5][2]) for k in range(30)] + [(None, None, None), (7, None, "<p>a")] * 3
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    whole = sorted(map(repr, htmltext.extract(frame).collect()))
    assert not any("Section" in x for x in whole)
    for group_rows in (40, 9, 2):
        assert sorted(map(repr, htmltext.extract(frame, group_rows=group_rows).collect())) == whole


def test_alignment_in_linear_space_is_longest(monkeypatch):
    r = random.Random(4)
    for _ in range(40):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 60))] for _ in range(2))
        monkeypatch.setattr(htmltext, "ROW_BITS", 1 << 31)
        whole = htmltext.common(a, b)
        monkeypatch.setattr(htmltext, "ROW_BITS", 30)
        found, rest = htmltext.common(a, b), iter(b)
        assert len(found) == len(whole) and found == sorted(set(found)) and all(any(x == y for y in rest) for x in (a[i] for i in found))


def test_html_lines_outside_an_article_are_decided_by_differencing(spark):
    plain = "<h1 class='entry-title'>Title {0}</h1><div class='post-meta'>By us</div><p>Story {0}<p>More {0}<p>Site footer line"
    mixed = "<div>Site name</div><p>Lead {0}</p><article><p>Shared words</p><p>Text {0}</p></article><p>After {0}</p>"
    data = [(k, f"http://{h}.example/{k}", x.format(k)) for h, x in (("a", plain), ("b", mixed)) for k in (1, 2)]
    out = [r["text"] for r in htmltext.extract(spark.createDataFrame(data, "page_id long, url string, html string")).orderBy("url").collect()]
    assert out == [f"Title {k}\nStory {k}\nMore {k}" for k in (1, 2)] + [f"Lead {k}\nShared words\nText {k}\nAfter {k}" for k in (1, 2)]


def test_html_template_goes_where_it_is_most_of_a_page(spark):
    around = "".join(f"<p>Template line {k}" for k in range(5))
    data = [(k, f"http://a.example/{k}", f"{around}<p>own {k // 2}<p>more {k // 2}{around}") for k in range(2, 8)]
    data += [(k, f"http://b.example/{k}", "<p>one<p>two<p>three") for k in (8, 9)]
    out = [r["text"] for r in htmltext.extract(spark.createDataFrame(data, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert out == [f"own {k // 2}\nmore {k // 2}" for k in range(2, 8)] + ["one\ntwo\nthree"] * 2


def test_rows_without_an_id_or_with_a_repeated_one(spark, tmp_path):
    text = "one two three four five six seven"
    d = spark.createDataFrame([(4, text), (None, text), (5, "a quite different text of some words"), (None, "nobody else has this")], "doc_id long, text string")
    found = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in neardup.near_duplicates(d).collect()}
    assert found[4, 4] == (4, True) and found[None, 4] == (4, False) and found[None, 1] == (None, True)
    item = "this very passage of thirteen words or more is in the benchmark set as an item"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.createDataFrame([(None, item), (None, "clean"), (1, "also clean"), (1, item), (2, "clean too"), (3, None)], "doc_id long, text string")
    left = corpus_pipeline.decontamination(spark, d, str(tmp_path)).collect()
    assert sorted(map(repr, left)) == sorted(repr(r) for r in d.collect() if r["text"] != item)


def test_repair_stops_only_when_no_pair_is_frequent():
    """Any ids come back, and no pair is left with as many places as a rule needs; three-byte symbols are read by place."""
    import io

    import numpy as np

    from meshlark.llm import repair

    r = random.Random(8)
    for alphabet, n in ((2, 400), (5, 3000), (30, 3000)):
        ids = np.array([2 if r.random() < 0.02 else 3 + r.randrange(alphabet) for _ in range(n)] + [4] * 40 + [2])
        symbols, rules = repair.compress(ids, 2, 50, least=4)
        lengths = repair.expansion_lengths(rules, 50)
        assert (repair.expand(symbols, rules, lengths, 50) == ids).all()
        places, last = {}, {}
        for k, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)):
            if 2 not in pair and last.get(pair) != k - 1:
                places[pair] = places.get(pair, 0) + 1
                last[pair] = k
        assert max(places.values()) < 4
    docs = [[70_000 + r.randrange(9) for _ in range(500)] + [2] for _ in range(8)]
    data = repair.write_file(list(range(8)), [501] * 8, np.array([i for d in docs for i in d]), 2, 80_000)
    shard = repair.Shard(io.BytesIO(data))
    assert shard.head["arrays"]["symbols"][2] == "u3" and [shard.document(k).tolist() for k in range(8)] == docs and shard.ids(495, 1100).tolist() == [i for d in docs for i in d][495:1100]


def test_html_text_against_brute_force(spark):
    """Every page's nearest other page by sorted path, a plain table of common subsequences, and what is left of plain lines."""
    r = random.Random(11)
    template = [f"line {c} of the site" for c in "abcdefghij"]
    pages = []
    for k in range(90):
        own = [f"page {k} says {m}" for m in range(r.randint(0, 4))]
        shared = sorted(r.sample(template, r.randint(0, 8)))
        lines = sorted(shared[: len(shared) // 2]) + own + sorted(shared[len(shared) // 2 :])
        nav = "<nav>menu</nav>" if r.random() < 0.5 else ""
        main = f"<article><p>story {k % 9}</p></article>" if r.random() < 0.2 else ""
        pages.append((k, f"http://h{k % 2}/{r.choice('pq')}/{r.choice('xyz')}{r.randrange(12)}", nav + main + "".join(f"<p>{x}</p>" for x in lines)))
    pages += [(200, None, None), (201, "http://h0/p/x3", pages[0][2]), (202, "http://h0/p/x3", pages[0][2])]
    cut = {k: htmltext.blocks(h) for k, _, h in pages}
    plain = lambda k: [t for z, t in cut[k] if z != htmltext.OUT]

    def common(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        out, i, j = set(), len(a), len(b)
        while i and j:
            if a[i - 1] == b[j - 1]:
                out.add(i - 1)
                i, j = i - 1, j - 1
            elif t[i - 1][j] >= t[i][j - 1]:
                i -= 1
            else:
                j -= 1
        return out

    def prefix(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    want = {}
    for host in ("h0", "h1", ""):
        own = sorted(((u or "http:///").split(host, 1)[1] if host else "/", k) for k, u, _ in pages if (u.split("/")[2] if u else "") == host)
        for at, (path, k) in enumerate(own):
            before = next((own[j] for j in range(at - 1, -1, -1) if plain(own[j][1]) != plain(k)), None)
            after = next((own[j] for j in range(at + 1, len(own)) if plain(own[j][1]) != plain(k)), None)
            near = max((p for p in (before, after) if p), key=lambda p: prefix(p[0], path), default=None)
            gone = common([t for _, t in cut[k]], [t for _, t in cut[near[1]]]) if near else set()
            want[k] = "\n".join(t for n, (z, t) in enumerate(cut[k]) if z == htmltext.MAIN or z != htmltext.OUT and n not in gone)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    for rows in (5000, 7):
        got = {x["page_id"]: x["text"] for x in htmltext.extract(df, group_rows=rows).collect()}
        assert got == want
    assert sum(want[k] != "\n".join(plain(k)) for k in want) > 30  # differencing decides


def test_toxicity_of_long_repeated_and_twice_labelled_documents(spark):
    docs = [(k, "calm words here " * 5 if k % 2 else "vile words here " * 5) for k in range(60)] + [(7, "vile"), (7, None), (None, "calm"), (99, "calm words " * 150_000), (100, "")]
    labels = [(k, int(k % 2 == 0)) for k in range(50)] + [(1, 0), (2, 0), (2, 1), (None, 1), (3, None)]
    out = toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out) and sum(r["doc_id"] == 7 for r in out) == 3
    by = {r["doc_id"]: r["score"] for r in out if r["doc_id"] != 7}
    assert by[50] > by[51] and by[52] > by[99]
    assert {r["held_out"] for r in out if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2} == {True}
