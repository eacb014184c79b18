"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import io
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshlark.llm import _pieces, _work, bpe, decontam, htmltext, linededup, neardup, quality, repair, shards, toxicity, warc

WORDS = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
SCHEMA = "doc_id long, text string, lang string, n_words long, segment string, id string, `odd name.x` int"


def corpus(seed=1, n=60):
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(n)]
    shared = "This very line is shared by several documents"
    texts = [t + ("\n  " + (shared.upper() if k % 2 else shared) + " \nown line number %d of this text" % k if k % 4 == 0 else "") for k, t in enumerate(texts)]
    texts += [texts[3], texts[3] + " mu", None, "", " \n\t ", "one", "x " * 30_000, "A B C D E F " * 40, "\n\n\n", texts[3]]
    rows = [(k, t, "en", 1, "s", "i", 2) for k, t in enumerate(texts)]
    return [*rows, (None, texts[3], None, None, None, None, None), (5, texts[5], "en", 1, "s", "i", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quality(docs, empty):
    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        rep = {i + k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(rep)

    book = quality.ledger(docs)
    assert rows(book.select("doc_id", *quality.MEASURES[:6])) == sorted(((r[0], *brute(r[1])) for r in corpus()), key=repr)
    kept = rows(book.where(quality.verdict()).select("doc_id"))
    assert kept == rows(quality.keep_good(docs).select("doc_id")) and quality.keep_good(docs).columns == docs.columns
    bits = Counter(r["failed_bits"] for r in book.collect())
    for r in quality.ablation(book).collect():
        bit = 1 << next(x.bit for x in quality.RULES if x.name == r["rule"])
        assert r["n_rows"] == sum(bits.values()) and r["n_failed"] == sum(n for b, n in bits.items() if b & bit) and r["n_failed_alone"] == bits[bit]
    assert quality.ledger(empty).count() == 0 and quality.keep_good(empty).count() == 0
    clash = docs.select("doc_id", "text").withColumn("n_words", docs["doc_id"]).withColumn("failed_bits", docs["text"])
    assert rows(quality.keep_good(clash).select("doc_id")) == kept and quality.keep_good(clash).columns == clash.columns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeat_words(w):
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    assert quality.repeat_words(w) == len({i + k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(5)})


def test_line_dedup(docs, empty):
    data = corpus()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(low)
    ids, last = defaultdict(set), {}
    for i, t, *_ in data:
        for k in {key(x) for x in (t or "").split("\n")}:
            ids[k].add(i)
            last[k] = max(last.get(k, -1), -1 if i is None else i)
    want = []
    for i, t, *_ in data:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(ids[key(x)]) >= 3 and last[key(x)] != i)]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    out = linededup.dedup_lines(docs)
    assert rows(out.select("doc_id", "n_lines", "n_dropped", "text")) == sorted(want, key=repr)
    assert set(docs.columns) < set(out.columns) and linededup.dedup_lines(empty).count() == 0
    assert any(w[2] for w in want)
    twice = docs.sparkSession.createDataFrame([(1, "a line of more than twenty letters"), (1, "b\na line of more than twenty letters"), (2, "a line of more than twenty letters")], "doc_id long, text string")
    assert [r["n_dropped"] for r in linededup.dedup_lines(twice).collect()] == [0, 0, 0]
    more = twice.union(twice.sparkSession.createDataFrame([(None, "a line of more than twenty letters\nc")], "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["n_dropped"], r["text"]) for r in linededup.dedup_lines(more).collect()) == [(0, 1, "c"), (1, 1, ""), (1, 1, "b"), (2, 0, "a line of more than twenty letters")]


def test_near_duplicates(docs, empty):
    def sets(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower() if (t or "").isascii() else (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())

    data = [r for r in corpus() if r[0] is not None][:-1]
    s = {r[0]: sets(r[1]) for r in data}
    comp = {i: i for i in s}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in s:
        for b in s:
            if a < b and s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    want = {i: (len(s[i]), find(i), find(i) == i) for i in s}
    out = neardup.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]
        else:
            assert r["component_id"] == 3 and not r["kept"]
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_chains_and_large_buckets(spark, monkeypatch):
    """Near copies of near copies, in blocks smaller than their buckets."""
    r = random.Random(5)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    base = [f"w{k}" for k in range(120)]
    texts, cur = [], base
    for k in range(90):
        cur = list(cur)
        cur[r.randrange(120)] = f"n{k}"
        cur[r.randrange(120)] = f"m{k}"
        texts.append(" ".join(cur))
    data = list(enumerate(texts))
    sets = [{tuple(t.split()[i : i + 4]) for i in range(117)} for t in texts]
    comp = list(range(90))
    find = lambda x: x if comp[x] == x else find(comp[x])
    for a in range(90):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    out = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out == {k: find(k) for k in range(90)}


def test_rows_stay_in_proportion_in_a_bucket_of_copies_below_the_threshold(spark, monkeypatch):
    """Members of one large bucket that are no near duplicates: rows between stages grow with the members, not with their square."""
    r = random.Random(6)
    base = [f"w{k}" for k in range(200)]

    def group(n):
        out = []
        for k in range(n):
            cur = list(base)
            for m in r.sample(range(200), 10):
                cur[m] = f"n{k}x{m}"
            out.append((k, " ".join(cur)))
        return out

    counted = []
    monkeypatch.setattr(neardup, "BLOCK", 64)
    plain = neardup.materialise

    def counting(df, label):
        out = plain(df, label)
        counted[-1][label] = max(counted[-1].get(label, 0), out[0].count())
        return out

    monkeypatch.setattr(neardup, "materialise", counting)
    for n in (300, 600):
        counted.append({})
        found = neardup.near_duplicates(spark.createDataFrame(group(n), "doc_id long, text string"))
        assert found.where("kept").count() == n
    for label, rows_of in counted[1].items():
        assert rows_of <= 2.6 * max(counted[0][label], 100), label


def test_components_and_bounds(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (20, 21), (30, 30)], "a long, b long")
    assert rows(neardup.components(links)) == [(2, 1), (21, 20), (3, 1), (9, 1)]
    assert neardup.components(links.limit(0)).count() == 0
    need = neardup.least_matches(1e-6)
    assert need == sorted(need) and 70 < need[-1] < 102 and need[-1] < neardup.least_matches(1e-2)[-1]


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_html_text(spark):
    art = "<nav><a>Home</a></nav><div class='ad'>buy</div><article><h1>Head &amp; more</h1><p><b>One\n  two<br><p>Three <i>f</i>our.</p></article><div id=comments><p>rude</p></div><footer>&copy; x</footer><script>var a='<p>no</p>';</script>"
    plain = "<div>Site name</div><p>{}</p><p>{}</p><div>All about us</div>"
    data = [
        (1, "https://a.example/x/1", page(art)), (2, "https://a.example/x/2", page(art)), (3, "http://b.example/p/1?q", page(plain.format("first own text", "second own text"))),
        (4, "http://b.example/p/2", page(plain.format("third own text", "fourth own text"))), (5, None, None), (6, "x", ""), (7, "http://c.example/", "just text <b>bold"), (8, "http://c.example/2", "<p>open <div style='display:none'>hid</div>end"),
    ]
    out = {r["page_id"]: r for r in htmltext.extract(spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("t"))).collect()}
    assert out[1]["text"] == out[2]["text"] == "Head & more\nOne two\nThree four."
    assert out[3]["text"] == "first own text\nsecond own text" and out[4]["text"] == "third own text\nfourth own text"
    assert out[5]["text"] == out[6]["text"] == "" and out[7]["text"] == "just text bold" and out[8]["text"] == "open\nend"
    assert out[1]["n_chars"] == len(out[1]["text"]) and out[1]["url"] == "https://a.example/x/1"
    many = spark.createDataFrame([(k, "http://h.example/same", page(plain.format(f"own {k}", f"more {k}"))) for k in range(40)], "page_id long, url string, html string")
    assert rows(htmltext.extract(many, group_rows=7).select("page_id", "text")) == sorted([(k, f"own {k}\nmore {k}") for k in range(40)], key=repr)
    assert htmltext.extract(many.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_common_is_longest(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            n[i + 1][j + 1] = n[i][j] + 1 if a[i] == b[j] else max(n[i][j + 1], n[i + 1][j])
    found = htmltext.common(a, b)
    rest = iter(b)
    assert found == sorted(set(found)) and len(found) == n[-1][-1] and all(any(x == y for y in rest) for x in (a[i] for i in found))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ab\"'=! -pdiv&;", max_size=60))
def test_any_markup_is_read(html):
    htmltext.blocks(html)


def test_warc(spark, tmp_path):
    data = [(3, "http://a/ b\r\n", "same"), (1, None, "same"), (2, "http://é/", "other ü" * 900), (4, "http://a/4", None), (5, "http://a/5", ""), (None, "http://n/", "same"), (7, "u", "tiny")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("sha1", F.lit(1)).withColumn("first", F.lit(2))
    path = warc.write_pages(df, dedup_min_bytes=0)
    back = warc.read_archive(spark, path, verify="true").where("record_type in ('response', 'revisit')")
    got = {(r["record_id"], r["target_uri"]): r for r in back.collect()}
    assert len(got) == 7
    one, three = got["urn:x-page:1", None], got["urn:x-page:3", "http://a/%20b%0D%0A"]
    assert one["record_type"] == "response" and one["payload"] == b"same" and one["payload_digest"] == warc.base32_sha1(b"same") and one["payload_bytes"] == 4
    assert three["record_type"] == "revisit" and three["refers_to"] == "urn:x-page:1" and three["payload"] is None and three["payload_bytes"] == 4
    assert got["urn:x-page:", "http://n/"]["refers_to"] == "urn:x-page:1" and got["urn:x-page:2", "http://é/"]["payload"].decode() == "other ü" * 900
    assert got["urn:x-page:5", "http://a/5"]["refers_to"] == "urn:x-page:4" and got["urn:x-page:4", "http://a/4"]["payload"] == b""
    only = warc.read_archive(spark, path, payload="false").where("record_type = 'revisit' and target_uri like 'http://a%'")
    assert only.count() == 2 and only.where("payload is not null").count() == 0
    small = warc.read_archive(spark, warc.write_pages(df, dedup_min_bytes=5), payload="false")
    assert small.where("record_type = 'revisit'").count() == 0
    assert warc.read_archive(spark, warc.write_pages(df.limit(0))).where("record_type = 'response'").count() == 0
    marked = warc.MARK_BYTES
    warc.MARK_BYTES = 150
    many = spark.createDataFrame([(k, None, f"page {k} " * (k % 7)) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    parts = warc.read_archive(spark, warc.write_pages(many), partitionBytes="400")
    assert parts.rdd.getNumPartitions() > 10 and parts.where("record_type in ('response', 'revisit')").select("record_id").distinct().count() == 40 == parts.where("record_type <> 'warcinfo'").count()
    warc.MARK_BYTES = marked
    plain = b"".join(warc.record([("WARC-Type", "response"), ("WARC-Record-ID", f"<r{k}>")], b"x" * k) for k in (0, 5000, 3))
    (tmp_path / "a.warc").write_bytes(plain)
    import gzip

    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.record([("WARC-Type", "request"), ("WARC-Record-ID", f"<q{k}>")], b"y" * k)) for k in (1, 9000)))
    both = warc.read_archive(spark, f"file://{tmp_path}")
    assert sorted((r["record_id"], len(r["payload"])) for r in both.collect()) == [("q1", 1), ("q9000", 9000), ("r0", 0), ("r3", 3), ("r5000", 5000)]
    assert both.where("record_type = 'request' and record_id = 'q1'").count() == 1


def test_warc_skips_payloads():
    data = b"".join(warc.member(warc.record([("WARC-Type", t)], bytes(200_000))) for t in ("response", "request", "response"))

    class Counted(io.BytesIO):
        n = 0

        def read(self, k=-1):
            out = super().read(k)
            Counted.n += len(out)
            return out

        def size(self):
            return len(data)

    random.seed(1)
    assert len(list(warc._Source(Counted(data)).records(lambda h: h["warc-type"] == "request", False))) == 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1.,' st\n\t\x1c\x85\xa0 éß漢😀lL")), max_size=20) | st.text(max_size=12))
def test_pieces_cut_where_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    import regex
    import tiktoken

    ranks = bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()) if not _RANKS else _RANKS
    _RANKS.update(ranks)
    enc = _ENC.setdefault("e", tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    split = regex.compile(P.PATTERN).findall
    import pyarrow as pa

    block = _pieces.cut(pa.array([text, None, "a b", text]), split)
    names = block.words.to_pylist()
    assert len(set(names)) == len(names) and sum(block.n_places) == len(block.places)
    stops = block.n_places.cumsum().tolist()
    own = [[names[w] for p in block.places[a:b].tolist() for w in block.flat[(block.ends[p - 1] if p else 0) : block.ends[p]]] for a, b in zip([0, *stops], stops)]
    assert own[0] == own[3] and own[1] == [] and own[2] == ["a", " b"]
    words = own[0]
    found = [i for w in words for i in enc._encode_single_piece(w.encode())]
    assert found == enc.encode_ordinary(text)


_RANKS: dict = {}
_ENC: dict = {}


def test_bpe(docs, empty, monkeypatch):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(open(path, "rb").read()), special_tokens={})
    coded = bpe.encode(docs, path, P.PATTERN)
    both = bpe.decode(coded, path).select("doc_id", "text", "ids", "decoded").collect()
    for r in both:
        assert r["ids"] == enc.encode_ordinary(r["text"] or "") and r["decoded"] == (r["text"] or "").encode()
    assert set(coded.columns) == {*docs.columns, "ids"} and len(both) == docs.count()
    out = bpe.round_trip(docs, path, P.PATTERN).collect()
    want = sorted((i, len(x := enc.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in corpus() if i is not None)
    assert sorted(tuple(r) for r in out if r["doc_id"] is not None) == want
    assert bpe.round_trip(empty, path, P.PATTERN).count() == 0
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 500)
    monkeypatch.setattr(bpe, "PART_WORDS", 20)
    assert rows(bpe.round_trip(docs, path, P.PATTERN)) == sorted(map(tuple, out), key=repr)


def test_repair(docs, empty, spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    odd = docs.select("doc_id", "text").union(spark.createDataFrame([(9001, "a <|endoftext|> b"), (9002, "<|endoftext|><|endoftext|>x <|endoftext|"), (9003, " <|endoftext|>")], "doc_id long, text string"))
    for r in bpe.encode(odd, path, P.PATTERN, library="tokenizers").collect():
        assert r["ids"] == tk.encode(r["text"] or "", add_special_tokens=False).ids
    data = sorted(((-1 if i is None else i), t or "") for i, t, *_ in corpus())
    start, want = 0, []
    for i, t in data:
        ids = [*tk.encode(t, add_special_tokens=False).ids, 2]
        want.append((None if i < 0 else i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    folder = repair.write_tokens(docs, path, P.PATTERN, shard_ids=300)
    assert rows(repair.read_documents(spark, folder)) == sorted(want, key=repr)
    bare = spark.createDataFrame([(None, f"text {k}") for k in range(40)], "doc_id long, text string")
    few, repair.RANGE_ROWS = repair.RANGE_ROWS, 5
    many = repair.write_tokens(bare, path, P.PATTERN)
    repair.RANGE_ROWS = few
    assert repair.files(spark, many).count() > 4
    starts = sorted((r["start"], r["n_tokens"]) for r in repair.read_documents(spark, many).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0 and len(starts) == 40
    assert repair.files(spark, folder).count() > 3
    assert repair.read_documents(spark, repair.write_tokens(empty, path, P.PATTERN)).count() == 0


def test_repair_files_are_read_anywhere():
    import numpy as np

    r = random.Random(2)
    docs = [[*[r.choice([5, 6, 7, 7, 7]) for _ in range(r.randint(0, 3000))], 2] for _ in range(30)]
    flat = np.array([x for d in docs for x in d])
    s = repair.Shard(io.BytesIO(repair.write_file(list(range(30)), [len(d) for d in docs], flat, 2, 100)))
    assert s.all_ids().tolist() == flat.tolist() and len(s.rules) > 5 and len(s.array("symbols")) < len(flat) / 2
    assert all(s.document(k).tolist() == d for k, d in enumerate(docs))
    for _ in range(60):
        a, b = sorted(r.randrange(len(flat) + 1) for _ in range(2))
        assert s.ids(a, b).tolist() == flat[a:b].tolist()
    assert repair.compress(np.array([], np.int64), 2, 10)[0].tolist() == [] and repair.compress(np.array([4] * 7), 2, 10, least=2)[0].tolist() != []


def test_shards(spark, tmp_path):
    t = shards.ShardedTable(spark, f"file://{tmp_path}/t")
    df = spark.createDataFrame(corpus(), SCHEMA)
    for k in range(6):
        t.append(df.repartition(2).withColumn("doc_id", F.col("doc_id") + 100 * k))
    before = rows(t.read())
    v = t.version()
    m = t.compact(target_bytes=60_000, fan_in=3)
    assert m["version"] > v and len(m["shards"]) < 12 and rows(t.read()) == before == rows(t.read(v))
    counts = Counter(shards.ShardedTable.tier(s["bytes"], 3) for s in m["shards"] if 2 * s["bytes"] < 60_000)
    assert all(n < 3 for n in counts.values())
    t.vacuum()
    assert rows(t.read()) == before and t.version() == m["version"]
    other = shards.ShardedTable(spark, t.path)
    stale = other.manifest()
    t.append(df.limit(1))
    with pytest.raises(shards.Conflict):
        other._commit(stale, [], stale["schema"], "late")
    with pytest.raises(ValueError):
        t.append(df.select("doc_id"))
    with pytest.raises(ValueError):
        t.append(df.withColumn("doc_id", F.col("doc_id").cast("string")))
    written, folder = other._written(df.limit(2).coalesce(1), "arrival")  # a writer that has not committed yet
    t.vacuum()
    now = t.manifest()
    other._commit(now, now["shards"] + written, now["schema"], "append")
    assert t.read().count() == t.read(now["version"]).count() + 2
    lost, plain = [], t.manifest

    def behind(version=None):  # another writer comes first, once
        m = plain(version)
        if version is None and not lost:
            lost.append(other.append(df.limit(1)))
        return m

    t.manifest = behind
    before = other.read().count()
    t.append(df.limit(3))
    assert lost and other.read().count() == before + 4
    lost.clear()
    assert t.compact(target_bytes=60_000, fan_in=2)["version"] == t.version() and lost and other.read().count() == before + 5
    orphan, folder = other._written(df.limit(2), "arrival")
    t.vacuum(given_up=-60)
    assert folder.split("/")[1] not in {p.name for p in (tmp_path / "t" / "data").iterdir()} and other.read().count() == before + 5
    e = shards.ShardedTable(spark, f"file://{tmp_path}/e")
    e.append(df.limit(0))
    assert e.compact()["version"] == 1 and e.read().count() == 0


def test_toxicity(spark, empty):
    r = random.Random(3)
    bad, docs, labels = ["vile", "brute", "oaf", "fool"], [], []
    for k in range(600):
        w = [r.choice("abcdefgh") + r.choice("aeiou") + r.choice("klmn") for _ in range(r.randint(20, 120))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(bad))
        docs.append((k, " ".join(w)))
        if k % 7:
            labels.append((k, int(toxic)))
    docs += [(900, None), (901, ""), (None, "va ke"), (902, "Vile OAF, you brute!")]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", F.lit(1)), spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    out = {x["doc_id"]: x for x in toxicity.score(d, lab).collect()}
    assert len(out) == len(docs)
    held = [x for i, x in out.items() if i is not None and i < 600 and x["held_out"]]
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in out.values() if x["doc_id"] is not None)
    assert sum((x["predicted"] == 1) == (x["doc_id"] % 5 == 0) for x in held) > 0.97 * len(held)
    assert out[900]["predicted"] == out[901]["predicted"] == 0 and out[902]["predicted"] == 1 and all(0 <= x["score"] <= 1 for x in out.values())
    flipped = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {x["doc_id"]: round(x["score"], 9) for x in toxicity.score(d, flipped).collect()} == {i: round(x["score"], 9) for i, x in out.items()}
    assert toxicity.score(empty, lab).count() == 0
    assert toxicity.score(d.limit(5), lab.limit(0)).where("score = 0.5").count() == 5


def powerset(names):
    return [[n for k, n in enumerate(names) if m >> k & 1] for m in range(1 << len(names))]


def test_decontamination(docs, empty, spark, monkeypatch):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    data = corpus()
    items = [(1, " ".join(data[0][1].split()[:20])), (12, data[7][1].upper()), (3, "alpha, BETA"), (4, None), (5, "..."), (6, "never seen words at all"), (10, "alpha BETA")]
    want = []
    spread = Counter(x for _, t, *_ in data for x in set(cut(t)))
    for i, t, *_ in data:
        w, hit, found, close = cut(t), set(), set(), set()
        for item, text in items:
            x = cut(text)
            n = min(13, len(x))
            for g in {tuple(x[s : s + n]) for s in range(len(x) - n + 1)} if n else ():
                if all(spread[y] for y in g):
                    rarest = min(g, key=lambda y: (spread[y], y.encode()))
                    if any(y == rarest and set(g) <= set(w[max(0, s - 26) : s + 27]) for s, y in enumerate(w)):
                        close.add(item)
            for g in {tuple(x[s : s + n]) for s in range(len(x) - n + 1)} if n else ():
                for s in range(len(w) - n + 1):
                    if tuple(w[s : s + n]) == g:
                        hit.update(range(s, s + n))
                        found.add(item)
        ids = ",".join(sorted(map(str, found)))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w), len(close)))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("t"))

    def run():
        return rows(decontam.decontaminate(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest(), "contaminated", F.size("near_item_ids")))

    want = sorted(want, key=repr)
    assert run() == want and any(w[5] for w in want) and any(w[6] > w[3] for w in want)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 15)
    monkeypatch.setattr(decontam, "CANDIDATES", 2)
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 200)
    assert run() == want
    with_12 = {hashlib.sha256(','.join(sorted(x)).encode()).hexdigest() for x in powerset(['1', '12', '3', '10']) if '12' in x}
    named = decontam.decontaminate(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), bench.withColumn("item_id", F.when(F.col("item_id") != 12, F.concat(F.lit("i"), "item_id"))))
    assert sorted(((r["doc_id"] and int(r["doc_id"][1:])), r["n_hit"], len(r["item_ids"]), None in r["item_ids"]) for r in named.collect() if r["doc_id"]) == sorted((w[0], w[2], w[3], w[4] in with_12) for w in want if w[0] is not None)
    assert decontam.decontaminate(empty, bench).count() == 0
    none = decontam.decontaminate(docs, bench.limit(0))
    assert none.where("n_hit > 0 or contaminated").count() == 0 and none.count() == docs.count()


def test_an_index_serves_any_benchmark(spark):
    d = spark.createDataFrame([(1, "the red fox and a brown dog"), (2, "red " + "x " * 50 + "fox"), (3, "fox red"), (None, None)], "doc_id long, text string")
    index = decontam.build_index(d)
    near = lambda items, n: sorted((r["doc_id"], r["near_item_ids"], r["item_ids"]) for r in decontam.matches(index, spark.createDataFrame(items, "item_id long, text string"), near=n).collect() if r["near_item_ids"])
    assert near([(7, "Red fox"), (8, "absent")], 3) == [(1, [7], [7]), (3, [7], [])]
    assert near([(9, "brown fox red")], 4) == [(1, [9], [])] and near([(9, "brown fox red")], 3) == []
    assert near([(7, "Red fox")], 60) == [(1, [7], [7]), (2, [7], []), (3, [7], [])]


@pytest.mark.parametrize("compacting", [False, True])
def test_an_old_versions_name_is_never_taken_again(spark, tmp_path, monkeypatch, compacting):
    """A writer reads the table, others commit, one vacuums, and then the writer commits."""
    t = shards.ShardedTable(spark, f"file://{tmp_path}/t")
    part = lambda k: spark.createDataFrame([(k, str(k))], "a int, b string")
    for k in range(3 if compacting else 1):
        t.append(part(k))
    late, stale = shards.ShardedTable(spark, t.path), t.manifest()
    for k in (10, 11, 12):
        t.append(part(k))
    t.compact(fan_in=2)
    t.vacuum()
    seen = []
    real = late.manifest
    monkeypatch.setattr(late, "manifest", lambda v=None: seen.append(1) or (stale if len(seen) == 1 else real(v)))
    if compacting:
        late.compact(fan_in=2)
        want = [0, 1, 2, 10, 11, 12]
    else:
        assert late.append(part(50))["version"] > t.manifest(6)["version"] - 1
        want = [0, 10, 11, 12, 50]
    assert sorted(r["a"] for r in t.read().collect()) == want
    assert t.versions() == list(range(1, t.version() + 1))
    t.vacuum()
    assert sorted(r["a"] for r in t.read().collect()) == want and t._vacuumed() == t.version()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB1 2'\n\tsé.!/Zß中 " + "xY", max_size=60), st.sampled_from([*_pieces.LONE, r"\w+(?: \w+)?|\s|[^\w\s]+", r"(a|b)+|."]))
def test_pieces_are_cut_as_any_pattern_does(text, pattern):
    import pyarrow as pa
    import regex

    want = [m.group() for m in regex.compile(pattern).finditer(text)]
    block = _pieces.cut(pa.array([text, None, text + " b1", text]), _pieces.splitter(pattern), (), pattern)
    names, stops = block.words.to_pylist(), block.n_places.cumsum().tolist()
    own = [[names[w] for p in block.places[a:b].tolist() for w in block.flat[(block.ends[p - 1] if p else 0) : block.ends[p]]] for a, b in zip([0, *stops], stops)]
    assert own[0] == own[3] == want and own[1] == [] and own[2] == [m.group() for m in regex.compile(pattern).finditer(text + " b1")]


def test_the_known_pattern_is_the_given_one():
    assert _pieces.PLAIN == P.PATTERN
