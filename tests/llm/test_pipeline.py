"""The pipeline's stages, each on what the stage before kept, and the registered queries against their SQL."""

from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from meshlark.llm import _work, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, found = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(found.columns)
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([r[found.columns.index(c)] for c in cols]) for r in found.fetchall())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.columns
    kept = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.count())
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == first
    assert kept[0] > kept[1] == kept[2] > kept[3] and kept[3] >= kept[4] == kept[5] > 0
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "a"), (2, "a")], "doc_id long, text string")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        odd = stage(spark, odd, SF)
    assert odd.count() == 4 and stage_rows(spark) == 0


def stage_rows(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    return none.count()


# Each stage against brute force, on what the stage before kept of odd documents.

OWN = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, component_id string, text_hash string, failed_bits int, gone_id int"


def odd_documents(items):
    """Nulls in any column, repeated rows, one very long text, shared lines, near copies, benchmark passages, and columns
    with names that the stages use themselves."""
    import random

    r = random.Random(11)
    vocabulary = [f"word{k}" for k in range(600)] + ["Straße", "naïve", "東京"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    texts = [prose(r.randint(30, 90)) for _ in range(30)]
    shared = ["This very line is found in many documents", "Another line that several of them have"]
    texts = [t + "".join(f"\n  {x.upper() if k % 2 else x} " for x in r.sample(shared, r.randint(0, 2))) for k, t in enumerate(texts)]
    texts += [" ".join([*t.split()[:-1], "changed"]) for t in texts[:6]]  # near copies
    texts += [texts[0], texts[0].upper(), None, "", " \n\t ", "a few words", "no " * 50, "# " * 40 + prose(20), prose(30) + "\n" + items[0], items[1], prose(900) + " " + items[2], "\n".join([prose(15)] * 9)]
    texts.append("\n".join(prose(50) for _ in range(1200)))
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(None, prose(40)), (None, texts[7]), (3, texts[3]), (3, prose(44)), (9000, texts[50 % len(texts)])]
    return [(i, t, r.choice(["en", None]), r.choice(["web", None]), len(t) if t and i != 4 else None, 5, None, "c", "h", 1, 2) for i, t in rows]


def good(row):
    import re

    t = row[1] or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    rep = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, upper = sum(map(len, w)), sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in w)
    bad = (
        len(w) < 10, 100 * len(rep) > 20 * len(w), 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(w), 2 * (len(lines) - len(set(lines))) > len(lines),
        chars < 2 * len(w) or chars > 20 * len(w), 2 * upper > len(w), 4 * sum(a == b for a, b in zip(w, w[1:])) > len(w),
    )
    return not any(bad)


def without_shared_lines(rows):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for row in rows:
        kept = "\n".join(x for x in (row[1] or "").split("\n") if key(x) not in last or last[key(x)] == row[0])
        out.append((row[0], kept, *row[2:4], len(kept), *row[5:]))
    return out


def one_of_each_group(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()

    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = defaultdict(list)
    for k, r in enumerate(rows):
        low[find(k)].append(r[0])
    first = {k: min((i for i in ids if i is not None), default=None) for k, ids in low.items()}
    return [r for k, r in enumerate(rows) if r[0] == first[find(k)]]


def clean(rows, items):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = defaultdict(set)
    for w in map(cut, items):
        for k in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[min(13, len(w))].add(tuple(w[k : k + 13]))
    out = []
    for row in rows:
        w = cut(row[1])
        hit = {k + j for n, known in windows.items() for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in known for j in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(row)
    return out


def encoded(rows):
    import hashlib

    import public_tokenizers as P
    import tiktoken

    from meshlark.llm import bpe

    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()), special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    ids = [(r[0], enc.encode_ordinary(r[1] or ""), r[1] or "") for r in rows]
    return [(i, len(x), sha(" ".join(map(str, x)).encode()), sha(t.encode())) for i, x, t in ids]


def test_every_stage_against_brute_force(spark):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = odd_documents(items)
    docs = spark.createDataFrame(rows, OWN).repartition(3)
    brute = [lambda x: [r for r in x if good(r)], without_shared_lines, one_of_each_group, lambda x: clean(x, items), encoded]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, brute, strict=True):
        before = [tuple(r) for r in docs.collect()]
        docs, _ = _work.materialise(stage(spark, docs, SF), "stage")
        after = [tuple(r) for r in docs.collect()]
        assert sorted(after, key=repr) == sorted(expected(before), key=repr), name
        assert after and (name in ("line dedup", "byte-level BPE") or len(after) < len(before)), name
