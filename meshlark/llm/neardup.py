"""MinHash near-duplicate groups with sequential Bayesian verification.

Documents with the same set of shingles are one class, whose smallest id stands for it. Signatures of the
classes are banded; documents that share a band are candidates. A candidate pair's signatures are compared
batch by batch, and the pair is dropped once the posterior probability that its similarity reaches the
threshold is below the chosen miss probability. Survivors are verified on their full shingle sets.

No bucket is ever expanded into all its pairs. Each member is first tested with its buckets' smallest member, then
with those of its other buckets; only members that are then still in different components are compared with each
other, block by block in one task each, by signatures and then by sets that are read from where they were written
once, without making rows of the pairs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._work import FileReader, FileWriter, col, is_small, materialise, remove, scratch, small_side, tidy

WORDS, PERCENT = 4, 80
BANDS, ROWS, BATCH = 32, 4, 32
SIZE = BANDS * ROWS
MISS = 1e-6
#: Members to a block, where a bucket's remaining members are compared with each other.
BLOCK = 4096

_rng = np.random.default_rng(20260101)
_MUL = _rng.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, SIZE, dtype=np.uint64)
_BAND = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    """64-bit hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _Q
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None, hashes: dict[bytes, int], size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; of all its words, if they are fewer; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    x = np.full(n, size, np.uint64)
    for k in range(size):
        x = _mix(x * _P + h[k : k + n])
    return np.unique(x)


def signature(x: np.ndarray) -> np.ndarray:
    best = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(x), 1024):
        np.minimum(best, (x[s : s + 1024, None] * _MUL + _ADD).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def least_matches(miss: float = MISS, percent: int = PERCENT) -> list[int]:
    """For each whole number of batches: the fewest matches with which a pair stays.

    With a flat prior, m matches in n hashes leave the similarity distributed as Beta(m + 1, n - m + 1), whose tail
    above t is the chance of at most m successes in n + 1 trials of probability t.
    """
    t = percent / 100
    out = []
    for n in range(BATCH, SIZE + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)) or not len(a) or not len(b):
        return False
    k = np.searchsorted(a, b)
    k[k == len(a)] = 0
    both = int((a[k] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    recent: dict[bytes, bytes] = {}
    for b in batches:
        n, digests, sigs = [], [], []
        for t in b.column(2):
            x = shingles(t.as_py(), hashes)
            n.append(len(x))
            if not len(x):
                digests.append(None)
                sigs.append(None)
                continue
            d = xxhash.xxh3_128_digest(x.tobytes())
            if d not in recent:
                if len(recent) > 5000:
                    recent.clear()
                recent[d] = signature(x).tobytes()
            digests.append(d)
            sigs.append(recent[d])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "text_hash", "n_shingles", "digest", "sig"]
        )


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each band of each signature, the band's number mixed in."""
    s = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(_BAND, s.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix((key ^ s[:, :, r]) * _P)
    return key.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        key = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4")).reshape(-1)
        reps = np.repeat(np.asarray(b.column(0)), BANDS)
        for k in range(0, len(reps), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(key[k : k + (1 << 17)]), pa.array(reps[k : k + (1 << 17)])], names=["key", "rep"])


def _survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    need = least_matches()
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<u4").reshape(-1, SIZE) for k in (2, 3))
        live, found = np.arange(len(x)), np.zeros(len(x), np.int64)
        for k, least in enumerate(need):
            part = slice(k * BATCH, (k + 1) * BATCH)
            found[live] += (x[live, part] == y[live, part]).sum(axis=1)
            live = live[found[live] >= least]
        yield b.select([0, 1]).take(pa.array(live))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hub, salt, b, text) in order, a hub's own text first: passes on the pairs that are linked."""
    hashes = _WordHashes()
    group, own = None, []
    for b in batches:
        found = []
        for hub, salt, other, is_hub, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            x = shingles(text, hashes)
            if (hub, salt) != group:
                group, own = (hub, salt), []
            if is_hub:
                own.append(x)
            elif any(linked(o, x) for o in own):
                found.append((hub, other))
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])


def _linked_pairs(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of representatives those that are linked; a table."""
    left, right = reps.select(F.col("rep").alias("a"), F.col("sig").alias("x")), reps.select(F.col("rep").alias("b"), F.col("sig").alias("y"))
    live = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(_survive), "a long, b long")
    live, path = materialise(live.distinct(), "survivors")
    n = live.count()
    spark = pairs.sparkSession
    if not n:
        return live
    # A hub with many partners is dealt to several salts, its own text to each.
    salts = live.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("salts"))
    live = live.join(salts, "a")
    partner = live.select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("id"), F.lit(False).alias("is_hub"))
    hub = salts.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("id"), F.lit(True).alias("is_hub"))
    wanted = partner.unionByName(hub)
    rows = texts.join(small_side(wanted, 2 * n), "id").select("hub", "salt", F.col("id").alias("other"), "is_hub", "text")
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("is_hub"))
    out, _ = materialise(rows.mapInArrow(tidy(_verify), "a long, b long").distinct(), "links")
    remove(spark, path)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links but the roots: alternating large and small stars, each round a table.

    links: rows (a, b) in any order; links that repeat, that join a node with itself or that have a null end add nothing,
    and no links give no rows. A root is its component's smallest node.

    Least neighbours are sent to the tasks where they are few. Elsewhere they are a table, so that Spark splits the
    join at a centre which a large part of the nodes has.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, path = materialise(edges, "stars")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        paths = [path]

        def kept(df: DataFrame) -> DataFrame:
            df, p = materialise(df, "stars")
            paths.append(p)
            return df

        small = is_small(edges, 2 * state[0])
        least = lambda df: F.broadcast(df) if small else kept(df)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large if small else kept(large)
        low = least(large.groupBy("u").agg(F.min("v").alias("m")))
        inner = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges, path = materialise(inner, "stars")
        remove(spark, *paths)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    n = roots.count()
    left = small_side(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), n)
    right = small_side(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), n)
    out = pairs.join(left, "a", "left").join(right, "b", "left")
    return out.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def linked_many(a: np.ndarray, others: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """``linked`` of a with each of the others, none of them empty."""
    n = np.array([len(x) for x in others])
    x = np.concatenate(others)
    k = np.searchsorted(a, x)
    k[k == len(a)] = 0
    both = np.add.reduceat((a[k] == x).astype(np.int64), np.cumsum(n) - n)
    return 100 * both >= percent * (len(a) + n - both)


def _write_sets(folder: str):
    """Writes each member's shingle set to a file of the task and returns its place with the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, out = _WordHashes(), FileWriter(folder)
        for b in batches:
            name, at, size = zip(*(out.add(shingles(t.as_py(), hashes).tobytes()) for t in b.column(3)), strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(name, pa.string()), pa.array(at, pa.int64()), pa.array(size, pa.int64())], names=["rep", "n_shingles", "sig", "file", "at", "size"])
        out.close()

    return run


def _pack_blocks(folder: str):
    """Rows (key, block, blocks, rep, root, n_shingles, sig, file, at, size) in order of key and block: a row to each
    block, its members in one byte string. That of a bucket's only block goes along, others are written to files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, group, held = FileWriter(folder), None, []

        def done():
            reps, roots, n, sigs, *places = zip(*dict.fromkeys(held), strict=True)
            data = pickle.dumps((np.array(reps), np.array(roots), np.array(n), np.frombuffer(b"".join(sigs), "<u4").reshape(-1, SIZE), list(zip(*places, strict=True))), 5)
            place = out.add(data) if group[2] > 1 else (None, None, None)
            row = zip((*group, None if group[2] > 1 else data, *place), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.int64()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row], names=["key", "block", "blocks", "data", "file", "at", "size"])

        for b in batches:
            for key, block, blocks, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (key, block, blocks) != group:
                    if held:
                        yield done()
                    group, held = (key, block, blocks), []
                held.append(tuple(row))
        if held:
            yield done()
        out.close()

    return run


def _compare_blocks(folder: str):
    """Rows (key, lo, hi, block, data, file, at, size) in order of key, lo and hi: links between members of block lo and block hi
    of a bucket. A pair is compared in the first band that it shares only. Full sets are read for pairs that signatures
    do not rule out and that links found so far have not joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need, read = least_matches(), FileReader(folder)

        def compare(key: int, blocks: dict[int, bytes]) -> list[tuple[int, int]]:
            sides = [pickle.loads(x) for _, x in sorted(blocks.items())]
            reps, roots, n, sig = (np.concatenate([s[k] for s in sides]) for k in range(4))
            places = [p for s in sides for p in s[4]]
            other = np.arange(len(reps)) >= (len(sides[0][0]) if len(sides) > 1 else 0)
            bands = band_keys(sig)
            band = int(np.flatnonzero((bands == key).all(axis=0))[0])
            size = lambda k: np.frombuffer(read.get(*places[k]), np.uint64)
            out = []
            for i in range(len(sides[0][0])):
                j = np.flatnonzero(other & (roots != roots[i]) & ((reps > reps[i]) | (len(sides) > 1)) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])))
                found = np.zeros(len(j), np.int64)
                for k, least in enumerate(need):
                    part = slice(k * BATCH, (k + 1) * BATCH)
                    found += (sig[j, part] == sig[i, part]).sum(axis=1)
                    j, found = j[found >= least], found[found >= least]
                j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
                for k in range(0, len(j), 64):
                    some = j[k : k + 64]
                    some = some[roots[some] != roots[i]]
                    if not len(some):
                        continue
                    for m in some[linked_many(size(i), [size(m) for m in some.tolist()])].tolist():
                        if roots[m] != roots[i]:
                            roots[roots == roots[m]] = roots[i]
                            out.append((int(reps[i]), int(reps[m])))
            return out

        group, held = None, {}

        def done():
            found = compare(group[0], held)
            return pa.RecordBatch.from_arrays([pa.array([min(f) for f in found], pa.int64()), pa.array([max(f) for f in found], pa.int64())], names=["a", "b"])

        for b in batches:
            for key, lo, hi, block, data, *place in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (key, lo, hi) != group:
                    if held:
                        yield done()
                    group, held = (key, lo, hi), {}
                held[block] = data if data is not None else read.get(*place)
        if held:
            yield done()

    return run


def _rest(buckets: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between a bucket's members that are still apart and that no leader has tested; a table.

    Each member's shingle set is written once. A bucket's members are dealt to blocks of about BLOCK; a block is one row,
    and each two blocks of a bucket meet in one task by their places in the shared folder. So rows are as many as
    members, plus one for each two blocks, and no pair becomes a row but those that are linked.
    """
    spark = buckets.sparkSession
    folder = scratch(spark, "sets")
    known = buckets.join(small_side(roots.select(F.col("node").alias("rep"), "root"), roots.count()), "rep", "left").select("key", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("low < high").select("key", "blocks")
    mixed, mixed_path = materialise(mixed, "mixed")
    members, path = materialise(known.join(small_side(mixed, mixed.count()), "key"), "members")
    wanted, wanted_path = materialise(members.select("rep").distinct(), "wanted")
    n = wanted.count()
    full = texts.join(small_side(wanted.select(F.col("rep").alias("id")), n), "id", "left_semi").withColumnRenamed("id", "rep").join(classes.select("rep", "n_shingles", "sig"), "rep")
    sets, sets_path = materialise(full.select("rep", "n_shingles", "sig", "text").mapInArrow(tidy(_write_sets(folder)), "rep long, n_shingles long, sig binary, file string, at long, size long"), "set-places")
    blocks = members.join(sets, "rep").select("key", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), "blocks", "rep", "root", "n_shingles", "sig", "file", "at", "size")
    blocks = blocks.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(tidy(_pack_blocks(folder)), "key long, block int, blocks int, data binary, file string, at long, size long")
    blocks, blocks_path = materialise(blocks, "blocks")
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "data", "file", "at", "size")
    out, _ = materialise(met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(tidy(_compare_blocks(folder)), "a long, b long").distinct(), "links")
    remove(spark, mixed_path, path, wanted_path, sets_path, blocks_path, folder)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component_id, kept.

    Two texts are linked when their sets of distinct WORDS-word shingles (A-Z lower-cased) have a Jaccard similarity
    of at least PERCENT; a text of fewer words is one shingle; null and empty texts have none and are linked with
    nothing. component_id is the smallest id reachable over links, the row's own included; kept tells whether it is
    the row's own. Rows that repeat an id go by their own text each; rows without id join the component of their
    class but never name one (they stay if nobody else can name it). Ids are integers; others stop the job at Spark's cast.
    Texts of any length count whole; an empty table gives no rows; other columns are not read.
    """
    src = df.select(col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit(""))).alias("text_hash"), col(text_col).cast("string").alias("text"))
    signed, signed_path = materialise(src.mapInArrow(tidy(_sign), "id long, text_hash long, n_shingles long, digest binary, sig binary"), "signed")
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")).where("rep is not null")
    classes, _ = materialise(classes, "classes")
    reps, texts = classes.select("rep", "sig"), src.where("id is not null").select("id", "text")

    banded = reps.mapInArrow(tidy(_bands), "key long, rep long")
    shared, shared_path = materialise(banded.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader"), "buckets")
    buckets, buckets_path = materialise(banded.join(small_side(shared, shared.count()), "key").where("rep <> leader").select("key", "rep", "leader"), "bucket-members")

    # Each member with its smallest leader; then with its other leaders, then with fellow members, where still apart.
    first = buckets.groupBy(F.col("rep").alias("b")).agg(F.min("leader").alias("a")).select("a", "b")
    links = _linked_pairs(first, reps, texts)
    roots = components(links)
    tested = buckets.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    links = links.unionByName(_linked_pairs(_apart(tested, roots), reps, texts))
    roots = components(links)
    links = links.unionByName(_rest(buckets.select("key", "rep"), roots, classes, texts))
    roots = components(links)

    several = classes.where("n > 1").select("digest", "rep")
    several = small_side(several, several.count())
    moved = roots.withColumnRenamed("node", "rep")
    out = signed.select("id", "text_hash", "n_shingles", "digest").join(several, "digest", "left").withColumn("rep", F.coalesce("rep", "id"))
    out = out.join(small_side(moved, moved.count()), "rep", "left")
    remove(df.sparkSession, shared_path, buckets_path)
    component = F.coalesce("root", "rep")
    return out.select(F.col("id").alias("doc_id"), "text_hash", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
