"""SimHash near-duplicate groups by anchor-point covering.

The words of a covering code are the anchors. A perfect code has exactly one anchor within its radius of any word, the
word's home. A fingerprint goes to every anchor within the radius plus the threshold; of two that differ in no more bits
than the threshold, one is at its home and the other within radius plus threshold of it, so they meet there. An anchor
compares those at home with all that came.

Codes are products of perfect ones over neighbouring bits (the binary Golay code, radius 3, and the Hamming code of
length 7, radius 1; bits that no code covers count nowhere). A product's anchors are near if the bits beyond the radius
of each factor are together within the threshold. More fingerprints are given more anchors, by a rule of cost; which
anchors are used changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._work import FileReader, FileWriter, col, made_once, materialise, remove, scratch, small_side, tidy
from .neardup import components

WORDS, THRESHOLD, SEED = 3, 3, 42
#: Members of an anchor that meet in one task at most; of anchors with more, each two blocks meet.
BLOCK = 1 << 16
#: Comparisons that take as long as making and dealing one row; comparisons made at once.
ROW_COST, AT_ONCE = 400, 1 << 21


class Perfect:
    """A perfect cyclic code of n bits: each word has one codeword within the radius."""

    def __init__(self, n: int, polynomial: int, radius: int, beyond: int = THRESHOLD):
        degree = polynomial.bit_length() - 1
        self.n, self.k, self.degree, self.polynomial = n, n - degree, degree, polynomial
        words = np.arange(1 << n, dtype=np.uint32)
        weight = np.bitwise_count(words)
        near = words[weight <= radius + beyond]
        excess = np.maximum(weight[near].astype(np.int64) - radius, 0)
        syndrome = self.syndrome(near)
        order = np.lexsort((near, excess, syndrome))
        #: What to add to a word of a syndrome to get a codeword, nearest first, and how far that is beyond the radius.
        self.pattern, self.excess, syndrome = near[order], excess[order], syndrome[order]
        per = np.zeros((1 << degree, beyond + 1), np.int64)
        np.add.at(per, (syndrome, self.excess), 1)
        self.start = np.cumsum(per.sum(axis=1)) - per.sum(axis=1)
        #: Codewords within so much beyond the radius, by syndrome; and on average by how far beyond.
        self.within, self.mean = np.cumsum(per, axis=1), per.mean(axis=0)

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        """The remainder of each word by the code's polynomial."""
        x = words.astype(np.uint32)
        for bit in range(self.n - 1, self.degree - 1, -1):
            x ^= ((x >> np.uint32(bit)) & np.uint32(1)) * np.uint32(self.polynomial << (bit - self.degree))
        return x.astype(np.int64)


#: Length, generator polynomial and radius of the perfect codes.
_CODES = {"golay": (23, 0b110001110101, 3), "hamming": (7, 0b1011, 1)}
#: Products, from few anchors to many.
PRODUCTS = (("golay",), ("golay", "hamming"), ("golay", "golay"), ("golay", "golay", "hamming"), ("golay", "golay", "hamming", "hamming"))


def factor(name: str) -> Perfect:
    return made_once(("perfect", name), lambda: Perfect(*_CODES[name]))


def copies(product: tuple[str, ...]) -> float:
    """To how many anchors a fingerprint goes on average."""
    mean = np.ones(1)
    for name in product:
        mean = np.convolve(mean, factor(name).mean)[: THRESHOLD + 1]
    return float(mean.sum())


def product_for(fingerprints: int) -> tuple[str, ...]:
    """The product with the least cost: rows that are dealt, and comparisons of homes with what comes to their anchor."""
    return min(PRODUCTS, key=lambda p: copies(p) * (ROW_COST + fingerprints / 2.0 ** sum(factor(x).k for x in p)))


def anchors(fingerprints: np.ndarray, product: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, anchor, whether it is the home) for each fingerprint and each anchor that it goes to."""
    row, label, spent, at = np.arange(len(fingerprints)), np.zeros(len(fingerprints), np.int64), np.zeros(len(fingerprints), np.int64), 0
    for name in product:
        code = factor(name)
        word = ((fingerprints >> np.uint64(at)) & np.uint64((1 << code.n) - 1)).astype(np.uint32)
        s = code.syndrome(word)[row]
        n = code.within[s, THRESHOLD - spent]
        pick = np.repeat(code.start[s] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        row = np.repeat(row, n)
        # Any k neighbouring bits tell which codeword of a cyclic code it is.
        label = (np.repeat(label, n) << code.k) | ((word[row] ^ code.pattern[pick]) >> np.uint32(code.degree)).astype(np.int64)
        spent = np.repeat(spent, n) + code.excess[pick]
        at += code.n
    return row, label, spent == 0


def fingerprint(text: str | None) -> int:
    """The majority of each bit over the hashes of all word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - WORDS + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(WORDS)), strict=False)), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        ones += np.unpackbits(h[k : k + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[np.ndarray]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(fp), rows):
            yield fp[k : k + rows]


def _replicate(product: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp in _slices(batches):
            row, anchor, home = anchors(fp, product)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row].view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"])

    return run


def _count(product: tuple[str, ...]):
    """Members by anchor, summed before they are dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def added():
            new, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], sums[:0])
            both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([sums, n]), len(both)).astype(np.int64)

        for fp in _slices(batches):
            waiting.append(anchors(fp, product)[1])
            if sum(map(len, waiting)) > 1 << 20:
                keys, sums = added()
                waiting = []
                if len(keys) > 1 << 21:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["anchor", "n"])
                    keys, sums = keys[:0], sums[:0]
        keys, sums = added()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["anchor", "n"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as the links (a, b), one less than there are in each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for ends in (root[x], root[y], x, y):
            np.minimum.at(new, ends, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[root[moved]], nodes[moved]
        root = new


def near(homes: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all homes and members which differ in THRESHOLD bits at most; not each pair, where these are many."""
    left, right, held = [], [], 0
    step = max(1, AT_ONCE // max(len(members), 1))
    for k in range(0, len(homes), step):
        some = homes[k : k + step]
        i, j = np.nonzero(np.bitwise_count(some[:, None] ^ members[None, :]) <= THRESHOLD)
        a, b = some[i], members[j]
        other = a != b
        left.append(a[other])
        right.append(b[other])
        held += len(left[-1])
        if held > len(homes) + len(members):
            a, b = _forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], len(a)
    return (np.concatenate(left), np.concatenate(right)) if left else (homes[:0], homes[:0])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Rows with ``keys`` leading columns in order of these: each group's key and its other columns."""
    group, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        new = np.any([np.diff(c) != 0 for c in cols[:keys]], axis=0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(int(c[lo]) for c in cols[:keys])
            if key != group:
                if held:
                    yield group, [np.concatenate(x) for x in zip(*held, strict=True)]
                group, held = key, []
            held.append([c[lo:hi] for c in cols[keys:]])
    if held:
        yield group, [np.concatenate(x) for x in zip(*held, strict=True)]


def _links(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of links, of many anchors at a time."""
    held, rows = [], 0
    for a, b in found:
        held.append((a, b))
        rows += len(a)
        if rows > 1 << 16 or len(held) > 4096:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*held, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            held, rows = [], 0
    if held:
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*held, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, fp, home) in order of the anchor."""
    yield from _links(near(fp.view(np.uint64)[home.astype(bool)], fp.view(np.uint64)) for _, (fp, home) in _groups(batches, 1))


def _pack(folder: str):
    """Rows (anchor, block, blocks, fp, home) in order of the first three: a block's homes and members go to a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = FileWriter(folder)
        for key, (fp, home) in _groups(batches, 3):
            own = home.astype(bool)
            name, at, size = out.add(np.concatenate([[own.sum()], fp[own], fp[~own]]).astype("<i8").tobytes())
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, name, at, size), kinds, strict=True)], names=["anchor", "block", "blocks", "file", "at", "size"])
        out.close()

    return run


def _meet(folder: str):
    """Rows with the places of two blocks: links of the first one's homes with the second one's members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = FileReader(folder)

        def block(place) -> tuple[np.ndarray, np.ndarray]:
            x = np.frombuffer(read.get(*place), "<i8").astype(np.int64)
            return x[1 : 1 + int(x[0])].view(np.uint64), x[1:].view(np.uint64)

        yield from _links(near(block(r[:3])[0], block(r[3:])[1]) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))

    return run


def links(fingerprints: DataFrame, product: tuple[str, ...]) -> DataFrame:
    """Links (a, b) that join what differs in THRESHOLD bits at most; a table. fingerprints: one column, fp, distinct.

    Anchors with up to BLOCK members are compared in one task each. Members of those with more are dealt to blocks, and
    each two blocks meet by their places in the shared folder: rows are as many as members, plus one for two blocks.
    """
    spark, folder = fingerprints.sparkSession, scratch(fingerprints.sparkSession, "anchor-blocks")
    large = fingerprints.mapInArrow(tidy(_count(product)), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK)
    large, large_path = materialise(large.select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large-anchors")
    n = large.count()
    members = fingerprints.mapInArrow(tidy(_replicate(product)), "anchor long, fp long, home boolean")
    usual = members.join(small_side(large, n), "anchor", "left_anti") if n else members
    found = usual.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(tidy(_compare), "a long, b long")
    if n:
        dealt = members.join(small_side(large, n), "anchor").select("anchor", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), "blocks", "fp", "home")
        places = dealt.repartition("anchor", "block").sortWithinPartitions("anchor", "block").mapInArrow(tidy(_pack(folder)), "anchor long, block int, blocks int, file string, at long, size long")
        places, _ = materialise(places, "anchor-blocks")
        own = places.select("anchor", "file", "at", "size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        met = own.join(places.select("anchor", "block", F.col("file").alias("file_2"), F.col("at").alias("at_2"), F.col("size").alias("size_2")), ["anchor", "block"])
        met = met.select("file", "at", "size", "file_2", "at_2", "size_2").repartition("file", "at", "file_2", "at_2")
        found = found.unionByName(met.mapInArrow(tidy(_meet(folder)), "a long, b long"))
    out, _ = materialise(found.distinct(), "links")
    remove(spark, large_path, folder)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", product: tuple[str, ...] | None = None) -> DataFrame:
    """One row per input row: doc_id, fp (the fingerprint as a signed long) and component_id.

    A text's fingerprint has a bit where over half the 64-bit hashes (XXH64 with seed 42) of its 3-word shingles, repeats
    included, A-Z lower-cased, have it; of all its words, if they are fewer. Null and empty texts, and those without
    words, have the fingerprint 0, which is linked like any other. Fingerprints that differ in 3 bits at most are linked;
    component_id is the smallest id reachable, the row's own included. Rows that repeat an id are rows of their own; rows
    without id link others but never name a component, and have none where nobody else can name it. Ids are integers.
    Texts of any length count whole; an empty table gives no rows; other columns are not read. ``product`` fixes the code.
    """
    spark = df.sparkSession
    src = df.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    signed, _ = materialise(src.mapInArrow(tidy(_fingerprints), "id long, fp long"), "simhashes")
    classes, _ = materialise(signed.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "fingerprints")
    found = links(classes.select("fp"), product or product_for(classes.count()))
    roots = components(found)
    roots = small_side(roots.select(F.col("node").alias("fp"), "root"), roots.count())
    named = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # A root's own fingerprint is in its component too; those that are linked with nothing, of one row, need no join.
    low = named.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("rows")).where("rows > 1").select("root", "component_id")
    low, low_path = materialise(low, "components")
    several, _ = materialise(named.join(small_side(low, low.count()), "root").select("fp", "component_id"), "classes")
    remove(spark, low_path)
    out = signed.join(small_side(several, several.count()), "fp", "left")
    return out.select(F.col("id").alias("doc_id"), "fp", F.coalesce("component_id", "id").alias("component_id"))


def as_hex(fp="fp"):
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
