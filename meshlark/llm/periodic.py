"""Runs of repeated words, by divide and conquer over each text (Main and Lorentz).

Words of a text are interned as small integers. A text is halved again and again; at each midpoint, Z-functions of the
two halves tell for every distance how far the words agree forwards and backwards, which gives all repetitions that
cross the midpoint, extended both ways as far as they go; one that goes on beyond the part belongs to a larger part. Each
interval is kept once, with its smallest period.

A run of at least LEAST words has six words in a row that come again one period later. Parts in which no six words come
again (found by hashes for many texts at once, so that only too much is ever entered) are therefore not halved further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._work import col, tidy

#: A run's least length in words, and the words that it has in common with itself one period later.
LEAST, GRAM = 12, 6
#: Words of texts that are looked through at once; a longer text is looked through alone.
AT_ONCE = 500_000

_P = np.uint64(0x9E3779B97F4A7C15)


def z_function(s: list[int]) -> list[int]:
    """For each position of s, the length of the longest common prefix of s and what begins there."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    first = s[0]
    for i in range(1, n):
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        elif s[i] != first:
            continue
        else:
            k = 1
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _crossing(w: list[int], lo: int, mid: int, hi: int, least: int) -> Iterator[tuple[int, int, int]]:
    """Repetitions (start, end, period) of w[lo:hi] that have words on both sides of mid."""
    left, right = w[lo:mid], w[mid:hi]
    a, b = len(left), len(right)
    back = left[::-1]
    # How far words agree p apart: forwards from mid and backwards from mid, within a half and from one half to the other.
    within, before = z_function(right), z_function(back)
    ahead, behind = z_function(right + [-1] + left), z_function(back + [-1] + right[::-1])
    for p in range(1, a + 1):
        f, g = ahead[b + 1 + a - p], before[p] if p < a else 0
        if f == p and p < b:
            f += within[p]
        if f + g >= p and f + g + p >= least:
            yield mid - p - g, mid + f, p
    for p in range(1, b + 1):
        f, g = within[p] if p < b else 0, behind[a + 1 + b - p]
        if g == p and p < a:
            g += before[p]
        if f + g >= p and f + g + p >= least:
            yield mid - g, mid + p + f, p


def runs(w: list[int], again: np.ndarray | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All (start, length, period) of w, by start and then period: stretches of at least ``least`` words and two periods,
    with their smallest period, that neither neighbouring word goes on. Words are numbers from 0.

    ``again`` says for each position where the next equal stretch of GRAM words begins (len(w) for none), or any earlier
    position after it; without it, every part is entered.
    """
    n = len(w)
    found: dict[tuple[int, int], int] = {}
    # sooner[k][i]: the least of again over 2^k positions from i.
    sooner = [] if again is None else [again]
    while sooner and 2 << (len(sooner) - 1) <= n:
        s, k = sooner[-1], 1 << (len(sooner) - 1)
        sooner.append(np.minimum(s[:-k], s[k:]))
    parts = [(0, n)]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < least:
            continue
        if sooner:
            k = (hi - lo).bit_length() - 1
            if min(sooner[k][lo], sooner[k][hi - (1 << k)]) + GRAM > hi:
                continue
        mid = (lo + hi) // 2
        parts += (lo, mid), (mid, hi)
        for start, end, p in _crossing(w, lo, mid, hi, least):
            # One that goes on beyond the part's border crosses a larger part's midpoint and has been found whole there.
            if start == lo and lo and w[lo - 1] == w[lo - 1 + p] or end == hi and hi < n and w[hi] == w[hi - p]:
                continue
            if p < found.get((start, end), n + 1):
                found[start, end] = p
    return sorted((s, e - s, p) for (s, e), p in found.items() if e - s >= max(least, 2 * p))


def _next_equal(ids: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For each position the next one in the same text with the same GRAM words, as far as hashes tell; else a far one."""
    n = len(ids) - GRAM + 1
    far = np.iinfo(np.int64).max // 2
    if n <= 0:
        return np.full(len(ids), far)
    h = text_of[:n].astype(np.uint64)
    for k in range(GRAM):
        h = (h ^ ids[k : k + n].astype(np.uint64)) * _P
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    out = np.full(len(ids), far)
    out[order[:-1][same]] = order[1:][same]
    return out


def _texts(texts: list[str | None], least: int) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Runs and the collapsed text of each text."""
    words = [(t or "").encode().split() for t in texts]
    known: dict[bytes, int] = {}
    ids = [[known.setdefault(x, len(known)) for x in w] for w in words]
    sizes = np.array([len(x) for x in ids])
    at = np.cumsum(sizes) - sizes
    flat = np.fromiter((x for w in ids for x in w), np.int64, int(sizes.sum()))
    text_of = np.repeat(np.arange(len(ids)), sizes)
    after = _next_equal(flat, text_of)
    for k, w in enumerate(ids):
        own = after[at[k] : at[k] + sizes[k]] - at[k]
        if len(w) < least:
            found = []
        elif least < 2 * GRAM:  # shorter runs need not have GRAM words in common with themselves
            found = runs(w, None, least)
        else:
            own[1 - GRAM :] = len(flat)
            found = runs(w, own, least) if own.min() < len(w) else []
        kept = words[k]
        if found:
            gone = np.zeros(len(w) + 1, np.int64)
            for start, length, p in found:
                gone[start + p] += 1
                gone[start + length] -= 1
            kept = [x for x, d in zip(kept, np.cumsum(gone).tolist(), strict=False) if not d]
        yield found, b" ".join(kept).decode()


def _find(least: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in b.column(1)])
            # Texts of about so many words go together; their order stays.
            group = np.cumsum(size) // (6 * AT_ONCE)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = b.slice(lo, hi - lo)
                found = list(_texts(part.column(1).to_pylist(), least))
                spans = [[{"start": s, "length": n, "period": p} for s, n, p in f] for f, _ in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind), pa.array([t for _, t in found], pa.string())], names=["id", "runs", "collapsed"])

    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per input row: doc_id, runs (start, length, period, by start and then period) and collapsed.

    A run is a stretch of consecutive words (whatever stands between ASCII white space) with smallest period q, at least
    ``least`` words and two periods long, that no neighbouring word goes on. Words are numbered from 0. collapsed is the
    words that no run holds after its first q words, with one space between them. Null and empty texts have no runs and
    an empty collapsed text; texts of any length count whole; rows that repeat an id, or have none, are rows of their
    own; an empty table gives no rows; other columns are not read. Texts are read once and nothing is shuffled.
    """
    src = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(tidy(_find(least)), f"id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", "doc_id")


def longest(runs_col="runs"):
    """The run of greatest length, of those the first, of those the one with the smallest period; null without runs."""
    better = lambda a, b: (b["length"] > a["length"]) | ((b["length"] == a["length"]) & ((b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))
    runs_col = F.col(runs_col)
    return F.aggregate(runs_col, F.get(runs_col, F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))


def runs_digest(runs_col="runs"):
    """sha256 of the lines ``start,length,period``, each with its line feed."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(F.col(runs_col), line), ""), 256)


def planted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with texts (id, text) of which one in ten, by crc32 of the id, ends in a repetition made of its own words: with
    g = h // 10 of that hash h and n words, word i >= a = g % n becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    Such a text has one space between words; others, and those without id or words, stay as they are."""
    text, h = col(text_col).cast("string"), F.crc32(col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    out = df.select(col(id_col).alias("doc_id"), text.alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    out = out.withColumn("n", n.cast("long")).withColumn("g", g).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    out = out.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform(F.col("w"), lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get(F.col("w"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return out.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
