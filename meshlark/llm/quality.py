"""Quality rules as a bitmask ledger.

One pass over the texts takes all measurements; every rule is evaluated once, as a Column over them,
and its failure is a bit of ``failed_bits``. Policies are versioned sets of rules: applying one, or
asking what one rule costs, is bitwise work on the ledger and never reads a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._work import col, numbered, tidy

#: Fixed values of the contract.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_stutter_words"]
_WEIGHTS = np.random.default_rng(7).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in windows of ``size`` words found twice or more. Hashes propose, the words confirm."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    win = np.zeros(n, np.uint64)
    for k in range(size):
        win += h[k : k + n] * _WEIGHTS[k]
    s = np.sort(win)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(win, twice)).tolist()
    seen = Counter(tuple(words[i : i + size]) for i in at)
    edge = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(words[i : i + size])] > 1:
            edge[i] += 1
            edge[i + size] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one whole text; null counts as empty."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        sum(map(bytes.isupper, words)),
        sum(map(eq, words, words[1:])),
    )


def _measured(df: DataFrame, text_col: str) -> DataFrame:
    """df with MEASURES behind its columns, in one pass without a shuffle; no column of df may have one of their names."""
    at, names = df.columns.index(text_col), [*df.columns, *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_py()) for t in b.column(at)]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    schema = T.StructType([*df.schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return df.mapInArrow(tidy(run), schema)


@dataclass(frozen=True)
class Rule:
    """A named test on the measurements; true means that the document fails."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule(5, "upper_case", "2 * n_upper_words > n_words"),
    Rule(6, "stutter", "4 * n_stutter_words > n_words"),
)
BASE = 0b11
#: Versioned policies: a document stays when it fails none of the policy's bits.
POLICIES = {"base": BASE, "2026-01": BASE | 0b100, "2026-02": 0b111111, "2026-03": 0b1111111}
CURRENT = "2026-03"


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: id, MEASURES and failed_bits.

    A null or empty text has no words (it fails ``few_words``); a null id stays null; repeated rows
    each get a row; an empty table gives an empty ledger. Other columns are not read.
    """
    src = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return _measured(src, "text").select(F.col("id").alias(id_col), *MEASURES, failed_bits(rules).alias("failed_bits"))


def failed_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    """Every rule evaluated once over MEASURES, a bit each."""
    bits: Column = F.lit(0).cast("long")
    for r in rules:
        bits = bits + F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def verdict(policy: str | int = CURRENT) -> Column:
    """Column over a ledger: true where the policy keeps the document."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")) == 0


def ablation(book: DataFrame, policy: str | int = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: rows that fail it, and rows that fail it alone (kept without it).

    The ledger is first summed by bit pattern, of which there are at most 2^rules, so one small shuffle
    serves all rules.
    """
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    live = [r for r in rules if mask >> r.bit & 1]
    seen = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))
    sums = book.groupBy(seen.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    entry = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in live]))
    each = sums.select("bits", "n", entry.alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
    )


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: str = CURRENT) -> DataFrame:
    """df without the rows whose ledger fails the policy; all columns stay.

    The ledger's measurements and bits are taken beside each row, so that the verdict needs no join by an id that may be
    null or repeated: each row goes by its own text. A null or empty text has no words and goes; an empty table stays empty;
    ``id_col`` is not read, and columns may have the names of measurements.
    """
    plain = numbered(df)
    book = _measured(plain, plain.columns[df.columns.index(text_col)]).withColumn("failed_bits", failed_bits())
    return book.where(verdict(policy)).select(*plain.columns).toDF(*df.columns)
