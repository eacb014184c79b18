"""Exact line deduplication across documents, with Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._work import col, fresh, materialise, remove, small_side

#: The blanks that are stripped from a line, and the letters that are lower-cased.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped, with A-Z in lower case; ASCII lines take the fast way."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """df with lines dropped that at least ``min_docs`` documents share, save in the row of the largest id.

    Lines are compared by ``line_key`` and 128 bits of hash; keys under ``min_chars`` code points always
    stay. Rows that repeat an id are one document, which counts once and, where its id is the largest, keeps
    the line in each of its rows. A null text counts as empty and comes back empty; rows without an id are one
    document whose id is smaller than any other; an empty table gives no rows. All columns stay; ``counts`` names
    the columns for the numbers of lines before and dropped.

    Plan: hashes of lines become narrow rows; distinct (line, id) rows are dealt by all three, so that a frequent
    line is many tasks' work, and are summed by line with map-side combining. Hashes over the threshold, a table,
    are sent to the tasks where they are few; elsewhere they are joined, and Spark splits a frequent line. Dropped
    positions are gathered by row, and the text, which never leaves its row except for this last join, is put
    together from what remains.
    """
    row, lines, drops, mark = fresh(df, "line_row", "line_list", "line_drops", "line_id")
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    row_key = F.xxhash64(text)
    key = F.transform(F.split(text, "\n", -1), line_key)
    hashed = F.transform(
        key,
        lambda k, i: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"), i.alias("pos"), (F.length(k) >= min_chars).alias("long")),
    )
    found = df.select(col(id_col).alias("id"), row_key.alias("row"), F.inline(F.filter(hashed, lambda x: x["long"]))).drop("long")
    table, path = materialise(found, "lines")

    holders = table.select("h1", "h2", "id").distinct()
    common = holders.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs).select("h1", "h2", "last")
    common, common_path = materialise(common, "shared-lines")
    lost = table.join(small_side(common, common.count()), ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
    gone = lost.groupBy(F.col("id").alias(mark), F.col("row").alias(row)).agg(F.array_distinct(F.collect_list("pos")).alias(drops))
    gone, _ = materialise(gone, "line-drops")
    remove(df.sparkSession, path, common_path)

    joined = df.join(gone, col(id_col).eqNullSafe(F.col(mark)) & (row_key == F.col(row)), "left")
    split = joined.withColumn(lines, F.split(text, "\n", -1))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops), lambda i: F.get(lines, i))
    out = {text_col: F.when(F.col(drops).isNull(), text).otherwise(F.array_join(left, "\n"))}
    n = [F.size(lines).cast("long"), F.coalesce(F.size(drops), F.lit(0)).cast("long")]
    kept = [out[c].alias(c) if c == text_col else col(c) for c in df.columns if not counts or c not in counts]
    return split.select(*kept, *([x.alias(c) for x, c in zip(n, counts, strict=True)] if counts else []))
