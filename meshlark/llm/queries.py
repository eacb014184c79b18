"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _work, bpe, decontam, hardneg, htmltext, linededup, neardup, periodic, quality, repair, shards, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(_table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_lines", "n_upper_words", "n_stutter_words", "failed_bits"]
    return book.select("doc_id", *names, (~quality.verdict("base")).alias("base_failed"), quality.verdict().alias("kept"), *more)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_pages(_table(spark, sf_dir, "pages"), dedup_min_bytes=0)
    back = warc.read_archive(spark, path, payload="false", verify="true").where(F.col("record_type").isin("response", "revisit"))
    return back.select(warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_number("refers_to").alias("refers_to"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four arrivals of documents, compacted: every row of the last version, with the text's digest."""
    table = shards.ShardedTable(spark, _work.scratch(spark, "shards"))
    shards.arrive_in_batches(_table(spark, sf_dir, "documents"), table, 4, "doc_id")
    table.compact()
    table.vacuum()
    return table.read().select("doc_id", "lang", "source", "n_chars", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest().alias("items_sha256"), "contaminated", F.size("near_item_ids").cast("long").alias("n_near_items"))


def op10_repair_tokens(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    return repair.read_documents(spark, repair.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary), public_tokenizers.PATTERN, end_id=2))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.planted(_table(spark, sf_dir, "documents"))).withColumn("best", periodic.longest())
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent, periodic.runs_digest().alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_text": op4_html_text,
    "op5_near_dedup": op5_near_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_repair_tokens": op10_repair_tokens,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash": op13_simhash,
}

_WS = r"\x20\x09-\x0D"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _base32(hexed: str) -> str:
    """SQL for base32 of 40 hex digits: five of them are four letters."""
    five = [f"('0x' || substr({hexed}, {5 * k + 1}, 5))::BIGINT" for k in range(8)]
    return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({x} >> {s}) & 31)::INT, 1)" for x in five for s in (15, 10, 5, 0))


ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^{_WS}]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^{_WS}]') GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS n_upper_words,
  CAST(len(list_filter(list_zip(ws[2:], ws[:-2]), lambda x: x[1] = x[2])) AS BIGINT) AS n_stutter_words
  FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id LEFT JOIN lines ON d.doc_id = lines.doc_id),
b AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
  + 16 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT + 32 * (2 * n_upper_words > n_words)::INT + 64 * (4 * n_stutter_words > n_words)::INT AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, n_lines, n_upper_words, n_stutter_words, failed_bits FROM b""",
    "op3_line_dedup": rf"""
WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[{_WS}]+|[{_WS}]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS drop FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE drop) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop), '')) AS kept_sha256 FROM f GROUP BY doc_id""",
    "op2_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
s AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, first FROM p)
SELECT page_id, payload_bytes, {_base32('x')} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM s""",
    "op9_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i+n-1], ' ') AS g FROM
  (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id),
place AS (SELECT doc_id, unnest(ws) AS term, unnest(range(len(ws))) AS pos FROM d),
spread AS (SELECT term, count(DISTINCT doc_id) AS n FROM place GROUP BY term),
win AS (SELECT g, string_split(g, ' ') AS ts, min(len(string_split(g, ' '))) AS n FROM bw GROUP BY g),
wt AS (SELECT DISTINCT g, unnest(ts) AS term FROM win),
wn AS (SELECT wt.g, wt.term, spread.n FROM wt JOIN spread ON wt.term = spread.term),
full_w AS (SELECT g, count(*) AS k, arg_min(term, (n, encode(term))) AS anchor FROM wn GROUP BY g HAVING count(*) = (SELECT count(*) FROM wt WHERE wt.g = wn.g)),
cand AS (SELECT full_w.g, full_w.k, place.doc_id, place.pos FROM full_w JOIN place ON place.term = full_w.anchor),
around AS (SELECT cand.g, cand.k, cand.doc_id, cand.pos, count(DISTINCT place.term) AS found FROM cand JOIN wt ON wt.g = cand.g
  JOIN place ON place.doc_id = cand.doc_id AND place.term = wt.term AND place.pos BETWEEN cand.pos - 26 AND cand.pos + 26 GROUP BY ALL),
nr AS (SELECT around.doc_id, count(DISTINCT bw.item_id) AS n_near FROM around JOIN bw ON bw.g = around.g WHERE found = k GROUP BY around.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN nr ON d.doc_id = nr.doc_id""",
    "op5_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^{_WS}]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+n-1], ' ') AS g FROM
  (SELECT doc_id, ws, least(4, len(ws)) AS n, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c ca ON a = ca.doc_id JOIN c cb ON b = cb.doc_id WHERE 100 * p.n >= 80 * (ca.n + cb.n - p.n)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS root FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, root AS component_id, d.doc_id = root AS kept
FROM d LEFT JOIN c ON d.doc_id = c.doc_id JOIN m ON d.doc_id = m.a""",
    "op7_sharding": "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents",
    # A run has six words in a row that come again a period later: consecutive places of equal six words, a distance apart, are a run.
    "op11_periodic_runs": rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_WS}]+') AS ws, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS r FROM documents),
h AS (SELECT doc_id, ws, CAST(len(ws) AS BIGINT) AS n, xor(r, 4294967295) % 10 AS last, xor(r, 4294967295) // 10 AS g FROM t),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (SELECT doc_id, CASE WHEN last = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) ELSE ws END AS ws FROM p),
grams AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(CAST(len(ws) AS BIGINT) - 5)) AS i FROM w)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT doc_id, p, min(i) AS s, max(i) + p + 6 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM pairs) GROUP BY doc_id, p, k),
runs AS (SELECT doc_id, s, e, min(p) AS p FROM islands WHERE e - s >= greatest(12, 2 * p) GROUP BY doc_id, s, e),
best AS (SELECT doc_id, count(*) AS n_runs, arg_max(s, (e - s, -s, -p)) AS start, arg_max(e - s, (e - s, -s, -p)) AS length, arg_max(p, (e - s, -s, -p)) AS period,
  string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p) AS said FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, e)) AS i FROM runs),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS text FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w) x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256 FROM w LEFT JOIN best ON w.doc_id = best.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, a.label AS al, b.id AS b, b.label AS bl, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v a JOIN v b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.id % 100 = 0),
p AS (SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s WHERE al = bl) WHERE k <= 5),
n AS (SELECT p.a, p.b, p.score AS ps, s.b AS nb, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k FROM p JOIN s ON p.a = s.a AND al <> bl AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, b AS positive_id, CAST(k AS INTEGER) AS rank, nb AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE k <= 10""",
}
