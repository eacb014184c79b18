"""Token ids in files compressed by Re-Pair grammars, one grammar to a file.

Frequent pairs of neighbouring ids are replaced by new symbols, again and again; a file has the rules, the
symbols that remain, each document's place in them, and the running sum of expansion lengths at every
STEP-th symbol, by which any range of ids is decoded without the rest. Pairs never reach across the end
of a document, so each document is a run of symbols of its own.

File format, version 1, all numbers little-endian: the magic ``RPR1``; the length of the header as u32; the
header as JSON with the byte place, length and type of each array (u3: three bytes a number); then the arrays.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from ._work import FileReader, col, materialise, open_fs, remove, scratch, tidy, write_table

MAGIC = b"RPR1"
STEP = 1024
#: Ids to a file, and the fewest places that a pair must have for a rule.
SHARD_IDS, LEAST = 4 << 20, 16
#: Buckets, two to so many at most, in which frequent pairs are looked up.
_BITS = 20
_NONE = np.iinfo(np.int32).max


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64)
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def compress(ids: np.ndarray, end_id: int, base: int, least: int = LEAST, rounds: int | None = None, rules_a_round: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rules has a row (left, right) for each symbol from ``base`` on.

    Goes on until no pair has ``least`` places that do not overlap, unless ``rounds`` or ``rules_a_round`` say less. In a
    round pairs are ranked by their places; a pair is replaced where it outranks the pairs that overlap it, if those
    places are enough. The most frequent pair is replaced everywhere, as in one step of Re-Pair, so each round has a rule.
    """
    s = ids.astype(np.uint32)
    rules = np.zeros((0, 2), np.int64)
    may = (s[:-1] != end_id) & (s[1:] != end_id)  # places whose pair may be frequent: it was, or it is new; none has an end
    ranks = np.full(len(s) + 1, _NONE, np.int32)  # of the places, with one more at either end; none between rounds
    while rounds != 0:
        rounds = None if rounds is None else rounds - 1
        half, kind = (16, np.uint32) if base + len(rules) < 1 << 16 else (32, np.uint64)  # narrow keys sort faster
        none = np.iinfo(kind).max  # no pair's key: the largest symbol is below that
        if dense := 4 * np.count_nonzero(may) > len(may):  # all places are looked at, the others without a key
            key = s[:-1].astype(kind) << kind(half) | s[1:] | may.astype(kind) - kind(1)
            again = np.flatnonzero((key[1:] == key[:-1]) & may[1:]) + 1
            before, here, after = slice(0, -2), slice(1, -1), slice(2, None)
        else:
            at = np.flatnonzero(may)
            key = s[at].astype(kind) << kind(half) | s[at + 1]
            again = np.flatnonzero(key[1:] == key[:-1]) + 1
            again = again[at[again] == at[again - 1] + 1]
            before, here, after = at, at + 1, at + 2
        # in a run of one symbol every second place counts
        run = np.flatnonzero(np.diff(again, prepend=-2) != 1)
        nth = np.arange(len(again)) - np.repeat(run, np.diff(run, append=len(again)))
        skipped = again[nth % 2 == 0]
        key[skipped] = none
        found = np.sort(key)
        edge = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else again
        n = np.diff(edge, append=len(found))
        often = (n >= least) & (found[edge] != none)
        pairs, n = found[edge][often], n[often]
        if not len(pairs):
            break
        rank = np.append(np.empty(len(pairs), np.int32), np.int32(_NONE))
        rank[np.lexsort((pairs, -n))] = np.arange(len(pairs))
        k = _places(key, pairs, none)
        own = rank[k]
        ranks[here] = own
        if dense:
            np.less(own, _NONE, out=may)
            may[skipped] = True
        else:
            may[:] = False
            may[at] = own < _NONE
            may[at[skipped]] = True
        first = np.flatnonzero((own < ranks[before]) & (own < ranks[after]))
        ranks[here] = _NONE
        at, k = first if dense else at[first], k[first]
        n = np.bincount(k, minlength=len(pairs))
        chosen = np.flatnonzero(n >= least)
        chosen = np.sort(chosen[np.lexsort((chosen, -n[chosen]))][:rules_a_round])
        new = np.full(len(pairs), -1, np.int64)
        new[chosen] = np.arange(len(chosen))
        k = new[k]
        at, k = at[k >= 0], k[k >= 0]
        s[at] = base + len(rules) + k
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        may = np.append(may, False)
        before = at[at > 0] - 1
        may[before] = s[before] != end_id
        may[at] = s[np.minimum(at + 2, len(s) - 1)] != end_id
        s |= may.astype(np.uint32) << np.uint32(31)  # both are cut at once
        s = s[keep]
        may = (s >> np.uint32(31)).astype(bool)[:-1]
        s &= np.uint32((1 << 31) - 1)
        ranks = ranks[: len(s) + 1]
        rules = np.concatenate([rules, np.stack([pairs[chosen] >> kind(half), pairs[chosen] & kind((1 << half) - 1)], axis=1).astype(np.int64)])
    return s.astype(np.int64), rules


def _places(keys: np.ndarray, pairs: np.ndarray, none: int) -> np.ndarray:
    """For each key its place among the sorted pairs, or their number where it is not there."""
    bits = min(_BITS, max(10, len(pairs).bit_length() + 4))
    bucket, nth = _bucket(pairs, bits), np.arange(len(pairs))
    slot = np.full(1 << bits, len(pairs), np.int32)
    slot[bucket] = nth
    shared = np.zeros(len(pairs) + 1, bool)  # pairs whose bucket others have too; these are searched for
    shared[slot[bucket[slot[bucket] != nth]]] = True
    k = slot[_bucket(keys, bits)]
    wrong = np.flatnonzero(np.append(pairs, pairs.dtype.type(none))[k] != keys)
    search = wrong[shared[k[wrong]]]
    k[wrong] = len(pairs)
    place = np.minimum(np.searchsorted(pairs, keys[search]), len(pairs) - 1)
    k[search] = np.where(pairs[place] == keys[search], place, len(pairs))
    return k


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for. A rule only names symbols before it."""
    out = np.ones(base + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[base + k] = out[a] + out[b]
    return out[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    flat = np.zeros(int(lengths.sum()), np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for k, pair in enumerate(rules.tolist()):
        at = int(starts[k])
        for x in pair:
            if x < base:
                flat[at] = x
                at += 1
            else:
                n = int(lengths[x - base])
                flat[at : at + n] = flat[starts[x - base] : starts[x - base] + n]
                at += n
    new = symbols >= base
    n = np.ones(len(symbols), np.int64)
    n[new] = lengths[symbols[new] - base]
    begin = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.int64)
    out[begin[~new]] = symbols[~new]
    m = n[new]
    if len(m):
        inside = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        out[np.repeat(begin[new], m) + inside] = flat[np.repeat(starts[symbols[new] - base], m) + inside]
    return out


def narrow(symbols: np.ndarray, above: int) -> np.ndarray:
    """Numbers below ``above`` in two, three or four bytes each; of three bytes, as rows."""
    if above <= 1 << 16:
        return symbols.astype("<u2")
    wide = symbols.astype("<u4")
    return wide if above > 1 << 24 else np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 4)[:, :3])


def write_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, end_id: int, vocabulary: int, least: int = LEAST, rounds: int | None = None, rules_a_round: int | None = None) -> bytes:
    symbols, rules = compress(ids, end_id, vocabulary, least, rounds, rules_a_round)
    lengths = expansion_lengths(rules, vocabulary)
    n = np.ones(len(symbols), np.int64)
    n[symbols >= vocabulary] = lengths[symbols[symbols >= vocabulary] - vocabulary]
    before = np.concatenate([[0], np.cumsum(n)])
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    arrays = {
        "symbols": narrow(symbols, vocabulary + len(rules)), "rules": rules.astype("<u4"), "lengths": lengths.astype("<u4"), "sums": before[::STEP].astype("<u8"),
        "doc_ids": np.array([i or 0 for i in doc_ids], "<i8"), "known": np.array([i is not None for i in doc_ids], "u1"), "first": first.astype("<u8"), "symbol": np.searchsorted(before, first).astype("<u8"),
    }
    head: dict = {"version": 1, "vocabulary": vocabulary, "end_id": end_id, "step": STEP, "arrays": {}}
    at = 0
    for k, a in arrays.items():
        head["arrays"][k] = [at, a.nbytes, "u3" if a.ndim == 2 and k == "symbols" else a.dtype.str]
        at += a.nbytes
    text = json.dumps(head).encode()
    return MAGIC + np.array([len(text)], "<u4").tobytes() + text + b"".join(a.tobytes() for a in arrays.values())


class Shard:
    """A file opened for reading, by an object with seek and read."""

    def __init__(self, f):
        self.f = f
        f.seek(0)
        if f.read(4) != MAGIC:
            raise ValueError("not a file of this format")
        n = int(np.frombuffer(f.read(4), "<u4")[0])
        self.head = json.loads(f.read(n))
        self.data = 8 + n
        self.base = self.head["vocabulary"]
        self.rules = self.array("rules").reshape(-1, 2).astype(np.int64)
        self.lengths = self.array("lengths").astype(np.int64)
        self.first = self.array("first").astype(np.int64)

    def array(self, name: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        at, n, kind = self.head["arrays"][name]
        w = 3 if kind == "u3" else np.dtype(kind).itemsize
        hi = n // w if hi is None else min(hi, n // w)
        self.f.seek(self.data + at + lo * w)
        data = self.f.read((hi - lo) * w)
        if kind != "u3":
            return np.frombuffer(data, kind)
        return np.pad(np.frombuffer(data, np.uint8).reshape(-1, 3), ((0, 0), (0, 1))).view("<u4").reshape(-1)

    @property
    def doc_ids(self) -> list[int | None]:
        return [int(i) if k else None for i, k in zip(self.array("doc_ids"), self.array("known"), strict=True)]

    def all_ids(self) -> np.ndarray:
        return expand(self.array("symbols").astype(np.int64), self.rules, self.lengths, self.base)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop of the file, from the symbols around them only."""
        start, stop = max(0, start), min(stop, int(self.first[-1]))
        if start >= stop:
            return np.zeros(0, np.int64)
        sums = self.array("sums").astype(np.int64)
        k = int(np.searchsorted(sums, start, "right")) - 1
        m = int(np.searchsorted(sums, stop, "left"))
        some = expand(self.array("symbols", k * STEP, m * STEP).astype(np.int64), self.rules, self.lengths, self.base)
        return some[start - int(sums[k]) : stop - int(sums[k])]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the file, its end id included."""
        lo, hi = self.array("symbol", k, k + 2).tolist()
        return expand(self.array("symbols", lo, hi).astype(np.int64), self.rules, self.lengths, self.base)


#: Rows to a range of ids.
RANGE_ROWS = 20_000


def write_tokens(
    df: DataFrame, tokenizer_path: str, pattern: str, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, shard_ids: int = SHARD_IDS,
    least: int = LEAST, rounds: int | None = None, rules_a_round: int | None = None,
) -> str:
    """Encodes every whole text, appends ``end_id``, and writes the ids in ascending order of id; returns the path.

    The tokenizer is a byte-level BPE file of the tokenizers library that splits texts by ``pattern``; each distinct
    match of the corpus is encoded once (see ``bpe.encode``). In a file, pairs are replaced until none has ``least`` places;
    ``rounds`` and ``rules_a_round`` may bound that. A null or empty text is its end id alone; ids are integers, others stop the job at Spark's cast; rows without
    id come first; rows that repeat an id are in order of a hash of their texts; other columns are not read; an empty
    table makes no files.

    Documents' ids are written once, compressed, and their places are dealt to tasks by ranges of document id and of a hash
    of the text, so that rows without an id are many tasks' work; a range is
    written in files of about ``shard_ids`` ids; a long document is never parted. Files have names of their own; Spark commits the list of those
    that count, with their order.
    """
    from tokenizers import Tokenizer

    spark = df.sparkSession
    path = path or scratch(spark, "tokens")
    size = Tokenizer.from_file(tokenizer_path).get_vocab_size()
    kind = "<u2" if size <= 1 << 16 else "<u4"
    folder = scratch(spark, "ids")
    made: list[str] = []

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(path)
        fs.create_dir(root, recursive=True)
        end = np.array([end_id], kind).tobytes()
        part, k, read = TaskContext.get().partitionId(), 0, FileReader(folder, 0)
        ids: list = []
        counts: list[int] = []
        coded: list[bytes] = []
        held = 0

        def shard():
            name = f"{uuid.uuid4().hex}.rpr"
            data = write_file(ids, counts, np.frombuffer(b"".join(coded), kind), end_id, size, least, rounds, rules_a_round)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(data)
            row = [[part], [k], [name], [len(data)], [len(ids)], [sum(counts)]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names=["part", "k", "name", "bytes", "n_docs", "n_ids"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = bpe.stored_ids(read, t.as_py(), kind).tobytes() + end
                ids.append(i)
                counts.append(len(data) // np.dtype(kind).itemsize)
                coded.append(data)
                held += counts[-1]
                if held >= shard_ids:
                    yield shard()
                    k += 1
                    ids, counts, coded, held = [], [], [], 0
        if ids:
            yield shard()

    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    src = df.select(col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    coded, path_of_coded = materialise(bpe.encode(src, tokenizer_path, pattern, library="tokenizers", packed=kind, keep=["id", "tie"], ids_folder=folder, made=made), "id-places")
    remove(spark, *made)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, 1 + coded.count() // RANGE_ROWS))
    order = coded.repartitionByRange(n, F.asc_nulls_first("id"), "tie").sortWithinPartitions(F.asc_nulls_first("id"), "tie").select("id", "ids")
    write_table(order.mapInArrow(tidy(write), "part int, k int, name string, bytes long, n_docs long, n_ids long"), f"{path}/_files")
    remove(spark, folder, path_of_coded)
    return path


def files(df_or_spark, path: str) -> DataFrame:
    """The committed files in order, with the number of ids before each. One row to a file of millions of ids."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    listed = spark.read.schema("part int, k int, name string, bytes long, n_docs long, n_ids long").parquet(f"{path}/_files")
    before = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(spark, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of its ids as little-endian u32).

    Null and repeated ids come as ``write_tokens`` has them; files of an empty table, none, give no rows; a file is one
    task's work, however long its documents.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(path)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{root}/{name}") as f:
                    s = Shard(f)
                    ids, first, raw = s.doc_ids, s.first, s.all_ids().astype("<u4").tobytes()
                view = memoryview(raw)
                crc = [zlib.crc32(view[4 * lo : 4 * hi]) for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first[:-1] + start), pa.array(np.diff(first)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = files(spark, path).select("name", "start")
    n = max(1, min(listed.count(), int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return listed.repartition(n, "name").mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long")
