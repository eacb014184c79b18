"""Byte-level BPE over distinct words: each distinct pre-token of the corpus is encoded once.

Texts are cut into pre-tokens in blocks of rows. A block's file in the shared folder has its distinct words in order of
their hashes and, row by row, its positions: the word that stands at each. Words are dealt by ranges of hash to parts, as
many as the session's shuffle partitions or as the number of words asks for. A part encodes each word once, however many
blocks have it, and its answers are joined back to the blocks, in the words' order, where ids take the words' positions.
Texts are read once and never shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import pickle
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._pieces import _ranges, cut, splitter
from ._work import FileReader, FileWriter, col, made_once, materialise, numbered, scratch, squeeze, tidy, unsqueeze

#: Bytes of text to a block, words asked for to a part, and bytes of words answered at once: what a task holds. They set
#: how work is cut, not results.
BLOCK_BYTES, PART_WORDS, PART_BYTES = 8_000_000, 500_000, 16_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def word_coder(library: str, data: bytes, pattern: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from matches of the pattern to their ids, one after the other, and how many each has. data: the vocabulary file of the library."""
    if library == "tiktoken":
        import tiktoken

        code = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(data), special_tokens={})._encode_single_piece

        def code_each(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            ids, n = array("I"), []
            for w in words.to_pylist():
                own = code(w)
                ids.extend(own)
                n.append(len(own))
            return np.array(ids, "<u4"), np.array(n, np.int64)

        return code_each
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    coder = Tokenizer.from_str(data.decode())
    added = set(added_tokens(library, data))
    long = np.zeros(1 + max(coder.get_vocab().values()), np.int64)  # bytes that each id stands for: a letter of its name to each
    for name, i in coder.get_vocab().items():
        long[i] = len(name.encode()) if name in added else len(name)

    def code_all(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, n = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 4096):
            some = words[k : k + 4096].cast(pa.large_string())
            (found,) = coder.encode_batch_fast([some.to_pylist()], is_pretokenized=True, add_special_tokens=False)
            own = np.array(found.ids, "<u4")
            sizes, ends = np.asarray(pc.binary_length(some)).astype(np.int64), np.cumsum(long[own])
            last = np.searchsorted(ends, np.cumsum(sizes))
            if coder.normalizer is None and sizes.all() and last[-1] == len(ends) - 1 and (ends[last] == np.cumsum(sizes)).all():
                n.append(np.diff(last, prepend=-1))
            else:  # ids that do not stand for the words' bytes: some are left out or put in, which the sums tell
                found = coder.encode(some.to_pylist(), is_pretokenized=True, add_special_tokens=False)
                own = np.array(found.ids, "<u4")
                n.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
            ids.append(own)
        return np.concatenate(ids), np.concatenate(n)

    return code_all


def added_tokens(library: str, data: bytes) -> tuple[str, ...]:
    """Strings that the library takes out of a text before the pattern, whatever stands around them."""
    found = json.loads(data).get("added_tokens", []) if library == "tokenizers" else []
    if odd := [x["content"] for x in found if x.get("lstrip") or x.get("rstrip") or x.get("single_word")]:
        raise ValueError(f"added tokens that depend on what stands around them are not supported: {odd}")
    return tuple(sorted((x["content"] for x in found), key=len, reverse=True))


def pack(sizes: np.ndarray, rest: bytes) -> bytes:
    """Byte strings that stand one after the other, and their sizes, compressed."""
    return squeeze(np.concatenate([[len(sizes)], sizes]).astype("<u4").tobytes() + rest)


def sizes_and_rest(data: bytes) -> tuple[np.ndarray, bytes]:
    data = unsqueeze(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    return np.frombuffer(data, "<u4", n, 4).astype(np.int64), data[4 * (n + 1) :]


def _parted(words: pa.Array) -> tuple[np.ndarray, bytes]:
    """Sizes of strings, none of them null, and their bytes one after the other."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset) if len(words) else np.zeros(1, np.int64)
    return np.diff(ends), words.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if ends[-1] > ends[0] else b""


def _joined(sizes: np.ndarray, rest: bytes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(rest)])


def _hashes(sizes: np.ndarray, rest: bytes) -> np.ndarray:
    """32 bits of each byte string: a sum of its bytes times powers of an odd number, mixed."""
    if not len(sizes):
        return np.zeros(0, np.uint32)
    starts = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x01000193, np.uint32), dtype=np.uint32)
    inside = np.arange(len(rest)) - np.repeat(starts, sizes)
    terms = np.append((np.frombuffer(rest, np.uint8) + np.uint32(1)) * powers[inside], np.uint32(0))
    h = np.add.reduceat(terms, starts, dtype=np.uint32)
    h[sizes == 0] = 0
    for by, times in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> np.uint32(by)) * np.uint32(times)
    return h


def _dealt(sizes: np.ndarray, rest: bytes, parts: int) -> np.ndarray:
    """Where each part begins among words in order of their hashes."""
    part = _hashes(sizes, rest).astype(np.uint64) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _planes(a: np.ndarray) -> bytes:
    """Numbers below 2^32 by significance of their bytes, compressed."""
    return squeeze(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unsqueeze(data), np.uint8).reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def _cut(folder: str, pattern: str, added: tuple[str, ...], place: int, keep: list[int]):
    """Writes blocks; a row to each: its place, and the number of its words."""
    block_bytes = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, out = splitter(pattern), FileWriter(folder)
        kept: list[pa.RecordBatch] = []
        texts: list[pa.Array] = []
        size = 0

        def close():
            nonlocal kept, texts, size
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for x in kept:
                    w.write_batch(x)
            block = cut(pa.concat_arrays(texts), split, added, pattern)
            order = np.argsort(_hashes(*_parted(block.words)), kind="stable")
            place_of = np.empty(len(order), np.int64)
            place_of[order] = np.arange(len(order))
            words = out.add(pack(*_parted(block.words.take(pa.array(order)))))
            table = (np.diff(block.ends, prepend=0), place_of[block.flat])
            rows = out.add(pickle.dumps((sink.getvalue().to_pybytes(), block.n_places.tolist(), *map(_planes, (block.places, *table))), 5))
            row = pa.RecordBatch.from_arrays([pa.array([json.dumps([words, rows])]), pa.array([len(block.words)])], names=["block", "n_words"])
            kept, texts, size = [], [], 0
            return row

        for b in batches:
            columns = b.select(keep) if keep else pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.bool_())], names=["none"])
            long = pc.coalesce(pc.binary_length(b.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
            ends = np.cumsum(long)
            first = 0
            while first < b.num_rows:
                done = int(ends[first - 1]) if first else 0
                stop = min(b.num_rows, 1 + int(np.searchsorted(ends, done + block_bytes - size)))
                kept.append(columns.slice(first, stop - first))
                texts.append(b.column(place).slice(first, stop - first))
                size += int(ends[stop - 1]) - done
                first = stop
                if size >= block_bytes:
                    yield close()
        if texts:
            yield close()
        out.close()

    return run


def _ask(folder: str, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = FileReader(folder, 0)
        for b in batches:
            for block in b.column(0).to_pylist():
                sizes, rest = sizes_and_rest(read.get(*json.loads(block)[0]))
                cuts = _dealt(sizes, rest, parts)
                ends = np.concatenate([[0], np.cumsum(sizes)])[cuts].tolist()
                full = np.flatnonzero(np.diff(cuts)).tolist()
                data = [pack(sizes[cuts[p] : cuts[p + 1]], rest[ends[p] : ends[p + 1]]) for p in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([block] * len(full), pa.string()), pa.array(data, pa.binary())], names=["part", "block", "data"])

    return run


def _answer(library: str, sent, pattern: str):
    """Rows (part, block, words) in order of part: the ids of each block's words. Within a part a word is encoded once, or
    once for so many bytes of words."""
    part_bytes = PART_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = made_once(("coder", library, pattern, zlib.crc32(sent.value)), lambda: word_coder(library, sent.value, pattern))
        blocks: list[str] = []
        words: list[pa.Array] = []
        size, last = 0, None

        def answers() -> Iterator[pa.RecordBatch]:
            each = pa.concat_arrays(words).dictionary_encode()
            ids, n = code(each.dictionary)
            starts, at = np.cumsum(n) - n, each.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum([len(w) for w in words])
            for block, own in zip(blocks, np.split(at, ends[:-1]), strict=True):
                data = pack(4 * n[own], ids[_ranges(starts[own], n[own])].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([last], pa.int32()), pa.array([data], pa.binary())], names=["block", "part", "data"])

        for b in batches:
            for part, block, data in zip(*(b.column(k) for k in range(3)), strict=True):
                if blocks and (part.as_py() != last or size >= part_bytes):
                    yield from answers()
                    blocks, words, size = [], [], 0
                last = part.as_py()
                sizes, rest = sizes_and_rest(data.as_py())
                blocks.append(block.as_py())
                words.append(_joined(sizes, rest))
                size += len(rest)
        if blocks:
            yield from answers()

    return run


def _assemble(folder: str, packed: str | None, names: list[str], ids_folder: str | None):
    """Rows (block, part, ids of words) in order of block: the block's rows with their ids by position, or these ids' places."""

    def rows(block: str, answers: dict[int, bytes], out: FileWriter | None) -> Iterator[pa.RecordBatch]:
        read = FileReader(folder, 0)
        stream, n_places, at, n_words, words = pickle.loads(read.get(*json.loads(block)[1]))
        found = [sizes_and_rest(answers[p]) for p in sorted(answers)]
        sizes = np.concatenate([np.zeros(0, np.int64), *(n for n, _ in found)]) // 4
        starts, flat = np.cumsum(sizes) - sizes, [np.frombuffer(ids, "<u4") for _, ids in found]
        # ids of words, then of pieces, then of rows
        at, n_words, words = _numbers(at), _numbers(n_words), _numbers(words)
        ids_of = (np.concatenate(flat) if flat else np.zeros(0, "<u4"))[_ranges(starts[words], sizes[words])]
        before = np.concatenate([[0], np.cumsum(sizes[words])])
        last = np.cumsum(n_words)
        starts, sizes = before[last - n_words], before[last] - before[last - n_words]
        kept = pa.ipc.open_stream(stream).read_all().combine_chunks()
        columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in kept.columns] if names[:-1] else []
        ends = np.cumsum(n_places)
        first = 0
        while first < len(ends):  # some rows at a time
            done = int(ends[first - 1]) if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, done + (1 << 18), "right")))
            some = at[done : int(ends[stop - 1])]
            n = sizes[some]
            all_ids = ids_of[_ranges(starts[some], n)]
            total = np.concatenate([[0], np.cumsum(n)])
            bounds = total[np.concatenate([[0], ends[first:stop] - done])]
            if out:
                own = [_put(all_ids[a:b].astype(packed)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                name, start, _ = out.add(b"".join(own))
                long = np.array([len(x) for x in own], np.int64)
                coded = pa.array([f"{name}:{a}:{x}" for a, x in zip((start + np.cumsum(long) - long).tolist(), long.tolist(), strict=True)], pa.string())
            elif packed:
                coded = pa.array([all_ids[a:b].astype(packed).tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())
            else:
                coded = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(all_ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(c.slice(first, stop - first) for c in columns), coded], names=names)
            first = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = FileWriter(ids_folder) if ids_folder else None
        last, held = None, {}
        for b in batches:
            for block, part, data in zip(*(b.column(k) for k in range(3)), strict=True):
                if block.as_py() != last:
                    if last is not None:
                        yield from rows(last, held, out)
                    last, held = block.as_py(), {}
                if data.is_valid:
                    held[part.as_py()] = data.as_py()
        if last is not None:
            yield from rows(last, held, out)
        if out:
            out.close()

    return run


def _put(ids: np.ndarray) -> bytes:
    """Ids by significance of their bytes, compressed."""
    return squeeze(np.ascontiguousarray(ids.view(np.uint8).reshape(-1, ids.itemsize).T).tobytes())


def stored_ids(read: FileReader, place: str, packed: str) -> np.ndarray:
    """The ids at a place that ``encode`` gave."""
    name, at, size = place.split(":")
    data = np.frombuffer(unsqueeze(read.get(name, int(at), int(size))), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(packed).itemsize, -1).T).reshape(-1).view(packed)


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", library: str = "tiktoken", packed: str | None = None, keep: list[str] | None = None,
    ids_folder: str | None = None, made: list[str] | None = None,
) -> DataFrame:
    """df with a column of token ids for each whole text, as the library (tiktoken or tokenizers, with a file of its
    own and byte-level BPE by this pattern) would encode it by default, without special tokens that stand for no text.
    The ids are an array of int, or, ``packed``, the bytes of an array of that numpy type, or, with ``ids_folder`` too, the
    place in that folder where ``stored_ids`` finds them: for callers that deal rows anew and need not shuffle ids.

    A null or empty text has no ids; repeated rows are encoded alike; the columns of ``keep`` stay, all by default, one
    called ``ids_col`` is replaced; an empty table gives no rows. A tokenizers file's added tokens are taken out of texts
    whole, as the library does. A text of any length is one row of a block. The vocabulary file is read on the driver and
    sent to the tasks; its size does not depend on the data. Blocks and their list stay in the shared folder for the result;
    their paths are added to ``made``.
    """
    spark = df.sparkSession
    with open(ranks_path, "rb") as f:
        data = f.read()
    sent = spark.sparkContext.broadcast(data)
    names = [c for c in (df.columns if keep is None else keep) if c != ids_col]
    columns = names if text_col in names else [*names, text_col]
    plain = numbered(df.select(*map(col, columns)))
    fields, place = plain.schema.fields[: len(names)], columns.index(text_col)
    schema = T.StructType([*fields]).add("ids", T.StringType() if ids_folder else T.BinaryType() if packed else T.ArrayType(T.IntegerType()))
    folder = scratch(spark, "words")
    blocks, path = materialise(plain.mapInArrow(tidy(_cut(folder, pattern, added_tokens(library, data), place, list(range(len(names))))), "block string, n_words long"), "word-blocks")
    if made is not None:
        made += [folder, path]
    n_blocks, n_words = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(session, 1 + n_words // PART_WORDS)
    asked = blocks.select("block").repartition(max(1, min(n_blocks, session))).mapInArrow(tidy(_ask(folder, parts)), "part int, block string, data binary")
    answered = asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(tidy(_answer(library, sent, pattern)), "block string, part int, data binary")
    said = answered.unionByName(blocks.select("block", F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("data")))
    coded = said.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(_assemble(folder, packed, schema.names, ids_folder)), schema)
    return coded.toDF(*names, ids_col)


class TokenBytes:
    """The token-byte table: what each id stands for."""

    def __init__(self, data: bytes):
        ranks = read_ranks(data)
        self.table: list = [None] * (1 + max(ranks.values()))
        for w, i in ranks.items():
            self.table[i] = w
        self.written = [str(i) for i in range(len(self.table))]

    def join(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """df with a column of the bytes that the ids stand for, joined from the token-byte table.

    The table (as many entries as the vocabulary) is looked up in every task. A null array gives null, an empty one
    no bytes, and an id outside the table is an error; an empty table gives no rows. All columns stay, one called
    ``bytes_col`` is replaced.
    """
    spark = df.sparkSession
    with open(ranks_path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    names = [c for c in df.columns if c != bytes_col]
    place = names.index(ids_col)
    plain = numbered(df.select(*map(col, names)))
    schema = T.StructType([*plain.schema.fields]).add("decoded", T.BinaryType())

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = made_once(("bytes", zlib.crc32(sent.value)), lambda: TokenBytes(sent.value))
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                found = [None if x is None else table.join(x) for x in (x.as_py() for x in part.column(place))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=schema.names)

    return plain.mapInArrow(tidy(look_up), schema).toDF(*names, bytes_col)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by blanks), decoded_sha256 (of the decoded bytes).

    The ids are ``encode``'s, and the bytes are joined from the token-byte table as ``decode`` joins them; both digests
    are taken in one pass over the ids. Null and empty texts, repeated rows, ids of any type and empty tables are handled
    as ``encode`` says; other columns are not read.
    """
    spark = df.sparkSession
    with open(ranks_path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = made_once(("bytes", zlib.crc32(sent.value)), lambda: TokenBytes(sent.value))
        for b in batches:
            n, x, y = [], [], []
            for ids in b.column(1):
                ids = ids.values.to_numpy().tolist()
                n.append(len(ids))
                x.append(hashlib.sha256(" ".join(map(table.written.__getitem__, ids)).encode()).hexdigest())
                y.append(hashlib.sha256(table.join(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    coded = encode(src, ranks_path, pattern, keep=["id"])
    return coded.mapInArrow(tidy(digest), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
