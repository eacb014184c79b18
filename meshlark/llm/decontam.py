"""Benchmark decontamination over a distributed positional inverted index.

Documents are dealt into segments of a bounded number of words. In a segment, words are numbered through, with a gap
between documents, so a posting is one number and no match can cross documents. A segment's file in the shared folder
has its terms with the number of their documents, the sorted postings of each, and the documents. The index holds all
terms of all texts, and any benchmark can be matched against it.

Test items are packed into blocks. A window of an item is looked for in the segments that have its rarest term, counted
over the corpus: lists of its terms, each less its place in the window, are intersected from that term on, for all
windows of a segment at once.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._work import FileReader, FileWriter, col, materialise, remove, scratch, squeeze, tidy, unsqueeze

#: Bytes that make words, after A-Z are lower-cased; all other bytes part words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WINDOW = 13
#: Words and documents to a segment, words of items to a block, and candidates tested at once. They set how work is cut, not results.
SEGMENT_WORDS, SEGMENT_DOCS, BLOCK_WORDS, CANDIDATES = 1 << 20, 1 << 14, 500_000, 1 << 20


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class _Numbers(dict):
    """Terms by number, in order of appearance."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


@dataclass(frozen=True, eq=False)
class Index:
    """segments: a row (segment, n_docs, n_words) for each segment; their files are in folder; id_type is the ids' type."""

    segments: DataFrame
    folder: str
    id_type: object


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all terms of all rows; reads each text once and shuffles nothing.

    A null or empty text is a document without words; ids are of any type, null ones are kept; repeated rows are
    documents of their own; a text of any length is in one segment; other columns are not read. An empty table gives an
    empty index.
    """
    folder = scratch(df.sparkSession, "index")
    segment_words, segment_docs = SEGMENT_WORDS, SEGMENT_DOCS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = FileWriter(folder), _Numbers()
        ids: list = []
        codes: list[np.ndarray] = []
        held = 0

        def close():
            nonlocal ids, codes, held
            n = np.array([len(c) for c in codes], np.int64)
            flat = np.concatenate(codes)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.argsort(flat, kind="stable")
            counts = np.bincount(flat, minlength=len(number))
            starts = np.cumsum(counts) - counts
            places, own = (np.arange(len(flat)) + doc)[order], doc[order]
            first = np.ones(len(flat), bool)
            first[1:] = own[1:] != own[:-1]
            first[starts[counts > 0]] = True
            gaps = np.diff(places, prepend=0)
            gaps[starts[counts > 0]] = places[starts[counts > 0]]
            n_docs = np.bincount(flat[order][first], minlength=len(number))
            at = [out.add(squeeze(b"\n".join(number))), out.add(_packed(n_docs)), out.add(_packed(counts) + _packed(gaps)), out.add(pickle.dumps((pa.array([i.as_py() for i in ids], ids[0].type), n), 5))]
            row = pa.RecordBatch.from_arrays([pa.array([json.dumps(at)]), pa.array([len(n)]), pa.array([len(flat)])], names=["segment", "n_docs", "n_words"])
            ids, codes, held = [], [], 0
            number.clear()
            return row

        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                w = words(t.as_py())
                ids.append(i)
                codes.append(np.fromiter(map(number.__getitem__, w), np.uint32, len(w)))
                held += len(w)
                if held >= segment_words or len(ids) >= segment_docs:
                    yield close()
        if ids:
            yield close()
        out.close()

    src = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    segments, _ = materialise(src.mapInArrow(tidy(build), "segment string, n_docs long, n_words long"), "segments")
    return Index(segments, folder, src.schema["id"].dataType)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 by significance of their bytes, compressed, behind the length of that."""
    data = squeeze(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())
    return len(data).to_bytes(8, "little") + data


def _unpacked(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n = int.from_bytes(data[at : at + 8], "little")
    planes = np.frombuffer(unsqueeze(data[at + 8 : at + 8 + n]), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64), at + 8 + n


class _Segment:
    """A segment's file; postings are read when a term is asked for."""

    def __init__(self, read: FileReader, segment: str):
        self.read, (self._terms, self._n_docs, self._postings, self._docs) = read, json.loads(segment)
        self.terms = unsqueeze(read.get(*self._terms)).split(b"\n")
        if self.terms == [b""]:
            self.terms = []

    def document_counts(self) -> np.ndarray:
        return _unpacked(self.read.get(*self._n_docs))[0]

    def documents(self) -> tuple[pa.Array, np.ndarray]:
        return pickle.loads(self.read.get(*self._docs))

    def postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of some terms one after the other, and their lengths."""
        data = self.read.get(*self._postings)
        counts, at = _unpacked(data)
        gaps, _ = _unpacked(data, at)
        ends = np.cumsum(counts)
        n = counts[terms]
        pick = np.repeat(ends[terms] - n - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        summed = np.cumsum(gaps[pick])
        begin = np.cumsum(n) - n
        return summed - np.repeat(summed[begin] - gaps[pick][begin], n), n


# test items ------------------------------------------------------------------------------------------------------

def _pack_items(folder: str):
    block_words = BLOCK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = FileWriter(folder), _Numbers()
        ids: list = []
        codes: list[np.ndarray] = []
        held = 0

        def close():
            nonlocal ids, codes, held
            row = pa.RecordBatch.from_arrays([pa.array([json.dumps(out.add(pickle.dumps((list(number), ids, codes), 5)))])], names=["block"])
            ids, codes, held = [], [], 0
            number.clear()
            return row

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words(t.as_py())
                if not w:
                    continue
                if held + len(w) > block_words and ids:
                    yield close()
                ids.append(i)
                codes.append(np.fromiter(map(number.__getitem__, w), np.int64, len(w)))
                held += len(w)
        if ids:
            yield close()
        out.close()

    return run


def _count_documents(folder: str, items: str):
    """Rows (segment, blocks): of each block's terms the documents of the segment that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, asked = FileReader(folder, 0), FileReader(items)
        for b in batches:
            for segment, blocks in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
                s = _Segment(read, segment)
                n_docs = s.document_counts()
                where = {t: k for k, t in enumerate(s.terms)}
                for block in blocks:
                    terms = pickle.loads(asked.get(*json.loads(block)))[0]
                    found = [(c, where[t]) for c, t in enumerate(terms) if t in where]
                    at = n_docs[[k for _, k in found]]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(found), pa.string()), pa.array([c for c, _ in found], pa.int64()), pa.array(at, pa.int64())], names=["block", "term", "n"])

    return run


def _prepare(folder: str, window: int):
    """Rows (block, term, n) in order of block: the block's different windows by their rarest terms, in a file."""

    def windows(block: str, counts: dict[int, int], read: FileReader) -> bytes:
        terms, ids, codes = pickle.loads(read.get(*json.loads(block)))
        n = np.array([counts.get(c, 0) for c in range(len(terms))], np.int64)
        rank = np.empty(len(terms), np.int64)
        rank[sorted(range(len(terms)), key=lambda c: (n[c], terms[c]))] = np.arange(len(terms))
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, c in enumerate(codes):
            size = min(window, len(c))
            w = np.lib.stride_tricks.sliding_window_view(c, size)
            w = w[(n[w] > 0).all(axis=1)]
            if len(w):
                by_length.setdefault(size, []).append((w, np.full(len(w), item)))
        groups = []
        for size, found in sorted(by_length.items()):
            w, which = np.unique(np.concatenate([x for x, _ in found]), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.reshape(-1), np.concatenate([x for _, x in found])], axis=1), axis=0)
            order = np.argsort(rank[w], axis=1, kind="stable")
            rarest = w[np.arange(len(w)), order[:, 0]]
            by_term = np.argsort(rarest, kind="stable")
            place = np.empty(len(w), np.int64)
            place[by_term] = np.arange(len(w))
            owner = place[pairs[:, 0]]
            sort = np.argsort(owner, kind="stable")
            groups.append((size, w[by_term].astype(np.int32), order[by_term].astype(np.int16), rarest[by_term], np.searchsorted(owner[sort], np.arange(len(w) + 1)), pairs[sort, 1]))
        return pickle.dumps((terms, ids, groups), 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, out = FileReader(folder, 0), FileWriter(folder)
        last, counts = None, {}

        def done():
            return pa.RecordBatch.from_arrays([pa.array([json.dumps(out.add(windows(last, counts, read)))])], names=["block"])

        for b in batches:
            for block, term, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if block != last:
                    if last is not None:
                        yield done()
                    last, counts = block, {}
                counts[term] = n
        if last is not None:
            yield done()
        out.close()

    return run


# search ----------------------------------------------------------------------------------------------------------

def _chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to ``most`` or are one."""
    ends = np.cumsum(sizes)
    k = 0
    while k < len(sizes):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + most, "right")))
        yield slice(k, stop)
        k = stop


def match_segment(lists: tuple[np.ndarray, np.ndarray], local: np.ndarray, group: tuple, starts: np.ndarray, lengths: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(windows, first places) of exact matches, and (windows, documents) of proximity matches. local: a block's terms by
    their lists in the segment, -1 for none."""
    size, terms, order, rarest, *_ = group
    places, n = lists
    ends = np.cumsum(n)
    keys = np.repeat(np.arange(len(n)) << 32, n) + places
    live = np.flatnonzero(local[rarest] >= 0)
    live = live[(local[terms[live]] >= 0).all(axis=1)]
    exact: list[tuple] = []
    close: list[tuple] = []
    for some in _chunks(n[local[rarest[live]]], CANDIDATES):
        w = live[some]
        a = local[rarest[w]]
        m = n[a]
        anchor = places[np.repeat(ends[a] - m - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
        w = np.repeat(w, m)
        first, at = anchor - order[w, 0], w
        for k in range(1, size):
            place = order[at, k]
            key = (local[terms[at, place]] << 32) + first + place
            found = np.searchsorted(keys, key)
            ok = keys[np.minimum(found, len(keys) - 1)] == key
            ok &= first + place >= 0
            first, at = first[ok], at[ok]
        exact.append((at, first))
        doc = np.searchsorted(starts, anchor, "right") - 1
        low, high = np.maximum(anchor - near, starts[doc]), np.minimum(anchor + near, starts[doc] + lengths[doc] - 1)
        for k in range(1, size):
            t = local[terms[w, order[w, k]]] << 32
            ok = np.searchsorted(keys, t + high, "right") > np.searchsorted(keys, t + low, "left")
            w, doc, low, high = w[ok], doc[ok], low[ok], high[ok]
        close.append((w, doc))
    both = [np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for found in (exact, close) for k in (0, 1)]
    return both[0], both[1], both[2], both[3]


def _search(folder: str, items: str, near: int, id_type: pa.DataType, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, asked = FileReader(folder, 0), FileReader(items, 128 << 20)
        loaded: dict[str, tuple] = {}

        def block_of(name: str) -> tuple:
            if name not in loaded:
                loaded.clear()
                terms, ids, groups = pickle.loads(asked.get(*json.loads(name)))
                loaded[name] = {t: c for c, t in enumerate(terms)}, ids, groups
            return loaded[name]

        def owners(group: tuple, found: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int]]:
            """Different (document, item) pairs of (window, document) pairs."""
            begin, item = group[4], group[5]
            pairs = np.unique(np.stack([found, docs], axis=1), axis=0)
            n = begin[pairs[:, 0] + 1] - begin[pairs[:, 0]]
            which = item[np.repeat(begin[pairs[:, 0]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            yield from map(tuple, np.unique(np.stack([np.repeat(pairs[:, 1], n), which], axis=1), axis=0).tolist())

        for b in batches:
            for segment, blocks in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
                s = _Segment(read, segment)
                ids, lengths = s.documents()
                starts = np.cumsum(lengths + 1) - (lengths + 1)
                opened = np.zeros(int(lengths.sum()) + len(lengths) + 1, np.int32)
                exact: list[dict] = [{} for _ in range(len(lengths))]
                close: list[dict] = [{} for _ in range(len(lengths))]
                for block in blocks:
                    wanted, item_ids, groups = block_of(block)
                    there = [(k, c) for k, t in enumerate(s.terms) if (c := wanted.get(t)) is not None]
                    if not there:
                        continue
                    lists = s.postings(np.array([k for k, _ in there]))
                    local = np.full(len(wanted), -1, np.int64)
                    local[[c for _, c in there]] = np.arange(len(there))
                    for g in groups:
                        w, first, w_near, d_near = match_segment(lists, local, g, starts, lengths, near)
                        np.add.at(opened, first, 1)
                        np.add.at(opened, first + g[0], -1)
                        for d, x in owners(g, w, np.searchsorted(starts, first, "right") - 1):
                            exact[d][item_ids[x]] = None
                        for d, x in owners(g, w_near, d_near):
                            close[d][item_ids[x]] = None
                edges = np.flatnonzero(np.diff((np.cumsum(opened) > 0).astype(np.int8), prepend=0))
                begin, end = edges[::2], edges[1::2]
                of = np.searchsorted(starts, begin, "right") - 1
                spans: list[list] = [[] for _ in range(len(lengths))]
                for d, x, y in zip(of.tolist(), begin.tolist(), end.tolist(), strict=True):
                    spans[d].append({"start": x - int(starts[d]), "end": y - int(starts[d])})
                for k in range(0, len(lengths), 2048):
                    part = slice(k, k + 2048)
                    yield pa.RecordBatch.from_arrays(
                        [ids[part], pa.array(lengths[part], pa.int64()), pa.array(spans[part], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), *[pa.array([list(x) for x in found[part]], pa.list_(item_type)) for found in (exact, close)]],
                        names=["doc_id", "n_words", "spans", "item_ids", "near_item_ids"],
                    )

    return run


def matches(index: Index, items: DataFrame, item_id: str = "item_id", text_col: str = "text", window: int = WINDOW, near: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, spans (start and end of the words that exact matches cover, where they overlap or
    touch as one), item_ids (of items with a window that occurs in the document) and near_item_ids (of items with a window
    all of whose terms lie, in any order, at most ``near`` words, two windows by default, from one place of its rarest).

    An item's windows are its runs of ``window`` words, or its whole if it has fewer; items without words match nothing;
    an item that repeats counts by its id, which may be of any type, null included. A window's rarest term is that of the
    fewest documents, of these the first in order of bytes. Documents without words, and without matches, come too.

    Items are packed into blocks on the executors, and a segment's task goes through the blocks one after the other.
    """
    spark = items.sparkSession
    folder = scratch(spark, "items")
    src = items.select(col(item_id).alias("id"), col(text_col).cast("string").alias("text"))
    item_type = src.schema["id"].dataType
    packed, packed_path = materialise(src.mapInArrow(tidy(_pack_items(folder)), "block string"), "item-blocks")
    names = [r["block"] for r in packed.collect()]  # places of files of BLOCK_WORDS words each
    segments = index.segments.select("segment", F.array(*[F.lit(x) for x in names]).cast("array<string>").alias("blocks"))
    n = max(1, min(index.segments.count(), 100_000))
    counted = segments.repartition(n).mapInArrow(tidy(_count_documents(index.folder, folder)), "block string, term long, n long").groupBy("block", "term").agg(F.sum("n").alias("n"))
    counted = counted.unionByName(packed.select("block", F.lit(-1).cast("long").alias("term"), F.lit(0).cast("long").alias("n")))
    prepared, path = materialise(counted.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(_prepare(folder, window)), "block string"), "item-windows")
    names = [r["block"] for r in prepared.collect()]
    remove(spark, packed_path, path)
    segments = index.segments.select("segment", F.array(*[F.lit(x) for x in names]).cast("array<string>").alias("blocks"))
    kinds = [x.simpleString() for x in (index.id_type, item_type)]
    run = _search(index.folder, folder, 2 * window if near is None else near, to_arrow_type(index.id_type), to_arrow_type(item_type))
    return segments.repartition(n).mapInArrow(tidy(run), f"doc_id {kinds[0]}, n_words long, spans array<struct<start:long,end:long>>, item_ids array<{kinds[1]}>, near_item_ids array<{kinds[1]}>")


def decontaminate(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, percent: int = 5,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids, near_item_ids, contaminated, spans.

    A document word inside any occurrence of an item's window is hit; a document is contaminated when it has hits and
    they are at least ``percent`` per cent of its words. Null and empty texts have no words and are clean; items
    without words match nothing; no items or no documents give no hits or rows; ids, texts and repeated rows are as
    ``build_index`` and ``matches`` say.
    """
    found = matches(build_index(docs, id_col, text_col), items, item_id, item_text, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", "near_item_ids", "spans")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent))


def items_digest(column: str = "item_ids"):
    """SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(F.col(column), lambda i: i.cast("string"))), ","), 256)
