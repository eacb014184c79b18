"""Toxicity by two Kneser-Ney language models, of toxic and of ordinary documents.

Both classes have interpolated bigram models whose lowest level is the same: word counts of the whole corpus,
labelled or not. So an expression that neither class has seen enough of is judged by shared counts, and moves
the comparison little. A document's words get log-likelihoods under both models; the differences, normalised
by length over the whole text and over its most toxic stretches, give the score.

Counts are kept by word (56-bit hashes) and by word pair (64-bit hashes), as many as the corpus has, and never gathered in one place.
Documents are numbered in blocks, whose files stay in the shared folder. Each block asks for its distinct pairs, and
then for its distinct words, in parts by hash; a part sums what all blocks sent and answers each of them. All rows and
pairs count, none is sampled; only the last step, a regression of the label on four numbers, takes a bounded number
of labelled rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._work import col, materialise, open_fs, remove, scratch, small_side, squeeze, tidy, unsqueeze

#: Words to a block, and pairs or words asked for to a part: what a task holds. They set how work is cut, not results.
BLOCK_WORDS, PART_KEYS = 2_000_000, 1_000_000
#: Pairs are counted by ranges of their hash, one range after the other, so that requests for one of them are on disk at a time.
ROUNDS = 3
#: Words to a stretch, for the features besides the whole text.
STRETCHES = (1, 4)
TOP_WORDS = 3
FEATURES = 2 + len(STRETCHES)
#: What is taken off a continuation count. A rare word's one to three neighbours in a class say nothing of toxicity: they go to the shared counts in full.
DISCOUNT = 3.0
#: Labelled rows at most that the regression is fitted on.
FIT_ROWS = 20_000
THRESHOLD = 0.3

_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 or c == 39 else 32 for c in range(256))
#: Counts of a word: in all texts, then by class as a word before another, of different words after it, and before it.
WORD_COUNTS = 7
_ASKED, _ANSWERED = "part int, block string, data binary", "block string, part int, data binary, totals array<double>"


class _Index(dict):
    """Words by number, in order of appearance; the start of a text is number 0."""

    def __init__(self):
        self[b""] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """The numbers of a text's words: runs of letters, in lower case."""
    words = (text or "").lower().encode().translate(_TABLE).split()
    return np.fromiter(map(known.__getitem__, words), np.uint32, len(words))


def word_hash(word: bytes) -> int:
    """56 bits of a hash, above a byte of zeros."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=7).digest(), "little") << 8


def pair_hashes(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of word hashes, order being told apart."""
    x = v * np.uint64(0x9E3779B97F4A7C15) + w
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(29)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4: fold 2 is held out, fold 3 fits the regression, 0 and 1 make the models."""
    return F.pmod(F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def _planes(a: np.ndarray) -> bytes:
    """Bytes of numbers by significance, so that leading zeros lie together and compress."""
    return np.ascontiguousarray(a.reshape(-1).view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def _numbers(data: bytes, kind: str, columns: int = 1) -> np.ndarray:
    size = np.dtype(kind).itemsize
    a = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)
    return a.reshape(-1, columns) if columns > 1 else a


class Block:
    """Documents of a block with their words by number, and its distinct pairs in order."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        with fs.open_input_stream(path) as f:
            self.ids, self.folds, self.toxic, self.sizes, words, hashes = pickle.loads(f.read())
        self.hashes = _numbers(unsqueeze(hashes), "<u8")
        self.w = _numbers(unsqueeze(words), "<u4").astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        v = np.concatenate([[0], self.w[:-1]]) if len(self.w) else self.w
        v[self.starts[self.sizes > 0]] = 0
        self.pairs, self.at = np.unique(v * len(self.hashes) + self.w, return_inverse=True)
        self.v_of, self.w_of = np.divmod(self.pairs, len(self.hashes))
        self.keys = pair_hashes(self.hashes[self.v_of], self.hashes[self.w_of])

    def by_class(self) -> np.ndarray:
        """Counts of the pairs in ordinary and in toxic documents of folds 0 and 1."""
        label = np.array([-1 if t is None or f > 1 else int(t > 0) for t, f in zip(self.toxic, self.folds, strict=True)], np.int8)
        label = np.repeat(label, self.sizes)
        return np.column_stack([np.bincount(self.at[label == c], minlength=len(self.pairs)) for c in (0, 1)]).astype("<i8")


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys in order, and where each part, a range of them, begins."""
    order = np.argsort(keys)
    part = (keys[order] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return order, np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _ask(block: str, keys: np.ndarray, counts: np.ndarray, parts: int, some: range | None = None) -> Iterator[pa.RecordBatch]:
    order, cuts = _by_part(keys, parts)
    for p in some or range(parts):
        own = order[cuts[p] : cuts[p + 1]]
        if len(own):
            gaps = np.diff(keys[own], prepend=np.uint64(0))
            data = pickle.dumps((squeeze(_planes(gaps)), squeeze(_planes(counts[own]))), 5)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([block]), pa.array([data], pa.binary())], names=["part", "block", "data"])


def _answer(columns: int, owners: bool, totals):
    """Sums what blocks sent of a part's keys, and answers each block; ``owners``: a further column is 1 at one of the
    blocks that have a key. Rows come in order of part. The first answer of a part has ``totals`` of its sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(part, blocks, keys, counts):
            cuts = np.cumsum([0, *map(len, keys)])
            found, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            counts = np.concatenate(counts)
            sums = np.column_stack([np.bincount(at, counts[:, k], len(found)) for k in range(columns)]).astype("<i8")
            own = np.zeros(len(at), "<i8")
            own[first] = 1
            for k, b in enumerate(blocks):
                x = sums[at[cuts[k] : cuts[k + 1]]]
                if owners:
                    x = np.column_stack([x, own[cuts[k] : cuts[k + 1]]])
                said = totals(found, sums) if k == 0 else None
                yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([part], pa.int32()), pa.array([squeeze(_planes(x))], pa.binary()), pa.array([said], pa.list_(pa.float64()))], names=["block", "part", "data", "totals"])

        last, held = None, ([], [], [])
        for b in batches:
            for part, block, data in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if part != last and held[0]:
                    yield from close(last, *held)
                    held = ([], [], [])
                last = part
                gaps, counts = pickle.loads(data)
                held[0].append(block)
                held[1].append(np.cumsum(_numbers(unsqueeze(gaps), "<u8"), dtype=np.uint64))
                held[2].append(_numbers(unsqueeze(counts), "<i8", columns))
        if held[0]:
            yield from close(last, *held)

    return run


def _pair_totals(found: np.ndarray, sums: np.ndarray) -> list[float]:
    """Pairs seen once and twice, by class."""
    return [float((sums[:, c] == n).sum()) for c in (0, 1) for n in (1, 2)]


def _word_totals(found: np.ndarray, sums: np.ndarray) -> list[float]:
    """Different words, and words; by class, continuation counts and what DISCOUNT takes of them."""
    kinds = sums[:, 5:7]
    return [float((found != word_hash(b"")).sum()), float(sums[:, 0].sum()), *map(float, kinds.sum(axis=0)), *map(float, np.minimum(kinds, DISCOUNT).sum(axis=0))]


def _summed(answers: DataFrame, size: int) -> list[float]:
    r = answers.where("totals is not null").agg(*[F.coalesce(F.sum(F.get("totals", F.lit(k))), F.lit(0.0)) for k in range(size)]).first()
    return list(r)


def _gathered(keys: np.ndarray, parts: int, rows: list[tuple[int, bytes]], columns: int) -> np.ndarray:
    """A block's answers in order of its keys."""
    out = np.zeros((len(keys), columns), np.int64)
    order, cuts = _by_part(keys, parts)
    for p, data in rows:
        out[order[cuts[p] : cuts[p + 1]]] = _numbers(unsqueeze(data), "<i8", columns)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[int, list[tuple[int, bytes]]]]]:
    """Block, and its answers by kind; rows (block, kind, part, data) come in order of block."""
    last, held = None, {}
    for b in batches:
        for block, kind, part, data in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if block != last:
                if last is not None:
                    yield last, held
                last, held = block, {0: [], 1: []}
            if data is not None:
                held[kind].append((part, data))
    if last is not None:
        yield last, held


def _features(block: Block, pair_n: np.ndarray, words: np.ndarray, discount: list[float], totals: list[float]) -> Iterator[list[float]]:
    """Per document: mean difference over the text under the whole models; then, under their continuation level, which
    copies of a document do not raise (they bring no new neighbours), over the highest stretch of each length and over
    the TOP_WORDS different words of the highest."""
    base = (words[:, 0] + 1.0) / (totals[1] + totals[0])
    word, logs = [], []
    for c in (0, 1):
        kinds, n = words[:, 5 + c], words[:, 1 + c]
        total = max(totals[2 + c], 1.0)
        left = totals[4 + c] / total if totals[2 + c] else 1.0
        word.append(np.maximum(kinds - DISCOUNT, 0) / total + left * base)
        back = np.where(n > 0, discount[c] * words[:, 3 + c] / np.maximum(n, 1), 1.0)
        seen = np.maximum(pair_n[:, c] - discount[c], 0) / np.maximum(n, 1)[block.v_of]
        logs.append(np.log(seen + back[block.v_of] * word[c][block.w_of]))
    ratios = np.concatenate([[0.0], np.cumsum((logs[1] - logs[0])[block.at])])
    low = np.log(word[1]) - np.log(word[0])
    for start, size in zip(block.starts.tolist(), block.sizes.tolist(), strict=True):
        if not size:
            yield [0.0] * FEATURES
            continue
        w = block.w[start : start + size]
        sums = np.concatenate([[0.0], np.cumsum(low[w])])
        out = [float((ratios[start + size] - ratios[start]) / size)]
        for n in STRETCHES:
            n = min(n, size)
            out.append(float((sums[n:] - sums[:-n]).max() / n))
        each = low[np.unique(w)]
        top = np.partition(each, len(each) - TOP_WORDS)[-TOP_WORDS:] if len(each) > TOP_WORDS else each
        yield [*out, float(top.sum() / TOP_WORDS)]


def measure(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: id, fold, toxic (its label, if any, in folds 0, 1 and 3) and f, its features under the models of folds 0 and 1."""
    spark = docs.sparkSession
    block_words, part_keys = BLOCK_WORDS, PART_KEYS
    marked = labels.where(col(label_col).isNotNull() & col(id_col).isNotNull() & (fold(id_col) != 2)).groupBy(col(id_col).alias("id")).agg(F.max(col(label_col).cast("int")).alias("toxic"))
    marked, _ = materialise(marked, "labels")
    src = docs.select(col(id_col).alias("id"), fold(id_col).alias("fold"), col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    src = src.join(small_side(marked, marked.count()), "id", "left").select("id", "fold", "toxic", "text")
    root = scratch(spark, "blocks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        def close():
            ids, folds, toxic, words = zip(*held, strict=True)
            sizes = np.array([len(w) for w in words], np.int64)
            hashes = np.fromiter(map(word_hash, known), np.uint64, len(known))
            data = pickle.dumps((pa.array([x.as_py() for x in ids], ids[0].type), folds, toxic, sizes, squeeze(_planes(np.concatenate(words).astype("<u4"))), squeeze(_planes(hashes))), 5)
            uri = f"{root}/{uuid.uuid4().hex}"
            fs, path = open_fs(uri)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(path) as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([int(sizes.sum())]), pa.array([len(known)])], names=["block", "n_words", "n_known"])

        known, held, size = _Index(), [], 0
        for b in batches:
            for i, f, x, t in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                held.append((i, f, x, word_numbers(t.as_py(), known)))
                size += len(held[-1][3]) + 1
                if size > block_words:
                    yield close()
                    known, held, size = _Index(), [], 0
        if held:
            yield close()

    blocks, _ = materialise(src.mapInArrow(tidy(cut), "block string, n_words long, n_known long"), "block-list")
    n, n_words, n_known = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_known"), F.lit(0))).first()
    n, pair_parts, word_parts = max(1, n), 1 + n_words // part_keys, 1 + n_known // part_keys

    def ask_pairs(some: range):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for uri in b.column(0).to_pylist():
                    block = Block(uri)
                    yield from _ask(uri, block.keys, block.by_class(), pair_parts, some)

        return run

    rounds = min(ROUNDS, pair_parts)
    tables, temporary = [], [root]
    for k in range(rounds):
        some = range(k * pair_parts // rounds, (k + 1) * pair_parts // rounds)
        asked = blocks.select("block").repartition(n).mapInArrow(tidy(ask_pairs(some)), _ASKED).repartition(len(some), "part").sortWithinPartitions("part", "block")
        table, path = materialise(asked.mapInArrow(tidy(_answer(2, True, _pair_totals)), _ANSWERED), "pairs")
        tables.append(table)
        temporary.append(path)
    pairs = reduce(DataFrame.unionByName, tables)
    seen = _summed(pairs, 4)
    discount = [d if 0 < (d := seen[2 * c] / max(1, seen[2 * c] + 2 * seen[2 * c + 1])) < 1 else 0.75 for c in (0, 1)]

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, held in _groups(batches):
            block = Block(uri)
            size, own = len(block.hashes), block.by_class()
            got = _gathered(block.keys, pair_parts, held[0], 3)
            count = lambda at, x: np.bincount(at, x, size)
            new = [(got[:, 2] == 1) & (got[:, c] > 0) for c in (0, 1)]
            columns = [np.bincount(block.w, minlength=size), *[count(block.v_of, own[:, c]) for c in (0, 1)], *[count(block.v_of, x) for x in new], *[count(block.w_of, x) for x in new]]
            yield from _ask(uri, block.hashes, np.column_stack(columns).astype("<i8"), word_parts)

    said = pairs.select("block", F.lit(0).alias("kind"), "part", "data")
    asked = said.repartition(n, "block").sortWithinPartitions("block").mapInArrow(tidy(ask_words), _ASKED).repartition(word_parts, "part").sortWithinPartitions("part", "block")
    words, path = materialise(asked.mapInArrow(tidy(_answer(WORD_COUNTS, False, _word_totals)), _ANSWERED), "words")
    temporary.append(path)
    totals = _summed(words, 6)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, held in _groups(batches):
            block = Block(uri)
            got = _gathered(block.keys, pair_parts, held[0], 3)
            f = list(_features(block, got, _gathered(block.hashes, word_parts, held[1], WORD_COUNTS), discount, totals))
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(block.folds, pa.int64()), pa.array(block.toxic, pa.int32()), pa.array(f, pa.list_(pa.float64()))], names=["id", "fold", "toxic", "f"])

    said = said.unionByName(words.select("block", F.lit(1).alias("kind"), "part", "data"))
    said = said.unionByName(blocks.select("block", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("data")))
    weighed = said.repartition(n, "block").sortWithinPartitions("block").mapInArrow(tidy(weigh), f"id {kind}, fold long, toxic int, f array<double>")
    out = materialise(weighed, "toxicity")[0]
    remove(spark, *temporary)
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method: weights (last: constant), and the means and scales of the features."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    if not len(x):
        return w, mean, scale
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (y - p) - ridge * w
        h = (z * (p * (1 - p))[:, None]).T @ z + (ridge + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w, mean, scale


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    Labels are read by id from folds 0, 1 and 3 only; what else the tables have is no input. Null and empty texts have
    no words and get the score of a text without evidence; a null id is in some fold and never labelled; a document
    that is labelled twice is toxic if either says so; documents that repeat count and are scored each. Without any
    labels all scores are one half. An empty table gives no rows.
    """
    measured = measure(docs, labels, id_col, text_col, label_col)
    some = measured.where("fold = 3 and toxic is not null").select("f", "toxic", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(FIT_ROWS).collect()
    x = np.array([r["f"] for r in some]).reshape(-1, FEATURES)
    w, mean, scale = fit(x, np.array([float(r["toxic"] > 0) for r in some]))
    z = F.lit(float(w[-1]))
    for k in range(len(mean)):
        z = z + F.lit(float(w[k] / scale[k])) * (F.get("f", F.lit(k)) - F.lit(float(mean[k])))
    out = measured.select(F.col("id").alias("doc_id"), (F.col("fold") == 2).alias("held_out"), (1 / (1 + F.exp(-z))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
