"""Hard negatives by dual-tree search for largest inner products.

A coarse tree, fitted on a bounded sample, deals all rows to cells of near vectors; cells are cut into blocks, and each
block has a ball tree of its own. Anchors are grouped in the same way. For two nodes, balls around a and c of radius r and
s, all inner products lie in a.c +- (r|c| + s|a| + rs). A group of anchors meets a block of candidates only if that
interval can hold something better than what the group's anchors have already, node pairs within are ruled out alike, and
leaf pairs are scored exactly, in whole numbers. The sample decides only which rows are near each other: nothing is
approximate.

Blocks and groups are files in the shared folder. Rows that are dealt are places: one for each group and each slice of the
blocks, so that a group's search runs in several tasks where groups are few. A task that is lost is run again alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._work import FileReader, FileWriter, col, materialise, remove, scratch, small_side, tidy

#: Rows to a block and to a leaf; anchors to a group and to a leaf.
BLOCK, LEAF, GROUP, ANCHOR_LEAF = 4096, 256, 256, 32
#: Rows and bytes on which the coarse tree is fitted at most, and its cells at most.
SAMPLE_ROWS, SAMPLE_BYTES, CELLS = 16_384, 16 << 20, 1024
#: Blocks of a slice at most; slices are made for so many tasks a core, as far as blocks go.
SLICE, TASKS = 1024, 4
#: No score reaches this: the squared length of a vector in whole numbers must be below it.
FAR = 1 << 62

_PLACE = "file string, at long, size long"


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers, one vector a row."""
    q = np.floor(scale * np.asarray(x, np.float64))
    if q.size and float((q * q).sum(axis=1).max()) >= FAR:
        raise ArithmeticError("a vector's squared length does not fit a long")
    return q.astype("<i4")


def _far_direction(x: np.ndarray) -> np.ndarray:
    """From one far point of x to one far from that."""
    a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
    b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
    return b - a


def coarse_tree(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and thresholds of a balanced tree of so many levels, as a heap."""
    dirs, cuts = np.zeros(((1 << levels) - 1, sample.shape[1])), np.zeros((1 << levels) - 1)
    parts = {0: sample}
    for node in range((1 << levels) - 1):
        x = parts.pop(node)
        if len(x):
            dirs[node] = _far_direction(x)
            along = x @ dirs[node]
            cuts[node] = np.median(along)
            parts[2 * node + 1], parts[2 * node + 2] = x[along <= cuts[node]], x[along > cuts[node]]
        else:
            parts[2 * node + 1] = parts[2 * node + 2] = x
    return dirs, cuts


def cell_of(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Leaf, from 0 on in order, that each row of x belongs to."""
    dirs, cuts = tree
    node = np.zeros(len(x), np.int64)
    for _ in range((len(cuts) + 1).bit_length() - 1):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", x, dirs[node]) > cuts[node])
    return node - len(cuts)


def _place(scale: int, tree, dim: int):
    """Rows (id, label, anchor, vec) as (id, label, anchor, cell, q); vectors of another length have a cell to each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column(3)
            sizes = np.array([len(v) for v in vecs], np.int64)
            flat = vecs.flatten().to_numpy(zero_copy_only=False)
            at = np.cumsum(sizes) - sizes
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                for k in range(0, len(rows), 2048):
                    some = rows[k : k + 2048]
                    q = quantise(flat[at[some][:, None] + np.arange(d)], scale)
                    cell = cell_of(q.astype(np.float64), tree) if tree is not None and d == dim else np.full(len(some), -1 - d)
                    kept = b.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*kept.columns[:3], pa.array(cell), pa.array([r.tobytes() for r in q], pa.binary())], names=["id", "label", "anchor", "cell", "q"])

    return run


class Tree:
    """Rows in an order in which each node's are together, by id in leaves, with the balls of all nodes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, leaf: int):
        order, x = np.arange(len(ids)), q.astype(np.float64)
        lo, hi, child, center, radius = [0], [len(ids)], [], [], []
        for node in range(2 * len(ids) + 1):
            if node == len(lo):
                break
            own = order[lo[node] : hi[node]]
            mean = x[own].mean(axis=0)
            center.append(mean)
            radius.append(np.sqrt(((x[own] - mean) ** 2).sum(axis=1).max()))
            if len(own) <= leaf or radius[-1] == 0:
                child.append(-1)
                order[lo[node] : hi[node]] = own[np.argsort(ids[own], kind="stable")]
                continue
            child.append(len(lo))
            order[lo[node] : hi[node]] = own = own[np.argsort(x[own] @ _far_direction(x[own]), kind="stable")]
            mid = (lo[node] + hi[node]) // 2
            lo += lo[node], mid
            hi += mid, hi[node]
        self.lo, self.hi, self.child, self.center, self.radius = np.array(lo), np.array(hi), np.array(child), np.array(center), np.array(radius)
        self.length = np.sqrt((self.center**2).sum(axis=1))
        self.ids, self.labels, self.q = ids[order], labels[order], q[order]
        self.low, self.high = (np.array([f(self.labels[a:b]) for a, b in zip(lo, hi, strict=True)]) for f in (np.min, np.max))
        self.longest = float(np.sqrt((x**2).sum(axis=1).max()))

    def dump(self) -> bytes:
        return pickle.dumps(vars(self), 5)

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        vars(tree).update(pickle.loads(data))
        return tree

    def top(self) -> tuple:
        return self.center[0], self.radius[0], self.length[0], self.longest


def intervals(a, r, la, c, s, lc) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of balls around rows of a with balls around rows of c, never too narrow."""
    middle = a @ c.T
    width = r[:, None] * lc + la[:, None] * s + r[:, None] * s
    width += 1 + 1e-9 * (la + r)[:, None] * (lc + s)
    return middle - width, middle + width


def scores(a: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of whole numbers; no sum of absolute products exceeds the bound."""
    kind = np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else object
    return (a.astype(kind) @ c.astype(kind).T).astype(np.int64)


class Best:
    """The first k (score, id) by score, greatest first, and then id, for each anchor and each of its windows."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.k, self.score, self.id = k, np.full((anchors, windows, k), -FAR), np.full((anchors, windows, k), np.iinfo(np.int64).max)

    def last(self) -> np.ndarray:
        return self.score[:, :, -1]

    def add(self, rows: np.ndarray, window: int, found: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores of anchors with candidates in order of their ids, as far as allowed."""
        t = np.where(allowed, found, -FAR)
        some = np.flatnonzero((t.max(axis=1) >= self.score[rows, window, -1]) & allowed.any(axis=1))
        if not len(some):
            return
        t, rows = t[some], rows[some]
        first = np.argsort(-t, axis=1, kind="stable")[:, : self.k]
        score = np.concatenate([self.score[rows, window], np.take_along_axis(t, first, 1)], axis=1)
        given = np.where(np.take_along_axis(t, first, 1) > -FAR, ids[first], np.iinfo(np.int64).max)
        ident = np.concatenate([self.id[rows, window], given], axis=1)
        order = np.lexsort((ident, -score), axis=-1)[:, : self.k]
        self.score[rows, window], self.id[rows, window] = np.take_along_axis(score, order, 1), np.take_along_axis(ident, order, 1)


def search(group: Tree, tops: list[np.ndarray], load: Callable[[int], Tree], wanted, leaf_pair) -> None:
    """Visits all pairs of leaves that are wanted. tops: centers, radii, lengths and greatest lengths of the blocks' roots.

    ``wanted(a, tree, c, low, high)`` tells whether node a of the group may gain from a node c whose products with it
    lie between low and high (of a block that is not read yet, tree is None). Blocks that promise most come first.
    """
    center, radius, length, _ = tops
    low, high = (x[0] for x in intervals(group.center[:1], group.radius[:1], group.length[:1], center, radius, length))
    for k in np.argsort(-high, kind="stable").tolist():
        if not wanted(0, None, 0, low[k], high[k]):
            continue
        tree = load(k)
        lows, highs = intervals(group.center, group.radius, group.length, tree.center, tree.radius, tree.length)
        todo = [(0, 0)]
        while todo:
            a, c = todo.pop()
            if not wanted(a, tree, c, lows[a, c], highs[a, c]):
                continue
            ca, cc = group.child[a], tree.child[c]
            if ca < 0 and cc < 0:
                rows = np.arange(group.lo[a], group.hi[a])
                part = slice(tree.lo[c], tree.hi[c])
                leaf_pair(rows, scores(group.q[rows], tree.q[part], group.longest * tree.longest), tree.ids[part], tree.labels[part])
            elif ca >= 0 and (cc < 0 or group.radius[a] > tree.radius[c]):
                todo += sorted([(ca, c), (ca + 1, c)], key=lambda p: highs[p])
            else:
                todo += sorted([(a, cc), (a, cc + 1)], key=lambda p: highs[p])


def _pack(folder: str, leaf: int):
    """Rows (key, part, id, label, q) in order of key and part: a tree of each, written to a file, and its root's ball.
    Rows that are alike in all count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, group, held = FileWriter(folder), None, {}

        def done():
            ids, labels, q = zip(*held, strict=True)
            tree = Tree(np.array(ids), np.array(labels), np.frombuffer(b"".join(q), "<i4").reshape(len(q), -1), leaf)
            data = (*group, len(q[0]) // 4, len(ids), *out.add(tree.dump()), pickle.dumps(tree.top(), 5))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(data, kinds, strict=True)], names=["key", "part", "dim", "n", "file", "at", "size", "top"])

        for b in batches:
            for key, part, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (key, part) != group:
                    if held:
                        yield done()
                    group, held = (key, part), {}
                held[tuple(row)] = None
        if held:
            yield done()
        out.close()

    return run


def _pack_slices(folder: str):
    """Rows (dim, slice, file, at, size, top) in order of the first two: what a task must know of a slice's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, group, held = FileWriter(folder), None, []

        def done():
            tops = [np.array(x) for x in zip(*(pickle.loads(h[3]) for h in held), strict=True)]
            row = (*group, *out.add(pickle.dumps((tops, [h[:3] for h in held]), 5)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["dim", "slice", "file", "at", "size"])

        for b in batches:
            for dim, part, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (dim, part) != group:
                    if held:
                        yield done()
                    group, held = (dim, part), []
                held.append(row)
        if held:
            yield done()
        out.close()

    return run


def _positives(folder: str, k: int):
    """Rows (key, part, place of the group, place of a slice): each anchor's first k other rows of its label in the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = FileReader(folder)
        for b in batches:
            for key, part, *places in zip(*(c.to_pylist() for c in b.columns), strict=True):
                group = Tree.load(read.get(*places[:3]))
                tops, blocks = pickle.loads(read.get(*places[3:]))
                best = Best(len(group.ids), 1, k)

                def wanted(a, tree, c, low, high, group=group, best=best):
                    if tree is not None and (tree.high[c] < group.low[a] or tree.low[c] > group.high[a]):
                        return False
                    return high >= best.score[group.lo[a] : group.hi[a], 0, -1].min()

                def leaf_pair(rows, found, ids, labels, group=group, best=best):
                    allowed = (group.labels[rows][:, None] == labels) & (group.ids[rows][:, None] != ids)
                    best.add(rows, 0, found, allowed, ids)

                search(group, tops, lambda n, blocks=blocks: Tree.load(read.get(*blocks[n])), wanted, leaf_pair)
                at, _, nth = np.nonzero(best.score > -FAR)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), key)), pa.array(np.full(len(at), part, np.int32)), pa.array(at.astype(np.int32)), pa.array(group.ids[at]), pa.array(best.id[at, 0, nth]), pa.array(best.score[at, 0, nth])],
                    names=["key", "part", "at", "anchor_id", "positive_id", "positive_score"],
                )

    return run


def _negatives(folder: str, k: int, low: int, high: int, per: int):
    """Rows as for ``_positives``, with the group's positives (at, nth, id, score): for each of these the first k rows of
    another label in the slice whose score is within its window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = FileReader(folder)
        for b in batches:
            for key, part, *places, positives in zip(*(c.to_pylist() for c in b.columns), strict=True):
                group = Tree.load(read.get(*places[:3]))
                tops, blocks = pickle.loads(read.get(*places[3:]))
                windows = max(p["nth"] for p in positives)
                best = Best(len(group.ids), windows, k)
                # Windows that hold nothing begin beyond any score.
                least, most, own = np.full((len(group.ids), windows), FAR), np.full((len(group.ids), windows), -FAR), {}
                for p in positives:
                    at = p["at"], p["nth"] - 1
                    own[at] = p["id"], p["score"]
                    first, last = -(-low * p["score"] // per), high * p["score"] // per
                    if first <= last:
                        least[at], most[at] = max(first, -FAR + 1), min(last, FAR)

                def wanted(a, tree, c, lowest, highest, group=group, best=best, least=least, most=most):
                    if tree is not None and tree.low[c] == tree.high[c] == group.low[a] == group.high[a]:
                        return False
                    part = slice(group.lo[a], group.hi[a])
                    return highest >= np.maximum(least[part], best.last()[part]).min() and lowest <= most[part].max()

                def leaf_pair(rows, found, ids, labels, group=group, best=best, least=least, most=most):
                    other = group.labels[rows][:, None] != labels
                    for w in range(least.shape[1]):
                        best.add(rows, w, found, other & (found >= least[rows, w][:, None]) & (found <= most[rows, w][:, None]), ids)

                search(group, tops, lambda n, blocks=blocks: Tree.load(read.get(*blocks[n])), wanted, leaf_pair)
                at, w, nth = np.nonzero(best.score > -FAR)
                pos = [own[x] for x in zip(at.tolist(), w.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), key)), pa.array(np.full(len(at), part, np.int32)), pa.array(at.astype(np.int32)), pa.array((w + 1).astype(np.int32)), pa.array(group.ids[at]),
                        pa.array([p[0] for p in pos], pa.int64()), pa.array([p[1] for p in pos], pa.int64()), pa.array(best.id[at, w, nth]), pa.array(best.score[at, w, nth]),
                    ],
                    names=["key", "part", "at", "nth", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
                )

    return run


def _dealt(rows: DataFrame, key: Column, size: int, folder: str, leaf: int) -> DataFrame:
    """Trees of at most about ``size`` rows with the same key; a table of their places."""
    keyed = rows.select(key.alias("key"), "id", "label", "q")
    parts, path = materialise(keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts")), "tree-parts")
    dealt = keyed.join(small_side(parts, parts.count()), "key").select("key", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "label", "q")
    out = dealt.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(tidy(_pack(folder, leaf)), f"key long, part int, dim int, n int, {_PLACE}, top binary")
    out, _ = materialise(out, "trees")
    remove(rows.sparkSession, path)
    return out


def hard_negatives(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, per: int = 100,
) -> DataFrame:
    """For each anchor and each of its positives, its hard negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components become floor(scale * x); a score is the inner product of two such vectors of the same length. An anchor (a
    row for which ``anchor`` holds; null is no) has as positives the first ``positives`` rows of its label with another
    id, by score, greatest first, and then id. Of the rows of another label whose score n satisfies
    low * p <= per * n <= high * p for a positive's score p, the first ``negatives`` are returned, ranked from 1. Fewer
    are returned where there are fewer; a pair without any gives no row.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows alike in id, label and
    vector count once; others that share an id are rows of their own. Vectors of different lengths have no score. Ids and
    labels are integers. A vector whose squared length reaches 2^62 in whole numbers stops the job. An empty table, or one
    without anchors, gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    folder = scratch(spark, "trees")
    vec = col(vector_col).cast("array<double>")
    src = df.select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), vec.alias("vec"))
    src = src.where("id is not null and label is not null and vec is not null").where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    lengths = src.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "dim").first()
    dim, tree, levels = -1, None, 0
    if common is not None and common["n"] > BLOCK and common["dim"]:
        dim = common["dim"]
        rows = max(16, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        sample = np.array([r[0] for r in src.where(F.size("vec") == dim).orderBy(F.xxhash64("id"), "id").limit(rows).select("vec").collect()])
        levels = min(int(np.log2(common["n"] / BLOCK)) + 1, int(np.log2(CELLS)), max(int(np.log2(len(sample) / 8)), 0))
        tree = coarse_tree(quantise(sample, scale).astype(np.float64), levels)
    placed, placed_path = materialise(src.mapInArrow(tidy(_place(scale, tree, dim)), "id long, label long, anchor boolean, cell long, q binary"), "placed")

    chosen = placed.where("anchor")
    n_anchors = chosen.count()
    # Cells next to each other are one group where they have few anchors.
    up = max(0, min(levels, int(np.floor(np.log2(max(GROUP << levels, 1) / max(n_anchors, 1))))))
    groups = _dealt(chosen, F.when(F.col("cell") < 0, F.col("cell")).otherwise(F.shiftright("cell", up)), GROUP, folder, ANCHOR_LEAF)
    blocks = _dealt(placed, F.col("cell"), BLOCK, folder, LEAF)
    remove(spark, placed_path)
    n_groups, n_blocks = groups.count(), blocks.count()
    tasks = TASKS * spark.sparkContext.defaultParallelism
    slices = max(1, min(n_blocks, max(-(-tasks // max(n_groups, 1)), -(-n_blocks // SLICE))))
    sliced = blocks.select("dim", F.pmod(F.xxhash64("key", "part"), F.lit(slices)).cast("int").alias("slice"), "file", "at", "size", "top")
    sliced = sliced.repartition("dim", "slice").sortWithinPartitions("dim", "slice").mapInArrow(tidy(_pack_slices(folder)), f"dim int, slice int, {_PLACE}")
    sliced, _ = materialise(sliced.select("dim", "slice", F.col("file").alias("file_2"), F.col("at").alias("at_2"), F.col("size").alias("size_2")), "slices")

    # A row to each group and each slice of the blocks: the anchors are a set of queries, in groups.
    met = groups.select("key", "part", "dim", "file", "at", "size", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")).join(sliced, ["dim", "slice"])
    met = met.select("key", "part", "file", "at", "size", "file_2", "at_2", "size_2")
    spread = max(1, min(n_groups * slices, 8 * tasks))
    first = Window.partitionBy("key", "part", "at").orderBy(F.desc("positive_score"), "positive_id")
    near = met.repartition(spread).mapInArrow(tidy(_positives(folder, positives)), "key long, part int, at int, anchor_id long, positive_id long, positive_score long")
    near, _ = materialise(near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives), "positives")
    # Of one group: GROUP anchors or some more, with their positives.
    asked = near.groupBy("key", "part").agg(F.collect_list(F.struct("at", "nth", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    found = met.join(asked, ["key", "part"]).select(*met.columns, "positives").repartition(spread)
    found = found.mapInArrow(tidy(_negatives(folder, negatives, low, high, per)), "key long, part int, at int, nth int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = Window.partitionBy("key", "part", "at", "nth").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
