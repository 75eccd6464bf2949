"""Hard negatives by an STR-packed R-tree: boxes bound inner products, a best-first queue visits what can still count.

Rows are sorted by label and one coordinate into slabs by Spark, and inside each slab tiled along the coordinates of
widest spread, so that neighbours in the stored order lie close together. A reader packs runs of that order into
leaves, and runs of leaves into inner nodes, each with its minimum bounding box. A box bounds the inner product with an
anchor coordinate by coordinate: from above by the better corner, from below by the worse one.

Anchors are the stated query set. They go against all rows in blocks of bounded size: each block is broadcast, every
task searches its part of the tree, and only the best few rows per anchor and task are shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import spool

#: Rows of a slab (one task's sort), of a tree that a task searches at once, of a leaf; children of an inner node.
SLAB_ROWS, TREE_ROWS, LEAF_ROWS, FANOUT = 1 << 16, 1 << 15, 128, 16
#: Coordinates a slab is tiled along, besides the one that Spark sorts by.
TILED = 3
#: Anchors of one block, which is collected and broadcast: at most so many in the mean, 8 bytes a coordinate.
ANCHORS_AT_ONCE = 16_384


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def _vectors(column: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of a list column as a matrix of whole numbers; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(dims, int(lengths.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = values
    return out


def str_order(q: np.ndarray, axes: list[int], leaf: int = LEAF_ROWS) -> np.ndarray:
    """Sort-tile-recursive order: cut into slices of whole leaves along the first axis, each slice along the next one."""

    def tile(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or not axes:
            return [rows]
        rows = rows[np.argsort(q[rows, axes[0]], kind="stable")]
        slices = math.ceil(leaves ** (1 / len(axes)))
        size = -(-leaves // slices) * leaf
        return [part for at in range(0, len(rows), size) for part in tile(rows[at : at + size], axes[1:])]

    return np.concatenate(tile(np.arange(len(q)), axes)) if len(q) else np.zeros(0, np.int64)


def _tiler() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one slab, of a size that the range partitioning bounds
        if not held:
            return
        slab = pa.Table.from_batches(held).combine_chunks()
        label, q = slab.column("label").to_numpy(), _vectors(slab.column("q"))
        order = []
        for one in np.unique(label):
            rows = np.flatnonzero(label == one)
            spread = q[rows].astype(np.float64).var(axis=0) if q.shape[1] else np.zeros(0)
            order.append(rows[str_order(q[rows], np.argsort(-spread, kind="stable")[:TILED].tolist())])
        yield from slab.take(pa.array(np.concatenate(order))).to_batches(max_chunksize=4096)

    return run


def pack(rows: DataFrame) -> DataFrame:
    """Rows (id, label, q array<bigint>, anchor) in STR order, written to the shared folder; adds a distinct ``row`` number.

    The range partitioning sorts by label, first coordinate and a hash, so equal vectors, or one
    label with most rows, spread over many slabs.
    """
    n = rows.count()
    # Small tables are cut finer, for the cluster's cores.
    slabs = max(-(-n // SLAB_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAF_ROWS)), 1)
    hashed = rows.withColumns({"__x": F.coalesce(F.try_element_at("q", F.lit(1)), F.lit(0)), "__h": F.xxhash64("id", "q")})
    ranged = hashed.repartitionByRange(slabs, "label", "__x", "__h", F.rand(5)).drop("__x", "__h")
    tiled = ranged.mapInArrow(_tiler(), ranged.schema)
    return spool(tiled.withColumn("row", F.monotonically_increasing_id()))


class Tree:
    """Bounding boxes over consecutive rows: level 0 has the leaves, each further level runs of FANOUT nodes."""

    def __init__(self, label: np.ndarray, q: np.ndarray):
        self.label, self.q, self.exact = label, q, q.dtype == np.float64
        self.levels, size = [], LEAF_ROWS
        low, high, first, last = q, q, label, label
        while True:
            cuts = np.arange(0, len(low), LEAF_ROWS if not self.levels else FANOUT)
            low, high = np.minimum.reduceat(low, cuts, axis=0), np.maximum.reduceat(high, cuts, axis=0)
            first, last = np.minimum.reduceat(first, cuts), np.maximum.reduceat(last, cuts)
            self.levels.append((low, high, first, last, size))
            size *= FANOUT
            if len(low) == 1:
                return

    def bounds(self, a: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and the greatest inner product of an anchor with a row of each box.

        Whole numbers beyond a double's are bounded by doubles, widened by more than their rounding.
        """
        up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
        out = []
        for low, high, *_ in self.levels:
            low, high = low.astype(np.float64, copy=False), high.astype(np.float64, copy=False)
            slack = 0.0 if self.exact else 1 + 1e-12 * (np.maximum(abs(low), abs(high)) @ (up - down))
            out.append((low @ up + high @ down - slack, high @ up + low @ down + slack))
        return out


def _exact(q: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every sum of products is a whole number that a double holds, else as 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(q.shape[1], 1)
    return (q.astype(np.float64), anchors.astype(np.float64)) if most < 2**52 else (q, anchors)


class Search:
    """The best rows of one request: an anchor, whether labels must equal or differ, a score window, k."""

    __slots__ = ("high", "k", "low", "best")

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.best: list[tuple] = []  # (score, id absent, -id), a heap whose least entry is the kth

    def offer(self, score: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        inside = np.ones(len(score), bool)
        if self.low is not None:
            inside &= (score >= self.low) & (score <= self.high)
        if len(self.best) == self.k:
            inside &= score >= self.best[0][0]
        at = np.flatnonzero(inside)
        if len(at) > self.k:  # best first: score, then ids that are there, then the smaller id
            at = at[np.lexsort((ids[at], absent[at], -score[at]))[: self.k]]
        for i in at.tolist():
            entry = int(score[i]), not absent[i], -int(ids[i])
            if len(self.best) < self.k:
                heapq.heappush(self.best, entry)
            elif entry > self.best[0]:
                heapq.heapreplace(self.best, entry)

    def reach(self, least: float, most: float) -> float | None:
        """The best score a box may still give, or None if it is outside the window or strictly below the kth."""
        if self.low is not None and (most < self.low or least > self.high):
            return None
        top = most if self.high is None else min(most, self.high)
        return None if len(self.best) == self.k and top < self.best[0][0] else top


def best_first(tree: Tree, anchor: np.ndarray, label: int, own: np.ndarray, searches: list[Search], same: bool, ids, absent) -> None:
    """Run all searches of an anchor over a tree; a leaf is scored once, whichever of them reach it."""
    bounds = tree.bounds(anchor)
    top = len(tree.levels) - 1
    scored: dict[int, tuple] = {}
    for search in searches:
        queue = [(-float("inf"), top, 0)]
        while queue:
            reach, level, node = heapq.heappop(queue)
            if len(search.best) == search.k and -reach < search.best[0][0]:
                break  # the queue is ordered: nothing left in it can count
            if level:
                inner = level - 1
                least, most = bounds[inner]
                first, last = tree.levels[inner][2:4]
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(most))):
                    if same and not first[child] <= label <= last[child] or not same and first[child] == label == last[child]:
                        continue
                    can = search.reach(least[child], most[child])
                    if can is not None:
                        heapq.heappush(queue, (-can, inner, child))
                continue
            if node not in scored:
                part = slice(node * LEAF_ROWS, (node + 1) * LEAF_ROWS)
                fits = ((tree.label[part] == label) == same) & ~own[part]
                at = np.flatnonzero(fits) + part.start
                score = tree.q[at] @ anchor
                scored[node] = score.astype(np.int64), ids[at], absent[at]
            search.offer(*scored[node])


def _searcher(shared, same: bool, k: int) -> Callable:
    """Searches the rows of a task, tree by tree, for all anchors of a block; gives the best k per request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        requests = [[Search(k, *w) for w in windows] for windows in block["windows"]]

        def visit(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            anchors = block["q"]
            q = _vectors(rows.column("q"), anchors.shape[1])
            wide = np.zeros((len(anchors), q.shape[1]), np.int64)
            wide[:, : anchors.shape[1]] = anchors
            q, wide = _exact(q, wide)
            tree = Tree(rows.column("label").to_numpy(), q)
            absent = rows.column("id").is_null().to_numpy(zero_copy_only=False)
            ids = rows.column("id").fill_null(0).to_numpy()
            for i, searches in enumerate(requests):
                own = (ids == block["id"][i]) & ~absent
                best_first(tree, wide[i], block["label"][i], own, searches, same, ids, absent)

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= TREE_ROWS:
                visit(held)
                held, n = [], 0
        if held:
            visit(held)
        found = [
            (int(block["row"][i]), j, -entry[2] if entry[1] else None, entry[0])
            for i, searches in enumerate(requests)
            for j, search in enumerate(searches)
            for entry in search.best
        ]
        for at in range(0, len(found), 8192):
            columns = zip(*found[at : at + 8192])
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "request", "id", "score"])

    return run


def _best(packed: DataFrame, shared, same: bool, k: int) -> DataFrame:
    """(anchor, request, id, score, rank): the best k over all tasks; each task sends k rows per request at most."""
    found = packed.select("id", "label", "q").mapInArrow(_searcher(shared, same, k), "anchor bigint, request int, id bigint, score bigint")
    order = Window.partitionBy("anchor", "request").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: tuple[int, int] = (30, 100),
    high: tuple[int, int] = (90, 100),
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    Each component x becomes floor(scale * x); scores are integer inner products, exact as long as
    they fit a long. An anchor's positives are its best rows of equal label; a positive's
    negatives are the anchor's best rows of other labels with
    ``low * positive_score <= negative_score <= high * positive_score`` (ratios as whole numbers).
    Ties fall to the smaller id, null ids last.

    Rows with a null label or vector, or a null or non-finite component, take no part. Rows with an
    anchor's own id are the anchor itself, never its positive or negative; repeated rows count
    each, repeated anchors are mined each. Anchors need an id. An empty vector, or the missing
    end of a shorter one, counts as zeros. Extra columns are ignored; an empty table gives none.

    Every anchor is searched in all rows: two scans of the packed table per block of
    ``ANCHORS_AT_ONCE`` anchors. Anchor blocks are the only thing that is collected.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col)
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    kept = rows.where(usable(vector) & F.col(label_col).isNotNull())
    packed = pack(
        kept.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.col(label_col).cast("bigint").alias("label"),
            whole.alias("q"),
            F.coalesce(anchor & F.col(id_col).isNotNull(), F.lit(False)).alias("anchor"),
        )
    )
    anchors = packed.where("anchor").select("row", "id", "label", "q")
    blocks = -(-anchors.count() // ANCHORS_AT_ONCE)
    shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    parts = [spark.createDataFrame([], shape)]
    for block in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        parts.append(_mine_block(packed, own, positives, negatives, low, high))
    out = parts[0] if len(parts) == 1 else parts[1]
    for part in parts[2:]:
        out = out.unionByName(part)
    return out


def _mine_block(packed: DataFrame, anchors: DataFrame, positives: int, negatives: int, low, high) -> DataFrame:
    context = packed.sparkSession.sparkContext
    asked = anchors.orderBy("row").toArrow()
    block = {
        "row": asked.column("row").to_numpy(),
        "id": asked.column("id").to_numpy(),
        "label": asked.column("label").to_numpy(),
        "q": _vectors(asked.column("q")),
    }
    near = spool(_best(packed, context.broadcast(block | {"windows": [[(None, None)]] * asked.num_rows}), True, positives))
    at = {int(row): i for i, row in enumerate(block["row"])}
    windows: list[list[tuple[int, int]]] = [[] for _ in at]
    scores: list[list[int]] = [[] for _ in at]
    for row, score in near.select("anchor", "score").distinct().collect():  # positives per anchor at most
        windows[at[row]].append((-(-low[0] * score // low[1]), high[0] * score // high[1]))
        scores[at[row]].append(score)
    found = _best(packed, context.broadcast(block | {"windows": windows}), False, negatives)
    which = [(int(block["row"][i]), int(block["id"][i]), j, s) for i, found_scores in enumerate(scores) for j, s in enumerate(found_scores)]
    asked_for = packed.sparkSession.createDataFrame(which, "anchor bigint, anchor_id bigint, request int, score bigint")
    pairs = near.select("anchor", F.col("id").alias("positive_id"), "score").join(asked_for, ["anchor", "score"])
    return pairs.select("anchor", "anchor_id", "positive_id", "request", F.col("score").alias("positive_score")).join(
        found.select("anchor", "request", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor", "request"]
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
