"""Embedding near-duplicates by randomised-rotation binary codes with correction factors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import components, mix, small, spool

#: Vectors meant to share a table's bucket by chance, and the chance that a pair at the threshold shares one in some table.
BUCKET = 512
FOUND = 0.9999
#: Width of the confidence bounds in standard deviations of the estimate.
EPSILON = 6.0
#: Larger buckets are cut into parts of about this size, and every pair of parts is compared on its own.
PART = 2048
#: Levels of a component of the rotated vector in a code: four bits.
LEVELS = 15


@lru_cache(maxsize=8)
def rotations(dim: int, bits: int, seed: int) -> np.ndarray:
    """Random rotations of the space, stacked until they have at least ``bits`` rows."""
    rng = np.random.default_rng([seed, dim])
    stacked = []
    for _ in range(-(-bits // dim)):
        q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
        stacked.append(q * np.sign(np.diag(r)))
    return np.concatenate(stacked)


def tables(n: int, threshold: float) -> tuple[int, int]:
    """(bits of a key, number of tables) for n vectors.

    Signs of a rotated pair differ with probability angle / pi. Keys grow with log2(n), so that a
    bucket holds BUCKET vectors by chance whatever the size; tables are added until a pair at
    the threshold shares a bucket with probability FOUND.
    """
    same = 1 - math.acos(threshold) / math.pi
    width = max(1, math.ceil(math.log2(max(2, n / BUCKET))))
    count = math.ceil(math.log(1 - FOUND) / math.log(1 - same**width))
    return width, max(1, count)


def _matrix(vectors: pa.Array, dtype: str) -> np.ndarray:
    """Vectors of one length, given as bytes, as rows in double precision."""
    raw = vectors.to_pylist()
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(unit: np.ndarray, width: int, count: int, seed: int) -> np.ndarray:
    """Each vector's key in every table: ``width`` signs of its rotations."""
    turned = unit @ rotations(unit.shape[1], width * count, seed)[: width * count].T
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
    return ((turned > 0).reshape(len(unit), count, width) * weights).sum(axis=2, dtype=np.uint64)


def _encode(unit: np.ndarray, seed: int) -> list[bytes]:
    """Codes of vectors: length, correction factor, least level and step, signs of the rotation, four-bit levels of the rotation.

    The binary code is the signs of a random rotation, the correction factor its inner product with the rotated vector. The
    levels are the vector's other part in an estimate, that of the one whose inner product with a binary code is taken;
    they are rounded by a fixed dither, which leaves no bias.
    """
    dim = unit.shape[1]
    rotated = unit @ rotations(dim, dim, seed + 1).T
    low = rotated.min(axis=1).astype("<f4")
    step = ((rotated.max(axis=1) - low) / LEVELS).astype("<f4")
    step[step <= 0] = 1
    dither = np.random.default_rng([seed, dim, 1]).random(dim)
    levels = np.clip(np.floor((rotated - low[:, None]) / step[:, None] + dither), 0, LEVELS).astype(np.uint8)
    if dim % 2:
        levels = np.concatenate([levels, np.zeros((len(levels), 1), np.uint8)], axis=1)
    head = np.empty((len(unit), 4), "<f4")
    head[:, 0].view("<i4")[:] = dim
    head[:, 1], head[:, 2], head[:, 3] = np.abs(rotated).sum(axis=1) / math.sqrt(dim), low, step
    parts = [head.view(np.uint8), np.packbits(rotated > 0, axis=1), levels[:, ::2] | levels[:, 1::2] << 4]
    return [row.tobytes() for row in np.concatenate(parts, axis=1)]


def _decode(codes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(correction factors, steps, signs, rounded rotated vectors) of codes of one length."""
    raw = codes.to_pylist()
    rows = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    head = rows[:, :16].copy().view("<f4")
    dim = int(head[0, 0].view("<i4"))
    end = 16 + -(-dim // 8)
    signs = np.unpackbits(rows[:, 16:end], axis=1, count=dim).astype(np.float32) * 2 - 1
    levels = np.stack([rows[:, end:] & 15, rows[:, end:] >> 4], axis=2).reshape(len(raw), -1)[:, :dim]
    return head[:, 1], head[:, 3], signs, head[:, 2:3] + head[:, 3:4] * levels.astype(np.float32)


def _enter(width: int, count: int, seed: int, dtype: str, full: bool):
    """Rows (node, copies, vector) to one row for each table: the bucket and, if ``full``, table, node and code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v.as_buffer()) for v in batch.column(2)], np.int64)
            for size in np.unique(sizes):
                chosen = batch.filter(pa.array(sizes == size))
                for at in range(0, chosen.num_rows, 4096):
                    rows = chosen.slice(at, 4096)
                    unit = _unit(_matrix(rows.column(2), dtype))
                    keys = _keys(unit, width, count, seed)
                    code = pa.array(_encode(unit, seed), pa.binary()) if full else None
                    for t in range(count):
                        salt = mix(np.full(rows.num_rows, t * 1_000_003 + int(size), np.uint64))
                        bucket = pa.array(mix(keys[:, t] + salt).view(np.int64))
                        own = [bucket]
                        if full:
                            own += [pa.array(np.full(rows.num_rows, t, np.int32)), rows.column(0), code]
                        yield pa.RecordBatch.from_arrays(own, ["bucket", "t", "node", "code"][: len(own)])

    return run


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the left and of the right of a piece: both are all of them where it is one part."""
    return np.flatnonzero(side != 1), np.flatnonzero(side != 0)


def _undecided(threshold: float) -> Callable:
    """Nodes of a piece with a partner whose inner product may reach the threshold, judged by the codes alone.

    The inner product of a with b is estimated without bias as <rounded rotated a, signs of b> / factor of b. Its deviation
    comes from the signs, as known from the factor, and from the rounding. A pair is ruled out where the upper
    confidence bound of either direction stays below the threshold.
    """
    angle = 1 - threshold * threshold

    def judge(rows: pa.Table) -> pa.RecordBatch | None:
        left, right = _sides(rows["side"].to_numpy())
        if not len(left) or not len(right):
            return None
        factor, step, signs, turned = _decode(rows["code"].combine_chunks())
        dim = signs.shape[1]

        def may(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            estimate = (turned[a] @ signs[b].T) / (math.sqrt(dim) * factor[b])
            own = angle * np.maximum(1 - factor[b] ** 2, 0) / max(1, dim - 1)
            return estimate >= threshold - EPSILON * np.sqrt(own + (step[a] ** 2)[:, None] / 4) / factor[b] - 1e-5

        pairs = may(left, right) & may(right, left).T
        if len(left) == len(right) == rows.num_rows:
            np.fill_diagonal(pairs, False)
        chosen = np.zeros(rows.num_rows, bool)
        chosen[left[pairs.any(axis=1)]] = True
        chosen[right[pairs.any(axis=0)]] = True
        kept = rows.select(["piece", "side", "t", "node"]).filter(pa.array(chosen)).combine_chunks().to_batches()
        return kept[0] if kept else None

    return judge


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each of n items to the least item of its component, by spreading the least label."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            other = np.flatnonzero(label != np.arange(n))
            return other, label[other]
        label = least


def _compare(
    unit: np.ndarray, node: np.ndarray, copies: np.ndarray, side: np.ndarray, t: int, threshold: float, options: tuple[int, int, int]
) -> tuple | None:
    """Links among the undecided vectors of one bucket, or between two of its parts, in double precision; nodes come sorted.

    A pair counts in the first table in which it shares a bucket, once.
    """
    width, count, seed = options
    left, right = _sides(side)
    if not len(left) or not len(right):
        return None
    i, j = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
    i, j = left[i], right[j]
    if (side == 2).all():
        i, j = i[i < j], j[i < j]
    # Each product again by itself, so that it does not depend on the other rows of its block.
    exact = [np.einsum("ij,ij->i", unit[i[k : k + 65536]], unit[j[k : k + 65536]]) for k in range(0, len(i), 65536)]
    near = np.concatenate([*exact, np.zeros(0)]) >= threshold
    i, j = i[near], j[near]
    if t and len(i):
        used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        keys = _keys(unit[used], width, count, seed)[:, :t]
        a, b = place[: len(i)], place[len(i) :]
        new = np.concatenate([~(keys[a[k : k + 65536]] == keys[b[k : k + 65536]]).any(axis=1) for k in range(0, len(a), 65536)])
        i, j = i[new], j[new]
    if not len(i):
        return None
    linked = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    other, root = _spanning(i, j, len(node))
    return node[linked > 0], linked[linked > 0].astype(np.int64), node[other], node[root]


def _linked(threshold: float, dtype: str, options: tuple[int, int, int]) -> Callable:
    """Rows (node, links, other) of a piece of vectors."""

    def solve(rows: pa.Table) -> pa.RecordBatch | None:
        node, copies, side = (rows[c].to_numpy() for c in ("node", "copies", "side"))
        unit = _unit(_matrix(rows["vector"].combine_chunks(), dtype))
        found = _compare(unit, node, copies.astype(float), side, rows["t"][0].as_py(), threshold, options)
        if found is None:
            return None
        own, links, other, root = found
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([own, other])),
                pa.array(np.concatenate([links, np.zeros(len(other), np.int64)])),
                pa.array([None] * len(own) + root.tolist(), pa.int64()),
            ],
            ["node", "links", "other"],
        )

    return solve


def _by_piece(solve: Callable):
    """Rows of a partition, sorted by piece, to what ``solve`` makes of each piece of two rows or more."""

    def all_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bounds = np.flatnonzero(np.diff(rows["piece"].to_numpy())) + 1
        for lo, hi in zip([0, *bounds.tolist()], [*bounds.tolist(), rows.num_rows], strict=True):
            found = solve(rows.slice(lo, hi - lo)) if hi - lo > 1 else None
            if found is not None:
                yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            piece = batch.column("piece").to_numpy()
            # The last piece may go on in the next batch.
            end = int(np.flatnonzero(piece != piece[-1])[-1]) + 1 if piece[0] != piece[-1] else 0
            if end or (waiting and waiting[-1].column("piece")[-1].as_py() != piece[0]):
                yield from all_of(pa.Table.from_batches([*waiting, batch.slice(0, end)]))
                waiting = []
            waiting.append(batch.slice(end))
        if waiting:
            yield from all_of(pa.Table.from_batches(waiting))

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, seed: int = 29
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: vectors with a cosine of at least the threshold are linked.

    Equal vectors are one node with a number of copies. A node enters one bucket of each table, named by the signs of some
    rotations, with its code (``_encode``), not its vector. The codes rule pairs out (``_undecided``); vectors
    follow only to buckets in which they have an undecided partner, and are compared there exactly. Buckets larger than
    PART are cut into parts, and every pair of parts is compared by itself, so no task holds a large bucket.
    A bucket gives counts and links to the least member only, never all its pairs.

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, not
    even their copies; vectors of different length never link; repeated rows are vectors of their own and link with each
    other; rows without an id are counted, but give no component_id unless nothing else is there (then null);
    an empty table gives none. Extra columns are ignored.
    """
    is_float = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    dtype, zero = ("<f4", F.lit(0.0).cast("float")) if is_float else ("<f8", F.lit(0.0))
    value = F.col(vector_col) if is_float else F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = value.isNotNull() & (F.size(value) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(value, lambda v: v != 0)
    vector = F.when(usable, F.transform(value, lambda v: F.when(v == 0, zero).otherwise(v)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if v is None else np.array(v, dtype).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["vec_id", "vector"])

    rows = spool(rows.mapInArrow(packed, "vec_id long, vector binary"))
    nodes = rows.where("vector is not null").groupBy("vector")
    nodes = nodes.agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    # Numbers are given before the table is written, so they stay with their rows.
    nodes = spool(nodes.withColumn("node", F.monotonically_increasing_id()))
    width, count = tables(nodes.count(), threshold)
    plain = nodes.select("node", "copies", "vector")
    sizes = plain.mapInArrow(_enter(width, count, seed, dtype, False), "bucket long").groupBy("bucket").agg(F.count("*").alias("n"))
    large = small(sizes.where(F.col("n") > PART).select("bucket", F.ceil(F.col("n") / PART).cast("int").alias("parts")))
    entered = plain.mapInArrow(_enter(width, count, seed, dtype, True), "bucket long, t int, node long, code binary")
    entered = entered.join(large, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    entered = entered.withColumn("part", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts")).cast("int"))
    entered = entered.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other_part"), F.greatest("part", "other_part")
    piece = F.when(F.col("parts") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", low, high))
    side = F.when(F.col("part") == F.col("other_part"), 2).when(F.col("part") == low, 0).otherwise(1)
    pieces = entered.select(piece.alias("piece"), side.alias("side"), "t", "node", "code")
    pieces = pieces.repartition("piece").sortWithinPartitions("piece")
    open_rows = spool(pieces.mapInArrow(_by_piece(_undecided(threshold)), "piece long, side int, t int, node long"))
    vectors_of = open_rows.join(plain, "node").repartition("piece").sortWithinPartitions("piece", "node")
    solve = _by_piece(_linked(threshold, dtype, (width, count, seed)))
    found = spool(vectors_of.mapInArrow(solve, "node long, links long, other long"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(links, "node", "left")
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select(
        F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(named, F.col("vector") == F.col("v"), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
