"""Shared pieces: lineage cuts, text buffers of Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table of narrow rows, by count, that is broadcast.
BROADCAST_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
#: Temporary folders of local sessions without the setting, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where it is unset (tests)."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _OWN.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="llm-")
        _OWN[context.applicationId] = root
    return root


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder; survives lost executors."""
    context = df.sparkSession.sparkContext
    root = shared_dir(df.sparkSession)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def spool(df: DataFrame) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared folder; smaller on disk than a checkpoint."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A checkpointed table, hinted for broadcast only if its counted rows are few; larger ones join by shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def key_column(name: str) -> Column:
    """A never-null join key of a nullable id; rows without an id share one key and are told apart by other means."""
    return F.coalesce(F.col(name).cast("long"), F.lit(2**63 - 1))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array and the n + 1 offsets into it; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows [a, b) whose bytes together stay below ``most`` (a longer row is a run of its own)."""
    runs, start, n = [], 0, len(offsets) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        runs.append((start, min(end, n)))
        start = min(end, n)
    return runs


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.cumprod(out, out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the smallest node.

    Alternates large stars and small stars until the edges form stars. Each round cuts the
    lineage; neighbours are never collected, only their minimum is (combined before the
    shuffle), so a hub costs no more than its edges. Nodes without an edge do not appear.
    """
    links = cut(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    state = None
    for _ in range(most_rounds):
        both = links.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(links.select("lo", "hi"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = cut(small.union(least.select("hi", "m")).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select("lo", "lo").distinct()
            )
        state = now
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
