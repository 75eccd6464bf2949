"""Sharding by extendible hashing: only oversized buckets split on another bit of the hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import cut, spool

#: Bits looked at in one round; a round sums bytes for all prefixes that long below an oversized bucket.
ROUND_BITS = 12
#: Bits of the hash; a bucket still oversized then holds rows with equal hashes and is cut by running size.
MOST_BITS = 48


def _bits(hexes: Column, digits: int) -> Column:
    """The leading hex digits as a string of bits."""
    return F.lpad(F.conv(F.substring(hexes, 1, digits), 16, 2), digits * 4, "0")


def directory(cells: DataFrame, limit: int, base: int, bits: int) -> DataFrame:
    """(cell, prefix, full): for each cell (a bit string) the shortest prefix of at least ``base`` bits within the limit.

    ``cells`` holds (cell, bytes). The prefix is null where even the whole cell is oversized.
    """
    lengths = F.explode(F.sequence(F.lit(base), F.lit(bits))).alias("n")
    sums = cells.select(lengths, "cell", "bytes").withColumn("prefix", F.substring("cell", F.lit(1), F.col("n")))
    sums = sums.groupBy("n", "prefix").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= limit)
    at = cells.select("cell", lengths).withColumn("prefix", F.substring("cell", F.lit(1), F.col("n")))
    best = at.join(sums, ["n", "prefix"]).groupBy("cell").agg(F.min("n").alias("n"))
    found = cells.join(best, "cell", "left")
    return found.select("cell", F.when(F.col("n").isNotNull(), F.substring("cell", F.lit(1), F.col("n"))).alias("prefix"))


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 32 * 1024 * 1024, seed: int = 5
) -> DataFrame:
    """(doc_id, n_bytes, shard, depth) for every row: shards of at most ``limit`` bytes of text.

    A shard is named by its prefix of the bits of a seeded md5 of the id; its depth is the
    prefix's length. A bucket splits only while it is oversized, so hot cells grow deep while the
    rest stays shallow. Only sums per hash cell are compared; the directory stays a table and is
    joined, never collected.

    Defined cases: a single text over the limit is a shard of its own; rows whose hashes agree in
    all bits (a repeated or null id) are cut by running size into numbered shards ``bits-number``
    that keep the limit (unless one text alone exceeds it); a null text has 0 bytes; an empty
    table gives an empty result; extra columns are ignored.
    """
    text = F.col(text_col).cast("string")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        _bits(digest, MOST_BITS // 4).alias("bits"),
        F.xxhash64(text).alias("tie"),
    )
    rows = spool(rows)
    done, open_rows, base = None, rows, 0
    for bits in range(ROUND_BITS, MOST_BITS + 1, ROUND_BITS):
        cell = F.substring("bits", 1, bits)
        cells = cut(open_rows.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes")))
        found = cut(directory(cells, limit, base, bits))
        placed = open_rows.join(found, cell == F.col("cell"))
        closed = placed.where("prefix is not null").select("doc_id", "n_bytes", F.col("prefix").alias("shard"))
        done = closed if done is None else done.union(closed)
        if found.where("prefix is null").isEmpty():
            open_rows = None
            break
        open_rows = placed.where("prefix is null").select("doc_id", "n_bytes", "bits", "tie")
        base = bits + 1
    if open_rows is not None:
        order = Window.partitionBy("bits").orderBy("n_bytes", "tie")
        running = F.sum("n_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
        # Rows of at most half the limit fill pieces of half the limit, so no piece exceeds it; larger rows stand alone.
        piece = F.when(
            F.col("n_bytes") * 2 > limit, F.concat(F.lit("r"), F.row_number().over(order).cast("string"))
        ).otherwise(F.floor((running - 1) / (limit / 2)).cast("string"))
        cut_rows = open_rows.select("doc_id", "n_bytes", F.concat_ws("-", "bits", piece).alias("shard"))
        done = done.union(cut_rows)
    depth = F.length(F.substring_index("shard", "-", 1)).alias("depth")
    return done.select("doc_id", "n_bytes", "shard", depth)
