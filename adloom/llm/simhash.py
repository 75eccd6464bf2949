"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import components, cut, key_column

#: Two blocks of 31 bits; two bits belong to neither. Three differing bits leave one block with one at most.
BLOCK_BITS = 31
BLOCKS = (0, 31)
THRESHOLD = 3
CHUNK = 1 << 15


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """64-bit SimHash: bit b is set if over half of the shingles' XXH64 (seed 42) have it; 0 without a word."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(words_per_shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[s:e], 42) for s, e in spans], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x.as_py()) for x in batch.column(1)]
        signed = np.array(prints, np.uint64).view(np.int64)
        columns = [batch.column(0), batch.column(2), pa.array(signed, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, fp): one row per input row; tag is a hash of the text, fp holds the 64 bits as a signed number."""
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    return narrow.mapInArrow(_batches, "doc_id long, tag long, fp long")


def _block(fp: Column, shift: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))


def _syndrome(block: Column) -> Column:
    """Syndrome of the perfect [31, 26] Hamming code: the XOR of the 1-based places of set bits."""
    total = F.lit(0)
    for j in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> j & 1)
        total = total + (F.bit_count(block.bitwiseAND(F.lit(mask).cast("long"))) % 2) * (1 << j)
    return total


def _flip(place: Column) -> Column:
    """A block with the bit at a 1-based place set; none for place 0."""
    return F.when(place == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))
    )


def anchors(fps: DataFrame, replicate: bool) -> DataFrame:
    """(block, anchor, columns of fps). Anchors are the codewords of the perfect code of radius 1 on each block.

    Without ``replicate``: the one codeword within the radius. With it: all codewords within
    radius + 1 (1 of a codeword itself, else 16), so that any fingerprint differing in one bit
    of the block meets this one at its own codeword.
    """
    parts = []
    for number, shift in enumerate(BLOCKS):
        rows = fps.select("*", _block(F.col("fp"), shift).alias("w")).withColumn("s", _syndrome(F.col("w")))
        nearest = F.col("w").bitwiseXOR(_flip(F.col("s")))
        if replicate:
            pairs = F.transform(
                F.filter(F.sequence(F.lit(1), F.lit(BLOCK_BITS)), lambda i: (F.col("s") > 0) & (i < i.bitwiseXOR(F.col("s")))),
                lambda i: F.col("w").bitwiseXOR(_flip(i)).bitwiseXOR(_flip(i.bitwiseXOR(F.col("s")))),
            )
            nearest = F.explode(F.concat(F.array(nearest), pairs))
        parts.append(rows.select(F.lit(number).alias("block"), nearest.alias("anchor"), *fps.columns))
    return parts[0].union(parts[1])


def _close(fps: DataFrame) -> DataFrame:
    """Pairs of fps' rows that meet at an anchor with at most 3 differing bits, the greater as ``other_…``; some twice."""
    others = anchors(fps, replicate=True).withColumnsRenamed({c: f"other_{c}" for c in fps.columns})
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other_fp"))) <= THRESHOLD
    met = anchors(fps, replicate=False).join(others, ["block", "anchor"])
    return met.where((F.col("fp") < F.col("other_fp")) & near)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): all pairs of different fingerprints with at most 3 differing bits, found per anchor."""
    return _close(fps).select(F.col("fp").alias("a"), F.col("other_fp").alias("b"))


def least_links(fps: DataFrame) -> DataFrame:
    """(a, b): for each fingerprint b that is close to a smaller one the least such a: fewer rows than fingerprints."""
    return _close(fps).groupBy(F.col("other_fp").alias("b")).agg(F.min("fp").alias("a")).select("a", "b")


def cluster_links(rooted: DataFrame) -> DataFrame:
    """(a, b): distinct pairs of different roots that hold close fingerprints, from rows (fp, root)."""
    apart = _close(rooted).where("root <> other_root")
    return apart.select(F.least("root", "other_root").alias("a"), F.greatest("root", "other_root").alias("b")).distinct()


def _with_roots(nodes: DataFrame, column: str, edges: DataFrame) -> DataFrame:
    """``column`` replaced by the root of its component; values without an edge stay."""
    roots = components(edges).select(F.col("node").alias(column), F.col("root").alias("_root"))
    found = nodes.join(roots, column, "left")
    return found.withColumn(column, F.coalesce("_root", column)).select(*nodes.columns)


def linked(fps: DataFrame) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint, by its links to others of at most 3 differing bits.

    Anchors are compared twice, and pairs never leave the task that finds them: first only
    the least neighbour of each fingerprint does, then only links between the clusters this
    makes, combined by cluster. N near copies with different fingerprints give N rows, not N².
    """
    first = cut(_with_roots(fps.select("fp", F.col("fp").alias("root")), "root", least_links(fps)))
    return _with_roots(first, "root", cluster_links(first))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, fp, component_id, kept) for every input row; component_id is the smallest doc_id reachable.

    Copies share a fingerprint and are collapsed before linking. Null and empty texts have
    fingerprint 0 and are linked like any other; repeated rows come back as often as they were
    given; rows without a doc_id count as larger than all others, and component_id is null only
    where the whole component has no id. ``kept`` marks the component's smallest (doc_id, tag).
    An empty table gives an empty result. Only the id and text columns are read.
    """
    fps = cut(fingerprints(docs, id_col, text_col))
    own = F.struct(key_column("doc_id").alias("key"), "doc_id", "tag")
    distinct = fps.groupBy("fp").agg(F.min(own).alias("first"))
    rooted = distinct.join(linked(distinct.select("fp")), "fp")
    least = rooted.groupBy("root").agg(F.min("first").alias("best"))
    labels = rooted.join(least, "root").select("fp", "best")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tag") == F.col("best.tag"))
    return fps.join(labels, "fp").select("doc_id", "tag", "fp", F.col("best.doc_id").alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that represent their component: its smallest doc_id; of repeated rows one.

    The text is shuffled once, by doc_id, which is even; hot fingerprints travel without their text.
    """
    found = near_duplicates(docs, id_col, text_col).where("kept")
    kept = found.select(key_column("doc_id").alias("_key"), F.col("tag").alias("_tag")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        key_column(id_col).alias("_key"),
        F.xxhash64(F.col(text_col).cast("string")).alias("_tag"),
    )
    rows = rows.join(kept, ["_key", "_tag"], "left_semi")
    return rows.groupBy("_key", "_tag").agg(F.min("_row").alias("_row")).select("_row.*")
