"""Mixing sources to target weights by capped water-filling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import WORD, cut, small, spool

#: Documents of a source are ordered by this many leading hex digits of their hash first; only
#: the one cell that a source's last repetition ends in is ordered document by document.
CELL_DIGITS = 3


def sizes(text_col: str = "text") -> Column:
    """Number of words of a text; 0 without one."""
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Water-filling over (source, source_size), one row per source: adds target (double).

    Sources in code-point order, null last, weigh ``weights``, repeated. They share the sum of all sizes; a
    source stops at ``max_epochs`` times its size and its excess goes to the others by weight. The
    fixed point needs no rounds: by rising ratio of cap to weight, sources are capped until the
    next one's share of what is left stays below its cap. Works on one row per source, so its
    two windows without a partition see as many rows as there are sources, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1)
    rows = totals.select("source", "source_size", weight.alias("w"), (F.col("source_size") * max_epochs).alias("cap"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows = rows.withColumns(
        {
            "all_size": F.sum("source_size").over(everything),
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)),
            "rest": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0)),
        }
    )
    # The first source, by ratio, whose share of what is left stays within its cap sets the level of all later ones.
    fits = F.col("left") * F.col("w") <= F.col("cap") * F.col("rest")
    level = F.min(F.when(fits, F.struct((F.col("cap") / F.col("w")).alias("at"), "source_rank", "left", "rest"))).over(everything)
    rows = rows.withColumn("source_rank", F.row_number().over(order)).withColumn("level", level)
    here = F.struct((F.col("cap") / F.col("w")).alias("at"), F.col("source_rank"))
    capped = F.col("level").isNull() | (here < F.struct(F.col("level.at"), F.col("level.source_rank")))
    share = (F.col("level.left") * F.col("w")).cast("double") / F.col("level.rest").cast("double")
    return rows.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, carry: bool) -> DataFrame:
    """source, size and the place (digest, size, tie) of each row in its source's order."""
    text = F.col(text_col).cast("string")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        sizes(text_col).alias("size"),
        digest.alias("digest"),
        F.xxhash64(text).alias("tie"),
        *row,
    )


def _plan(places: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source: source_size, target, whole repetitions, and the last place that is taken once more."""
    cells = places.groupBy("source", F.substring("digest", 1, CELL_DIGITS).alias("cell")).agg(F.sum("size").alias("cell_size"))
    cells = cut(cells)
    goal = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("whole", whole.cast("long"))
    goal = cut(goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    cells = cells.join(goal.select(F.col("source").alias("s"), "part"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # The cells in which the part ends, one per source: only their documents are ordered one by one.
    last = cells.where("part > 0 and before < part and before + cell_size >= part")
    last = small(last.select(F.col("source").alias("s"), F.col("cell").alias("c"), "before", "part"))
    inside = places.join(
        last, F.col("source").eqNullSafe(F.col("s")) & (F.substring("digest", 1, CELL_DIGITS) == F.col("c"))
    )
    so_far = Window.partitionBy("source", "c").orderBy("digest", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(so_far), F.lit(0)) + F.col("size") / 2
    inside = inside.withColumn("middle", middle)
    # All cells before the last are taken; their places are below the cell's first place.
    cuts = inside.groupBy("source").agg(
        F.max(F.when(F.col("middle") <= F.col("part"), F.struct("digest", "size", "tie"))).alias("taken_to"),
        F.min(F.struct("digest", "size", "tie")).alias("cell_from"),
    )
    cuts = cuts.withColumnRenamed("source", "s")
    return small(goal.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 17,
    carry: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, repetitions, taken) for every row; ``carry`` adds the row as ``_row``.

    Every document is taken floor(target / source_size) times whole, and once more while the
    documents of its source, in the order of a seeded md5 of the id, stay within what is left of
    the target (the last one if its middle does), so a source misses its target by half a
    document at most. The order's cut is found by cells: sums per (source, hash cell), then one
    cell per source document by document, so no window sees a whole source. Rows meet a table
    of one row per source, which is broadcast only after it was counted.

    Defined cases: null or wordless texts have size 0; a null source is a source of its own,
    last; a null id hashes like the empty string; repeated rows follow each other by size and
    text hash; a source of size 0 has target 0 and is not taken; an empty table gives an empty
    result. Extra columns are ignored unless carried.
    """
    places = spool(_placed(docs, id_col, text_col, source_col, seed, False))
    plan = _plan(places, weights, max_epochs).withColumnRenamed("source", "s")
    rows = _placed(docs, id_col, text_col, source_col, seed, True) if carry else places
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    place = F.struct("digest", "size", "tie")
    extra = (F.col("part") > 0) & (
        F.coalesce(place <= F.col("taken_to"), F.lit(False)) | F.coalesce(place < F.col("cell_from"), F.lit(False))
    )
    rows = rows.withColumn("repetitions", F.col("whole") + F.when(extra, 1).otherwise(0))
    taken = (F.col("repetitions") * F.col("size")).alias("taken")
    return rows.select("doc_id", "source", "size", "source_size", "target", "repetitions", taken, *(["_row"] if carry else []))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of docs as often as the mix takes it."""
    mixed = mix(docs, carry=True, **options).where("repetitions > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repetitions")))
    return mixed.select("_row", copies.alias("_copy")).select("_row.*")
