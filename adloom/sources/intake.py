"""Intake of lake files into bronze, each file once, with a ledger of files and the replay of single ones.

Below ``base``: ``bronze/load=…`` holds records, damaged units and the path each came from,
``ledger/load=…`` one row per file, ``checkpoint`` the stream's list of files it has seen. A load's
ledger is written after its bronze rows, and bronze rows without a ledger are not read, so a run
that dies leaves nothing visible; the next one repeats its last load under the same name.
One writer per table.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.latest import latest_version
from adloom.schemas import landing_schema
from adloom.sources import lake

LEDGER = "path string, version int, landed_at timestamp, records bigint, damaged bigint, load string"
#: Columns of a bronze row beside the record's own: an absent record is a damaged unit or stands for an empty file.
_OWN = "_path string, _record boolean, _damaged string"


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """(path, version, landed_at, records, damaged, load): every intake and replay of a file; empty before the first."""
    return _read(spark, f"{base.rstrip('/')}/ledger", LEDGER)


def files_taken(spark: SparkSession, base: str) -> DataFrame:
    """The ledger's newest row of each file."""
    return latest_version(ledger(spark, base), ["path"], "version", ["load"])


def _bronze_schema(schema: T.StructType) -> T.StructType:
    own = T.StructType.fromDDL(f"{_OWN}, load string").fields
    clash = {f.name for f in own} & set(schema.names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} of the table are needed for the intake")
    return T.StructType([*schema.fields, *own])


def _take(texts: DataFrame, base: str, schema: T.StructType, load: str, versions: DataFrame | None = None) -> None:
    """Writes a load: its bronze rows, then its ledger. Files are read once; the ledger is counted from bronze."""
    spark, base = texts.sparkSession, base.rstrip("/")
    units = lake.parsed_units(texts, schema, keep_empty=True)
    good = F.filter(F.coalesce("__rows", F.array()), lambda r: r.isNotNull())
    item = lambda record, damaged: F.struct(record.alias("record"), damaged.alias("damaged"))
    absent = F.array(item(F.lit(None).cast(schema), F.col("__unit")))
    records = F.transform(good, lambda r: item(r, F.lit(None).cast("string")))
    items = F.when(F.col("__bad") | F.col("__unit").isNull(), F.concat(records, absent)).otherwise(records)
    rows = units.select("__path", F.explode(items).alias("__item"))
    rows.select(
        *[F.col("__item.record")[name].alias(name) for name in schema.names],
        F.col("__path").alias("_path"),
        F.col("__item.record").isNotNull().alias("_record"),
        F.col("__item.damaged").alias("_damaged"),
    ).write.mode("overwrite").parquet(f"{base}/bronze/load={load}")

    taken = spark.read.schema(_OWN).parquet(f"{base}/bronze/load={load}").groupBy(F.col("_path").alias("path")).agg(
        F.count_if("_record").alias("records"), F.count("_damaged").alias("damaged")
    )
    taken = taken.withColumn("version", F.lit(0)) if versions is None else taken.join(versions, "path")
    entry = taken.select("path", "version", lake.landed_at(F.col("path")).alias("landed_at"), "records", "damaged")
    entry.write.mode("overwrite").parquet(f"{base}/ledger/load={load}")


def run_intake(
    spark: SparkSession,
    root: str,
    table: str,
    base: str,
    schema: T.StructType | None = None,
    files: str = lake.FILES,
    max_files: int = 10_000,
) -> None:
    """Take in all files of a landing table that no run has taken yet, at most ``max_files`` in one load.

    The file stream's checkpoint knows the files seen, of any age. A file that lands empty or
    damaged is taken too, with what can be read of it; a file changed after its intake is not
    read again but by ``replay``. A table whose folder does not exist yet leaves the ledger as it is.
    """
    declared = schema or landing_schema(table)
    _bronze_schema(declared)
    # Files may land with old times; the stream's default is to pass over those a week behind the newest.
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d")
    try:
        texts = lake.file_texts(reader, lake.landing_folder(root, table), files)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    writer = texts.writeStream.foreachBatch(lambda batch, epoch: _take(batch, base, declared, f"intake-{epoch:09d}"))
    writer.option("checkpointLocation", f"{base.rstrip('/')}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def replay(
    spark: SparkSession,
    root: str,
    table: str,
    base: str,
    path: str,
    schema: T.StructType | None = None,
    files: str = lake.FILES,
) -> None:
    """Read one file again, by its ledger path; its new rows replace its old ones in ``read_bronze``.

    Raises for a file the ledger does not hold, or that is no longer in the lake.
    """
    known = files_taken(spark, base).where(F.col("path") == path).select("path", (F.col("version") + 1).alias("version"))
    texts = lake.file_texts(spark.read, lake.landing_folder(root, table), files).where(F.col("__path") == path)
    if known.isEmpty() or texts.isEmpty():
        raise ValueError(f"{path} is not in the ledger, or no longer in the lake")
    _take(texts, base, schema or landing_schema(table), f"replay-{uuid.uuid4().hex}", known)


def _visible(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Bronze rows of finished loads but those of files taken again since.

    Both lists are short, of loads and of replayed files, and do not grow with the records.
    """
    entries = ledger(spark, base)
    newest = files_taken(spark, base).select("path", F.col("load").alias("newest"))
    again = entries.where("version > 0").select("path").distinct()
    replaced = entries.join(again, "path", "left_semi").join(newest, "path").where("load <> newest")
    rows = _read(spark, f"{base.rstrip('/')}/bronze", _bronze_schema(schema))
    rows = rows.join(entries.select("load").distinct(), "load", "left_semi")
    return rows.join(replaced.select(F.col("path").alias("_path"), "load"), ["_path", "load"], "left_anti")


def read_bronze(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None, origin: bool = False) -> DataFrame:
    """All records taken in, each once; with ``origin`` also the file (``_path``) and the load of each."""
    declared = schema or landing_schema(table)
    rows = _visible(spark, base, declared).where("_record")
    return rows.select(*declared.names, *(["_path", "load"] if origin else []))


def read_damaged(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """(path, unit): every array or line that could not be read, whole, with its file."""
    rows = _visible(spark, base, schema or landing_schema(table)).where("_damaged IS NOT NULL")
    return rows.select(F.col("_path").alias("path"), F.col("_damaged").alias("unit"))
