"""The JSON lake: ``{root}/{table}/{YYYY}/{MM}/{DD}/{HH}/{mm}/*.json`` (or ``.txt``), either also gzipped (``.gz``)."""

from __future__ import annotations

import calendar
import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.schemas import landing_schema


def landing_folder(
    root: str, table: str, start: datetime.date | None = None, end: datetime.date | None = None
) -> str:
    """Folder of a table, or the pattern of its day folders if both bounds are given.

    Whole years and months collapse into one alternative, so the pattern grows with the
    number of months in the range and listing touches only folders inside it. A folder may
    be named ``2026`` or ``yyyy=2026``.
    """
    base = f"{root.rstrip('/')}/{table}"
    if start is None or end is None:
        return base
    if start > end:
        raise ValueError("start must not be after end")
    parts: list[str] = []
    year, month = start.year, start.month
    while (year, month) <= (end.year, end.month):
        if month == 1 and start <= datetime.date(year, 1, 1) and datetime.date(year, 12, 31) <= end:
            parts.append(f"*{year}")
            year += 1
            continue
        last = calendar.monthrange(year, month)[1]
        first_day = start.day if (year, month) == (start.year, start.month) else 1
        last_day = end.day if (year, month) == (end.year, end.month) else last
        if (first_day, last_day) == (1, last):
            parts.append(f"*{year}/*{month:02d}")
        else:
            parts += [f"*{year}/*{month:02d}/*{day:02d}" for day in range(first_day, last_day + 1)]
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{base}/{parts[0]}" if len(parts) == 1 else f"{base}/{{{','.join(parts)}}}"


#: Files of a landing table; folders may be named ``2026`` or ``yyyy=2026``.
FILES = "*.{json,txt,json.gz,txt.gz}"
_PART = r"/(?:[a-z]+=)?(\d{2})"
LANDED = rf"^(?:[a-z]+=)?(\d{{4}}){_PART}{_PART}{_PART}{_PART}/[^/]+$"


def landed_at(path: Column) -> Column:
    """Landing time of a file by its folders; NULL outside minute folders.

    The last six parts of the path are matched once; what does not match holds slashes and is no timestamp.
    """
    tail = F.substring_index(path, "/", -6)
    return F.regexp_replace(tail, LANDED, "$1-$2-$3 $4:$5:00").try_cast("timestamp")


def file_texts(reader, folder: str, files: str) -> DataFrame:
    """Files below a folder as (value, path), for a batch or a stream reader; minute folders are listed in parallel."""
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    return reader.text(folder, wholetext=True).select("value", F.col("_metadata.file_path").alias("__path"))


#: Larger files are not held whole unless they are arrays: files of lines are split over tasks.
WHOLE_BYTES = 16 << 20
#: The same for gzipped files. They cannot be split, so a writer should bound them.
WHOLE_GZIP_BYTES = 64 << 10
#: Most array files above that size that are named in a filter; more are joined by path.
MOST_PATHS = 10_000


def _text_units(texts: DataFrame, keep_empty: bool = False) -> DataFrame:
    """(value, path) of whole files to (path, unit); the layout is told by each file's first character."""
    lines = F.filter(F.split("value", "\n"), lambda line: line.rlike(r"\S"))
    is_array = F.regexp_extract("value", r"^\s*(\[)", 1) == "["
    units = F.when(is_array, F.array("value")).otherwise(F.transform(lines, lambda line: F.concat(F.lit("["), line, F.lit("]"))))
    return texts.select("__path", (F.explode_outer if keep_empty else F.explode)(units).alias("__unit"))


def _file_units(spark: SparkSession, folder: str, files: str, keep: Column | None = None) -> DataFrame:
    """(path, unit) of the files below a folder, or of those whose ``__path`` is to be kept.

    Files up to WHOLE_BYTES are read whole, many to a task. Larger ones take a pass over their lines
    that tells arrays by the first character that is no white space; the others are read by the
    splittable text reader, whatever their size, and only large arrays are one task's text.
    Size and path prune the list of files, so no file is opened in vain.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    path = F.col("_metadata.file_path")
    most = F.when(path.endswith(".gz"), min(WHOLE_GZIP_BYTES, WHOLE_BYTES)).otherwise(WHOLE_BYTES)
    meta = path.alias("__path"), (F.col("_metadata.file_size") <= most).alias("__small")
    whole = reader.text(folder, wholetext=True).select("value", *meta)
    lines = reader.text(folder, lineSep="\n").select("value", *meta, F.col("_metadata.file_block_start").alias("__at"))
    if keep is not None:
        whole, lines = whole.where(keep), lines.where(keep)
    units = _text_units(whole.where("__small"))
    lines = lines.where("NOT __small").withColumn("__first", F.regexp_extract("value", r"^\s*(\S)", 1))
    # Lines of a file's first block keep their order inside a task; the last bit of a place says whether an array starts there.
    place = F.monotonically_increasing_id() * 2 + (F.col("__first") == "[").cast("long")
    starts = lines.where("__at = 0 AND __first <> ''").select("__path", place.alias("place"))
    arrays = starts.groupBy("__path").agg(F.min("place").alias("place")).where("place % 2 = 1").select("__path")
    if lines._jdf.toJavaRDD().getNumPartitions() == 0:
        return units
    named = [row[0] for row in arrays.take(MOST_PATHS + 1)]
    if len(named) <= MOST_PATHS:
        by_line = lines.where(~F.col("__path").isin(named)) if named else lines
        by_file = whole.where(F.col("__path").isin(named)) if named else None
    else:
        by_line, by_file = lines.join(arrays, "__path", "left_anti"), whole.join(arrays, "__path", "left_semi")
    split = by_line.where("__first <> ''").select("__path", F.concat(F.lit("["), "value", F.lit("]")).alias("__unit"))
    units = units.unionByName(split)
    return units if by_file is None else units.unionByName(_text_units(by_file))


def parsed_units(texts: DataFrame, schema: T.StructType, keep_empty: bool = False) -> DataFrame:
    """Whole files as (path, ``__unit``, ``__rows``, ``__bad``): a unit is an array file, or one line of a file of lines.

    The layout is told by the file's first character, so it does not matter how it was written.
    A file without a unit is left out, or has one row with a NULL unit that is not bad (``keep_empty``).
    """
    return _parsed(_text_units(texts, keep_empty), schema)


def _parsed(units: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``__rows`` and ``__bad``: a unit that is no JSON, or holds something other than objects, is bad."""
    rows = units.withColumn("__rows", F.from_json("__unit", T.ArrayType(schema)))
    unread = F.col("__rows").isNull() | F.exists("__rows", lambda r: r.isNull())
    return rows.withColumn("__bad", F.col("__unit").isNotNull() & unread)


def _records(
    units: DataFrame, schema: T.StructType, skip_damaged: bool, version: str | None, origin: str | None = None
) -> DataFrame:
    parsed = _parsed(units, schema)
    if skip_damaged:
        rows = F.filter(F.coalesce("__rows", F.array()), lambda r: r.isNotNull())
    else:
        message = F.concat(F.lit("damaged landing file "), "__path", F.lit(": "), F.substring("__unit", 1, 200))
        rows = F.when(F.col("__bad"), F.raise_error(message).cast(T.ArrayType(schema))).otherwise(F.col("__rows"))
    own = [landed_at(F.col("__path")).alias(version)] if version else []
    own += [F.col("__path").alias(origin)] if origin else []
    names = [name for name in (version, origin) if name]
    # An inner generator would have its rows parsed for a filter on their number, and then again.
    listed = parsed.select(*own, rows.alias("__rows")).select(*names, F.posexplode_outer("__rows").alias("__at", "__row"))
    return listed.where("__at IS NOT NULL").select("__row.*", *names)


def read_landing(
    spark: SparkSession,
    root: str,
    table: str,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    schema: T.StructType | None = None,
    files: str = FILES,
    skip_damaged: bool = False,
    version: str | None = None,
    origin: str | None = None,
) -> DataFrame:
    """All records of a landing table; a table that does not exist reads as empty.

    Files hold a JSON array or one object per line; both may lie side by side. The schema is
    declared, so there is no inference pass, and an absent column is NULL. A file of lines may have
    any size and is split over tasks, unless it is gzipped; an array is one task's text (2 GB at most). The first damaged file,
    or line of a file of lines, fails the read, unless ``skip_damaged``; ``damaged`` lists them.
    Either day bound may be left open; with both, only the folders between them are listed.
    ``version`` names a column to add with the landing time, ``origin`` one with the file's path.
    """
    declared = schema or landing_schema(table)
    day = F.to_date(landed_at(F.col("__path")))
    keep = None
    if (start is None) != (end is None):
        keep = day >= F.lit(start) if end is None else day <= F.lit(end)
    try:
        units = _file_units(spark, landing_folder(root, table, start, end), files, keep)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        own = [T.StructField(version, T.TimestampType())] if version else []
        own += [T.StructField(origin, T.StringType())] if origin else []
        return spark.createDataFrame([], T.StructType([*declared.fields, *own]))
    return _records(units, declared, skip_damaged, version, origin)


def damaged(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None, files: str = FILES) -> DataFrame:
    """(path, units): files of a landing table with the number of their arrays or lines that cannot be read."""
    parsed = _parsed(_file_units(spark, landing_folder(root, table), files), schema or landing_schema(table))
    return parsed.where("__bad").groupBy(F.col("__path").alias("path")).agg(F.count(F.lit(1)).alias("units"))


def stream_landing(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    files: str = FILES,
    max_files: int = 10_000,
    skip_damaged: bool = False,
    version: str | None = None,
) -> DataFrame:
    """The landing table as a stream of new files: each file is read once, not on every run."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    texts = file_texts(reader, landing_folder(root, table), files)
    return _records(_text_units(texts), schema or landing_schema(table), skip_damaged, version)
