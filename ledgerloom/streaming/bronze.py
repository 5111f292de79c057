"""File stream over a landing folder, with a stored schema that can widen."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.pages import BROKEN, broken_pages, explode_pages, flatten_studies, page_rows


def with_lineage(df: DataFrame) -> DataFrame:
    """Arrival time and source file of every row."""
    return df.withColumns(
        {"_ingestion_ts": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def stream_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Flat JSON records as they land."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_lineage(reader.json(path))


def _page_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None, multi_line: bool) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return page_rows(reader, path, multi_line)


def stream_pages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, multi_line: bool = False
) -> DataFrame:
    """Nested pages as they land, one flat record per study."""
    pages = _page_stream(spark, path, max_files_per_trigger, multi_line).drop(BROKEN)
    return flatten_studies(explode_pages(with_lineage(pages)))


def stream_broken_pages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, multi_line: bool = False
) -> DataFrame:
    """The landed pages that do not parse, for a quarantine output of their own."""
    return broken_pages(_page_stream(spark, path, max_files_per_trigger, multi_line))


def load_schema(spark: SparkSession, location: str) -> tuple[T.StructType | None, int]:
    """The newest schema stored at a location and its number; (None, 0) if none is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/version=*/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path):
        return None, 0
    stored = spark.read.schema("schema string, version int").option("basePath", location).json(f"{location}/version=*")
    newest = stored.orderBy(F.col("version").desc()).first()
    return T.StructType.fromJson(json.loads(newest["schema"])), newest["version"]


def _wider(known: T.DataType, seen: T.DataType) -> T.DataType:
    """A type that holds both: structs and arrays by their parts, whole numbers in
    fractions, anything in text."""
    if known == seen or isinstance(seen, T.NullType):
        return known
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        return widen(known, seen)
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(_wider(known.elementType, seen.elementType))
    if {type(known), type(seen)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def widen(known: T.StructType | None, seen: T.StructType) -> T.StructType:
    """Known columns, each as wide as both ask for, then the columns not met before."""
    if known is None:
        return seen
    new = {f.name: f for f in seen.fields}
    kept = [T.StructField(f.name, _wider(f.dataType, new[f.name].dataType) if f.name in new else f.dataType) for f in known.fields]
    names = set(known.fieldNames())
    return T.StructType(kept + [f for f in seen.fields if f.name not in names])


RESCUED = "_rescued"


def fit(df: DataFrame, kept: T.StructType) -> DataFrame:
    """Widened columns back in the types of a table that is already written.

    A value that doesn't fit becomes null and stands as text in ``_rescued``, a map from
    column to value. Columns that ``kept`` doesn't name stay as they are.
    """
    types = {f.name: f.dataType for f in kept.fields}
    out, lost = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        wanted = types.get(f.name, f.dataType)
        plain = not isinstance(wanted, (T.StructType, T.ArrayType, T.MapType))
        if wanted == f.dataType or not plain or not isinstance(f.dataType, (T.StringType, T.DoubleType)):
            out.append(c)
            continue
        text = c.cast("string")
        # whole numbers that were read as fractions still fit
        value = text.try_cast(wanted) if isinstance(f.dataType, T.StringType) else F.when(c == F.floor(c), c.cast(wanted))
        out.append(value.alias(f.name))
        lost.append(F.when(c.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("key"), text.alias("value"))))
    found = F.array_compact(F.array(*lost)) if lost else F.array()
    rescued = F.map_from_entries(found.cast("array<struct<key: string, value: string>>"))
    return df.select(*out, F.when(F.size(found) > 0, rescued).alias(RESCUED))


def evolve_schema(
    spark: SparkSession, landing: str, location: str, modified_after: str | None = None
) -> T.StructType:
    """Brings the stored schema up to date with the landed files.

    Run before a triggered stream starts; the stream then reads with the wider schema
    and resumes from its own checkpoint. Types come from a pass over the JSON files that
    came since the newest one of the last pass, whose time is stored beside the schema;
    ``modified_after`` (a timestamp) sets another time.
    """
    known, version = load_schema(spark, location)
    after = modified_after or _seen_until(spark, location)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    newest = (files.option("modifiedAfter", after) if after else files).load(landing).agg(F.max("modificationTime")).first()[0]
    if newest is None:
        return known if known is not None else T.StructType([])
    reader = spark.read.option("modifiedAfter", after) if after else spark.read
    wide = widen(known, reader.json(landing).schema)
    if wide != known:
        (
            spark.range(1)
            .select(F.lit(wide.json()).alias("schema"))
            .coalesce(1)
            .write.json(f"{location}/version={version + 1}")
        )
    # a second less: files of the newest file's own second may still be landing
    until = F.date_format(F.lit(newest) - F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss")
    spark.range(1).select(until.alias("until")).coalesce(1).write.mode("append").json(f"{location}/seen")
    return wide


def _seen_until(spark: SparkSession, location: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/seen/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("until string").json(f"{location}/seen").agg(F.max("until")).first()[0]
