"""Landed registry responses: pages of nested studies to flat raw records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.fixed_values import QUERY_TERMS, RAW_COLUMNS, SOURCE_TAG
from ledgerloom.functions import join_list

# The parts of a study that are read; the file may hold more, or less.
STUDY_SCHEMA = """
    protocolSection struct<
      identificationModule: struct<nctId: string, briefTitle: string>,
      statusModule: struct<
        overallStatus: string,
        startDateStruct: struct<date: string>,
        completionDateStruct: struct<date: string>,
        lastUpdatePostDateStruct: struct<date: string>>,
      designModule: struct<
        phases: array<string>, studyType: string, enrollmentInfo: struct<count: bigint>>,
      descriptionModule: struct<briefSummary: string>,
      sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string>>,
      conditionsModule: struct<conditions: array<string>>>
"""

# A study read as text keeps every field it came with.
PAGE_SCHEMA = "studies array<string>, nextPageToken string"

# Where each raw column sits in a study.
STUDY_FIELDS = {
    "nct_id": "identificationModule.nctId",
    "brief_title": "identificationModule.briefTitle",
    "overall_status": "statusModule.overallStatus",
    "phase": "designModule.phases",
    "start_date": "statusModule.startDateStruct.date",
    "completion_date": "statusModule.completionDateStruct.date",
    "last_update_date": "statusModule.lastUpdatePostDateStruct.date",
    "study_type": "designModule.studyType",
    "enrollment_count": "designModule.enrollmentInfo.count",
    "conditions": "conditionsModule.conditions",
    "brief_summary": "descriptionModule.briefSummary",
    "lead_sponsor": "sponsorCollaboratorsModule.leadSponsor.name",
}


def raw_schema() -> T.StructType:
    """Schema of the flat raw record, for typed reads."""
    return T.StructType(
        [
            T.StructField(
                c, T.LongType() if c == "enrollment_count" else T.StringType(), c != "nct_id"
            )
            for c in RAW_COLUMNS
        ]
    )


BROKEN = "_broken_page"


def page_rows(reader, path: str | Sequence[str], multi_line: bool = False, fail: bool = False, more: str = "") -> DataFrame:
    """Parsed pages, and the text of those that do not parse (``_broken_page``).

    ``reader``: ``spark.read`` or ``spark.readStream``. One page per line by default, so large
    files split; ``multi_line`` reads files that are one page each. ``fail`` stops at the
    first broken page instead.
    """
    reader = reader.schema(f"{PAGE_SCHEMA}, {BROKEN} string{more}").option("multiLine", multi_line)
    reader = reader.option("mode", "FAILFAST" if fail else "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    return reader.json(path)


def broken_pages(pages: DataFrame) -> DataFrame:
    """The pages that did not parse: their text and their file."""
    # the parsed column is named so that Spark parses the page at all
    rows = pages.select(BROKEN, F.col("_metadata.file_path").alias("_source_file"), F.col("studies").isNull().alias("unread"))
    return rows.filter(F.col("unread") & F.col(BROKEN).isNotNull()).drop("unread")


def read_pages(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False, broken: str | None = None, fail: bool = False) -> DataFrame:
    """One row per study: its text (``raw_json``) and its fields (``study``).

    A page without studies gives no rows. A page that does not parse gives none either: name
    a folder as ``broken`` to have such pages appended there, or ask to ``fail``.
    """
    pages = page_rows(spark.read, path, multi_line, fail)
    if broken is not None:
        broken_pages(pages).write.mode("append").parquet(broken)
    return explode_pages(pages.drop(BROKEN))


def explode_pages(pages: DataFrame) -> DataFrame:
    """Studies of parsed pages; other columns of the pages are kept."""
    kept = [c for c in pages.columns if c not in ("studies", "nextPageToken")]
    return pages.select(*kept, F.explode("studies").alias("raw_json")).withColumn(
        "study", F.from_json("raw_json", STUDY_SCHEMA)
    )


def flatten_studies(studies: DataFrame, keep_arrays: bool = False) -> DataFrame:
    """The 12 fields of every study; a missing level gives NULL.

    ``keep_arrays`` adds the conditions as an array (``condition_list``): labels that
    contain a comma cannot be told apart in the joined text.
    """
    rest = [c for c in studies.columns if c not in ("study", "raw_json")]
    section = "study.protocolSection."
    fields = [
        (join_list(section + p) if c in ("phase", "conditions") else F.col(section + p)).alias(c)
        for c, p in STUDY_FIELDS.items()
    ]
    arrays = [F.col(section + STUDY_FIELDS["conditions"]).alias("condition_list")] if keep_arrays else []
    return studies.select(*fields, "raw_json", *arrays, *rest)


def with_ingest_metadata(
    df: DataFrame,
    ingestion_ts: str | Column,
    query_term: str | Column | None = None,
    source: str = SOURCE_TAG,
) -> DataFrame:
    """Adds arrival time (given, so runs can be repeated), search term and source tag.

    Without a term a ``query_term`` column already present is kept.
    """
    def column(v: str | Column) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    df = df.withColumns({"ingestion_ts": column(ingestion_ts), "source": F.lit(source)})
    return df if query_term is None else df.withColumn("query_term", column(query_term))


def read_terms(
    spark: SparkSession,
    root: str,
    terms: Sequence[str] = QUERY_TERMS,
    folders: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Pages landed per search term under ``root``/query_term=<term>, as one frame.

    One read over all terms; the term comes from the folder name.
    """
    paths = [f"{root}/query_term={t}" if folders is None else folders[t] for t in terms]
    pages = page_rows(spark.read.option("basePath", root), paths, multi_line, more=", query_term string")
    return explode_pages(pages.drop(BROKEN))
