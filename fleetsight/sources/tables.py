"""SC5 / SC6: staged Parquet tables, and tables or folders that may not exist yet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.session import session_like

ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A staged table: a catalog table name or a Parquet folder."""
    if "/" not in location and spark.catalog.tableExists(location):
        return spark.table(location)
    return spark.read.parquet(location)


# fixed values: Spark's file formats with a first-generation reader, Parquet left out
_FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session in which ``count``, ``min`` and ``max`` over whole Parquet tables come from the files' footers.

    Only Spark's second reader does that. Such an aggregate reads no data pages: its cost grows with
    the files, not with the rows. Strings, timestamps and nested columns have no pushed ``min`` or ``max`` and are scanned.
    """
    return session_like(spark, **_FOOTER_CONF)


def footer_extent(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(total_rows, first, last) of a staged table, from its footers."""
    table = footer_session(spark).read.parquet(path)
    return table.agg(F.count(F.lit(1)).alias("total_rows"), F.min(column).alias("first"), F.max(column).alias("last"))


def table_rows(spark: SparkSession, path: str) -> int:
    """The number of rows of a staged table, from its footers."""
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1))).first()[0]


def is_absent(error: AnalysisException) -> bool:
    """Whether Spark's error condition says that a path or table isn't there."""
    return error.getCondition() in ABSENT


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked through Spark's own file access (nothing is read)."""
    from fleetsight.sources.csv import literal_path

    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal_path(path))
    except AnalysisException as error:
        if is_absent(error):
            return False
        raise
    return True


def load_optional_tables(
    spark: SparkSession, locations: Mapping[str, str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Open each table that exists; return them and the names of the missing ones."""
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name, location in locations.items():
        try:
            found[name] = read_table(spark, location)
        except AnalysisException as error:
            if not is_absent(error):
                raise
            missing.append(name)
    return found, missing
