"""SC1 / SC2 / ST1: header-aware reading of drifting CSV batches.

Spark applies one header to every file of a single CSV read, so files whose columns were added or
reordered would silently swap values. We first read each file's header line (a distributed job
that returns one short row per file), then issue one CSV read per distinct header and conform
each to the target schema before the union.

Paths are metadata and are held on the driver, as Spark's own file index holds them.
"""

from __future__ import annotations

import csv as pycsv
import re
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetsight.sources.conform import conform_to_schema, union_all

LINEAGE_COLUMN = "source_file"
_WHOLE_FILE = str(1 << 50)  # a split of at most so many bytes: one for each file


def literal_path(path: str) -> str:
    """A path as Spark's readers take it when its name holds glob characters."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def discover_batch_files(spark: SparkSession, root: str, batches: Sequence[str] = (), pattern: str = "*.csv") -> list[str]:
    """Files of the named batch folders under ``root``, or of every folder when none is named.

    Only files one level down (``root/<batch>/<file>``) are taken, so loose files beside the
    batch folders are skipped. The listing is Spark's own (binaryFile source without content).
    """
    base = literal_path(root.rstrip("/"))
    globs = [f"{base}/{literal_path(b)}/{pattern}" for b in batches] if batches else [f"{base}/*/{pattern}"]
    listing = spark.read.format("binaryFile").load(globs).select("path")
    return sorted(r.path for r in listing.collect())


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First line of each file, through Spark's text source (any file system or compression it reads).

    Each file is one split of one task, and a task stops after its first line, so of a large file
    only the first block is fetched. A file without any line isn't in the result; any failure to
    read one is raised.
    """
    if not paths:
        return {}

    # a closure, so it is pickled by value and executors need no copy of this package
    def first_line(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    # a session of its own, so that the split sizes of the caller's session stay as they are
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.files.minPartitionNum", str(len(paths)))
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = probe.read.text([literal_path(p) for p in paths]).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = lines.mapInArrow(first_line, "path string, value string").collect()
    # the metadata column gives paths as URIs
    return {unquote(r.path): r.value.removeprefix("﻿") for r in rows}


def header_names(header: str) -> list[str]:
    """The column names of a header line; a repeated name (in any case) is numbered, so the first one counts."""
    names, seen = [], defaultdict(int)
    for name in next(pycsv.reader([header]), []):
        seen[name.lower()] += 1
        names.append(name if seen[name.lower()] == 1 else f"{name}__repeat_{seen[name.lower()]}")
    return names


def read_csv_batches(
    spark: SparkSession,
    paths: Sequence[str],
    target: StructType,
    with_lineage: bool = False,
) -> DataFrame | None:
    """Read CSV files with their own headers, conform each header group, union them.

    Returns None when there is nothing to read (an empty micro-batch).
    """
    if not paths:
        return None
    headers = file_headers(spark, paths)
    groups: dict[str, list[str]] = defaultdict(list)
    for path, header in headers.items():
        groups[header.strip()].append(path)
    frames = []
    for header in sorted(groups):
        # the header is already known: its columns, all strings, are the read schema (no inference job)
        schema = StructType([StructField(n, StringType(), True) for n in header_names(header)])
        raw = spark.read.option("header", True).schema(schema).csv([literal_path(p) for p in sorted(groups[header])])
        if with_lineage:
            raw = raw.withColumn(LINEAGE_COLUMN, F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
            fields = list(target.fields) + [StructField(LINEAGE_COLUMN, StringType(), True)]
            frames.append(conform_to_schema(raw, StructType(fields)))
        else:
            frames.append(conform_to_schema(raw, target))
    if not frames:
        return None
    return union_all(frames)
