"""SC3 / U1: conform a drifting frame to a target schema; union frames by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def conform_to_schema(raw: DataFrame, target: StructType) -> DataFrame:
    """Cast present columns, add absent ones as typed NULL, drop extras, follow target order.

    Raw text is cast with ``try_cast`` so a malformed value becomes NULL instead of failing the
    job under ANSI mode; the cleaning step then decides what a NULL means.
    """
    present = set(raw.columns)
    cols = []
    for field in target.fields:
        if field.name in present:
            source = F.col(_quoted(field.name))
            source_type = raw.schema[field.name].dataType
            expr = source if source_type == field.dataType else source.try_cast(field.dataType)
            cols.append(expr.alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return raw.select(*cols)


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name. An empty list is an error, not an empty frame."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
