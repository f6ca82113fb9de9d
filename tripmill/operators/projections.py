"""Projections and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripmill import schemas


def common_names(df: DataFrame) -> DataFrame:
    """Service-specific timestamp columns under their common names."""
    return df.withColumnsRenamed(schemas.COMMON_NAMES)


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both frames have, in the order of ``left``."""
    other = set(right.columns)
    return [c for c in left.columns if c in other]


def cast_all(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Columns of a schema, cast to its types; with ``strict`` off bad values become null."""
    def cast(field: T.StructField) -> Column:
        col = F.col(field.name)
        col = col.cast(field.dataType) if strict else col.try_cast(field.dataType)
        return col.alias(field.name)
    return df.select(*[cast(f) for f in schema.fields])


def drop_columns(df: DataFrame, *cols: Column) -> DataFrame:
    """Drop by column reference, which cannot hit another column of the same spelling."""
    return df.drop(*cols)


def keep_or_default(df: DataFrame, columns: Sequence[str], default: str = "N/A") -> DataFrame:
    """Listed columns, with a default for nulls and for columns that do not exist.

    Numbers stay numbers: a text default cannot be stored in them, so they keep their nulls.
    """
    out = []
    for name in columns:
        if name not in df.columns:
            out.append(F.lit(default).alias(name))
        elif isinstance(df.schema[name].dataType, T.StringType):
            out.append(F.coalesce(F.col(name), F.lit(default)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "service_type") -> DataFrame:
    """Rows of all frames in their common columns, tagged with the mapping's keys.

    Columns are matched by name, duplicates are kept, and no shuffle happens.
    """
    parts = list(frames.values())
    names = [c for c in parts[0].columns if all(c in p.columns for p in parts[1:])]
    tagged = [df.select(*names, F.lit(key).alias(tag)) for key, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
