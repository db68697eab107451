"""Nested records to flat rows: renames, clean text, flattening, rest-as-JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import clean_name

# Fixed value: zero-width and separator characters removed from text.
INVISIBLE = r"[\u200B-\u200F\u2028-\u202F\uFEFF]"


def rename_columns(df: DataFrame, style: str) -> DataFrame:
    """Normalise column names; of columns that become alike the last one stays."""
    winners = {clean_name(c, style): i for i, c in enumerate(df.columns)}
    numbered = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return numbered.select(*(F.col(f"_c{i}").alias(name) for name, i in winners.items()))


def clean_records(df: DataFrame, style: str = "contact", opaque: str = "data") -> DataFrame:
    """Normalise names and text at every level; a field called ``opaque`` becomes JSON."""
    numbered = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    cleaned = {
        clean_name(f.name, style): _clean_field(F.col(f"_c{i}"), f, style, opaque)
        for i, f in enumerate(df.schema.fields)
    }
    return numbered.select(*(c.alias(name) for name, c in cleaned.items()))


def _clean_field(col: Column, field: T.StructField, style: str, opaque: str) -> Column:
    if field.name == opaque and not isinstance(field.dataType, T.StringType):
        return F.to_json(col) if _is_container(field.dataType) else col.cast("string")
    if field.name == opaque:
        return col
    return _clean_value(col, field.dataType, style, opaque)


def _clean_value(col: Column, dtype: T.DataType, style: str, opaque: str) -> Column:
    if isinstance(dtype, T.StringType):
        return F.regexp_replace(col, INVISIBLE, "")
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _clean_value(x, dtype.elementType, style, opaque))
    if isinstance(dtype, T.StructType):
        inner = {
            clean_name(f.name, style): _clean_field(col.getField(f.name), f, style, opaque) for f in dtype.fields
        }
        return F.when(col.isNotNull(), F.struct(*(c.alias(name) for name, c in inner.items())))
    return col


def _is_container(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def text_columns(df: DataFrame) -> DataFrame:
    """Every column as text: containers as JSON, empty ones and NULL as NULL."""
    return df.select(*(_as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))


def _as_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, F.to_json(col))
    if isinstance(dtype, T.StructType):
        return F.when(F.coalesce(*(col.getField(f.name).cast("string") for f in dtype.fields)).isNotNull(), F.to_json(col))
    return col.cast("string")


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct columns replaced by their leaves, named by path."""

    def leaves(col: Column, name: str, dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from leaves(col.getField(f.name), f"{name}{sep}{f.name}", f.dataType)
        else:
            yield col.alias(name)

    return df.select(*(leaf for f in df.schema.fields for leaf in leaves(F.col(f"`{f.name}`"), f.name, f.dataType)))


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select(*(c for c in wanted if c in df.columns))


def keys_and_rest(df: DataFrame, keys: Sequence[str], rest: str = "data") -> DataFrame:
    """Key columns (NULL when the feed lacks one) and all others as one JSON text."""
    others = [c for c in df.columns if c not in keys]
    key_cols = [F.col(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in keys]
    return df.select(*key_cols, F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias(rest))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames under the union of their columns."""
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
