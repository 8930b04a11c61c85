"""Column-level shaping: selection, renaming, lineage, alignment, type inference, sort order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.functions.coerce import nan_to_null, to_integer, to_number, typed, unknown_if_missing
from dimlathe.registry import TableSpec


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project and rename: ``names`` maps source column to result column."""
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in names.items()))


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*(c for c in columns if c in df.columns))


def first_existing(df: DataFrame, *candidates: str) -> Column:
    """The first candidate column that exists; decided when the plan is built."""
    return F.col(next(c for c in candidates if c in df.columns))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def ensure_schema(df: DataFrame | None, schema: T.StructType, spark=None) -> DataFrame:
    """Guarantee the declared columns: absent ones are typed NULLs, no frame at all is an empty frame."""
    if df is None:
        return spark.createDataFrame([], schema)
    return df.select(
        *(
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def guarded(df: DataFrame, required: Sequence[str], schema: T.StructType, transform) -> DataFrame:
    """Apply ``transform``, or return the empty declared table if a required column is missing."""
    if missing_columns(df, required):
        return df.sparkSession.createDataFrame([], schema)
    return ensure_schema(transform(df), schema)


def stamp_lineage(
    df: DataFrame, source: str, load_ts: datetime, lineage: str = "source", loaded_at: str = "created_at"
) -> DataFrame:
    """Add load time and source. The time is an argument, so reruns give the same rows."""
    return df.withColumns(
        {loaded_at: F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz"), lineage: F.lit(source)}
    )


def conform(df: DataFrame, spec: TableSpec, show_unknown: bool = True) -> DataFrame:
    """Typed columns in declared order; a missing column is an error."""
    held = {f.name: f.dataType for f in df.select(*spec.columns).schema}
    typed_columns = {c: typed(c, held[c], t) for c, t in spec.columns.items()}
    if show_unknown:
        typed_columns |= {c: unknown_if_missing(typed_columns[c]) for c in spec.unknown_text}
    return df.select(*(column.alias(c) for c, column in typed_columns.items()))


def align(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name in the first frame's order; columns missing on either side are NULL."""
    return first.unionByName(second, allowMissingColumns=True)


def numeric_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column, the share of all rows (NULLs count as failures) that parse as a number.

    One row, one pass over the table, whatever the number of columns.
    """
    return df.agg(*(F.avg(to_number(f"`{c}`").isNotNull().cast("int")).alias(c) for c in columns))


def infer_numeric(
    df: DataFrame, share: float = 0.5, always: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Turn text columns into doubles where more than ``share`` of all rows parse.

    ``always`` names columns to convert whatever their share. Only the one-row summary reaches the driver.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df, []
    ratios = numeric_share(df, text).first().asDict()
    numeric = [c for c in text if c in always or (ratios[c] or 0.0) > share]
    return df.withColumns({c: to_number(f"`{c}`") for c in numeric}), numeric


def null_nans(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns means missing; make it NULL at ingest."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(f"`{c}`") for c in floating}) if floating else df


def numeric_text_order(c: str) -> Column:
    """Sort key for numbers held as text; NULL and non-numbers last."""
    return to_integer(c).asc_nulls_last()
