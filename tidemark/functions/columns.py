"""Column-level helpers (projection, filters, scalar expressions).

All of these return Columns or DataFrames built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exclude_columns(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """Drop the given columns; unknown names are an error, not a silent no-op."""
    exclude = list(exclude)
    missing = [c for c in exclude if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.drop(*exclude)


def _as_bound(value, dtype: T.DataType) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        if isinstance(value, str):
            value = _dt.datetime.fromisoformat(value)
        elif isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
            value = _dt.datetime(value.year, value.month, value.day)
        target = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        return F.lit(value).cast(target)
    if isinstance(dtype, T.DateType):
        if isinstance(value, str):
            value = _dt.date.fromisoformat(value)
        return F.lit(value).cast("date")
    return F.lit(value)


def period_filter(df: DataFrame, column: str, lo, hi, inclusive_end: bool | None = None) -> DataFrame:
    """Rows of one period. Dates use the inclusive ``between(lo, hi)``; on
    timestamps the default is half-open ``[lo, hi)`` because an inclusive
    upper date would stop at midnight of the last day. The predicate is a
    plain comparison, so it reaches the Parquet scan as a pushed filter."""
    dtype = df.schema[column].dataType
    c = F.col(column)
    lo_c, hi_c = _as_bound(lo, dtype), _as_bound(hi, dtype)
    if inclusive_end is None:
        inclusive_end = not isinstance(dtype, (T.TimestampNTZType, T.TimestampType))
    return df.where((c >= lo_c) & ((c <= hi_c) if inclusive_end else (c < hi_c)))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant tag column (for example the period an append belongs to)."""
    return df.withColumn(name, F.lit(value))


def column_roles(df: DataFrame, target: str | None = None,
                 exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Split columns into categorical (strings) and numeric (any numeric
    type), leaving out the target and any excluded columns."""
    skip = set(exclude) | ({target} if target else set())
    cats, nums = [], []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.StringType):
            cats.append(field.name)
        elif isinstance(field.dataType, NUMERIC_TYPES):
            nums.append(field.name)
    return {"categorical": cats, "numeric": nums}


def clean_name(name: str) -> str:
    """Remove spaces and ')' and turn '(' into '-': the literal intent of the
    feature-name cleanup (the characters are not regex patterns here)."""
    return name.replace(" ", "").replace(")", "").replace("(", "-")


def clean_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"cleaned column names collide: {names}")
    return df.toDF(*names)


def zero_flag(c: str | Column) -> Column:
    """1 where the value is 0, else 0 (null stays null)."""
    return (col(c) == F.lit(0)).cast("int")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when the denominator is 0 or null (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def affine(c: str | Column, scale: float, offset: float) -> Column:
    """c * scale + offset, e.g. Celsius to Fahrenheit with (9/5, 32)."""
    return col(c) * F.lit(float(scale)) + F.lit(float(offset))


def celsius_to_fahrenheit(c: str | Column) -> Column:
    return col(c) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)


def null_where(c: str | Column, cond: Column) -> Column:
    """The value, or null where ``cond`` holds (fault injection or masking)."""
    return F.when(~F.coalesce(cond, F.lit(False)), col(c))


def linear_score(intercept: float, terms: Sequence[tuple[float, Column]], scale: float = 1.0) -> Column:
    """round-half-even(intercept + sum(w * x)) as int, then times ``scale``
    rounded half-even again when scale != 1. Boolean terms count as 0/1."""
    total = F.lit(float(intercept))
    for weight, term in terms:
        total = total + F.lit(float(weight)) * term.cast("double")
    score = F.bround(total, 0).cast("int")
    if scale != 1.0:
        score = F.bround(score * F.lit(float(scale)), 0).cast("int")
    return score


_JSON_PATH = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def parse_json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Extract top-level JSON fields from a string column with a fixed
    schema (``from_json``), e.g. {"model_name": "string", "version": "int"}."""
    for name in fields:
        if not _JSON_PATH.match(name):
            raise ValueError(f"bad field name {name!r}")
    ddl = ", ".join(f"`{k}` {v}" for k, v in fields.items())
    parsed = F.from_json(F.col(column), ddl)
    return df.select("*", *[parsed[k].alias(k) for k in fields])
