"""Column-level helpers: names, strings, casts, overrides and fills of constants.

Everything returns Column expressions or applies ``select``/``withColumns``, so
the work stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name (one projection, no data pass)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def norm_string(c: str | Column, space: str = "_") -> Column:
    """lower(trim(c)) with runs of whitespace replaced by ``space``."""
    return F.regexp_replace(F.lower(F.trim(_col(c))), r"\s+", space)


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Turn float NaN into SQL NULL so that only NULL means missing downstream."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    targets = [c for c in (cols or floating) if c in floating]
    if not targets:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in targets})


def strict_cast(c: str | Column, to: str) -> Column:
    """Cast that fails the job on malformed input (ANSI mode)."""
    return _col(c).cast(to)


def lenient_cast(c: str | Column, to: str) -> Column:
    """Cast that turns malformed input into NULL (pandas ``errors='coerce'``)."""
    return _col(c).try_cast(to)


def invert_when(value: str | Column, invert: Column) -> Column:
    """1/value where ``invert`` holds, value otherwise; 1/0 gives NULL."""
    v = _col(value)
    return F.when(invert, F.try_divide(F.lit(1.0), v)).otherwise(v)


def quote_suffix_invert(series_id: str | Column, value: str | Column, suffix: str = "US", start: int = 6) -> Column:
    """Invert a rate whose series id ends in the base-currency suffix.

    The id is tested from character ``start`` (1-based) to the end, e.g.
    ``DEXJPUS`` -> 'US' -> inverted, ``DEXUSAL`` -> 'AL' -> unchanged.
    """
    tail = F.substr(_col(series_id), F.lit(start))
    return invert_when(value, tail == F.lit(suffix))


def override_chain(target: str | Column, rules: Sequence[tuple[Column, Column]]) -> Column:
    """First matching rule wins; no match keeps ``target``.

    ``rules`` is a list of (condition, value) pairs, evaluated in order.
    """
    if not rules:
        return _col(target)
    expr = None
    for cond, val in rules:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(_col(target))


def zero_fill(df: DataFrame, cols: Iterable[str], value=0) -> DataFrame:
    """Replace NULL by a constant in the given columns."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def any_null(cols: Iterable[str | Column]) -> Column:
    """True when any of the columns is NULL."""
    return reduce(or_, [_col(c).isNull() for c in cols])


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where any column (or any of ``subset``) is NULL or NaN."""
    return df.dropna(how="any", subset=subset)


def select_slice(df: DataFrame, first: str, last: str) -> DataFrame:
    """Inclusive label slice of columns, like ``pdf.loc[:, first:last]``."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    return df.select(*names[i : j + 1])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def round_half_up(c: str | Column, digits: int = 4) -> Column:
    """Round a double half away from zero at ``digits`` decimals, returning a
    double. The value is first snapped to 8 decimals as a DECIMAL, so two
    engines whose sums differ in the last bits still agree on exact halves
    (an average of 2-decimal prices over 8 rows ends in 5 at the 5th decimal)."""
    return F.round(_col(c).cast("decimal(38,8)"), digits).cast("double")


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (for stable comparisons and exports)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out[f.name] = round_half_up(F.col(f.name), digits)
    return df.withColumns(out) if out else df
