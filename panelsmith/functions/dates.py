"""Period and date helpers (as-of bounds, parts, labels parsed back to periods)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-letter month abbreviations in calendar order (month 1..12).
MONTH_ABBR = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Full month names in calendar order (month 1..12).
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Quarter-end month labels of a quarterly series and their month numbers.
QUARTER_MONTHS = {"Mar": 3, "Jun": 6, "Sep": 9, "Dec": 12}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _lookup(names: list[str]) -> Column:
    pairs = []
    for i, n in enumerate(names, start=1):
        pairs += [F.lit(n), F.lit(i)]
    return F.create_map(*pairs)


def prev_month_end(as_of: str | Column) -> Column:
    """Last day of the month before ``as_of``."""
    return F.last_day(F.add_months(_col(as_of), -1))


def day_before(as_of: str | Column) -> Column:
    return F.date_sub(_col(as_of), 1)


def yyyymmdd(d: str | Column) -> Column:
    """Date -> int like 20060430."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def from_yyyymmdd(i: str | Column) -> Column:
    """Int/str like 20060430 -> date; malformed input fails the job."""
    return F.to_date(_col(i).cast("string"), "yyyyMMdd")


def yyyymm(year: str | Column, month: str | Column) -> Column:
    """(year, month) -> 'yyyyMM' text key."""
    return F.concat(_col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def period_from_label(label: str | Column) -> tuple[Column, Column]:
    """'2006-04', '2006-M04' or '20060401' -> (year, month) ints.

    Dash forms are split on '-' and a leading 'M' of the month part is dropped;
    the compact form takes characters 1-4 and 5-6.
    """
    s = _col(label).cast("string")
    parts = F.split(s, "-")
    has_dash = F.instr(s, "-") > 0
    year = F.when(has_dash, F.get(parts, 0)).otherwise(F.substring(s, 1, 4)).cast("int")
    month = F.when(has_dash, F.regexp_replace(F.get(parts, 1), "^M", "")).otherwise(F.substring(s, 5, 2)).cast("int")
    return year, month


def month_label_parts(label: str | Column) -> tuple[Column, Column]:
    """'feb. 2006' / 'may 2006' / 'September 2010' -> (month, year).

    Anchored pattern on the first three letters; an unknown month gives NULL.
    """
    s = F.lower(F.trim(_col(label)))
    pat = r"^([a-z]{3})[a-z]*\.? +(\d{4})$"
    abbr = F.regexp_extract(s, pat, 1)
    year = F.regexp_extract(s, pat, 2)
    month = _lookup(MONTH_ABBR)[abbr]
    return month.cast("int"), F.when(year != "", year.cast("int"))


def month_from_name(name: str | Column, strict: bool = True) -> Column:
    """Full month name -> 1..12; an unknown name fails the job when strict."""
    m = _lookup(MONTH_NAMES)[F.lower(F.trim(_col(name)))]
    if strict:
        return F.when(m.isNotNull(), m).otherwise(
            F.raise_error(F.concat(F.lit("unknown month name: "), _col(name).cast("string")))
        ).cast("int")
    return m.cast("int")


def quarter_month(label: str | Column) -> Column:
    """'Mar'/'Jun'/'Sep'/'Dec' -> 3/6/9/12, anything else NULL."""
    expr = None
    for k, v in QUARTER_MONTHS.items():
        expr = F.when(_col(label) == k, F.lit(v)) if expr is None else expr.when(_col(label) == k, F.lit(v))
    return expr.cast("int")


def month_start(year: str | Column, month: str | Column) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))
