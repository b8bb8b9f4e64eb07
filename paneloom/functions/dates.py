"""Day, week, month and second arithmetic (SC1-SC6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Patterns tried after the ISO form, first hit wins.
DAY_PATTERNS = ("MM/dd/yyyy", "yyyy/MM/dd", "dd MMM yyyy", "MMM dd, yyyy", "yyyyMMdd")


def parse_day(col: Column | str, patterns: Sequence[str] = DAY_PATTERNS) -> Column:
    """Lenient text-to-day parse; whatever cannot be read becomes null."""
    text = F.trim(_col(col).cast("string"))
    # A compact yyyyMMdd would otherwise be read as a huge year by the timestamp cast.
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}(-\d{1,2})?([ T].*)?$"), text.try_cast("timestamp").cast("date"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])


def parse_year(col: Column | str) -> Column:
    """An integer year becomes the first of January of that year."""
    year = _col(col).try_cast("int")
    return F.when(year.between(1, 9999), F.make_date(year, F.lit(1), F.lit(1)))


def iso_day(col: Column | str) -> Column:
    """The ISO day contained in a text, as text; empty when there is none."""
    return F.regexp_extract(_col(col).cast("string"), r"(\d{4}-\d{2}-\d{2})", 1)


def format_day(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd")


def week_start(col: Column | str) -> Column:
    """Monday of the Monday-to-Sunday week."""
    return F.date_trunc("week", _col(col)).cast("date")


def year_month(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM")


def floor_second(col: Column | str) -> Column:
    return F.date_trunc("second", _col(col))


def day_lag(earlier: Column | str, later: Column | str) -> Column:
    """Days from ``earlier`` to ``later``."""
    return F.datediff(_col(later), _col(earlier))


def utc_now() -> Column:
    """The instant of the query or micro-batch (SC15)."""
    return F.current_timestamp()


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
