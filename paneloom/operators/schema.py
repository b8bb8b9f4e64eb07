"""Projections and schema operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paneloom.functions.text import underscore_expr, underscore_name

# Accepted spellings of the core columns.
COLUMN_ALIASES = {
    "iso_code": "ISO_Code",
    "date": "Date",
    "confirmed": "Confirmed",
    "deaths": "Deaths",
    "continent": "Continent",
}

# Candidate names in order of preference.
DATE_CANDIDATES = ("date", "Date", "year")
ISO_CANDIDATES = ("iso_code", "ISO_Code", "country_code")
PLACE_CANDIDATES = ("country", "location", "entity")

# Names that are never added to a panel by an enrichment.
KEY_LIKE = (
    "ISO_Code", "Date", "country", "location", "entity", "continent",
    "Continent", "Country", "year", "date", "iso_code", "country_code",
)

# Columns that mark a table as broken down below country and day.
BREAKDOWN_COLUMNS = ("age_group", "age", "vaccine", "manufacturer", "state")


def normalize_columns(df: DataFrame, aliases: Mapping[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Alias spellings to canonical names; where both exist the canonical value wins per row."""
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])
    at = {name: F.col(f"_{i}") for i, name in enumerate(names)}
    out: list[Column] = []
    for name in names:
        canonical = aliases.get(name)
        if canonical is None:
            old = next((o for o, n in aliases.items() if n == name and o in at), None)
            out.append((at[name] if old is None else F.coalesce(at[name], at[old])).alias(name))
        elif canonical not in at:
            out.append(at[name].alias(canonical))
    return flat.select(*out)


def pick_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate that the table has."""
    return next((c for c in candidates if c in df.columns), None)


def sniff_column(
    df: DataFrame, token: str, parser: Callable[[Column], Column] | None = None, share: float = 0.5
) -> str | None:
    """First column whose name contains ``token``; failing that, the first of whose values, blank ones
    aside, more than ``share`` can be parsed. All rows decide, in one aggregate."""
    named = next((c for c in df.columns if token in c.lower()), None)
    if named is not None or parser is None:
        return named
    text = {c: F.col(c).cast("string") for c in df.columns}
    readable = [F.count(parser(v)).alias(f"r{i}") for i, v in enumerate(text.values())]
    filled = [F.count_if(F.trim(v) != "").alias(f"n{i}") for i, v in enumerate(text.values())]
    hits = df.agg(*readable, *filled).first()
    return next((c for i, c in enumerate(text) if hits[f"r{i}"] > share * hits[f"n{i}"]), None)


def pick_low_cardinality(df: DataFrame, cols: Sequence[str] = ("class", "category"), limit: int = 20) -> str | None:
    """First column with at most ``limit`` distinct values; a column is read until it shows one more."""
    for c in (c for c in cols if c in df.columns):
        if df.select(c).dropna().distinct().limit(limit + 1).count() <= limit:
            return c
    return None


def pick_populated(df: DataFrame, cols: Sequence[str], k: int) -> str | None:
    """First column that exists with more than ``k`` non-null values."""
    return next(iter(populated(df, cols, k)), None)


def populated(df: DataFrame, cols: Sequence[str], k: int) -> list[str]:
    """Every existing column with more than ``k`` non-null values, in the given order, by one job."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return []
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in present]).first()
    return [c for c in present if counts[c] > k]


def to_double(df: DataFrame, except_: Sequence[str] = ()) -> DataFrame:
    """Every column outside ``except_`` as double, unreadable values as null, in one projection."""
    return df.select(*[df[c] if c in except_ else as_double(df, c).alias(c) for c in df.columns])


def as_double(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = df[name]
    if isinstance(kind, (T.StringType, T.NumericType, T.BooleanType)):
        return value.try_cast("double")
    return F.lit(None).cast("double")


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every floating column."""
    floating = (T.DoubleType, T.FloatType)

    def finite(field: T.StructField) -> Column:
        value = df[field.name]
        if not isinstance(field.dataType, floating):
            return value
        bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
        return F.when(~bad, value).alias(field.name)

    return df.select(*[finite(f) for f in df.schema.fields])


def drop_columns(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop the listed columns that exist; also return those that were absent."""
    return df.drop(*[n for n in names if n in df.columns]), [n for n in names if n not in df.columns]


def rename_if_free(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename where the old name exists and the new one is free."""
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in df.columns and n not in df.columns})


def drop_derived(df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """Drop columns of an earlier run, so that a re-run gives the same table."""
    return df.drop(*[c for c in df.columns if c in names or c.startswith(tuple(prefixes))])


def empty_columns(df: DataFrame) -> list[str]:
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value; one aggregate decides for all of them."""
    return df.drop(*empty_columns(df))


def columns_like(df: DataFrame, tokens: Sequence[str] = (), prefixes: Sequence[str] = ()) -> list[str]:
    """Names that contain one of ``tokens`` or start with one of ``prefixes``."""
    return [c for c in df.columns if any(t in c for t in tokens) or (prefixes and c.startswith(tuple(prefixes)))]


def with_default(df: DataFrame, name: str, *fallbacks: str | int | float, value: object = None) -> DataFrame:
    """``name`` filled from the first non-null existing fallback column, then from ``value``."""
    sources = [F.col(c) for c in (name, *fallbacks) if c in df.columns]
    if value is not None:
        sources.append(F.lit(value))
    return df.withColumn(name, F.coalesce(*sources)) if sources else df


def explode_columns(df: DataFrame, cols: Sequence[str], name: str = "source", value: str = "value") -> DataFrame:
    """Several columns of one meaning to one row per non-blank value."""
    rest = [c for c in df.columns if c not in cols]
    long = df.unpivot(rest, list(cols), name, value)
    return long.withColumn(value, F.trim(F.col(value))).filter(F.col(value) != "")


def new_columns(left: DataFrame | Sequence[str], right: DataFrame | Sequence[str], skip: Sequence[str] = KEY_LIKE) -> list[str]:
    """Columns of ``right`` that ``left`` lacks and that are not key-like."""
    have = set(left if isinstance(left, (list, tuple)) else left.columns)
    names = right if isinstance(right, (list, tuple)) else right.columns
    return [c for c in names if c not in have and c not in skip]


def breakdown_columns(df: DataFrame) -> list[str]:
    return [c for c in BREAKDOWN_COLUMNS if c in df.columns]


def is_disaggregated(df: DataFrame) -> bool:
    return bool(breakdown_columns(df))


#: Most names that become columns; more than these stay rows.
MAX_NAMES = 2000


def few_names(df: DataFrame, col: str, limit: int = MAX_NAMES) -> list[str] | None:
    """Distinct values, sorted, where there are at most ``limit``, else None: no more than one value above
    the limit ever reaches the driver."""
    rows = df.select(F.col(col).cast("string").alias("v")).filter("v is not null").distinct().limit(limit + 1).collect()
    return sorted(r["v"] for r in rows) if len(rows) <= limit else None


def category_values(df: DataFrame, col: str, limit: int = MAX_NAMES) -> list[str]:
    """Distinct values that are to become column names, sorted; an error where they are too many for that."""
    names = few_names(df, col, limit)
    if names is None:
        raise ValueError(f"{col} has more than {limit} values: keep them as rows with first_values")
    return names


def first_values(df: DataFrame, keys: Sequence[str], name: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    """The first value by ``order`` (ties by value) of each key and name, still one row for each: the form
    for name sets that are too many to be columns."""
    ranked = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.col(value).alias("_v"))
    return df.groupBy(*keys, name).agg(F.min(ranked)["_v"].alias(value))


def named_cells(df: DataFrame, keys: Sequence[str], name: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    """``first_values`` under the names that a pivot would give its columns, values as double.

    Names that become alike share a cell. Rows without a name have none. No name passes through the driver
    and no row gathers the cells of a key, so neither the names nor the cells of one key are bounded.
    """
    named = df.filter(F.col(name).isNotNull()).withColumn(name, underscore_expr(F.col(name).cast("string")))
    return to_double(first_values(named, keys, name, value, order), except_=[*keys, name])


def pivot_first(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    order: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide, the first value by ``order`` per cell (ties by value).

    ``names`` are the columns to be; found in the data when not given, at most ``MAX_NAMES`` of them. Names
    that become alike share a column.
    The first aggregate makes one row of each cell and combines on the map side, so a cell or key that
    holds most of the rows costs no task more than its share; the second one turns cells into columns.
    """
    labels = list(names) if names is not None else category_values(df, name)
    columns = [underscore_name(n) for n in labels]
    if len(set(columns)) < len(columns):
        df, labels = df.withColumn(name, underscore_expr(F.col(name).cast("string"))), list(dict.fromkeys(columns))
    ranked = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.col(value).alias("_v"))
    wide = df.groupBy(*keys).pivot(name, labels).agg(F.min_by(value, ranked))
    return wide.withColumnsRenamed({n: underscore_name(n) for n in labels})


def pivot_count(
    df: DataFrame, keys: Sequence[str], category: str, names: Mapping[str, str]
) -> DataFrame:
    """Count per key and category as one column per category, zero when absent.

    Conditional counts in a single aggregate: one shuffle of partial counts.
    """
    cells = [F.count(F.when(F.col(category) == F.lit(v), F.lit(1))).alias(n) for v, n in names.items()]
    return df.groupBy(*keys).agg(*cells)
