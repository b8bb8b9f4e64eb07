"""Lookup, enrichment and work-list joins.

No side is force-broadcast: Spark's own size check picks the broadcast for the small dimension
tables, and AQE splits skewed sides of the shuffled ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.functions.dates import parse_day, parse_year, week_start
from paneloom.operators import schema as S
from paneloom.operators.aggregates import dedupe_first
from paneloom.operators.filters import exclude_prefix, valid_iso


def map_country(
    df: DataFrame, col: str, dim: DataFrame, name: str = "name", code: str = "iso3", into: str = "ISO_Code"
) -> tuple[DataFrame, DataFrame]:
    """Names to codes. Returns every row with its code (null when unknown) and the unmapped report."""
    lookup = dim.select(F.col(name).alias("_name"), F.col(code).alias("_code"))
    mapped = df.join(lookup, F.col(col) == F.col("_name"), "left").withColumn(into, F.col("_code")).drop("_name", "_code")
    return mapped, unmapped_names(df, col, dim, name, code)


def unmapped_names(df: DataFrame, col: str, dim: DataFrame, name: str = "name", code: str = "iso3") -> DataFrame:
    """Names without a code and how many rows carry each."""
    known = dim.filter(F.col(code).isNotNull()).select(F.col(name).alias(col))
    names = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return names.join(known, col, "left_anti")


def mapping_coverage(mapped: DataFrame, code: str = "ISO_Code") -> DataFrame:
    return mapped.agg(F.count(code).alias("mapped"), F.count(F.lit(1)).alias("total"))


def with_continent(
    df: DataFrame, dim: DataFrame, key: str = "ISO_Code", into: str = "Continent", default: str = "Unknown"
) -> DataFrame:
    lookup = dim.select(F.col("iso3").alias("_iso"), F.col("continent").alias("_cont"))
    joined = df.drop(into).join(lookup, F.col(key) == F.col("_iso"), "left")
    return joined.withColumn(into, F.coalesce("_cont", F.lit(default))).drop("_iso", "_cont")


def match_count(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct right keys occur on the left."""
    hits = right.select(*keys).distinct().join(left.select(*keys), list(keys), "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("matched"))


def join_weekly(
    panel: DataFrame,
    weekly: DataFrame | None,
    keys: Sequence[str] = ("ISO_Code",),
    date: str = "Date",
    weekly_date: str = "Date",
    skip: Sequence[str] = ("country",),
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Each row takes the values of its week; ``None`` leaves the panel as it is.

    ``unique`` states that ``weekly`` has one row for each key and week, as an aggregate by them has;
    otherwise the first row by ``order`` is taken.
    """
    if weekly is None:
        return panel
    values = [c for c in weekly.columns if c not in (*keys, weekly_date, *skip, "_week")]
    dated = weekly.withColumn("_week", week_start(weekly_date))
    ranked = dated.select(*keys, "_week", *[c for c in order if c not in values and c in dated.columns], *values)
    right = (ranked if unique else dedupe_first(ranked, [*keys, "_week"], order)).select(*keys, "_week", *values)
    joined = panel.withColumn("_week", week_start(date)).join(right, [*keys, "_week"], "left")
    return joined.select(*panel.columns, *values)


#: Chunks that the terms of a work list are dealt into.
TERM_CHUNKS = 32


def work_list(
    countries: DataFrame, terms: DataFrame, done: DataFrame | None = None, geo: str = "geo", term: str = "term_id", chunks: int = TERM_CHUNKS
) -> DataFrame:
    """Every entity with every term, less what is done.

    The product is the result. Terms are dealt into ``chunks`` by their hash; an entity meets each chunk
    by its number and unfolds it, so no task needs all terms.
    """
    chunk = F.pmod(F.xxhash64(term), F.lit(chunks))
    dealt = terms.select(term).distinct().groupBy(chunk.alias("_chunk")).agg(F.collect_list(term).alias("_terms"))
    numbered = countries.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    full = numbered.join(dealt, "_chunk").withColumn(term, F.explode("_terms")).drop("_chunk", "_terms")
    full = full.withColumn("query_key", F.concat_ws("_", geo, term))
    if done is None:
        return full
    finished = done.select(F.concat_ws("_", geo, term).alias("query_key")).distinct()
    return full.join(finished, "query_key", "left_anti")


def localized_term(work: DataFrame, terms: DataFrame, term: str = "term_id", lang: str = "lang") -> DataFrame:
    """Keyword in the entity's language, else the default one."""
    own = terms.select(F.col(term), F.col(lang), F.col("keyword").alias("_own"))
    default = terms.filter(F.col(lang) == "default").select(F.col(term), F.col("keyword").alias("_default"))
    joined = work.join(own, [term, lang], "left").join(default, term, "left")
    return joined.select(*work.columns, F.coalesce("_own", "_default").alias("keyword"))


def in_both(df: DataFrame, top: DataFrame, src: str = "src", dst: str = "dst", id_: str = "id") -> DataFrame:
    """Edges with both ends in ``top``. Spark sees how large it is and sends it to the edges or not."""
    ids = top.select(F.col(id_).alias("_top"))
    return df.join(ids, F.col(src) == F.col("_top"), "left_semi").join(ids, F.col(dst) == F.col("_top"), "left_semi")


@dataclass
class EnrichmentReport:
    """What each source table contributed. The static part is known from schemas; counts are lazy."""

    entries: list[dict] = field(default_factory=list)
    counts: list[DataFrame] = field(default_factory=list)
    cells: dict[str, DataFrame] = field(default_factory=dict)

    def note(self, name: str, status: str, reason: str = "", added: Sequence[str] = ()) -> None:
        self.entries.append({"name": name, "status": status, "reason": reason, "added": list(added)})

    def frame(self, spark: SparkSession) -> DataFrame:
        schema = "name string, status string, reason string, added array<string>"
        return spark.createDataFrame(self.entries, schema) if self.entries else spark.createDataFrame([], schema)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The whole report: what became of each table, the columns it added and the keys it matched."""
        found = self.matches()
        told = self.frame(spark)
        return told.withColumn("matched", F.lit(None).cast("long")) if found is None else told.join(found, "name", "left")

    def matches(self) -> DataFrame | None:
        """Matched keys per table, computed only when asked for."""
        from paneloom.operators.ordering import union_all

        return union_all(self.counts) if self.counts else None

    @property
    def skipped(self) -> list[str]:
        return [e["name"] for e in self.entries if e["status"] == "skipped"]


def enrich(
    panel: DataFrame,
    tables: Mapping[str, DataFrame],
    dim: DataFrame | None = None,
    order: Sequence[str] = (),
    check_empty: bool = True,
    max_names: int = S.MAX_NAMES,
) -> tuple[DataFrame, EnrichmentReport]:
    """Fold source tables into the panel by left joins on entity and day.

    The first table to bring a column wins. What the schemas alone reject goes first, then one job finds
    the empty ones among the others. Every right side is reduced to one row per key by an aggregate hashed
    on the join keys, so it arrives already partitioned for the join; the panel is exchanged at most once
    for the whole fold, because a left join keeps its partitioning.

    A long table with more than ``max_names`` names adds no columns: its cells stay rows, in the report's
    ``cells``.
    """
    keys = ["ISO_Code", "Date"]
    report = EnrichmentReport()
    merged = panel
    sources: dict[str, DataFrame] = {}
    reasons: dict[str, str] = {}
    for name, table in tables.items():
        source, reason = _keyed(table, dim)
        if source is not None and S.is_disaggregated(source):
            reason, source = "broken down by " + ", ".join(S.breakdown_columns(source)), None
        if source is None:
            reasons[name] = reason
        else:
            sources[name] = source
    filled = _with_rows(sources) if check_empty else set(sources)
    for name in tables:
        source = sources.get(name)
        if source is None:
            report.note(name, "skipped", reasons[name])
            continue
        if name not in filled:
            report.note(name, "skipped", "no rows after the key filter")
            continue
        long = {"indicator", "value"} <= set(source.columns)
        if long:
            place = [c for c in order if c in source.columns]
            names = S.few_names(source, "indicator", max_names)
            if names is None:
                report.cells[name] = enrich_cells(panel, source, "indicator", "value", place, keys)
                report.counts.append(match_count(panel, source.select(*keys).distinct(), keys).select(F.lit(name).alias("name"), "matched"))
                report.note(name, "cells", f"more than {max_names} names")
                continue
            source = S.pivot_first(source, keys, "indicator", "value", place, names)
        added = [c for c in S.new_columns(merged.columns, source) if c not in order]
        if not added:
            report.note(name, "skipped", "no new columns")
            continue
        ranked = [c for c in order if c in source.columns]
        first = source if long else dedupe_first(source.select(*keys, *ranked, *added), keys, ranked)
        subset = S.to_double(first.select(*keys, *added), except_=keys)
        report.counts.append(match_count(panel, subset, keys).select(F.lit(name).alias("name"), "matched"))
        merged = merged.join(subset, keys, "left").select(*merged.columns, *added)
        report.note(name, "joined", "", added)
    return merged, report


def enrich_cells(
    panel: DataFrame, table: DataFrame, name: str, value: str, order: Sequence[str] = (), keys: Sequence[str] = ("ISO_Code", "Date")
) -> DataFrame:
    """The cells ``(keys, name, value)`` that a long table has for the rows of the panel, the first value by
    ``order`` for each name, however many names there are."""
    return S.named_cells(table, keys, name, value, order).join(panel.select(*keys), list(keys), "left_semi")


def _with_rows(sources: Mapping[str, DataFrame]) -> set[str]:
    """Names of the tables that hold a row, by one job that reads one row of each."""
    from paneloom.operators.ordering import union_all

    if not sources:
        return set()
    return {r["name"] for r in union_all([s.limit(1).select(F.lit(n).alias("name")) for n, s in sources.items()]).collect()}


def _keyed(table: DataFrame, dim: DataFrame | None) -> tuple[DataFrame | None, str]:
    """A source table with canonical key columns, or the reason why it has none."""
    date = S.pick_column(table, S.DATE_CANDIDATES)
    if date is None:
        return None, "no date column"
    day = parse_year(F.col(date)) if date == "year" else parse_day(F.col(date))
    source = table.withColumn("_day", day).drop(date, "Date").withColumnRenamed("_day", "Date")
    iso = S.pick_column(source, S.ISO_CANDIDATES)
    if iso is not None:
        source = source.withColumnRenamed(iso, "ISO_Code")
    else:
        place = S.pick_column(source, S.PLACE_CANDIDATES)
        if place is None or dim is None:
            return None, "no place column"
        source, _ = map_country(source, place, dim)
    return exclude_prefix(valid_iso(source.filter(F.col("Date").isNotNull()))), ""
