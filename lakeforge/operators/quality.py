"""Declarative data-quality checks.

Five kinds: ``unique``, ``not_null``, ``accepted_values``, ``expression`` (with
an optional ``where``) and ``relationships``. Each has a failing-rows
function (zero rows = pass). :func:`run_suite` evaluates a whole suite with
one aggregate scan per table for the row-level checks (instead of a job per
check), one pre-aggregated shuffle per ``unique`` check and one key-level
anti join per ``relationships`` check, and returns one summary row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.operators.joins import HOT_KEY_ROWS, skew_safe_join


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    to_table: str | None = None
    to_column: str | None = None


class QualityError(AssertionError):
    """Raised by the gate; ``rows`` holds the full summary."""

    def __init__(self, message: str, rows: list[dict]):
        super().__init__(message)
        self.rows = rows


# ── failing rows per check kind ─────────────────────────────────────────────
def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their row counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def _not_accepted(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-NULL values outside ``values``, with their row counts."""
    return (df.filter(_not_accepted(column, values)).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))


def _expression_fails(expression: str, where: str | None) -> Column:
    # NOT(expr) is NULL when expr is NULL, so a NULL result is not a failure.
    cond = ~F.expr(expression)
    return cond if where is None else (F.expr(where) & cond)


def expression_failures(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    return df.filter(_expression_fails(expression, where))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                           hot_key_rows: int = HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (a key shared by a
    large share of child rows is split across tasks). ``hot``: keys to split,
    known beforehand; without it they are counted in a pass of its own."""
    parent_keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return skew_safe_join(child.filter(F.col(column).isNotNull()), parent_keys, column, "left_anti",
                          hot_key_rows, hot)


# ── suite ───────────────────────────────────────────────────────────────────
def _row(check: Check, failures: Column) -> Column:
    return F.struct(F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
                    F.lit(check.kind).alias("test_name"), failures.cast("bigint").alias("failures"))


def _row_level_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in a single aggregate scan."""
    rows = []
    for c in checks:
        if c.kind == "not_null":
            n = F.count_if(F.col(c.column).isNull())
        elif c.kind == "accepted_values":
            # one failing row per distinct non-accepted value
            n = F.count_distinct(F.when(_not_accepted(c.column, c.values), F.col(c.column)))
        elif c.kind == "expression":
            n = F.count_if(_expression_fails(c.expression, c.where))
        else:
            raise ValueError(c.kind)
        rows.append(_row(c, n))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Summary ``(table_name, column_name, test_name, failures)`` per check."""
    parts: list[DataFrame] = []
    row_level = ("not_null", "accepted_values", "expression")
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table and c.kind in row_level]
        if mine:
            parts.append(_row_level_counts(tables[table], mine))
    for c in checks:
        if c.kind == "unique":
            n = unique_failures(tables[c.table], c.column).agg(F.count(F.lit(1)).alias("n"))
        elif c.kind == "relationships":
            child_keys = (tables[c.table].filter(F.col(c.column).isNotNull())
                          .groupBy(c.column).agg(F.count(F.lit(1)).alias("rows")))
            parent_keys = tables[c.to_table].select(F.col(c.to_column).alias(c.column)).distinct()
            n = (child_keys.join(parent_keys, c.column, "left_anti")
                 .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")))
        elif c.kind in row_level:
            continue
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")
        parts.append(n.select(F.inline(F.array(_row(c, F.col("n"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_suite(summary: DataFrame) -> list[dict]:
    """Gate: raise :class:`QualityError` when any check has failures.

    Collects the summary only: one small row per check.
    """
    rows = [r.asDict() for r in summary.collect()]
    bad = [r for r in rows if r["failures"]]
    if bad:
        lines = ", ".join(f"{r['table_name']}.{r['column_name']} {r['test_name']}={r['failures']}" for r in bad)
        raise QualityError(f"{len(bad)} data-quality checks failed: {lines}", rows)
    return rows


def default_suite(cities: Sequence[str] = S.ACCEPTED_CITIES,
                  room_types: Sequence[str] = S.ACCEPTED_ROOM_TYPES) -> list[Check]:
    """The staging and mart checks of the reference suite (19 checks)."""
    cities, room_types = tuple(cities), tuple(room_types)
    return [
        Check("unique", "stg_listings", "listing_id"),
        Check("not_null", "stg_listings", "listing_id"),
        Check("not_null", "stg_listings", "city"),
        Check("accepted_values", "stg_listings", "city", values=cities),
        Check("not_null", "stg_listings", "room_type"),
        Check("accepted_values", "stg_listings", "room_type", values=room_types),
        Check("not_null", "stg_listings", "price"),
        Check("expression", "stg_listings", "price", expression="price > 0"),
        Check("expression", "stg_listings", "review_scores_rating",
              expression="review_scores_rating between 0 and 100",
              where="review_scores_rating is not null"),
        Check("unique", "stg_reviews", "review_id"),
        Check("not_null", "stg_reviews", "review_id"),
        Check("not_null", "stg_reviews", "listing_id"),
        Check("relationships", "stg_reviews", "listing_id", to_table="stg_listings", to_column="listing_id"),
        Check("not_null", "stg_reviews", "review_date"),
        Check("not_null", "mart_city_pricing", "city"),
        Check("not_null", "mart_city_pricing", "room_type"),
        Check("expression", "mart_city_pricing", "avg_price", expression="avg_price > 0"),
        Check("not_null", "mart_host_performance", "host_id"),
        Check("not_null", "mart_review_trends", "month_start_date"),
    ]
