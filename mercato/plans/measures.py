"""Named measures usable under any grouping, the dashboard queries over them and
the stored questions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import chosen, day, safe_ratio, total
from mercato.plans.features import since


def measures() -> dict[str, Column]:
    revenue, margin = total(F.col("revenue")), total(F.col("margin"))
    orders = F.countDistinct("order_id")
    return {
        "revenue": revenue,
        "margin": margin,
        "orders": orders,
        "ticket": safe_ratio(revenue, orders),
        "margin_pct": safe_ratio(margin.cast("double") * 100, revenue),
    }


def dimensions() -> dict[str, Column]:
    """Derived dimensions; any other name is a column of the fact."""
    return {"month_start": F.trunc("ordered_on", "month")}


def measure_query(
    fact: DataFrame,
    dims: Sequence[str],
    names: Sequence[str],
    filters: Mapping[str, Sequence[object] | None] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Filters first (an empty choice keeps all), then group and measure. `order`
    takes result names, with '-' for descending; dimensions break ties."""
    for column, values in (filters or {}).items():
        if values:
            fact = fact.where(chosen(F.col(column), values))
    derived, known = dimensions(), measures()
    keys = [derived.get(d, F.col(d)).alias(d) for d in dims]
    out = fact.groupBy(*keys).agg(*[known[n].alias(n) for n in names])
    if order:
        wanted = [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order]
        named = {o.lstrip("-") for o in order}
        out = out.orderBy(*wanted, *[F.asc(d) for d in dims if d not in named])
    return out


# -- dashboard -------------------------------------------------------------------

def kpi(fact: DataFrame, name: str, filters=None) -> DataFrame:
    return measure_query(fact, [], [name], filters)


def revenue_by_month(fact: DataFrame, filters=None) -> DataFrame:
    return measure_query(fact, ["month_start"], ["revenue"], filters, ["month_start"])


def revenue_by_brand(fact: DataFrame, filters=None) -> DataFrame:
    return measure_query(fact, ["brand"], ["revenue"], filters, ["-revenue"])


def margin_by_category(fact: DataFrame, filters=None) -> DataFrame:
    return measure_query(fact, ["category"], ["margin_pct"], filters, ["margin_pct"])


def revenue_by_channel(fact: DataFrame, filters=None) -> DataFrame:
    return measure_query(fact, ["channel"], ["revenue"], filters, ["-revenue"])


def top_clients(
    fact: DataFrame, n: int = 20, segments: Sequence[str] | None = None, cities: Sequence[str] | None = None
) -> DataFrame:
    """The n largest by revenue; the choices act on those n, not before the cut."""
    sums = fact.groupBy("legal_name", "segment", "city").agg(total(F.col("revenue")).alias("revenue"))
    top = sums.orderBy(F.desc("revenue"), F.asc("legal_name"), F.asc("segment"), F.asc("city")).limit(n)
    return top.where(chosen(F.col("segment"), segments) & chosen(F.col("city"), cities))


def queue_table(queue: DataFrame, reps: Sequence[str] | None = None) -> DataFrame:
    return queue.where(chosen(F.col("rep"), reps)).select(
        "rep", "position", "legal_name", "city", "score", "band", "reason", "advice"
    ).orderBy("rep", "position")


# -- questions ----------------------------------------------------------------------

def launch_top(launches: DataFrame, n: int = 10) -> DataFrame:
    return (
        launches.select("sku", "title", "launch_per_day", "rest_per_day")
        .orderBy(F.desc_nulls_last("launch_per_day"), F.asc("sku"))
        .limit(n)
    )


def last_months(df: DataFrame, date: str, as_of: str, n: int = 6) -> DataFrame:
    return since(df, date, F.add_months(day(as_of), -n))


def top_brands(fact: DataFrame, as_of: str, months: int = 6, n: int = 5) -> DataFrame:
    """In millions, one decimal; ranked by the exact revenue."""
    sums = last_months(fact, "ordered_on", as_of, months).groupBy("brand").agg(
        total(F.col("revenue")).alias("revenue")
    )
    return (
        sums.orderBy(F.desc("revenue"), F.asc("brand"))
        .limit(n)
        .select("brand", F.round(F.col("revenue").cast("double") / 1e6, 1).alias("revenue_millions"))
    )


def lost_revenue(at_risk: DataFrame) -> DataFrame:
    """The monthly figures have two decimals, so they are added exactly."""
    return at_risk.agg(
        F.count(F.lit(1)).alias("clients_at_risk"),
        F.sum(F.col("monthly_revenue").cast("decimal(18,2)")).cast("decimal(38,2)").alias("monthly_revenue_lost"),
    )


def worst_stockouts(stockouts: DataFrame, n: int = 5) -> DataFrame:
    return (
        stockouts.select("brand", "stock_out_pct")
        .orderBy(F.desc("stock_out_pct"), F.asc("brand"))
        .limit(n)
    )


def categories_by_margin(categories: DataFrame) -> DataFrame:
    return categories.select("category", "revenue", "margin", "margin_pct").orderBy("margin_pct", "category")


def season(months: DataFrame) -> DataFrame:
    return months.select("year", "month", "revenue", "peak_month").orderBy("year", "month")


def call_list(queue: DataFrame, rep: str) -> DataFrame:
    return (
        queue.where(F.col("rep") == rep)
        .select("rep", "position", "legal_name", F.round("score", 2).alias("score"), "reason")
        .orderBy("position")
    )


def gross_revenue(fact: DataFrame) -> DataFrame:
    """Sales without returns."""
    sold = F.when(~F.col("is_return"), F.col("revenue"))
    return fact.agg(total(sold).alias("gross_revenue"), total(F.col("revenue")).alias("net_revenue"))
