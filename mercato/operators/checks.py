"""Row rules, test results and gates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RESULT_COLUMNS = ("test", "value", "expected", "passed")


class CheckFailed(Exception):
    """A rule, test or gate did not hold; the run must stop."""


# Rules by table. A NULL outcome breaks a rule.
ROW_RULES: dict[str, dict[str, Column]] = {}


def row_rules() -> dict[str, dict[str, Column]]:
    """Built on first use: columns need a session."""
    if not ROW_RULES:
        ROW_RULES.update({
            "clients": {
                "client_tax_id": F.length("tax_id") == 14,
                "client_date": F.col("registered_on").isNotNull(),
            },
            "orders": {
                "order_date": F.col("ordered_on").isNotNull(),
                "cancelled_zero": ~F.col("cancelled") | (F.col("net_value") == 0),
            },
            "lines": {"quantity_positive": F.col("abs_quantity") > 0},
        })
    return ROW_RULES


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row, one count per rule, in one pass over the columns the rules use."""
    return df.agg(
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    )


def refuse(counts: Mapping[str, int]) -> None:
    """CheckFailed naming each broken rule and its count, if there is one."""
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise CheckFailed("rows break rules: " + ", ".join(f"{k} ({v})" for k, v in broken.items()))


def enforce(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The frame itself, or CheckFailed naming each broken rule and its count."""
    refuse(violations(df, rules).first().asDict())
    return df


class Observed:
    """Row rules and measures of a frame, taken while it is written.

    They are watched at the top of the plan, in the tasks that write: Spark counts such
    a task once, also when it is run again after a loss."""

    def __init__(self, rules: Mapping[str, Column], measures: Mapping[str, Column]):
        self.rules, self.measures = rules, measures
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        broken = [F.count_if(~F.coalesce(r, F.lit(False))).alias(f"rule.{n}") for n, r in self.rules.items()]
        taken = [m.alias(f"measure.{n}") for n, m in self.measures.items()]
        return df.observe(self.observation, *broken, *taken) if broken or taken else df

    def _found(self, kind: str) -> dict:
        return {k.removeprefix(kind): v for k, v in self.observation.get.items() if k.startswith(kind)}

    def enforce(self) -> None:
        if self.rules:
            refuse(self._found("rule."))

    def notes(self) -> dict[str, str]:
        """Measures as text, to be kept with the version; those without a value left out."""
        found = self._found("measure.") if self.measures else {}
        return {f"measure.{k}": str(v) for k, v in found.items() if v is not None}


def result(test: str, value: Column, expected: Column | str, passed: Column) -> list[Column]:
    wanted = F.lit(expected) if isinstance(expected, str) else expected
    return [
        F.lit(test).alias("test"),
        value.cast("string").alias("value"),
        wanted.cast("string").alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    ]


def zero_result(counts: DataFrame, test: str, column: str) -> DataFrame:
    """A test that passes when the one counted value is 0."""
    c = F.col(column)
    return counts.select(*result(test, c, "0", c == 0))


def gate(results: DataFrame) -> DataFrame:
    """Raises naming every failed test. A run has a fixed handful of tests, so
    their rows come to the driver."""
    failed = sorted(r["test"] for r in results.where(~F.col("passed")).select("test").collect())
    if failed:
        raise CheckFailed("failed tests: " + ", ".join(failed))
    return results


def gate_text(results: DataFrame) -> DataFrame:
    """The gate as a query: one row saying all passed, or an error."""
    bad = ~F.col("passed")
    summary = results.agg(
        F.count_if(bad).alias("failed"),
        F.count(F.lit(1)).alias("n"),
        F.concat_ws(", ", F.sort_array(F.collect_list(F.when(bad, F.col("test"))))).alias("names"),
    )
    return summary.select(
        F.when(F.col("failed") > 0, F.raise_error(F.concat(F.lit("failed tests: "), "names")).cast("string"))
        .otherwise(F.concat(F.col("n").cast("string"), F.lit(" tests passed")))
        .alias("outcome")
    )
