"""Data-quality checks: one result row for each check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A rule for one column. Only ``not_null`` objects to a NULL."""

    column: str
    test: str
    values: tuple[str, ...] = ()
    minimum: float | None = None
    inclusive: bool = True

    def broken(self) -> Column:
        """Whether a row breaks the rule; rules on single rows only."""
        value = F.col(self.column)
        if self.test == "not_null":
            return value.isNull()
        if self.test == "accepted_values":
            return ~value.isin(*self.values)
        if self.test == "accepted_range":
            return ~(value >= self.minimum if self.inclusive else value > self.minimum)
        raise ValueError(f"not a rule on single rows: {self.test}")


def not_null(*columns: str) -> list[Check]:
    return [Check(c, "not_null") for c in columns]


def unique(*columns: str) -> list[Check]:
    return [Check(c, "unique") for c in columns]


def accepted_values(column: str, values: Sequence[str]) -> list[Check]:
    return [Check(column, "accepted_values", values=tuple(values))]


def accepted_range(column: str, minimum: float, inclusive: bool = True) -> list[Check]:
    return [Check(column, "accepted_range", minimum=minimum, inclusive=inclusive)]


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """``(model, column_name, test, failing_rows, passed)`` for one table, from one scan of the columns named.

    For ``unique`` the failing rows are the values that occur more than once. The
    columns that should be unique are grouping sets of one aggregate: each row is
    counted under its value of every such column, and under the first of them it also
    counts for the rules on single rows. That aggregate is partial before its shuffle,
    and what it leaves is folded to one row.
    """
    rowwise = [c for c in checks if c.test != "unique"]
    keys = [c for c in checks if c.test == "unique"]
    counts = [F.count_if(c.broken()).alias(f"n{i}") for i, c in enumerate(rowwise)]
    if keys:
        flags = [c.broken().alias(f"b{i}") for i, c in enumerate(rowwise)]
        values = [
            F.struct(F.lit(k).alias("set"), F.col(c.column).cast("string").alias("value")) for k, c in enumerate(keys)
        ]
        copies = df.select(*flags, F.explode(F.array(*values)).alias("of")).select("of.*", *[f"b{i}" for i in range(len(rowwise))])
        broken = [F.count_if(F.col(f"b{i}") & (F.col("set") == 0)).alias(f"n{i}") for i in range(len(rowwise))]
        by_value = copies.groupBy("set", "value").agg(F.count(F.lit(1)).alias("times"), *broken)
        repeated = F.col("value").isNotNull() & (F.col("times") > 1)
        folded = by_value.agg(
            *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(rowwise))],
            *[F.count_if(repeated & (F.col("set") == k)).alias(f"u{k}") for k in range(len(keys))],
        )
    else:
        folded = df.agg(*counts)
    lines = [_line(model, c.column, c.test, F.col(f"n{i}")) for i, c in enumerate(rowwise)]
    lines += [_line(model, c.column, c.test, F.col(f"u{k}")) for k, c in enumerate(keys)]
    return folded.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def check_reference(child: DataFrame, column: str, parent: DataFrame, key: str, model: str) -> DataFrame:
    """Rows of ``child`` whose ``column`` names no row of ``parent``.

    Child rows are counted by value before the join, so it has one row for each
    value however often that value occurs.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).count()
    orphans = used.join(parent.select(key), key, "left_anti")
    failing = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    return failing.select(_line(model, column, "relationship", F.col("n")).alias("r")).select("r.*")


def _line(model: str, column: str, test: str, failing: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        failing.cast("bigint").alias("failing_rows"),
        (failing == 0).alias("passed"),
    )


class ChecksFailed(Exception):
    """At least one check did not pass."""


def enforce(report: DataFrame) -> DataFrame:
    """Run the report; raise :class:`ChecksFailed` if a check did not pass.

    Brings the failed lines of the report to the driver, never table rows; a
    report has one line for each check.
    """
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failing_rows}" for r in failed))
    return report
