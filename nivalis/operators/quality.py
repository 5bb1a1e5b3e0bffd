"""Expectations on tables. Each gives one row for each rule: expectation, checked, failed, ok.

``expect`` and its kin scan a table for the report alone. A ``Watch`` counts while the table passes
on its way to a sink, so the report costs no second scan; ``publish_checked`` keeps a result that
breaks a rule from being published.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nivalis.sources.published import publish

FAILED = "expectation failed"


def expect(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule (a rule that is null for a row counts as broken), in one scan."""
    row = df.agg(F.count(F.lit(1)).alias("checked"), *[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("failed")) for n in rules]))
    return row.select("checked", each.alias("e")).select("e.expectation", "checked", "e.failed", (F.col("e.failed") == 0).alias("ok"))


def no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return expect(df, {c: F.col(c).isNotNull() for c in columns})


def at_most(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Values up to a limit; nulls are for ``no_nulls``."""
    return expect(df, {c: F.coalesce(F.col(c) <= limit, F.lit(True)) for c, limit in limits.items()})


class Watch:
    """Rules counted on a table as it passes: use ``df`` in place of the table, write it, then read the report."""

    def __init__(self, df: DataFrame, rules: Mapping[str, Column] | None = None):
        self.rules, self.plain, self.seen = dict(rules or {}), df, Observation()
        counts = [F.count_if(~F.coalesce(r, F.lit(False))).alias(f"rule{i}") for i, r in enumerate(self.rules.values())]
        self.df = df.observe(self.seen, F.count(F.lit(1)).alias("checked"), *counts)

    @property
    def rows(self) -> int:
        return self.seen.get["checked"]

    def failed(self) -> dict[str, int]:
        return {n: self.seen.get[f"rule{i}"] for i, n in enumerate(self.rules)}

    def report(self) -> DataFrame:
        """expectation, checked, failed and ok of each rule, once ``df`` has been written."""
        rows = [(n, self.rows, failed, failed == 0) for n, failed in self.failed().items()]
        return self.plain.sparkSession.createDataFrame(rows, "expectation string, checked long, failed long, ok boolean")


def watched_step(before: DataFrame, step: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> DataFrame:
    """Writes step(before) and gives rows before, rows after, and whether they agree, counted in that one pass.

    The step must read its input once. If tasks ran again, a count may be too high: a table that
    seems to have changed is counted again before that is said.
    """
    first = Watch(before)
    last = Watch(step(first.df))
    write(last.df)
    counts = first.rows, last.rows
    if counts[0] != counts[1]:
        counts = before.count(), step(before).count()
    return before.sparkSession.createDataFrame([(*counts, counts[0] == counts[1])], "before long, after long, ok boolean")


class ExpectationFailed(ValueError):
    """A result broke a rule and was not published; failed: the broken rows by rule."""

    def __init__(self, failed: Mapping[str, int]):
        super().__init__(f"{FAILED}: {dict(failed)}")
        self.failed = dict(failed)


def publish_checked(spark: SparkSession, root: str, run_id: str, df: DataFrame, rules: Mapping[str, Column], least_rows: int = 0) -> tuple[int, DataFrame]:
    """Writes df as a run, counting the rules on its way; publishes it if all hold. The version's number and the report.

    A run that breaks a rule, or has fewer rows than ``least_rows``, leaves no trace.
    """
    watch = Watch(df, rules)

    def write(path: str) -> None:
        watch.df.write.parquet(path)
        broken = {n: k for n, k in watch.failed().items() if k}
        if watch.rows < least_rows:
            broken["rows"] = least_rows - watch.rows
        if broken:
            raise ExpectationFailed(broken)

    return publish(spark, root, run_id, write), watch.report()


def fills_grid(df: DataFrame) -> DataFrame:
    """Rows, height times width, and whether they agree."""
    return df.agg(F.count(F.lit(1)).alias("rows"), ((F.max("y") + 1) * (F.max("x") + 1)).cast("long").alias("cells")).withColumn("ok", F.col("rows") == F.col("cells"))


def enough_places(df: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """expectation, checked (distinct places), failed (how many are missing) and ok."""
    n = F.count_distinct(*columns)
    return df.agg(F.lit("distinct places").alias("expectation"), n.alias("checked"), F.greatest(F.lit(least) - n, F.lit(0)).alias("failed"), (n >= least).alias("ok"))


def same_columns(train: DataFrame, serve: DataFrame) -> DataFrame:
    """For each column of either table: expectation, checked, failed (1 if the other table lacks it) and ok."""
    names = sorted({*train.columns, *serve.columns})
    both = {*train.columns} & {*serve.columns}
    return train.sparkSession.createDataFrame([(c, 1, int(c not in both), c in both) for c in names], "expectation string, checked long, failed long, ok boolean")


def required(df: DataFrame, condition: Column, message: str = FAILED) -> DataFrame:
    """df, with an error at run time if a row breaks the condition."""
    return df.where(F.coalesce(F.assert_true(F.coalesce(condition, F.lit(False)), message).isNull(), F.lit(True)))
