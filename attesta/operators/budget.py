"""A running total over a log of costs, against ceilings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.sources.tables import staged


def running(log: DataFrame, scope: list[str], order: list[str], amount: str, ceiling: float) -> DataFrame:
    """spent (before each row, within scope) and rejected: spent + amount exceeds the ceiling. Every row counts, rejected or not."""
    by = Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(amount).over(by), F.lit(0).cast(dict(log.dtypes)[amount]))
    return log.withColumn("spent", spent).withColumn("rejected", F.col("spent") + F.col(amount) > ceiling)


def admit(log: DataFrame, scope: list[str], order: list[str], amount: str, ceiling: float) -> DataFrame:
    """accepted, where a rejected row is not spent: a later, smaller one may still fit."""
    from attesta.operators.sequence import fold

    def step(state, rows: pd.DataFrame):
        spent, out = state or 0, []
        for x in rows[amount].tolist():
            fits = spent + x <= ceiling
            spent += x if fits else 0
            out.append(fits)
        return spent, pd.Series(out, dtype=bool)

    return fold(log, scope, order, step, "accepted", "boolean")


def running_total(log: DataFrame, order: list[str], amount: str) -> DataFrame:
    """spent: the sum of the amounts before each row in the whole order, for any number of rows: no task has more than a range of them.

    Rows are dealt into ranges that are written once; each range's sum and the sums before it are a row for each
    partition; the rest is a window within a range. The order is a total one, and amounts are whole numbers or
    decimals, so the partitioning does not change a sum.
    """
    placed = staged(log.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "running-total")
    sums = placed.groupBy("_p").agg(F.sum(amount).alias("_s"))
    before = sums.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # as many rows as partitions
    within = F.coalesce(F.sum(amount).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(F.broadcast(before), "_p").withColumn("spent", F.col("_before") + within).drop("_p", "_before")


def check(log: DataFrame, predicted: float, ceiling: float, chapter: str | None = None, chapter_ceiling: float | None = None) -> DataFrame:
    """One row: what has been spent in all and for the chapter, and whether a predicted cost is accepted."""
    own = F.coalesce(F.sum(F.when(F.col("stage") == f"chapter:{chapter}", F.col("usd"))), F.lit(0.0)) if chapter else F.lit(0.0)
    facts = log.agg(F.coalesce(F.sum("usd"), F.lit(0.0)).alias("total"), own.alias("chapter_total"))
    ok = F.col("total") + predicted <= ceiling
    if chapter and chapter_ceiling is not None:
        ok = ok & (F.col("chapter_total") + predicted <= chapter_ceiling)
    return facts.withColumn("accepted", ok)
