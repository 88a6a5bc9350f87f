"""Selection of a varied subset under a token budget.

Documents of a source are taken round by round: one of each group (in the order of the group's name), then the next of
each.  A document is kept if the tokens before it are under the budget, so the last may overshoot.  That is a rank in the
group and a running sum in the source.  Both are computed without gathering a group or source in one task: rows are dealt
by range, each range is summed by itself, and the sums before a range come from one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import shared_table


def running_total(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """rows with `name`: the sum of value over the rows of the same group before it in order (which must be total)."""
    dealt = shared_table(rows.withColumn("__value", value.cast("long")).repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    in_range = Window.partitionBy("__range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("__range", *group).agg(F.sum("__value").alias("__sum"))
    before = sums.select("__range", *(F.col(g).alias(f"__{g}") for g in group), F.coalesce(F.sum("__sum").over(ranges), F.lit(0)).alias("__before"))
    same = F.col("r.__range") == F.col("b.__range")
    for g in group:
        same &= F.col(f"r.{g}").eqNullSafe(F.col(f"b.__{g}"))
    own = dealt.withColumn("__own", F.coalesce(F.sum("__value").over(in_range), F.lit(0)))
    return own.alias("r").join(before.alias("b"), same).select("r.*", F.col("b.__before")).withColumn(name, F.col("__own") + F.col("__before")).drop("__value", "__range", "__own", "__before")


def ranked(docs: DataFrame, source: str, group: str, order: list[str], tokens: str) -> DataFrame:
    """docs with rank (in the group, from 1) and tokens_before (in the source, round by round)."""
    rank = running_total(docs, [source, group], order, F.lit(1), "__rank").withColumn("rank", F.col("__rank") + 1).drop("__rank")
    return running_total(rank, [source], ["rank", group, *order], F.col(tokens), "tokens_before")


def select_within_budget(docs: DataFrame, budget: Column, source: str = "source_id", group: str = "grp", order: tuple[str, ...] = ("rel_path", "ord"), tokens: str = "n_tokens") -> DataFrame:
    """docs with kept, rank and tokens_before.  A budget of 0 or less keeps nothing."""
    return ranked(docs, source, group, list(order), tokens).withColumn("kept", F.col("tokens_before") < budget)


def budget_table(docs: DataFrame, source: str = "source_id", group: str = "grp", order: tuple[str, ...] = ("rel_path", "ord"), tokens: str = "n_tokens") -> DataFrame:
    """Written table of docs with rank and tokens_before, from which within() selects under any budgets.

    Ranks and sums do not depend on budgets, so both of their shuffles happen once.  The table is dealt out and sorted by
    source and tokens_before: a file has a range of them, and what is over a budget is skipped by the ranges of its row groups.
    """
    rows = ranked(docs, source, group, list(order), tokens)
    return shared_table(rows.repartitionByRange(source, "tokens_before").sortWithinPartitions(source, "tokens_before"), "budget-table")


def within(table: DataFrame, budget: Column) -> DataFrame:
    """The documents of a budget_table that select_within_budget keeps under a budget: no shuffle."""
    return table.where(F.col("tokens_before") < budget)


def scaled_budget(budget: Column, scale: float) -> Column:
    """Cut to whole tokens."""
    return (budget * F.lit(float(scale))).cast("long")
