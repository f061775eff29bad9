"""Risk tables: wide range strings, wealth and income, the risk form projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import range_string
from siltstone.operators.aggregates import class_sums
from siltstone.operators.conform import project_existing

# Repeated items per score and the item types that count as income.
SCORE_ITEMS = 30
INCOME_TYPES = (
    "SAVINGS_FROM_SALARY_OR_EARNINGS",
    "INCOME_FROM_SALARY_BONUS_BENEFITS_COMMISSIONS",
    "INCOME_FROM_PERSONAL_SAVINGS",
)


def _range(amount: Column) -> Column:
    return range_string(amount["code"], amount["from"], amount["to"])


def _stamped(scores: DataFrame) -> DataFrame:
    """Scores with an update time."""
    return scores.where(F.col("updated_at").isNotNull() & (F.col("updated_at").cast("string") != ""))


def score_table(scores: DataFrame, items: int = SCORE_ITEMS) -> DataFrame:
    """One wide row per score: type and two range strings for every item, and totals.

    ``scores``: ``customer_id, alt_customer_id, updated_at, items array<struct<type,
    converted struct<code,from,to>, local struct<...>>>, net_worth struct<converted,
    local, code, from, to>``. The array stays an array until this last projection. A score with more
    than ``items`` items fails the job: a wide table of that width cannot hold it.
    """
    wide: list[Column] = []
    message = F.concat(F.lit(f"a score has more than {items} items: "), F.size("items").cast("string"))
    checked = F.when(F.size("items") > items, F.raise_error(message)).otherwise(F.col("items"))
    scores = scores.withColumn("items", checked)
    for i in range(items):
        item = F.get("items", i)
        wide += [
            item["type"].alias(f"item_{i}_type"),
            _range(item["converted"]).alias(f"item_{i}_converted"),
            _range(item["local"]).alias(f"item_{i}_local"),
        ]
    worth = F.col("net_worth")
    return _stamped(scores).select(
        F.coalesce("customer_id", "alt_customer_id").alias("customer_id"),
        F.col("updated_at").alias("updated_timestamp"),
        F.col("updated_at").cast("date").cast("string").alias("date"),
        *wide,
        _range(worth["converted"]).alias("total_converted"),
        _range(worth["local"]).alias("total_local"),
        worth["code"].cast("string").alias("worth_code"),
        worth["from"].cast("string").alias("worth_min"),
        worth["to"].cast("string").alias("worth_max"),
    )


def wealth_and_income(
    scores: DataFrame, income_types: Sequence[str] = INCOME_TYPES, unreadable: str | None = None
) -> DataFrame:
    """Summed lower bounds per customer: listed types are income, all others wealth.

    ``scores`` is the input of :func:`score_table`; the sums come from its item arrays, of any length.
    """
    rows = _stamped(scores).withColumn("customer_id", F.coalesce("customer_id", "alt_customer_id"))
    items = F.transform("items", lambda x: F.struct(x["type"].alias("type"), _range(x["converted"]).alias("range")))
    return class_sums(rows, "customer_id", items, {"income_salary": income_types}, "wealth", unreadable)


def form_projection(form: DataFrame, wanted: Sequence[str], day: str | None = None) -> DataFrame:
    """The wanted risk-form columns that the raw table has, of one day if given."""
    return project_existing(form, wanted, None if day is None else F.col("date") == day)
