"""Customer tables built from the change log: timeline and age flag.

Change log columns: ``key_id, alt_key_id, image_id, updated_at, status, date_of_birth,
gender, phone, email, nickname`` and any of ``CARRIED`` / ``MARKETING``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import AGE_BANDS, age_years, band, safe_date
from siltstone.functions.rules import populated
from siltstone.operators import latest_state
from siltstone.operators.conform import keep_declared
from siltstone.operators.keys import latest_per_key, latest_with_ties

# Attributes the timeline carries over and those it reduces to 1/0.
CARRIED = (
    "nationality", "address_country", "address_status", "asset_types", "assets_value",
    "income_sources", "monthly_income", "opening_reason", "idv_status", "tax_country",
    "brand_id", "applicant_id", "document_type",
)
POPULATED = ("phone", "email", "nickname", "tax_value", "tax_skip_reason")
MARKETING = ("push_marketing", "sms_marketing", "email_marketing")
# Ages that count as student.
STUDENT_AGES = (16, 23)


_TIMELINE = ("date_of_birth", "gender", *CARRIED, *POPULATED, *MARKETING)


def _changes(log: DataFrame) -> DataFrame:
    """The dated rows of the change log under one customer id, with the columns a timeline needs."""
    present = set(log.columns)
    dated = log.withColumn("user_id", F.coalesce("key_id", "alt_key_id")).where(F.col("updated_at").isNotNull())
    return dated.select("user_id", "updated_at", "status", *dict.fromkeys(c for c in _TIMELINE if c in present))


def timeline(log: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest record per customer with populated flags, age band and first-seen date.

    The newest row and the first date come from two reads of the log that are grouped by
    the same key, so joining them adds no shuffle.
    """
    changes = _changes(log)
    newest = latest_per_key(changes, ["user_id"], "updated_at", ["status"])
    firsts = changes.groupBy("user_id").agg(F.min("updated_at").alias("first_join_date"))
    return _timeline_rows(newest, firsts, as_of)


def refresh_timeline(
    delta: DataFrame, root: str, batch: str, as_of: dt.date, buckets: int = latest_state.BUCKETS
) -> DataFrame:
    """The timeline after new rows of the change log, from states that hold all earlier ones.

    ``delta`` is all that is read of the log: the newest row and the first date of each customer are stored
    below ``root`` and brought up to date. A run that stopped between the two states is completed when
    its batch is repeated. Every delta must have the same columns.
    """
    changes = _changes(delta)
    latest_state.advance(changes, f"{root}/newest", batch, ["user_id"], "updated_at", ["status"], buckets=buckets)
    dates = changes.select("user_id", "updated_at")
    latest_state.advance(dates, f"{root}/first", batch, ["user_id"], "updated_at", oldest=True, buckets=buckets)
    firsts = latest_state.state(delta.sparkSession, f"{root}/first")
    newest = latest_state.state(delta.sparkSession, f"{root}/newest")
    return _timeline_rows(newest, firsts.withColumnRenamed("updated_at", "first_join_date"), as_of)


def _timeline_rows(newest: DataFrame, firsts: DataFrame, as_of: dt.date) -> DataFrame:
    present = set(newest.columns)
    with_age = newest.withColumn("age", age_years(safe_date(F.col("date_of_birth")), as_of))
    rows = with_age.select(
        "user_id",
        "updated_at",
        "status",
        *[c for c in CARRIED if c in present],
        *[populated(F.col(c)).alias(f"{c}_populated") for c in POPULATED if c in present],
        band(F.col("age"), AGE_BANDS).alias("age_range"),
        "age",
        F.when(F.col("gender").startswith("Female"), 1)
        .when(F.col("gender").startswith("Male"), 0)
        .alias("gender_code"),
        *[c for c in MARKETING if c in present],
    )
    joined = rows.join(firsts, "user_id", "left")
    return joined.withColumn("date", F.lit(as_of.strftime("%Y%m%d")))


def student_flag(log: DataFrame, as_of: dt.date) -> DataFrame:
    """1 for customers of student age by their newest birthday, else 0; ties kept."""
    newest = latest_with_ties(
        keep_declared(log, ["key_id", "updated_at", "date_of_birth"]), ["key_id"], "updated_at"
    )
    given = newest.where(F.col("date_of_birth").isNotNull() & (F.col("date_of_birth") != " "))
    age = age_years(safe_date(F.col("date_of_birth")), as_of)
    flag = F.when(age.between(*STUDENT_AGES), 1).otherwise(0)
    return given.select(F.col("key_id").alias("user_id"), flag.alias("is_student")).distinct()
