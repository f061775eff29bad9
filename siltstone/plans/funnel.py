"""Onboarding funnel: bucket per applicant, merged into the previous day's report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import (
    AGE_BANDS_FROM_16,
    age_years,
    band,
    safe_date,
    ts_literal,
    whole_weeks,
)
from siltstone.functions.rules import decide, yes_no
from siltstone.functions.text import contains_any, join_strict, replace_literal, strip_end
from siltstone.operators.joins import matched_flag
from siltstone.operators.keys import latest_per_key
from siltstone.operators.sets import snapshot_merge

# Ordered rules (identity, address, application status) -> bucket. A tuple
# lists accepted statuses, None accepts any.
_OPEN_IDV = ("AWAITING_CUSTOMER_RETRY", "AWAITING_MANUAL_REVIEW", "PENDING")
_OPEN_POA = ("AWAITING_MANUAL_REVIEW", "AWAITING_MANUAL_INPUT", "AWAITING_DOCUMENT_UPLOAD")
BUCKET_RULES = (
    (("PASSED",), ("AWAITING_MANUAL_REVIEW",), None, "Complete IDV, Awaiting Address Review"),
    (("PASSED",), ("AWAITING_QR_SCAN",), None, "Complete IDV, Awaiting QR Scan"),
    (("PASSED",), ("AWAITING_MANUAL_INPUT", "AWAITING_DOCUMENT_UPLOAD"), None,
     "Complete IDV, Don't Complete POA"),
    (("PASSED",), ("AWAITING_PROVIDER_SELECTION",), None, "Complete IDV, Don't Start POA"),
    (("PASSED",), ("VERIFIED",), ("AWAITING_SUBMISSION",), "Complete IDV, POA - Don't Submit"),
    (("UNKNOWN",), ("AWAITING_PROVIDER_SELECTION",), ("AWAITING_SUBMISSION",),
     "Don't start IDV, POA"),
    (("AWAITING_CUSTOMER_RETRY",), ("AWAITING_MANUAL_REVIEW",), ("AWAITING_MANUAL_REVIEW",),
     "IDV incomplete, Awaiting Address Review"),
    (_OPEN_IDV, ("VERIFIED",), None, "IDV Incomplete, POA Complete"),
    (_OPEN_IDV, _OPEN_POA, None, "IDV incomplete, POA incomplete"),
    (_OPEN_IDV, ("AWAITING_QR_SCAN",), None, "IDV incomplete,Awaiting QR Scan"),
    (_OPEN_IDV, ("AWAITING_PROVIDER_SELECTION",), None, "IDV incomplete. Don't Start POA"),
    (("UNKNOWN",), ("AWAITING_QR_SCAN",), None, "IDV Not Started, Awaiting QR Scan"),
    (("UNKNOWN",), _OPEN_POA, None, "IDV Not Started, POA Incomplete"),
    (("UNKNOWN",), ("VERIFIED",), None, "IDV Not Started, POA Complete"),
    (("PASSED",), ("VERIFIED",), ("AWAITING_APPROVAL", "AWAITING_ADDITIONAL_DOCUMENTS"),
     "Submit Application, Don't Submit EDD Docs"),
    (("PASSED",), ("VERIFIED",), ("AWAITING_MANUAL_REVIEW",), "Submitted EDD Docs"),
)
# Application statuses that replace the bucket, and those of finished
# applications, which are not added to the report.
TERMINAL = (
    "APPROVED", "REJECTED", "AWAITING_EXIT_PERIOD", "CEASED", "CLOSED",
    "AWAITING_BANK_ACCOUNT_CREATION",
)
FINISHED = ("APPROVED", "REJECTED")
# Reporting start, country, waiting label, self-employment marks.
REPORT_START = dt.datetime(2023, 4, 16)
COUNTRY = "ARE"
WAITING_STATUS = "AWAITING_QR_SCAN"
WAITING_WEEKS, WAITING_LABEL = 3, "3 weeks or more"
SELF_EMPLOYED_MARKS = ("SELF_EMPLOYED", "BUSINESS_OWNER")

REPORT_COLUMNS = (
    "user_id", "first_name", "last_name", "email", "phone", "age_range", "gender",
    "application_status", "idv_status", "address_status", "brand_id", "join_date",
    "original_bucket", "weeks_waiting", "rework", "pep", "self_employed", "called",
    "onboarded", "nickname", "latest_bucket", "moved",
)


def bucket(idv: Column, address: Column, status: Column) -> Column:
    """Funnel bucket of an applicant; null when no rule applies."""
    rules = []
    for idvs, addresses, statuses, text in BUCKET_RULES:
        cond = idv.isin(*idvs) & address.isin(*addresses)
        if statuses is not None:
            cond = cond & status.isin(*statuses)
        rules.append((cond, f"[{text}]"))
    return decide(rules)


def preferred_flag(df: DataFrame, key: str, ts: str, flag: Column, name: str) -> DataFrame:
    """One Y/N/null row per key: the newest row with a value, null only if none has one.

    Only two timestamps per key are aggregated, so the pass combines in the map tasks.
    """
    at = F.coalesce(F.col(ts), F.lit("0001-01-01").cast("timestamp_ntz"))
    marked = df.select(key, at.alias("at"), flag.alias("flag"))
    newest = marked.groupBy(key).agg(
        F.max(F.when(F.col("flag") == "Y", F.col("at"))).alias("y"),
        F.max(F.when(F.col("flag") == "N", F.col("at"))).alias("n"),
    )
    value = (
        F.when(F.col("y").isNotNull() & (F.col("n").isNull() | (F.col("y") >= F.col("n"))), "Y")
        .when(F.col("n").isNotNull(), "N")
    )
    return newest.select(key, value.alias(name))


def self_employed(forms: DataFrame, circumstances: list[str]) -> DataFrame:
    """Y/N per customer from the joined circumstance texts."""
    text = strip_end(join_strict("| ", *[F.col(c) for c in circumstances]), " |")
    flag = F.when(text.isNull(), None).when(contains_any(text, *SELF_EMPLOYED_MARKS), "Y").otherwise("N")
    return preferred_flag(forms, "customer_id", "updated_at", flag, "self_employed")


def applicants(
    log: DataFrame,
    as_of: dt.datetime,
    since: dt.datetime = REPORT_START,
    country: str | None = COUNTRY,
) -> DataFrame:
    """Newest record per applicant with join date, bucket, PEP flag and waiting label.

    ``log`` is the change log with ``idv_status``, ``address_status``, ``pep_passed`` and
    names. First dates come from one grouped pass over three columns.
    """
    changes = log.withColumn("user_id", F.coalesce("key_id", "alt_key_id"))
    if country is not None:
        changes = changes.where(F.col("address_country") == country)
    firsts = changes.groupBy("user_id").agg(
        F.min("updated_at").alias("join_ts"),
        F.min(F.when(F.col("address_status") == WAITING_STATUS, F.col("updated_at"))).alias("wait_ts"),
    )
    carried = (
        "first_name", "last_name", "email", "phone", "date_of_birth", "gender", "status", "idv_status", "address_status",
        "brand_id", "pep_passed", "nickname",
    )
    newest = latest_per_key(changes.select("user_id", "updated_at", *carried), ["user_id"], "updated_at", ["status"])
    rows = newest.join(firsts.where(F.col("join_ts") >= ts_literal(since)), "user_id")
    waits = (F.col("address_status") == WAITING_STATUS) & (
        whole_weeks(F.col("wait_ts"), as_of) >= WAITING_WEEKS
    )
    with_age = rows.withColumn("age", age_years(safe_date(F.col("date_of_birth")), as_of.date()))
    return with_age.select(
        "user_id", "first_name", "last_name", "email", "phone",
        band(F.col("age"), AGE_BANDS_FROM_16).alias("age_range"),
        F.when(F.col("gender").startswith("Female"), "Female")
        .when(F.col("gender").startswith("Male"), "Male").alias("gender"),
        F.col("status").alias("application_status"),
        "idv_status", "address_status", "brand_id",
        F.col("join_ts").cast("date").cast("string").alias("join_date"),
        bucket(F.col("idv_status"), F.col("address_status"), F.col("status")).alias("bucket"),
        F.when(waits, WAITING_LABEL).alias("weeks_waiting"),
        yes_no(F.col("pep_passed"), invert=True).alias("pep"),
        "nickname",
    )


def funnel_report(
    log: DataFrame,
    reworks: DataFrame,
    forms: DataFrame,
    circumstances: list[str],
    previous: DataFrame,
    as_of: dt.datetime,
    since: dt.datetime = REPORT_START,
    country: str | None = COUNTRY,
) -> DataFrame:
    """The day's report: yesterday's rows brought up to date, plus new open applicants.

    ``reworks`` lists the ``user_id`` of cases sent back; ``previous`` has
    ``REPORT_COLUMNS`` and may be empty.
    """
    people = applicants(log, as_of, since, country)
    # One row per user on both sides, so no key can be hot.
    flagged = matched_flag(people, reworks, ["user_id"], "rework", "Y", " ")
    owners = self_employed(forms, circumstances).withColumnRenamed("customer_id", "user_id")
    today = flagged.join(owners, "user_id", "left")
    return merge_report(previous, today)


def merge_report(previous: DataFrame, today: DataFrame) -> DataFrame:
    """Snapshot step of the funnel: carry old identity columns, refresh the state."""

    def carried(old, new):
        origin = replace_literal(old("original_bucket"), "}", "]")
        status = new("application_status")
        values = {
            c: old(c)
            for c in ("user_id", "first_name", "last_name", "email", "phone", "application_status",
                      "idv_status", "address_status", "brand_id", "join_date", "called")
        }
        values.update(
            {c: new(c) for c in ("age_range", "gender", "weeks_waiting", "pep", "self_employed", "nickname")}
        )
        values["original_bucket"] = origin
        values["moved"] = F.when(~origin.eqNullSafe(new("bucket")), "Y").otherwise("N")
        values["onboarded"] = replace_literal(
            F.when(status == "APPROVED", "Y").otherwise(old("onboarded")), "nan", "N"
        )
        values["rework"] = F.when(new("rework") == "Y", "Y").otherwise(old("rework"))
        values["latest_bucket"] = F.when(status.isin(*TERMINAL), status).otherwise(new("bucket"))
        return [values[c].cast("string").alias(c) for c in REPORT_COLUMNS]

    def fresh(new):
        fixed = {"called": F.lit("N"), "onboarded": F.lit("N"), "moved": F.lit(""), "latest_bucket": F.lit("")}
        fixed["original_bucket"] = new("bucket")
        return [fixed.get(c, None if c in fixed else new(c)).cast("string").alias(c) for c in REPORT_COLUMNS]

    def admit(new):
        return F.coalesce(~new("application_status").isin(*FINISHED), F.lit(True))

    return snapshot_merge(previous.distinct(), today, "user_id", carried, fresh, admit)
