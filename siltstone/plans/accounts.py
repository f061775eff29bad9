"""Account tables: account 360 and the monthly risk report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import iso_timestamp
from siltstone.functions.rules import blank_to
from siltstone.operators.aggregates import filtered_sums
from siltstone.operators.keys import latest_per_key, surrogate_id
from siltstone.session import materialize

# Type of outbound money and the status of reported customers. Channel names
# belong to a lake's partners and are passed in.
OUTBOUND_TYPE = "WITHDRAWAL"
REPORTED_STATUS = "APPROVED"


def outbound_sums(
    txns: DataFrame,
    card_channels: Sequence[str],
    transfer_channels: Sequence[str],
    outbound: str = OUTBOUND_TYPE,
) -> DataFrame:
    """Card and transfer spend per account and currency, both in one pass."""
    channel = F.col("channel_id")
    return filtered_sums(
        txns,
        ["parent_account_key", "currency_code"],
        F.col("amount"),
        {
            "outbound_card_amount": channel.isin(*card_channels),
            "outbound_transfer_amount": channel.isin(*transfer_channels),
        },
        where=(F.col("type") == outbound)
        & channel.isin(*card_channels, *transfer_channels),
    )


def account_360(
    log: DataFrame,
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    txns: DataFrame,
    card_channels: Sequence[str],
    transfer_channels: Sequence[str],
    outbound: str = OUTBOUND_TYPE,
) -> DataFrame:
    """Newest account per holder with its customer, client, card state and outbound sums.

    Customers, clients and cards must exist; the sums may be absent. All sides hold one
    row per key before they meet.
    """
    customers = latest_per_key(
        log.select(
            F.coalesce("key_id", "alt_key_id", "image_id").alias("user_id"),
            "updated_at", "status", "card_ordered",
        ),
        ["user_id"], "updated_at", ["status", "card_ordered"],
    ).select("user_id", "card_ordered")
    people = latest_per_key(
        clients.select("encoded_key", "id", "last_modified_date", "state"), ["encoded_key", "id"], "last_modified_date", ["state"]
    ).select(
        F.col("id").alias("client_id"),
        F.col("encoded_key").alias("account_holder_key"),
        F.col("state").alias("client_state"),
    )
    held = latest_per_key(
        accounts.withColumn("last_modified", iso_timestamp(F.col("last_modified_date"))).select(
            "account_holder_key", "account_type", "id", "last_modified", "encoded_key", "name", "balances_total_balance",
            "currency_code", "account_state", "approved_date", "activation_date",
        ),
        ["account_holder_key", "account_type", "id"], "last_modified", ["encoded_key"],
    ).select(
        F.col("name").alias("account"),
        F.col("id").alias("account_id"),
        "account_type",
        F.col("balances_total_balance").cast("double").alias("account_total_balance"),
        F.col("encoded_key").alias("account_encoded_key"),
        "account_holder_key",
        "currency_code",
        "account_state",
        F.col("last_modified").alias("account_last_modified"),
        iso_timestamp(F.col("approved_date")).alias("account_approved"),
        iso_timestamp(F.col("activation_date")).alias("account_activated"),
    )
    card_state = latest_per_key(cards.select("user_id", "updated_at", "state"), ["user_id"], "updated_at", ["state"]).select(
        F.col("user_id").cast("string").alias("user_id"),
        blank_to(F.col("state")).alias("card_state"),
    )
    owners = (
        people.join(customers, people.client_id == customers.user_id)
        .drop("client_id")
        .join(card_state, "user_id")
    )
    holder = ["account_holder_key"]
    owned = held.join(owners, holder)
    sums = outbound_sums(txns, card_channels, transfer_channels, outbound).withColumnRenamed(
        "parent_account_key", "account_encoded_key"
    )
    return owned.join(sums, ["account_encoded_key", "currency_code"], "left")


def risk_report(
    log: DataFrame,
    clients: DataFrame,
    accounts: DataFrame,
    status: str = REPORTED_STATUS,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Approved customers under a generated id, with their accounts and balances."""
    keyed = log.withColumn("user_id", F.coalesce("key_id", "alt_key_id", "image_id"))
    customers = latest_per_key(
        keyed.select("user_id", "updated_at", "status", "nationality", "address_country"), ["user_id"], "updated_at", ["status"]
    ).drop("updated_at")
    extra = {"rows_per_bucket": rows_per_bucket} if rows_per_bucket else {}
    # All users are numbered, one row each; numbering reads its input several times, the log once.
    users = materialize(customers, "users")
    numbered = surrogate_id(users, ["user_id"], "customer_id_generated", **extra).where(F.col("status") == status).drop("status")
    people = latest_per_key(
        clients.select("id", "encoded_key", "last_modified_date", "state"), ["id", "encoded_key"], "last_modified_date", ["state"]
    ).select(
        F.col("id").alias("user_id"), F.col("encoded_key").alias("account_holder_key")
    )
    held = latest_per_key(
        accounts.select(
            "id", "last_modified_date", "encoded_key", "account_holder_key", "currency_code", "balances_total_balance",
            "accrued_interest", "name", "approved_date", "maturity_date", "interest_rate",
        ),
        ["id"], "last_modified_date", ["encoded_key"],
    ).select(
        "account_holder_key",
        "currency_code",
        F.col("balances_total_balance").try_cast("decimal(20,2)").alias("total_balance"),
        F.col("accrued_interest").alias("profit_accrued"),
        F.col("name").alias("account_type"),
        iso_timestamp(F.col("approved_date")).cast("date").alias("account_open_date"),
        iso_timestamp(F.col("maturity_date")).cast("date").alias("maturity_date"),
        F.col("interest_rate").alias("profit_rate"),
    )
    known = numbered.join(people, "user_id", "left")
    holder = ["account_holder_key"]
    return known.join(held, holder, "left").drop("account_holder_key", "user_id")
