"""Request validation: predicate columns, and splits into kept and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import email_ok

UNPROCESSABLE = 422


def product_faults(optional: bool = False) -> Column:
    """Comma-joined names of the offending fields; empty when the row is fine.

    ``optional=True`` is the partial update: a null field is not checked.
    """

    def fault(name: str, bad: Column, required: bool) -> Column:
        test = bad if not required or optional else F.col(name).isNull() | bad
        return F.when(test, name)

    return F.concat_ws(
        ",",
        fault("name", F.lit(False), True),
        fault("description", F.lit(False), True),
        fault("price", F.col("price") <= 0, True),
        fault("quantity", F.col("quantity") < 0, True),
    )


def checked_products(products: DataFrame, optional: bool = False) -> DataFrame:
    accepted = F.lit(200 if optional else 201)
    return products.withColumn("faults", product_faults(optional)).withColumn(
        "status_code",
        F.when(F.col("faults") == "", accepted).otherwise(UNPROCESSABLE).cast("bigint"),
    )


def request_ok(items: str = "items", key: str = "idempotency_key") -> Column:
    """Validity of a nested request: items present, all quantities positive, key present."""
    return (
        F.coalesce(F.size(items) >= 1, F.lit(False))
        & F.coalesce(F.forall(items, lambda x: x.quantity > 0), F.lit(False))
        & F.col(key).isNotNull()
    )


def checked_requests(requests: DataFrame, items: DataFrame) -> DataFrame:
    """The same test on flat items: adds ``n_items``, ``error_code``, ``status_code``.

    Items are reduced to one row per request before they meet the requests.
    """
    facts = items.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min("quantity").alias("_least"),
        F.count_if(F.col("product_id").isNull()).alias("_unnamed"),
    )
    code = (
        F.when(F.col("idempotency_key").isNull(), "MISSING_KEY")
        .when(F.col("n_items").isNull(), "NO_ITEMS")
        .when(F.col("_unnamed") > 0, "NO_PRODUCT")
        .when(F.coalesce(F.col("_least"), F.lit(0)) <= 0, "BAD_QUANTITY")
    )
    return (
        requests.join(facts, "request_id", "left")
        .withColumn("error_code", code)
        .withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("bigint")))
        .withColumn(
            "status_code", F.when(F.col("error_code").isNull(), 201).otherwise(UNPROCESSABLE).cast("bigint")
        )
        .drop("_least", "_unnamed")
    )


def checked_emails(registrations: DataFrame) -> DataFrame:
    return registrations.withColumn("valid", email_ok(F.col("email")))
