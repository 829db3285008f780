"""Catalog changes, user registration and age-bounded lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.operators.dedupe import first_per_key
from ledgerbrook.operators.running import ROWS_PER_SLICE, running

FIELDS = ("name", "description", "price", "quantity")


def apply_updates(products: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Latest non-null value per field wins; a null field is left alone.

    ``updates`` is reduced to one row per product first. ``updated`` tells whether
    the product had any update.
    """
    fields = [f for f in FIELDS if f in updates.columns]
    latest = updates.groupBy(F.col("product_id").alias("_id")).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(seq))).alias(f"_u_{f}") for f in fields]
    )
    merged = products.join(latest, products["id"] == F.col("_id"), "left")
    return merged.select(
        "id",
        *[F.coalesce(f"_u_{f}", f).alias(f) if f in fields else F.col(f) for f in FIELDS],
        F.col("_id").isNotNull().alias("updated"),
    )


def missing_updates(products: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of products that do not exist."""
    return updates.join(products.select(F.col("id").alias("product_id")), "product_id", "left_anti")


def judge_deletes(deletes: DataFrame, products: DataFrame, references: DataFrame) -> DataFrame:
    """MISSING when there is no such product, BLOCKED when an order line refers to it, else DELETED.

    One outcome per row of ``deletes``, also where an id stands in the catalog more than once.
    """
    known = products.select(F.col("id").alias("product_id")).distinct().withColumn("_known", F.lit(True))
    used = references.select("product_id").distinct().withColumn("_used", F.lit(True))
    outcome = (
        F.when(F.col("_known").isNull(), "MISSING").when(F.col("_used"), "BLOCKED").otherwise("DELETED")
    )
    return (
        deletes.join(known, "product_id", "left")
        .join(used, "product_id", "left")
        .select("product_id", outcome.alias("outcome"))
    )


def delete_products(products: DataFrame, judged: DataFrame) -> DataFrame:
    gone = judged.where("outcome = 'DELETED'").select(F.col("product_id").alias("id"))
    return products.join(gone, "id", "left_anti")


def register_unique(registrations: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """201 for the first registration of an e-mail, 409 for the rest.

    The first one is found by aggregation and matched on (email, seq), so a
    single much-repeated e-mail does not gather in one task.
    """
    firsts = registrations.groupBy("email").agg(F.min("seq").alias("seq"))
    if users is not None:
        firsts = firsts.join(users.select("email"), "email", "left_anti")
    firsts = firsts.withColumn("_first", F.lit(True))
    return (
        registrations.join(firsts, ["email", "seq"], "left")
        .withColumn("status_code", F.when(F.col("_first"), 201).otherwise(409).cast("bigint"))
        .drop("_first")
    )


# fixed values: product and quantity of the first stock rows
FIRST_STOCK = ((1, 100), (2, 50))


def stock_rows(quantities: DataFrame) -> DataFrame:
    """New stock rows (product_id, quantity) with nothing reserved."""
    return quantities.select("product_id", "quantity", F.lit(0).cast("bigint").alias("reserved_quantity"))


def seed_if_absent(inventory: DataFrame, seed: DataFrame) -> DataFrame:
    """Add a stock row, nothing reserved, for each seeded product that has none."""
    new = first_per_key(seed, ["product_id"], ["quantity"]).join(
        inventory.select("product_id"), "product_id", "left_anti"
    )
    return inventory.select("product_id", "quantity", "reserved_quantity").unionByName(stock_rows(new))


def asof_with_ttl(
    reads: DataFrame, versions: DataFrame, ttl_seconds: int, tie: str = "id", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Each read with the last version of its key, if that is young enough and not a tombstone.

    ``reads``: id, key, ts. ``versions``: id, key, ts, value (null value = tombstone).
    Adds ``hit``, ``value`` and ``filled_at``. A version older than ``ttl_seconds``
    cannot serve, so a read needs only the versions of its own time bucket (one ttl
    wide) and the one before: both sides meet in (key, bucket), which also splits a
    busy key along time. Reads go on shuffling once, versions twice their size.
    """

    bucket = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(ttl_seconds * 1_000_000))
    filled = versions.select(
        "key",
        "ts",
        F.col(tie).alias("_tie"),
        F.lit(0).alias("_kind"),
        F.struct("ts", "value").alias("_version"),
        F.explode(F.array(bucket, bucket + 1)).alias("_bucket"),
    )
    asked = reads.select(
        "key",
        "ts",
        F.col(tie).alias("_tie"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(filled.schema["_version"].dataType).alias("_version"),
        bucket.alias("_bucket"),
    )
    # a running value: the rows of a busy (key, bucket) are cut into slices
    served = running(
        asked.unionByName(filled), ["key", "_bucket"], ["ts", "_kind", "_tie"], {"_last": ("last", "_version")},
        rows_per_slice=rows_per_slice,
    ).where("_kind = 1")
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_last.ts").cast("timestamp"))
    hit = F.coalesce((age <= ttl_seconds * 1_000_000) & F.col("_last.value").isNotNull(), F.lit(False))
    return served.withColumn("hit", hit).select(
        F.col("_tie").alias(tie),
        "key",
        "ts",
        "hit",
        F.when(F.col("hit"), F.col("_last.value")).alias("value"),
        F.when(F.col("hit"), F.col("_last.ts")).alias("filled_at"),
    )
