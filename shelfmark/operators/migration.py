"""Rebuilding snapshots from the older split or single tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.values import as_uuid, content_fingerprint
from shelfmark.operators.history import source_rows
from shelfmark.operators.store import Store
from shelfmark.schemas import MONEY, validate_money

#: Columns of the rebuilt table with their types and what stands where the old table has none (fixed values).
TARGET = {
    "id": ("bigint", "NULL"), "canonical_product_id": ("string", "NULL"), "parser_name": ("string", "'unknown'"), "source_id": ("string", "concat('generated:', id)"), "source_run_id": ("string", "NULL"), "receiver_product_id": ("bigint", "NULL"),
    "receiver_artifact_id": ("bigint", "NULL"), "receiver_sort_order": ("int", "NULL"), "source_event_uid": ("string", "NULL"), "content_fingerprint": ("string", "NULL"), "valid_from_at": ("timestamp", "observed_at"), "valid_to_at": ("timestamp", "observed_at"), "price": ("decimal(12,4)", "NULL"),
    "discount_price": ("decimal(12,4)", "NULL"), "loyal_price": ("decimal(12,4)", "NULL"), "price_unit": ("string", "NULL"), "available_count": ("double", "NULL"), "observed_at": ("timestamp", "NULL"), "created_at": ("timestamp", "observed_at"),
}


def from_split(events: DataFrame, snapshots: DataFrame | None = None, counts: DataFrame | None = None, now: str | None = None) -> DataFrame:
    """The target's columns from the split tables: events (id) left-joined with snapshots (id) and available counts (snapshot_id), where
    these exist. Prices come from the snapshot, available_count from the counts, else the snapshot; created_at from the
    event, the counts, the event's observed_at, or now. Rows are in no order; write them sorted by id where order matters."""
    d = events
    if snapshots is not None:
        d = d.join(snapshots.select([F.col(c).alias(f"s_{c}") for c in snapshots.columns]), F.col("id") == F.col("s_id"), "left")
    if counts is not None:
        d = d.join(counts.select([F.col(c).alias(f"c_{c}") for c in counts.columns]), F.col("id") == F.col("c_snapshot_id"), "left")
    have = set(d.columns)
    first = lambda *names: F.coalesce(F.lit(None), *[F.col(n) for n in names if n in have])
    sources = {name: (name, f"s_{name}") for name in TARGET} | {"available_count": ("c_available_count", "s_available_count"), "created_at": ("created_at", "c_created_at", "observed_at")}
    base = d.select(*[first(*names).cast(TARGET[n][0]).alias(n) for n, names in sources.items()])
    if now:
        base = base.withColumn("created_at", F.coalesce("created_at", F.lit(now).cast("timestamp")))
    return with_defaults(base)


def with_defaults(base: DataFrame) -> DataFrame:
    return base.select(*[F.coalesce(F.col(c), F.expr(default).cast(t)).alias(c) for c, (t, default) in TARGET.items()])


def from_single(old: DataFrame) -> DataFrame:
    """The target's columns from whatever the old table has, defaults elsewhere."""
    have = set(old.columns)
    base = old.select(*[F.col(c).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, (t, _) in TARGET.items()])
    return with_defaults(base)


def duplicate_uids(df: DataFrame) -> DataFrame:
    """Event uids that occur more than once: the target must have none."""
    return df.where("source_event_uid IS NOT NULL").groupBy("source_event_uid").count().where("count > 1")


def checked(df: DataFrame) -> DataFrame:
    """df, or ValueError if an event uid occurs twice or a money column isn't decimal(12,4)."""
    validate_money(df, "snapshots")
    twice = duplicate_uids(df).limit(3).collect()
    if twice:
        raise ValueError(f"source_event_uid occurs more than once: {', '.join(r.source_event_uid for r in twice)}")
    return df


def live(rebuilt: DataFrame) -> DataFrame:
    """The rebuilt table in the layout of the live one: ids from event uids (or the old id), missing fingerprints from the prices, one
    row a snapshot, and the receiver's ids as payload."""
    uid = F.coalesce("source_event_uid", F.concat(F.lit("migrated:"), F.col("id").cast("string")))
    old = F.to_json(F.struct(F.col("source_run_id").alias("run_id"), F.col("receiver_artifact_id").alias("artifact_id"), F.col("receiver_product_id").alias("product_id"), F.col("receiver_sort_order").alias("sort_order")))
    fingerprint = F.coalesce("content_fingerprint", content_fingerprint({c: F.col(c).cast("double") for c in MONEY}))
    return rebuilt.select(
        as_uuid(uid).alias("snapshot_id"), "parser_name", "source_id", fingerprint.alias("content_fingerprint"), F.col("valid_from_at").alias("valid_from"), F.col("valid_to_at").alias("valid_to"), F.lit(1).cast("long").alias("n_rows"),
        uid.alias("source_event_uid"), "canonical_product_id", *MONEY, "price_unit", "available_count", old.alias("payload"),
    )


def swap(store: Store, rebuilt: DataFrame, table: str = "snapshots", legacy: tuple[str, ...] = ()) -> int:
    """Puts the rebuilt table, in the live layout, in place of the live one, its sources beside it, and drops the legacy tables, all in
    one commit: the sync goes on from it. vacuum() then frees the old files."""
    base = store.manifest()
    base["tables"] = {n: t for n, t in base["tables"].items() if n not in (table, "sources", *legacy)}
    rows = live(checked(rebuilt))
    return store.commit({table: (rows, ["snapshot_id"]), "sources": (source_rows(rows, None), ["parser_name", "source_id"])}, base)
