"""Keyed upsert, its change feed and its statistics, all from one pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.sizing import BROADCAST_BYTES, fits_broadcast

AUDIT_COLUMNS = ("_record_hash", "_silver_created_at", "_silver_updated_at", "_update_count")
ACTIONS = ("inserted", "updated", "unchanged", "target_only")


def _old(c: str) -> str:
    return f"old__{c}"


def _new(c: str) -> str:
    return f"new__{c}"


def _side(df: DataFrame, name) -> DataFrame:
    """Prefixed columns (kept flat, so unused ones are pruned) and a presence mark."""
    return df.select(*[F.col(c).alias(name(c)) for c in df.columns], F.lit(True).alias(name("")))


def chosen_strategy(strategy: str, delta: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> str:
    """What ``auto`` stands for with this delta."""
    if strategy != "auto":
        return strategy
    return "broadcast" if fits_broadcast(delta, broadcast_bytes) else "shuffle"


def pair_changes(
    target: DataFrame,
    delta: DataFrame,
    key: str = "nct_id",
    order_by: str | None = None,
    strategy: str = "auto",
    hash_column: str = "_record_hash",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every record of either side once: key, action, ``old__*`` and ``new__*`` columns.

    ``action`` is inserted, updated, unchanged or target_only. The delta must hold
    one row per key (see ``dedupe_latest``). With ``order_by`` an incoming row older
    than the newest delivery of its key is left alone, so late files cannot revert a record.
    Rows of a null key match nothing; they are kept out of the join.

    strategy 'shuffle': one full outer join, both sides shuffled on the key.
    strategy 'broadcast': the target is not shuffled at all; it takes the delta by a
    broadcast left join, and only keys that match travel to find the inserts.
    strategy 'auto': measures the delta and broadcasts it only within the limit.
    """
    strategy = chosen_strategy(strategy, delta, broadcast_bytes)
    old, new = _side(target.filter(F.col(key).isNotNull()), _old), _side(delta.filter(F.col(key).isNotNull()), _new)
    same_key = F.col(_old(key)) == F.col(_new(key))
    if strategy == "shuffle":
        paired = old.join(new, same_key, "full_outer")
    elif strategy == "broadcast":
        matched = old.select(_old(key)).join(
            F.broadcast(new.select(_new(key))), same_key, "left_semi"
        )
        fresh = new.join(matched, same_key, "left_anti")
        paired = old.join(F.broadcast(new), same_key, "left").unionByName(
            fresh.withColumns({f.name: F.lit(None).cast(f.dataType) for f in old.schema})
        )
    else:
        raise ValueError(f"unknown strategy: {strategy}")

    # rows without a key would all meet in one task of the join
    for side, name in ((target, _old), (delta, _new)):
        paired = paired.unionByName(_side(side.filter(F.col(key).isNull()), name), allowMissingColumns=True)

    changed = F.col(_old(hash_column)) != F.col(_new(hash_column))
    if order_by is not None:
        before, now = F.col(_old(order_by)), F.col(_new(order_by))
        changed = changed & (before.isNull() | (now >= before))
    action = (
        F.when(F.col(_old("")).isNull(), ACTIONS[0])
        .when(F.col(_new("")).isNull(), ACTIONS[3])
        .when(changed, ACTIONS[1])
        .otherwise(ACTIONS[2])
    )
    return paired.withColumns(
        {key: F.coalesce(_old(key), _new(key)), "action": action}
    ).drop(_old(""), _new(""))


def _taken(
    columns: Sequence[str], key: str, update_columns: Sequence[str] | None
) -> set[str]:
    """Columns an update overwrites (default: all but the key and the audit columns)."""
    if update_columns is None:
        update_columns = [c for c in columns if c != key and c not in AUDIT_COLUMNS]
    return {*update_columns, "_record_hash", "_silver_updated_at"}


def _after_update(c: str, taken: set[str]) -> Column:
    if c == "_update_count":
        return F.col(_old(c)) + 1
    return F.col(_new(c) if c in taken else _old(c))


def apply_pairs(
    pairs: DataFrame,
    columns: Sequence[str],
    key: str = "nct_id",
    update_columns: Sequence[str] | None = None,
    keep_action: bool = False,
    order_by: str | None = None,
) -> DataFrame:
    """The table after the merge.

    ``update_columns`` lists what an update overwrites; by default every column but
    the key and the audit columns. Created-at is always kept. ``order_by`` moves on to the
    newest value that was delivered, also by a record that changes nothing else.
    """
    taken = _taken(columns, key, update_columns)

    def unchanged(c: str) -> Column:
        return F.greatest(_old(c), _new(c)) if c == order_by else F.col(_old(c))

    def updated(c: str) -> Column:
        return F.col(_new(c)) if c == order_by else _after_update(c, taken)

    merged = [
        F.when(F.col("action") == "inserted", F.col(_new(c)))
        .when(F.col("action") == "updated", updated(c))
        .otherwise(unchanged(c))
        .alias(c)
        for c in columns
    ]
    return pairs.select(*merged, *(["action"] if keep_action else []))


def merge_changes(
    target: DataFrame,
    delta: DataFrame,
    key: str = "nct_id",
    update_columns: Sequence[str] | None = None,
    order_by: str | None = None,
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Upsert ``delta`` into ``target`` by key; equal fingerprints change nothing."""
    columns = target.columns
    pairs = pair_changes(
        target, delta.select(*columns), key, order_by, strategy, broadcast_bytes=broadcast_bytes
    )
    return apply_pairs(pairs, columns, key, update_columns, order_by=order_by)


def with_order(target: DataFrame, delta: DataFrame, order_by: str | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same columns; a table that has no ``order_by`` yet gets an empty one."""
    if order_by is not None and order_by in delta.columns and order_by not in target.columns:
        target = target.withColumn(order_by, F.lit(None).cast(delta.schema[order_by].dataType))
    return target, delta.select(*target.columns)


def change_feed(
    pairs: DataFrame,
    columns: Sequence[str],
    key: str = "nct_id",
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Inserted rows, and updated rows before and after, with ``_change_type``."""
    taken = _taken(columns, key, update_columns)

    def entry(kind: str, value) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), *[value(c).alias(c) for c in columns])

    entries = F.when(
        F.col("action") == "inserted", F.array(entry("insert", lambda c: F.col(_new(c))))
    ).otherwise(
        F.array(
            entry("update_preimage", lambda c: F.col(_old(c))),
            entry("update_postimage", lambda c: _after_update(c, taken)),
        )
    )
    return (
        pairs.filter(F.col("action").isin("inserted", "updated"))
        .select(F.explode(entries).alias("e"))
        .select(*[F.col(f"e.`{c}`").alias(c) for c in columns], "e._change_type")
    )


def merge_stats(pairs: DataFrame) -> DataFrame:
    """Rows per action of one merge."""
    return pairs.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"))


def updated_rows(table: DataFrame) -> DataFrame:
    """How many records were ever updated."""
    return table.agg(F.count_if(F.col("_update_count") > 0).alias("updated_records"))
