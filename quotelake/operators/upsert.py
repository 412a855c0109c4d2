"""Upsert by key as DataFrame plans.

A batch is first folded to one row per key: columns that a repeat load does not refresh
come from the key's first row, refreshed columns (NULLs included) from its last.  That is
what loading the rows one after another leaves behind.  The fold is an aggregate with
map-side partials, so a key that holds a large share of the batch reaches the shuffle as
one row per task.  The folded batch is then merged with the stored rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UpsertPolicy:
    """``update`` columns are overwritten on a match, ``created`` is set on insert only,
    ``touched`` on every write; all other non-key columns keep their first value.

    ``newer`` names an event time among the ``update`` columns: a row whose time is before the
    stored one, however late it arrives, changes nothing.  A NULL time is before all others.
    Without it the last arrival counts."""

    keys: tuple[str, ...]
    update: tuple[str, ...]
    created: str | None = None
    touched: tuple[str, ...] = ()
    newer: str | None = None

    def __post_init__(self) -> None:
        if self.newer is not None and self.newer not in self.update:
            raise ValueError(f"{self.newer} is not among the columns that an upsert refreshes")

    @property
    def stamps(self) -> tuple[str, ...]:
        return (*((self.created,) if self.created else ()), *self.touched)

    def keep_first(self, columns: list[str]) -> list[str]:
        taken = {*self.keys, *self.update, *self.stamps}
        return [c for c in columns if c not in taken]


def fold_batch(batch: DataFrame, policy: UpsertPolicy, order: tuple[str, ...]) -> DataFrame:
    """One row per key; ``order`` must place the rows of a key without ties."""
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first = policy.keep_first([c for c in batch.columns if c not in order])
    # one comparison for all first values and one for all last values
    age = F.struct(F.col(policy.newer), position) if policy.newer else position
    ends = {"_first": (F.min_by, first, position), "_last": (F.max_by, list(policy.update), age)}
    picked = [pick(F.struct(*cs), by).alias(name) for name, (pick, cs, by) in ends.items() if cs]
    values = [F.col(f"{name}.{c}").alias(c) for name, (_, cs, _) in ends.items() for c in cs]
    return batch.groupBy(*policy.keys).agg(*picked).select(*policy.keys, *values)


def _merged_columns(
    columns: list[str], policy: UpsertPolicy, now: Column | None, stored: Column, loaded: Column
) -> list[Column]:
    def old(c: str) -> Column:
        return F.col(f"o.{c}")

    def new(c: str) -> Column:
        return F.col(f"n.{c}")

    if policy.newer:
        older = F.coalesce(new(policy.newer) < old(policy.newer), new(policy.newer).isNull() & old(policy.newer).isNotNull())
        loaded = loaded & ~(stored & F.coalesce(older, F.lit(False)))
    out = []
    for c in columns:
        if c in policy.keys:
            value = F.coalesce(new(c), old(c))
        elif c == policy.created:
            value = F.when(stored, old(c)).otherwise(now)
        elif c in policy.touched:
            value = F.when(loaded, now).otherwise(old(c))
        elif c in policy.update:  # an incoming NULL replaces a stored value
            value = F.when(loaded, new(c)).otherwise(old(c))
        else:
            value = F.when(stored, old(c)).otherwise(new(c))
        out.append(value.alias(c))
    return out


def merge(
    current: DataFrame, folded: DataFrame, policy: UpsertPolicy, now: Column | None = None
) -> DataFrame:
    """The stored rows after the folded batch is applied; both sides unique by key.

    One full outer join on the key.  The fold has already placed the batch by key, so the
    join shuffles the stored side only.
    """
    o = current.withColumn("_stored", F.lit(True)).alias("o")
    n = folded.withColumn("_loaded", F.lit(True)).alias("n")
    joined = o.join(n, _same_key(policy), "full_outer")
    stored, loaded = F.col("o._stored").isNotNull(), F.col("n._loaded").isNotNull()
    return joined.select(*_merged_columns(current.columns, policy, now, stored, loaded))


def _same_key(policy: UpsertPolicy) -> Column:
    condition = F.lit(True)
    for i, k in enumerate(policy.keys):
        same = F.col(f"o.{k}") == F.col(f"n.{k}")
        condition = same if i == 0 else condition & same
    return condition


def upsert(
    current: DataFrame,
    batch: DataFrame,
    policy: UpsertPolicy,
    order: tuple[str, ...],
    now: Column | None = None,
) -> DataFrame:
    """Fold ``batch`` in ``order``, then merge it into ``current``."""
    return merge(current, fold_batch(batch, policy, order), policy, now)


def upsert_delta(current: DataFrame, batch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row with how many keys of the batch are new (``inserted``) and known (``updated``)."""
    batch_keys = batch.select(*keys).distinct()
    known = current.select(*keys).distinct().withColumn("_known", F.lit(True))
    joined = batch_keys.join(known, list(keys), "left")
    return joined.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
    )
