"""Priority upsert, partial replacement and insert-only increments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimlathe.operators.keys import (
    append_keys,
    complete_keys,
    dense_key,
    keep_first,
    max_id_outside,
    max_key,
    ordering,
)
from dimlathe.operators.lookup import new_rows, unseen
from dimlathe.operators.shape import align, select_existing, stamp_lineage
from dimlathe.registry import TableSpec
from dimlathe.session import materialize

ADD, UPDATE, SKIP_PROTECTED, SKIP_EQUAL, NULL_KEY = "add", "update", "skip_protected", "skip_equal", "null_key"


def same_values(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str = "") -> Column:
    """NULL-safe equality over a column list: NULL equals NULL and nothing else."""
    tests = [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in columns]
    return reduce(lambda x, y: x & y, tests, F.lit(True))


def _incoming(batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The batch under names that cannot clash with the stored table's."""
    names = dict.fromkeys([*keys, *(c for c in columns if c in batch.columns)])
    return complete_keys(batch, keys).select(
        *(F.col(c).alias(f"__new_{c}") for c in names), F.lit(True).alias("__matched")
    )


def _join_incoming(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    match = reduce(lambda x, y: x & y, (existing[k] == incoming[f"__new_{k}"] for k in keys))
    return existing.join(incoming, match, how)


def _action_on_match(compare: Sequence[str], lineage: str, protected: str) -> Column:
    equal = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in compare), F.lit(True))
    return F.when(F.col(lineage).eqNullSafe(protected), SKIP_PROTECTED).when(equal, SKIP_EQUAL).otherwise(UPDATE)


def action_counts(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], compare: Sequence[str], protected: str,
    lineage: str = "source",
) -> DataFrame:
    """Rows of the batch per action: the reconciliation of an upsert before it is written."""
    stored = existing.select(*dict.fromkeys([*keys, lineage, *compare]))
    matched = _join_incoming(stored, _incoming(batch, keys, compare), keys, "inner")
    actions = matched.select(_action_on_match(compare, lineage, protected).alias("action"))
    added = unseen(complete_keys(batch, keys), existing, keys).select(F.lit(ADD).alias("action"))
    broken = complete_keys(batch, keys, complete=False).select(F.lit(NULL_KEY).alias("action"))
    return actions.union(added).union(broken).groupBy("action").agg(F.count("*").alias("rows"))


def _digest(columns: Sequence[str]) -> Column:
    """128 bits over named values, NULLs included."""
    return F.md5(F.to_json(F.struct(*(F.col(f"`{c}`").alias(c) for c in sorted(columns))), {"ignoreNullFields": "false"}))


def digest_index(
    table: DataFrame, keys: Sequence[str], compare: Sequence[str], lineage: str = "source", first_by: Sequence[str] | None = None
) -> DataFrame:
    """A narrow side table for change detection: natural key, lineage, digest of the compared columns.

    Store it next to the table, bucketed alike. ``first_by`` names the row that counts where a key is stored more than once.
    """
    rows = complete_keys(table, keys)
    rows = keep_first(rows, keys, first_by) if first_by else rows
    return rows.select(*keys, F.col(lineage).alias("__lineage"), _digest(compare).alias("__digest"))


def changed_rows(index: DataFrame, batch: DataFrame, keys: Sequence[str], compare: Sequence[str], protected: str) -> DataFrame:
    """Batch rows whose key is new, or whose values differ from the stored ones and may replace them.

    Only the index and the batch's keys and compared columns are joined; wide stored rows are not read. Equal digests count as
    equal values; rows whose digests differ are compared again by value where they are merged.
    """
    held = index.select(*(F.col(k).alias(f"__i{i}") for i, k in enumerate(keys)), "__lineage", "__digest")
    narrow = batch.select(*keys, _digest(compare).alias("__now"))
    same = reduce(lambda x, y: x & y, (F.col(k) == F.col(f"__i{i}") for i, k in enumerate(keys)))
    settled = F.col("__lineage").eqNullSafe(protected) | (F.col("__digest") == F.col("__now"))
    done = narrow.join(held, same).where(settled).select(*(F.col(k).alias(f"__d{i}") for i, k in enumerate(keys))).distinct()
    return batch.join(done, reduce(lambda x, y: x & y, (F.col(k) == F.col(f"__d{i}") for i, k in enumerate(keys))), "left_anti")


def refresh_index(index: DataFrame, written: DataFrame, keys: Sequence[str], compare: Sequence[str], lineage: str = "source") -> DataFrame:
    """The index after ``written``, the added and updated rows as they are stored now."""
    fresh = digest_index(written, keys, compare, lineage)
    return unseen(index, fresh, keys).unionByName(fresh)


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    surrogate: str,
    compare: Sequence[str],
    preserve: Sequence[str],
    protected: str,
    key_order: Sequence[str],
    load_ts: datetime,
    lineage: str = "source",
    loaded_at: str = "created_at",
    floor: int | Column = 0,
    first_existing_by: Sequence[str] | None = None,
    last_batch_by: Sequence[str] | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Merge a batch into a table by natural key; the result is the whole new table.

    Per batch row: no stored match, add with the next surrogate key; match of protected lineage,
    keep the stored row; equal ``compare`` columns, keep it; otherwise update all columns but
    ``preserve``. Batch rows with a NULL key part are left out (``action_counts`` reports them).

    The stored table is left-joined to the batch instead of a full outer join: a batch under the
    broadcast threshold then moves none of the stored rows. Of a key repeated in the batch the last row by
    ``last_batch_by`` (else by ``key_order``) counts. No stored row is ever removed; ``first_existing_by`` names the one that
    is updated where a key is stored more than once. When ``existing``
    is only the part of a table that the batch touches, ``floor`` is the largest key of the rest. With an ``index`` of the
    stored table (``digest_index``) only new and changed rows of the batch meet the wide stored rows.
    """
    batch = keep_first(complete_keys(batch, keys), keys, [F.col(c).desc_nulls_first() for c in last_batch_by or key_order])
    if index is not None:
        # The merge reads the batch in several places; what has changed is found once.
        batch = materialize(changed_rows(index, batch, keys, compare, protected), "changed")
    columns = existing.columns
    if first_existing_by is not None:
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering(first_existing_by)))
        existing = existing.withColumn("__place", place)
    fresh = [c for c in existing.columns if c in batch.columns and c not in preserve and c not in keys]
    incoming = _incoming(batch, keys, [*fresh, *compare])
    action = F.when(F.col("__matched"), _action_on_match(compare, lineage, protected))
    if first_existing_by is not None:  # a key's other stored rows stay as they are
        action = F.when(F.col("__place") == 1, action)
    joined = _join_incoming(existing, incoming, keys, "left").withColumn("__action", action)
    updated = F.col("__action") == UPDATE
    stored = joined.select(
        *(
            F.when(updated, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c)
            for c in columns
        )
    )
    added = unseen(complete_keys(batch, keys), existing, keys)
    added = added.withColumn(loaded_at, F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz"))
    floor = F.lit(floor) if isinstance(floor, int) else floor
    start = F.greatest(max_key(existing, surrogate), floor)
    added = dense_key(select_existing(added, columns), surrogate, key_order, start=start)
    return align(stored, added)


def upsert_table(
    existing: DataFrame, batch: DataFrame, spec: TableSpec, *, protected: str, key_order: Sequence[str],
    load_ts: datetime, **options,
) -> DataFrame:
    """``upsert`` with keys and columns from a table declaration."""
    return upsert(
        existing, batch, keys=spec.natural, surrogate=spec.surrogate, compare=spec.compare,
        preserve=spec.preserved, protected=protected, key_order=key_order, load_ts=load_ts,
        lineage=spec.lineage, loaded_at=spec.loaded_at, **options,
    )


def replace_unprotected(
    existing: DataFrame,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    protected: Sequence[str],
    surrogate: str,
    key_order: Sequence[str],
    lineage: str = "source",
    rekey: bool = True,
    scope: Sequence[str] | None = None,
    floor: int | Column = 0,
) -> DataFrame:
    """Keep protected rows, drop the others, add batch rows whose key no protected row has.

    With ``scope`` only rows whose values of these columns the batch holds are replaced; the rest of the table stays.
    A NULL key part equals a NULL key part. ``rekey=True`` numbers the whole result anew; ``rekey=False`` numbers only
    rows whose key was not stored: added rows take over the stored number of their key, so published keys stay valid.
    When ``existing`` is only the part of a table that the batch touches, ``floor`` is the largest number of the whole.
    """
    safe = F.coalesce(F.col(lineage).isin(*protected), F.lit(False))
    kept, replaced = existing.where(safe), existing.where(~safe)
    if scope is not None:
        kept = align(kept, unseen(replaced, batch, scope, null_safe=True))
    added = unseen(batch, kept, keys, null_safe=True)
    if rekey:
        merged = align(kept.drop(surrogate), select_existing(added, [c for c in existing.columns if c != surrogate]))
        return dense_key(merged, surrogate, key_order)
    stored = keep_first(replaced, keys, [surrogate]).select(
        *(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(surrogate).alias("__stored")
    )
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
    columns = [c for c in existing.columns if c != surrogate]
    # Of a key repeated in the batch only the first row can take over the number.
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering(key_order)))
    added = select_existing(added, columns).withColumn("__place", place)
    known = added.join(stored, same & (F.col("__place") == 1), "left").drop("__place", *(f"__k{i}" for i in range(len(keys))))
    known = materialize(known, "replaced")
    again = known.where("__stored IS NOT NULL").withColumnRenamed("__stored", surrogate)
    floor = F.lit(floor) if isinstance(floor, int) else floor
    start = F.greatest(max_key(existing, surrogate), floor)
    fresh = dense_key(known.where("__stored IS NULL").drop("__stored"), surrogate, key_order, start=start)
    return align(align(kept, again), fresh)


def increment(
    existing: DataFrame,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    surrogate: str,
    key_order: Sequence[str],
    source: str,
    load_ts: datetime,
    columns: Sequence[str] | None = None,
    identity: str | None = None,
    identity_floor: int = 0,
    protected: str | None = None,
    lineage: str = "source",
    loaded_at: str = "created_at",
) -> DataFrame:
    """The rows an insert-only increment adds: unseen keys, next surrogate keys, new lineage.

    The surrogate maximum is taken over the whole table. ``identity`` also continues the natural id
    after the largest one outside ``protected`` lineage, or after ``identity_floor``.
    A key repeated in the batch is added once, at its first place in ``key_order``.
    """
    new = new_rows(batch, existing, keys, key_order)
    new = append_keys(new, existing, surrogate, key_order)
    if identity:
        largest = max_key(existing, surrogate)
        after = max_id_outside(existing, identity, lineage, protected, identity_floor)
        new = new.withColumn(identity, F.col(surrogate) - largest + after)
    new = stamp_lineage(new, source, load_ts, lineage, loaded_at)
    return select_existing(new, columns or existing.columns)
