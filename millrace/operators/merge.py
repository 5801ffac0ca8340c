"""Keyed merge of a batch of rows into a table's rows, on plain DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import fits_broadcast, sized

_ROW, _HIT = "__row", "__hit"


def _null_key(keys: list[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(f"`{k}`").isNull()
    return cond


def one_row_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None, last: bool = True) -> DataFrame:
    """Keep one row per key: the last (or first) by ``order``, ties by the row's other values.

    A max over a struct instead of a row number over a window: it combines on the
    map side, so a key with a third of the rows reaches the shuffle as one row per
    task, and the choice is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    lead = [c for c in (order or []) if c in rest]
    maps = [c for c in rest if "map<" in df.schema[c].dataType.simpleString()]
    row = F.struct(*[F.col(f"`{c}`") for c in lead + [c for c in rest if c not in lead]])
    if maps:
        # Maps have no order: rows go by the sequence, then by their text.
        by = F.struct(*[F.col(f"`{c}`") for c in lead], F.to_json(row))
        pick = F.max_by(row, by) if last else F.min_by(row, by)
    else:
        pick = F.max(row) if last else F.min(row)
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias(_ROW)).select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"{_ROW}.`{c}`").alias(c) for c in df.columns]
    )


def _checked(target: DataFrame, batch: DataFrame, keys: list[str]) -> list[str]:
    if not keys:
        raise ValueError("merge needs keys")
    absent = [k for k in keys if k not in batch.columns or k not in target.columns]
    if absent:
        raise ValueError(f"merge keys {absent} are not in both tables")
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the target")
    values = [c for c in batch.columns if c not in keys]
    if not values:
        raise ValueError("nothing to update: all columns are merge keys")
    return values


def merge_update(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    sequence: str | None = None,
    narrow: bool | None = None,
) -> DataFrame:
    """Upsert: rows of ``batch`` replace the columns they carry, unknown keys are added.

    Of several batch rows with one key the last by ``sequence`` wins; ``sequence``
    itself is stored only if the target has such a column. NULL keys never match:
    those rows are added as they are, and they stay out of the joins, where they
    would all land in one partition.

    ``narrow``: with a batch small enough to broadcast, the target is scanned twice
    (once for its keys only) and never shuffled; otherwise a left join
    and an anti join for new keys shuffle both sides. Decided from the batch's size unless given.
    """
    stored = batch.columns if sequence is None or sequence in target.columns else [
        c for c in batch.columns if c != sequence
    ]
    values = _checked(target, batch.select(*stored), keys)
    null_key = _null_key(keys)
    fresh = one_row_per_key(
        batch.filter(~null_key), keys, [sequence] if sequence else None
    ).select(*stored)
    fresh = sized(fresh, "merge-batch")
    if narrow is None:
        narrow = fits_broadcast(fresh)
    fresh = fresh.withColumns({c: F.col(c).cast(target.schema[c].dataType) for c in stored})
    changes = fresh.select(
        *keys, F.struct(*[F.col(c) for c in values]).alias(_ROW), F.lit(True).alias(_HIT)
    )
    known = target.filter(~null_key)

    def settled(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in values:
            return F.when(F.col(_HIT), F.col(f"{_ROW}.`{name}`")).otherwise(F.col(name)).alias(name)
        return F.col(name)

    columns = [settled(c) for c in target.columns]
    if narrow:
        hit_keys = target.select(*keys).join(changes.select(*keys), keys, "left_semi")
        merged = known.join(changes, keys, "left").select(*columns).unionByName(
            fresh.join(hit_keys, keys, "left_anti"), allowMissingColumns=True
        )
    else:
        # Left join and anti join instead of one full outer join: there, no side of a hot key can be split.
        merged = known.join(changes, keys, "left").select(*columns).unionByName(
            fresh.join(known.select(*keys), keys, "left_anti"), allowMissingColumns=True
        )
    keyless = [target.filter(null_key), batch.filter(null_key).select(*stored)]
    for part in keyless:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return _as_target(merged, target)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], sequence: str | None = None) -> DataFrame:
    """Batch rows whose key the target lacks, the first by ``sequence`` per key; NULL keys all.

    Only the target's key columns are read. Appending these rows is the whole of a
    merge that leaves existing rows alone.
    """
    stored = batch.columns if sequence is None or sequence in target.columns else [
        c for c in batch.columns if c != sequence
    ]
    _checked(target, batch.select(*stored), keys)
    null_key = _null_key(keys)
    first = one_row_per_key(batch.filter(~null_key), keys, [sequence] if sequence else None, last=False)
    first = sized(first.select(*stored), "merge-batch")
    if fits_broadcast(first):
        # Keys of the batch that the target has: a scan of the target's keys, no shuffle of it.
        known = target.select(*keys).join(first.select(*keys), keys, "left_semi")
        known = sized(known.distinct(), "merge-known")
    else:
        known = target.select(*keys)
    added = first.join(known, keys, "left_anti")
    added = added.unionByName(batch.filter(null_key).select(*stored))
    empty = target.limit(0)
    return _as_target(empty.unionByName(added, allowMissingColumns=True), target)


def merge_nothing(target: DataFrame, batch: DataFrame, keys: list[str], sequence: str | None = None) -> DataFrame:
    """Insert unknown keys, keep every existing row."""
    return target.unionByName(new_rows(target, batch, keys, sequence))


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    on_conflict: str = "update",
    sequence: str | None = None,
) -> DataFrame:
    if on_conflict == "update":
        return merge_update(target, batch, keys, sequence)
    if on_conflict in ("nothing", "ignore"):
        return merge_nothing(target, batch, keys, sequence)
    raise ValueError(f"unknown conflict action {on_conflict!r}")


def _as_target(df: DataFrame, target: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )
