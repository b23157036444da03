"""Applying change events as SCD type 1 or 2 tables.

Type 1 is a fold of maxima: for each column the latest non-NULL value together with its position, and
the positions of the last delete and the last upsert. A value counts if its position lies after the
last delete. Maxima are partial on the map side, do not depend on arrival order, and repeating an event
changes nothing, so the same fold serves batches, streams and compaction, and a key with many events
reaches the reducer as one row per map task.

Type 2 needs the order of events within a key, hence windows. Keys with more than about
``max_group_rows`` events, which a sample of keys and sequence numbers tells, are cut into blocks of the
sequence; each block is ordered on its own and receives what earlier and later blocks contribute from one
summary row per block. Where the sample finds no such key, there is one window and no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.operations import operation_rank
from tidemark.session import column, shared_folder

DELETE_EVENTS = "operation = 'DELETE'"
START, END = "__start_at", "__end_at"
DELETED_FLAG = "_is_deleted"

# Into how many blocks of about equal rows a key with many events is cut at most, and how many events of a block are
# sampled to find where.
HOT_BLOCKS = 200
SAMPLED = 100
# Events in the low bits of a rank: which of several events with one sequence, time and operation is the later one.
TIE_BITS = 56
LOWEST_RANK = -(1 << 62)


@dataclass(frozen=True)
class ApplyRules:
    """How change events become rows of the target."""

    keys: tuple[str, ...]
    sequence: str = "_seq_num"
    soft_delete: bool = False
    ignore_nulls: bool = True
    delete_when: str = DELETE_EVENTS
    except_columns: tuple[str, ...] = ("_seq_num", "operation", "_extracted_at")
    max_group_rows: int = 1_000_000

    def values(self, events: DataFrame) -> list[str]:
        """Payload columns: all but keys, control columns and the delete flag."""
        left_out = {c.lower() for c in (*self.keys, *self.except_columns, self.sequence, DELETED_FLAG)}
        return [c for c in events.columns if c.lower() not in left_out]

    def position(self, events: DataFrame) -> Column:
        """Order of an event: sequence, extraction time, load < insert < update < delete, then a hash of its values.

        The hash makes it an order of whole events, so that of several that tie in all else the values of one count
        in every column.
        """
        parts = [column(self.sequence).alias("seq")]
        parts.append((F.col("_extracted_at") if "_extracted_at" in events.columns else F.lit(0)).cast("bigint").alias("at"))
        rank = (operation_rank(F.col("operation")) if "operation" in events.columns else F.lit(0)).cast("bigint")
        values = [column(c) for c in self.values(events)]
        tie = F.shiftrightunsigned(F.xxhash64(*[hashable(v, events.schema[c].dataType) for c, v in zip(self.values(events), values)]), 64 - TIE_BITS) if values else F.lit(0)
        parts.append((F.shiftleft(rank, TIE_BITS) + tie).alias("rank"))
        return F.struct(*parts)

    @property
    def by(self) -> list[Column]:
        return [column(k) for k in self.keys]

    @property
    def deletes(self) -> Column:
        return F.coalesce(F.expr(self.delete_when), F.lit(False))


def hashable(value: Column, kind: T.DataType) -> Column:
    """The value in a form that can be hashed; maps and variants have none of their own."""
    return value if isinstance(kind, T.AtomicType) else F.to_json(F.struct(value.alias("v")))


def rules(keys: Sequence[str] | str, **options) -> ApplyRules:
    """Rules for one or several key columns."""
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    if not keys:
        raise ValueError("change events are applied by key; no key was given")
    return ApplyRules(keys=keys, **options)


def mark(events: DataFrame, how: ApplyRules) -> DataFrame:
    """Keys and payload with the position of each event and whether it deletes."""
    payload = [column(c) for c in how.values(events)]
    return events.select(*how.by, *payload, how.position(events).alias("_pos"), how.deletes.alias("_del"))


# ---- type 1 ---------------------------------------------------------------------------------------


def fold_state(events: DataFrame, how: ApplyRules) -> DataFrame:
    """Per key, the latest positions and values; states of disjoint or overlapping events can be merged."""
    values = how.values(events)
    marked = mark(events, how)
    position, deleted = F.col("_pos"), F.col("_del")
    kept = F.lit(True) if how.soft_delete else ~deleted
    latest = [
        F.max(F.when(deleted, position)).alias("_deleted_pos"),
        F.max(F.when(~deleted, position)).alias("_upsert_pos"),
    ]
    if how.ignore_nulls:
        latest += [
            F.max(F.when(kept & column(c).isNotNull(), F.struct(position.alias("pos"), column(c).alias("value")))).alias(c)
            for c in values
        ]
    else:
        row = F.struct(position.alias("pos"), F.struct(*[column(c) for c in values]).alias("value"))
        latest.append(F.max(F.when(kept, row)).alias("_row"))
    return marked.groupBy(*how.by).agg(*latest)


def merge_states(states: DataFrame, how: ApplyRules) -> DataFrame:
    """One state per key from any number of partial ones."""
    return states.groupBy(*how.by).agg(*[F.max(column(c)).alias(c) for c in states.columns if c not in how.keys])


def finish_state(state: DataFrame, how: ApplyRules, with_start: bool = False) -> DataFrame:
    """Current rows from a merged state."""
    deleted, upserted = F.col("_deleted_pos"), F.col("_upsert_pos")
    payload = [c for c in state.columns if c not in (*how.keys, "_deleted_pos", "_upsert_pos")]

    def current(latest: Column, value: Column) -> Column:
        if how.soft_delete:
            return value
        return F.when(deleted.isNull() | (latest["pos"] > deleted), value)

    if how.ignore_nulls:
        columns = [current(column(c), column(c)["value"]).alias(c) for c in payload]
    else:
        names = state.schema["_row"].dataType["value"].dataType.names
        columns = [current(F.col("_row"), F.col("_row.value").getField(c)).alias(c) for c in names]
    start = [upserted["seq"].alias(START)] if with_start else []
    if how.soft_delete:
        flag = deleted.isNotNull() & (upserted.isNull() | (deleted > upserted))
        if with_start:
            start = [F.greatest(upserted["seq"], deleted["seq"]).alias(START)]
        return state.select(*how.by, *columns, flag.alias(DELETED_FLAG), *start)
    live = upserted.isNotNull() & (deleted.isNull() | (upserted > deleted))
    return state.where(live).select(*how.by, *columns, *start)


def scd1(events: DataFrame, how: ApplyRules) -> DataFrame:
    """Current state of every key."""
    return finish_state(fold_state(events, how), how)


# ---- type 2 ---------------------------------------------------------------------------------------


def _same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & column(key, left).eqNullSafe(column(key, right))
    return on


def _hot_keys(events: DataFrame, how: ApplyRules) -> DataFrame | None:
    """Keys with more than about ``max_group_rows`` events and sequence numbers that cut them into even blocks, if any.

    Where the cuts lie, and whether a key is cut at all, has no bearing on the result, so a sample does. Its rows are
    at most one for each ``max_group_rows`` events; it is written once, so that all who use it see the same cuts.
    """
    share = min(1.0, SAMPLED / how.max_group_rows)
    limit = how.max_group_rows * share
    seen = events.select(*how.by, F.col("_pos.seq").alias("_seq"))
    seen = seen if share == 1.0 else seen.sample(share, seed=11)
    shares = F.array(*[F.lit(i / HOT_BLOCKS) for i in range(1, HOT_BLOCKS)])
    counted = seen.groupBy(*how.by).agg(F.count("*").alias("_n"), F.percentile_approx("_seq", shares, 4 * HOT_BLOCKS).alias("_cuts"))
    blocks = F.least(F.lit(HOT_BLOCKS), F.ceil(F.col("_n") / limit)).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), blocks - 1), lambda i: F.element_at("_cuts", F.floor(i * HOT_BLOCKS / blocks).cast("int")))
    hot = counted.where((F.col("_n") > limit) & F.col("_cuts").isNotNull()).select(*how.by, F.array_distinct(chosen).alias("_cuts"), F.lit(True).alias("_hot"))
    path = shared_folder(events.sparkSession, "hot-keys")
    hot.write.parquet(path)
    found = events.sparkSession.read.schema(hot.schema).parquet(path)
    return None if found.isEmpty() else found


def _with_blocks(events: DataFrame, hot: DataFrame | None, how: ApplyRules, join: str) -> DataFrame:
    """Adds ``_block``, the number of cuts below an event of a hot key; events without a number come first."""
    if hot is None:
        return events.withColumn("_block", F.lit(None).cast("int"))
    joined = events.alias("e").join(hot.alias("h"), _same_keys(how.keys, "e", "h"), join)
    below = F.coalesce(F.size(F.filter("h._cuts", lambda cut: cut < F.col("e._pos.seq"))), F.lit(0))
    block = F.when(F.col("h._hot"), F.when(F.col("e._pos.seq").isNull(), -1).otherwise(below))
    return joined.select("e.*", block.alias("_block"))


def scd2(events: DataFrame, how: ApplyRules) -> DataFrame:
    """Every version of every key, with the sequence at which it starts and ends (NULL while open).

    Each event opens a version; of events with the same sequence number the last one counts.
    """
    return versions_of_marked(mark(events, how), how.values(events), how)


def _filled(name: str) -> Column:
    return F.when(column(name).isNotNull(), F.struct(F.col("_pos").alias("pos"), column(name).alias("value")))


def versions_of_marked(marked: DataFrame, values: Sequence[str], how: ApplyRules) -> DataFrame:
    """Versions of marked events; ``values`` are their payload columns."""
    carries = {c: f"_f{i}" for i, c in enumerate(values)} if how.ignore_nulls else {}
    hot = _hot_keys(marked, how)
    blocks = _with_blocks(marked, hot, how, "left")
    group = [*how.by] if hot is None else [*how.by, F.col("_block")]
    ordered = W.partitionBy(*group).orderBy("_pos")
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    kept = F.lit(True) if how.soft_delete else ~F.col("_del")

    # Within a block: last non-NULL values and last delete so far, and where the next event starts.
    # Shuffling first keeps the window inputs, which repeat the position, out of the shuffle.
    local = blocks.repartition(*group).select(
        *how.by, "_block", "_pos", "_del",
        *([] if carries else [column(c) for c in values]),
        F.lead(F.col("_pos.seq")).over(ordered).alias("_next"),
        *[F.last(F.when(kept, _filled(c)), ignorenulls=True).over(so_far).alias(f) for c, f in carries.items()],
        *([] if how.soft_delete else [F.last(F.when(F.col("_del"), F.col("_pos")), ignorenulls=True).over(so_far).alias("_d")]),
    )
    if hot is None:
        joined, kinds = local.alias("l"), {f.name: f.dataType for f in local.schema}
        carry = lambda name: F.lit(None).cast(kinds[name])
    else:
        joined = local.alias("l").join(_carried(marked, hot, carries, how).alias("c"), _same_keys([*how.keys, "_block"], "l", "c"), "left")
        carry = lambda name: F.col(f"c.{name}")
    following = F.coalesce(F.col("l._next"), carry("_next"))
    start = F.col("l._pos.seq")
    last_delete = F.lit(None) if how.soft_delete else F.coalesce(F.col("l._d"), carry("_d"))

    def value(name: str) -> Column:
        if not carries:
            return column(name, "l")
        held = F.coalesce(F.col(f"l.{carries[name]}"), carry(carries[name]))
        if how.soft_delete:
            return held["value"].alias(name)
        return F.when(last_delete.isNull() | (held["pos"] > last_delete), held["value"]).alias(name)

    # Of events at one sequence number only the last is followed by a greater one.
    last_of_tie = following.isNull() | (following > start) | start.isNull()
    shown = last_of_tie if how.soft_delete else last_of_tie & ~F.col("l._del")
    flag = [F.col("l._del").alias(DELETED_FLAG)] if how.soft_delete else []
    return joined.where(shown).select(
        *[column(k, "l") for k in how.keys],
        *[value(c) for c in values],
        *flag,
        start.alias(START),
        following.alias(END),
    )


def _carried(marked: DataFrame, hot: DataFrame, carries: dict[str, str], how: ApplyRules) -> DataFrame:
    """What the blocks of hot keys get from the blocks before and after, from one summary row per block."""
    group = [*how.by, F.col("_block")]
    kept = F.lit(True) if how.soft_delete else ~F.col("_del")
    summary = _with_blocks(marked, hot, how, "inner").groupBy(*group).agg(
        F.min("_pos.seq").alias("_first"),
        F.max(F.when(F.col("_del"), F.col("_pos"))).alias("_d"),
        *[F.max(F.when(kept, _filled(c))).alias(f) for c, f in carries.items()],
    )
    by_block = W.partitionBy(*how.by).orderBy("_block")
    before = by_block.rowsBetween(W.unboundedPreceding, -1)
    return summary.select(
        *group,
        F.lead("_first").over(by_block).alias("_next"),
        F.last("_d", ignorenulls=True).over(before).alias("_d"),
        *[F.last(f, ignorenulls=True).over(before).alias(f) for f in carries.values()],
    )


def current_versions(versions: DataFrame) -> DataFrame:
    """Open versions only."""
    return versions.where(F.col(END).isNull())


def versions_as_of(versions: DataFrame, sequence: int | Column) -> DataFrame:
    """Versions valid at a sequence number."""
    at = sequence if isinstance(sequence, Column) else F.lit(sequence)
    return versions.where((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


# ---- entry ----------------------------------------------------------------------------------------


def apply_changes(events: DataFrame, keys: Sequence[str] | str, scd_type: int = 1, **options) -> DataFrame:
    """Applies change events by key as SCD type 1 or 2; ``options`` are the fields of ``ApplyRules``."""
    how = rules(keys, **options)
    if scd_type not in (1, 2):
        raise ValueError(f"scd_type {scd_type!r} is not one of [1, 2]")
    return scd1(events, how) if scd_type == 1 else scd2(events, how)


def after_reload(events: DataFrame, how: ApplyRules) -> DataFrame:
    """Drops what came before the latest full load, so keys missing from that load disappear.

    Off by default: a reload otherwise only upserts.
    """
    latest = events.where(F.col("operation") == "LOAD").agg(F.max(column(how.sequence)).alias("v"))
    return events.where(column(how.sequence) >= F.coalesce(latest.scalar(), F.lit(0)))

