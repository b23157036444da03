from __future__ import annotations

import random

import brute_force
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import uoid_of
from tidemark.operators.apply import rules
from tidemark.operators.envelope import to_envelope
from tidemark.operators.sinks import write_landing
from tidemark.operators.widening import UnsupportedTypeChange
from tidemark.streaming.bronze import bronze_table, start_bronze
from tidemark.streaming.silver import SilverTable, apply_all, apply_stream

PAYLOAD = T.StructType().add("key", "integer").add("a", "string").add("b", "integer")
CODES = {"LOAD": "L", "INSERT": "I", "UPDATE": "U", "DELETE": "D"}


def envelopes(spark, events, table="t"):
    changes = [(seq, CODES[op], key, a, b) for key, seq, op, a, b in events]
    fields = "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, key int, a string, b int"
    return to_envelope(spark.createDataFrame(changes, fields), "db", "dbo", table, extracted_at_ms=1)


def batches(rng, events, n, overlap=True):
    """Events in any order over ``n`` batches, some of them delivered twice."""
    scrambled = rng.sample(events, len(events))
    split = [scrambled[i::n] for i in range(n)]
    return [part + (rng.sample(events, 3) if overlap else []) for part in split]


def expected(events, scd_type, soft, ignore_nulls):
    fold = brute_force.scd1 if scd_type == 1 else brute_force.scd2
    return fold(events, soft, ignore_nulls)


@pytest.mark.parametrize(
    "scd_type,soft,ignore_nulls,in_order",
    [(1, False, True, False), (1, True, False, False), (2, False, True, True), (2, True, True, False), (2, False, False, False)],
)
def test_batches_end_like_one_fold(spark, folder, scd_type, soft, ignore_nulls, in_order):
    rng = random.Random(11)
    events = brute_force.random_events(rng, n=50)
    if in_order:
        events.sort(key=lambda e: (e[1], brute_force.RANK[e[2]]))
        parts = [events[i : i + 17] for i in range(0, len(events), 17)]
    else:
        parts = batches(rng, events, 3)
    how = rules("key", soft_delete=soft, ignore_nulls=ignore_nulls)
    silver = SilverTable(spark, folder, PAYLOAD, how, scd_type, buckets=2, parts_per_bucket=1)
    seen = []
    for number, part in enumerate(parts):
        seen += part
        silver.apply_batch(envelopes(spark, part), number)
    assert columns_sorted(silver.read(), soft, scd_type) == expected(list(dict.fromkeys(seen)), scd_type, soft, ignore_nulls)


def columns_sorted(df, soft, scd_type):
    order = ["key", "a", "b"] + (["_is_deleted"] if soft else []) + (["__start_at", "__end_at"] if scd_type == 2 else [])
    return rows(df.select(*order))


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_batch_cut_short_or_repeated_changes_nothing(spark, folder, monkeypatch, scd_type):
    events = brute_force.random_events(random.Random(5), n=40)
    silver = SilverTable(spark, folder, PAYLOAD, rules("key"), scd_type, buckets=2, parts_per_bucket=1)
    for number, part in enumerate(batches(random.Random(5), events, 2)):
        before = rows(silver.read())
        with monkeypatch.context() as patch:
            patch.setattr(silver.state, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                silver.apply_batch(envelopes(spark, part), number)
        assert rows(silver.read()) == before
        silver.apply_batch(envelopes(spark, part), number)
        once = rows(silver.read())
        silver.apply_batch(envelopes(spark, part), number)
        assert rows(silver.read()) == once
    assert columns_sorted(silver.read(), False, scd_type) == expected(events, scd_type, False, True)


def test_an_uncommitted_batch_is_not_seen(spark, folder):
    silver = SilverTable(spark, folder, PAYLOAD, rules("key"), 1, buckets=2)
    silver.apply_batch(envelopes(spark, [(1, 1, "INSERT", "x", 1)]), 0)
    before = rows(silver.read())
    silver.state.write(silver.state.read(silver.state.parts()), 1)
    assert rows(silver.read()) == before


def test_streams_from_landing_to_silver(spark, folder):
    """Two tables through one bronze, landed in two goes, the second with older events."""
    first = [(1, 5, "INSERT", "x", 1), (2, 6, "INSERT", "y", 2)]
    second = [(1, 3, "UPDATE", "w", 9), (2, 7, "DELETE", None, None), (3, 8, "LOAD", "z", 3)]
    landing, bronze = f"{folder}/landing", f"{folder}/bronze"
    tables = {name: SilverTable(spark, f"{folder}/{name}", PAYLOAD, rules("key"), scd, buckets=2) for name, scd in (("t1", 1), ("t2", 2))}
    for events in (first, second):
        for name in tables:
            write_landing(envelopes(spark, events, name), landing, "2024-01-01")
        start_bronze(spark, landing, bronze, f"{folder}/cp_bronze").awaitTermination()
        apply_all(spark, bronze, [(uoid_of("db", "dbo", n), s) for n, s in tables.items()], f"{folder}/cp")
    assert bronze_table(spark, bronze).count() == 10
    assert columns_sorted(tables["t1"].read(), False, 1) == brute_force.scd1(first + second)
    assert columns_sorted(tables["t2"].read(), False, 2) == brute_force.scd2(first + second)


def test_many_small_files_in_many_batches(spark, folder):
    events = brute_force.random_events(random.Random(3), n=24)
    for part in batches(random.Random(3), events, 2, overlap=False):
        write_landing(envelopes(spark, part), f"{folder}/landing", "2024-01-01")
    start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/cp_bronze", max_files=1).awaitTermination()
    silver = SilverTable(spark, f"{folder}/silver", PAYLOAD, rules("key"), 2, buckets=2)
    apply_stream(spark, f"{folder}/bronze", uoid_of("db", "dbo", "t"), silver, f"{folder}/cp", max_files=1).awaitTermination()
    assert columns_sorted(silver.read(), False, 2) == brute_force.scd2(events)


@pytest.mark.parametrize("scd_type,ignore_nulls", [(1, True), (2, True), (2, False)])
def test_a_wider_payload_reads_what_is_stored(spark, folder, scd_type, ignore_nulls):
    def table(payload):
        return SilverTable(spark, folder, payload, rules("key", ignore_nulls=ignore_nulls), scd_type, buckets=2)

    table(PAYLOAD).apply_batch(envelopes(spark, [(1, 1, "INSERT", "x", 1), (1, 2, "UPDATE", "y", 2), (2, 1, "INSERT", "z", 3)]), 0)
    wide = T.StructType().add("key", "integer").add("a", "string").add("b", "long").add("c", "string")
    later = envelopes(spark, [(2, 5, "UPDATE", None, 4)]).withColumn("data", F.lit('{"key":2,"a":"z","b":5000000000,"c":"new"}'))
    table(wide).apply_batch(later, 1)
    got = rows(table(wide).read().select("key", "a", "b", "c"))
    want = [(1, "y", 2, None), (2, "z", 5_000_000_000, "new")]
    assert got == sorted(want + ([(1, "x", 1, None), (2, "z", 3, None)] if scd_type == 2 else []), key=repr)
    with pytest.raises(UnsupportedTypeChange):
        table(T.StructType().add("key", "integer").add("a", "integer").add("b", "long"))


def test_another_checkpoint_or_bucket_count_is_refused(spark, folder):
    write_landing(envelopes(spark, [(1, 5, "INSERT", "x", 1)]), f"{folder}/landing", "2024-01-01")
    start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/cp_bronze").awaitTermination()
    silver, uoid = SilverTable(spark, f"{folder}/silver", PAYLOAD, rules("key"), 1, buckets=2), uoid_of("db", "dbo", "t")
    apply_stream(spark, f"{folder}/bronze", uoid, silver, f"{folder}/cp").awaitTermination()
    before = rows(silver.read())
    assert before == [(1, "x", 1)]
    with pytest.raises(Exception, match="is written by stream"):
        apply_stream(spark, f"{folder}/bronze", uoid, silver, f"{folder}/other").awaitTermination()
    assert rows(silver.read()) == before
    with pytest.raises(ValueError, match="kept in 2 buckets"):
        SilverTable(spark, f"{folder}/silver", PAYLOAD, rules("key"), 1, buckets=64)


@pytest.mark.parametrize("soft", [False, True])
def test_changes_between_batches(spark, folder, soft):
    rng = random.Random(8)
    events = brute_force.random_events(rng, n=45)
    silver = SilverTable(spark, folder, PAYLOAD, rules("key", soft_delete=soft), 1, buckets=3, parts_per_bucket=1)
    states = []
    for number, part in enumerate(batches(rng, events, 3)):
        silver.apply_batch(envelopes(spark, part), number)
        states.append({r.key: tuple(r) for r in silver.read().collect()})
    for first, last in ((0, 1), (1, 2), (0, 2), (2, 2)):
        old, new = states[first], states[last]
        wanted = [("insert", *new[k]) for k in new.keys() - old.keys()] + [("delete", *old[k]) for k in old.keys() - new.keys()]
        wanted += [row for k in old.keys() & new.keys() if old[k] != new[k] for row in (("update_preimage", *old[k]), ("update_postimage", *new[k]))]
        assert rows(silver.changes_between(first, last)) == sorted(wanted, key=repr)
    with pytest.raises(ValueError):
        silver.changes_between(2, 1)
