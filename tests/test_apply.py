from __future__ import annotations

import random

import brute_force
import pytest
from conftest import rows

from tidemark.operators.apply import apply_changes, current_versions, fold_state, merge_states, rules, versions_as_of

FIELDS = "key int, _seq_num bigint, operation string, a string, b int"
# Key, sequence, operation, two columns; from the hand-made table of the fixtures.
HAND = [
    (1, 1, "INSERT", "a", 10),
    (1, 2, "UPDATE", None, 20),
    (1, 3, "DELETE", None, None),
    (1, 4, "INSERT", "b", None),
    (2, 1, "LOAD", "q", 30),
]


def frame(spark, events):
    return spark.createDataFrame(events, FIELDS)


def test_type_1_on_hand_rows(spark):
    events = frame(spark, HAND)
    assert rows(apply_changes(events, "key")) == [(1, "b", None), (2, "q", 30)]
    assert rows(apply_changes(events, "key", soft_delete=True)) == [(1, "b", 20, False), (2, "q", 30, False)]


def test_type_2_on_hand_rows(spark):
    events = frame(spark, HAND)
    assert rows(apply_changes(events, "key", 2)) == [
        (1, "a", 10, 1, 2), (1, "a", 20, 2, 3), (1, "b", None, 4, None), (2, "q", 30, 1, None),
    ]


@pytest.mark.parametrize("soft", [False, True])
@pytest.mark.parametrize("ignore_nulls", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_events_match_brute_force(spark, seed, ignore_nulls, soft):
    rng = random.Random(seed)
    events = brute_force.random_events(rng)
    scrambled = rng.sample(events + events, 2 * len(events))
    options = {"soft_delete": soft, "ignore_nulls": ignore_nulls}
    df = frame(spark, scrambled)
    assert rows(apply_changes(df, "key", 1, **options)) == brute_force.scd1(events, soft, ignore_nulls)
    want = brute_force.scd2(events, soft, ignore_nulls)
    assert rows(apply_changes(df, "key", 2, **options)) == want
    for block in (1, 7, 30):
        assert rows(apply_changes(df, "key", 2, max_group_rows=block, **options)) == want


def test_only_hot_keys_are_cut(spark):
    hot = [(1, i, "UPDATE", "x" if i % 10 == 0 else None, i if i % 3 == 0 else None) for i in range(1, 200)]
    cold = [(k, 1, "INSERT", "y", k) for k in range(2, 50)]
    got = rows(apply_changes(frame(spark, hot + cold), "key", 2, max_group_rows=20))
    assert got == brute_force.scd2(hot + cold)


def test_states_merge_in_any_split(spark):
    events = brute_force.random_events(random.Random(7), n=80)
    how = rules("key")
    whole = fold_state(frame(spark, events), how)
    parts = fold_state(frame(spark, events[::2]), how).unionByName(fold_state(frame(spark, events[1::2] + events[:9]), how))
    assert rows(merge_states(parts, how)) == rows(whole)


def test_same_sequence_takes_the_later_extraction(spark):
    fields = "key int, _seq_num bigint, operation string, _extracted_at bigint, a string"
    events = spark.createDataFrame([(1, 5, "UPDATE", 100, "old"), (1, 5, "INSERT", 200, "new")], fields)
    assert rows(apply_changes(events, "key")) == [(1, "new")]
    assert rows(apply_changes(events, "key", 2)) == [(1, "new", 5, None)]


def test_delete_predicate_and_composite_key(spark):
    events = spark.createDataFrame(
        [(1, "x", 1, "INSERT", 5), (1, "y", 2, "INSERT", 50), (2, "x", 3, "UPDATE", 99)],
        "k1 int, k2 string, _seq_num bigint, operation string, v int",
    )
    assert rows(apply_changes(events, ["k1", "k2"], delete_when="v > 60")) == [(1, "x", 5), (1, "y", 50)]


def test_current_and_as_of(spark):
    versions = apply_changes(frame(spark, HAND), "key", 2)
    assert rows(current_versions(versions)) == [(1, "b", None, 4, None), (2, "q", 30, 1, None)]
    assert rows(versions_as_of(versions, 2)) == [(1, "a", 20, 2, 3), (2, "q", 30, 1, None)]
    assert rows(versions_as_of(versions, 3)) == [(2, "q", 30, 1, None)]


def test_a_key_is_required(spark):
    with pytest.raises(ValueError):
        apply_changes(frame(spark, HAND), [])
    with pytest.raises(ValueError):
        apply_changes(frame(spark, HAND), "key", 3)


def test_type_1_needs_one_shuffle(spark):
    plan = apply_changes(frame(spark, HAND), "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max" in plan and "Window" not in plan


def test_odd_column_names(spark):
    events = spark.createDataFrame([(1, 1, "INSERT", "a", 1), (1, 2, "UPDATE", None, 2), (2, 1, "INSERT", "b", 3), (2, 2, "DELETE", None, None)], FIELDS)
    odd = events.toDF("or.der id", "_seq_num", "operation", "x]y z", "select")
    assert rows(apply_changes(odd, "or.der id")) == [(1, "a", 2)]
    assert apply_changes(odd, "or.der id").columns == ["or.der id", "x]y z", "select"]
    for block in (1, 100):
        assert rows(apply_changes(odd, "or.der id", 2, max_group_rows=block)) == [(1, "a", 1, 1, 2), (1, "a", 2, 2, None), (2, "b", 3, 1, 2)]
    assert rows(apply_changes(odd, "or.der id", ignore_nulls=False)) == [(1, None, 2)]


def test_cut_keys_end_like_whole_ones(spark):
    """Sparse, tied and missing sequence numbers, and a missing key."""
    rng = random.Random(8)
    for _ in range(3):
        events = []
        for key in (1, None):
            for _ in range(60):
                seq = rng.choice([None, 7, rng.randrange(10) * 1_000_003, rng.randrange(10**12)])
                if seq not in [e[1] for e in events if e[0] == key]:
                    events.append((key, seq, rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.choice([None, "p", "q"]), rng.choice([None, 1, 2])))
        for options in ({}, {"soft_delete": True}, {"ignore_nulls": False}):
            whole = rows(apply_changes(frame(spark, events), "key", 2, **options))
            assert rows(apply_changes(frame(spark, events), "key", 2, max_group_rows=5, **options)) == whole


def test_events_that_tie_are_applied_as_whole_rows(spark):
    """Of events with one key, sequence and operation the values of one count in every column, in any order of arrival."""
    tied = [(1, 7, "UPDATE", "a", "p"), (1, 7, "UPDATE", "b", "r"), (1, 7, "UPDATE", "c", "q")]
    results = set()
    for order in (tied, tied[::-1], tied[1:] + tied[:1], tied * 2):
        frame = spark.createDataFrame(order, "id long, _seq_num long, operation string, a string, b string").repartition(3)
        own = {tuple(r) for r in apply_changes(frame, "id").collect()}
        latest = {tuple(r)[:3] for r in apply_changes(frame, "id", scd_type=2).collect()}
        assert own == latest == {(1, *tuple(r)[1:]) for r in apply_changes(frame, "id", ignore_nulls=False).collect()}
        results |= own
    assert len(results) == 1 and results <= {(1, "a", "p"), (1, "b", "r"), (1, "c", "q")}
    maps = spark.createDataFrame([(1, 1, "UPDATE", {"x": 1})], "id long, _seq_num long, operation string, m map<string,int>")
    assert apply_changes(maps, "id", scd_type=2).count() == 1


def test_a_table_without_hot_keys_is_read_in_one_exchange(spark):
    events = spark.range(500).selectExpr("id % 50 AS id", "id AS _seq_num", "'UPDATE' AS operation", "id AS a")
    plan = apply_changes(events, "id", scd_type=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
