from __future__ import annotations

import math
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup
from tidemark.llm.embedding_dedup import embedding_report


def brute(rows):
    """By id: links and least id reachable, for rows of id and vector or None."""
    good = [i for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = np.array([v for i, v in rows if i in set(good)], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    out = {i: (0, i) for i, _ in rows}
    label = np.array(good)
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    for k, i in enumerate(good):
        out[i] = (int(near[k].sum()) - 1, int(label[k]))
    return out


def test_random_clusters(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL_VECTORS", 60)
    monkeypatch.setattr(embedding_dedup, "HOMES", 25)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    vectors = [(c + rng.normal(scale=0.25, size=6)).astype(np.float32).tolist() for c in centres for _ in range(40)]
    vectors += [vectors[0]] * 50 + [[0.0] * 6, None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1e30] * 6, [1e-30] * 6]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_report(frame).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) > 5


def test_edge_cases(spark):
    rows = [(4, [1.0, 0.0], "a"), (4, [1.0, 0.0], "b"), (None, [1.0, 0.01], "c"), (9, [1.0], "d"), (8, [], "e"), (7, None, "f")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_report(frame).collect())
    assert got == [(0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)]
    assert embedding_report(frame.limit(0)).count() == 0


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_report(frame).collect()}
    assert got == brute(rows)


def spread(rng, n, dims):
    """Vectors far from each other, and for some of them a chain of near ones."""
    far = rng.normal(size=(n, dims))
    near = far[: n // 10] * np.sqrt(dims) / np.linalg.norm(far[: n // 10], axis=1, keepdims=True)
    steps = [near := near + rng.normal(scale=0.3, size=near.shape) for _ in range(3)]
    return np.concatenate([far, *steps]).astype(np.float32)


def test_vectors_are_stored_not_shuffled(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_dedup, "CELL_VECTORS", 100)
    monkeypatch.setattr(embedding_dedup, "HOMES", 50)
    rows = list(enumerate(spread(np.random.default_rng(5), 1_500, 64).tolist()))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "vectors"))
    real, held, plans = embedding_dedup.stored, {}, {}

    def stored(df, purpose, **options):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        out = real(df, purpose, **options)
        folder = out.inputFiles()[0].rpartition("/")[0].removeprefix("file://") if purpose != "near" else None
        held[purpose] = sum(f.stat().st_size for f in Path(folder).glob("*.parquet")) if folder else 0
        return out

    monkeypatch.setattr(embedding_dedup, "stored", stored)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_report(spark.read.parquet(str(tmp_path / "vectors"))).collect()}
    assert got == brute(rows)
    # Every vector visits most cells of such a table; none is copied for that.
    assert "Exchange" not in plans["near"]
    assert sum(held.values()) < 3 * len(rows) * 64 * 4


def test_few_coordinates_rule_out_no_link():
    vectors = spread(np.random.default_rng(6), 2_000, 64)
    units = embedding_dedup.of_length_one(vectors)
    sketch = embedding_dedup.Sketch(units[:1_024], 0.9)
    assert sketch.axes is not None and sketch.axes.shape[1] < 60
    bounds = sketch.rows(units, True) @ sketch.rows(units, False).T
    assert (bounds + sketch.error(64) >= units @ units.T).all()
    flags = np.zeros(100 * 30 + 8, bool)
    flags[[0, 7, 8, 1_234, 2_990]] = True
    assert sorted(embedding_dedup.positions(flags, 2_991).tolist()) == [0, 7, 8, 1_234, 2_990]


def test_spread_and_dense_vectors_in_rounds(spark, monkeypatch):
    for name, value in (("CELL_VECTORS", 100), ("HOMES", 60), ("HOSTS", 16), ("VISITORS", 24), ("ROUND_BYTES", 60_000), ("SENT", 40_000), ("REMEMBERED", 100_000)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(8)
    vectors = spread(rng, 500, 32)
    crowd = (rng.normal(size=32) + rng.normal(scale=0.15, size=(200, 32))).astype(np.float32)  # all near each other
    rows = list(enumerate(np.concatenate([vectors, crowd, vectors[:40], crowd[:30], crowd[:30]]).tolist()))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_report(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == brute(rows)
    doubles = spark.createDataFrame([(i, [x * 1e200 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    assert {r.vec_id: (r.n_links, r.component_id) for r in embedding_report(doubles).collect()} == got


def test_vectors_with_one_hash(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "hashes", lambda: [F.lit(1).cast("long"), F.lit(2).cast("long")])
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("d", [-0.0, 2.0]), ("e", None), ("f", [-1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_report(frame).collect())
    assert got == [("a", 1, "a"), ("b", 1, "a"), ("c", 1, "c"), ("d", 1, "c"), ("e", 0, "e"), ("f", 0, "f")]
