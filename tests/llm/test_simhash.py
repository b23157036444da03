from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from tidemark.llm.components import components
from tidemark.llm.simhash import drop_near_duplicates, home, links, near_duplicates, simhash_report, visits


def brute_bits(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, near):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(parent)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_a_neighbour_always_visits_the_home():
    rnd = np.random.default_rng(5)
    bits = rnd.integers(-(2**63), 2**63, 300, dtype=np.int64)
    for part in range(3):
        where, anchors = visits(bits, part)
        for i, (own, anchor) in enumerate(zip(bits, home(bits, part))):
            for bit in range(64):
                other = np.array([own ^ np.int64(np.uint64(1 << bit).astype(np.int64))])
                assert anchor in visits(other, part)[1]
        assert len(where) == len(anchors) and set(where) == set(range(len(bits)))


def test_links_connect_all_pairs(spark):
    rnd = random.Random(4)
    centres = [rnd.getrandbits(64) for _ in range(30)]
    near = {0}
    for c in centres:
        for _ in range(60):
            x = c
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                x ^= 1 << bit
            near.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    frame = spark.createDataFrame([(x,) for x in signed], "bits long")
    got = {r.node: r.root for r in components(links(frame)).collect()}
    wanted = brute_roots(signed, lambda a, b: (a ^ b).bit_count() <= 4 if (a ^ b) >= 0 else ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {n: got.get(n, n) for n in signed} == wanted
    for a, b in ((r.a, r.b) for r in links(frame).collect()):
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 * 2 or got[a] == got[b]


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(5000))
    rows = [(5, long, "x"), (3, long + " more", "y"), (3, long + " more", "y"), (None, long, "z"), (7, None, None), (8, " \n", "a"), (9, "", "b"), (None, "alone here now today ok", "q"), (10, "One two", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_report(docs).collect()}
    assert {(i, f) for i, f, _ in got} == {(i, f"{brute_bits(t):016x}") for i, t, _ in rows}
    by_id = {i: c for i, _, c in got if i is not None}
    assert by_id == {5: 3, 3: 3, 7: 7, 8: 7, 9: 7, 10: 10}
    assert near_duplicates(docs).count() == len(rows) and near_duplicates(docs.limit(0)).count() == 0
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.bits or "") for r in kept.collect()) == [(False, 3, "y"), (False, 7, ""), (False, 10, "c"), (True, 0, "q")]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bits = {r.doc_id: brute_bits(r.text) for r in docs.collect()}
    roots = brute_roots(set(bits.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least: dict[int, int] = {}
    for i, b in bits.items():
        least[roots[b]] = min(i, least.get(roots[b], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_report(docs).collect()}
    assert got == {i: (f"{b:016x}", least[roots[b]]) for i, b in bits.items()}
    assert len(least) < len(bits)
