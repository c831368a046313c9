"""Exact search in several groups of queries and candidates, whose meetings are no join."""

import numpy as np
import pytest
from conftest import plan

from tillsight.llm import topk_search as S


def brute(vectors, k, every):
    exact = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors}
    want = set()
    for q in (i for i in exact if i % every == 0):
        products = {c: sum(a * b for a, b in zip(exact[q], exact[c], strict=True)) for c in exact if c != q}
        scores = sorted((-max(min(s, 2**63 - 1), -(2**63)), c) for c, s in products.items())
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])}
    return want


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e9])  # single, double precision and Python's integers
def test_groups_of_blocks_equal_brute_force(spark, monkeypatch, scale):
    for name, value in (("BLOCK_ROWS", 40), ("QUERY_ROWS", 4), ("QUERY_GROUP", 10), ("GROUPS", 5)):
        monkeypatch.setattr(S, name, value)
    rng = np.random.default_rng(11)
    rows = rng.normal(0, 1, (400, 20)) * scale * np.where(np.arange(400) % 3 == 0, 1.0, 0.01)[:, None]
    rows[7:60:3] = rows[7]
    vectors = [(i, rows[i].tolist()) for i in range(400)]
    found = S.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), k=4, every=10)
    assert {tuple(r) for r in found.collect()} == brute(vectors, 4, 10)
    assert "Join" not in plan(found)  # pairs of blocks, grown as the square, were broadcast before


def test_queries_and_candidates_are_copied_once_per_group(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 10), ("QUERY_ROWS", 4), ("GROUPS", 4)):
        monkeypatch.setattr(S, name, value)
    seen, frame = [], type(spark.range(0))
    deal = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, n, by: seen.append(self) or deal(self, n, by))
    rows = np.random.default_rng(3).normal(0, 1, (600, 6))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    S.top_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")).count()
    sent = {(r["kind"]): r["n"] for r in seen[0].groupBy("kind").agg({"n": "sum"}).toDF("kind", "n").collect()}
    assert sent[1] == 600 and 12 <= sent[0] <= 12 * max(4, spark.sparkContext.defaultParallelism)


def test_vectors_of_falling_length_meet_only_where_they_can_matter(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 64)
    monkeypatch.setattr(S, "TILE", 64)
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(0, 1, 8) * 0.98**i * 50 + 1).tolist()) for i in range(500)]
    found = S.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), k=3)
    assert {tuple(r) for r in found.collect()} == brute(vectors, 3, 50)
