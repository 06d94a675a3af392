from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from coldloop.llm import embedding_dedup
from coldloop.llm.queries import QUERIES


def brute(rows, threshold=0.93):
    """vec_id to (n_links, component) of (vec_id, vector, label) rows with different ids."""
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows
            if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: k for i, _, k in rows}
    links = {i: set() for i, *_ in rows}
    for i in unit:
        for j in unit:
            if (i != j and label[i] is not None and label[i] == label[j]
                    and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold):
                links[i].add(j)
    component = {i: i for i in links}
    for _ in links:
        component = {i: min([component[i], *(component[j] for j in links[i])]) for i in links}
    return {i: (len(links[i]), component[i]) for i in links}


def vectors(n=160, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(n):
        v = centres[i % 12] + rng.normal(size=16) * rng.choice([0, 0.02, 0.2, 1.0])
        rows.append((i, [float(x) for x in v], int(rng.integers(3))))
    return rows


ODD = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1),
       (903, [None] + [1.0] * 15, 1), (904, [float("inf")] + [1.0] * 15, 1),
       (905, [1.0] * 16, None), (906, [1.0] * 16, None), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1),
       (909, [-0.0, 1.0], 1), (910, [0.0, 1.0], 1), (911, [], 1)]


@pytest.mark.parametrize("block", [1_024, 7])
def test_equals_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "CELL_SIZE", 60)
    rows = vectors() + ODD
    folder = documents(rows, "vec_id long, embedding array<float>, label int", "embeddings")
    got = QUERIES["op10_embedding_dedup"](spark, folder).collect()
    want = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(n for n, _ in want.values()) > 100


@pytest.mark.parametrize("dimension", [3, 8, 16])
def test_no_link_is_lost_between_cells(spark, monkeypatch, dimension):
    """Vectors in all directions, in forty cells with long borders, against all products."""
    monkeypatch.setattr(embedding_dedup, "CELL_SIZE", 60)
    rng = np.random.default_rng(dimension)
    near = rng.normal(size=(1_200, dimension))
    near = np.concatenate([near, near + 0.3 * rng.normal(size=near.shape)])
    docs = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(near)],
                                 "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(docs).collect()}
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    want = (unit @ unit.T >= embedding_dedup.THRESHOLD).sum(axis=1) - 1
    assert want.sum() > 300
    assert got == dict(enumerate(want.tolist()))


def test_null_and_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 0, 1), (1, [1.0, 0.0], 0, 2), (None, [1.0, 0.0], 0, 3),
            (2, [1.0, 0.01], 0, 4)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep int")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
                          (None, 0, None, True)], key=str)
    assert embedding_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_labels_that_fit_a_cell_are_not_divided(spark, documents, monkeypatch):
    """Ten labels of 30 vectors are more than a cell together, and none is alone."""
    def learn(*_):
        raise AssertionError("no label needs centroids")
    monkeypatch.setattr(embedding_dedup, "CELL_SIZE", 60)
    monkeypatch.setattr(embedding_dedup, "spherical_kmeans", learn)
    rows = [(i, v, i % 10) for i, v, _ in vectors(300, seed=3)]
    folder = documents(rows, "vec_id long, embedding array<float>, label int", "embeddings")
    got = QUERIES["op10_embedding_dedup"](spark, folder).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


@pytest.mark.parametrize("block", [1_024, 7])
def test_divided_and_whole_labels_together(spark, documents, monkeypatch, block):
    """One label in several cells with visitors, others whole, vectors of three lengths."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "CELL_SIZE", 20)
    rows = [(i, v, max(0, i % 8 - 4)) for i, v, _ in vectors(180, seed=4)]
    rows += [(400 + i, v[:5], 0) for i, v, _ in vectors(40, seed=5)] + ODD
    folder = documents(rows, "vec_id long, embedding array<float>, label int", "embeddings")
    got = QUERIES["op10_embedding_dedup"](spark, folder).collect()
    want = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert sum(n for n, _ in want.values()) > 100


def test_strips_of_a_block(monkeypatch):
    """Strips of any length give the same links; what the smaller home has is left out."""
    points = [v for _, v, _ in vectors(96, seed=6)]
    own = [k // 12 % 2 for k in range(96)]
    home = [k % 5 if guest else 2 for k, guest in enumerate(own)]
    cells = [None if guest else [2, k % 3] for k, guest in enumerate(own)]
    table = pa.table({
        "cell": [2] * 96, "i": [0] * 96, "j": [1] * 96, "rep": range(96), "copies": [1, 2] * 48,
        "own": own, "home": home, "cells": cells, "v": points})
    found = []
    for strip in (1_000, 5):
        monkeypatch.setattr(embedding_dedup, "STRIP", strip)
        found.append(embedding_dedup.block_links(table, 0.8))
    unit = np.array(points) / np.linalg.norm(points, axis=1, keepdims=True)
    pairs = [(x, y) for x in range(96) for y in range(96) if not own[x] and own[y]
             and unit[x] @ unit[y] >= 0.8 and not (home[y] < 2 and home[y] in cells[x])]
    assert len(pairs) > 20 and found[0].equals(found[1])
    assert sum(found[0]["links"].to_pylist()) == sum(
        [1, 2][x % 2] + [1, 2][y % 2] for x, y in pairs)
