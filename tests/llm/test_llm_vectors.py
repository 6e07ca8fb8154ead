"""Vector operators against all pairs in double precision."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripfold.llm import embedding_dedup, frames, nearest, queries
from tripfold.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, n_links string, rank string"


def rows_of(matrix, start=0):
    return [(start + k, [float(x) for x in row], "x", "y") for k, row in enumerate(matrix)]


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(1)
    centres = random.normal(size=(12, 24))
    rows = np.vstack(
        [
            np.repeat(centres[:1], 60, axis=0),  # exact copies
            centres[1] + 0.2 * random.normal(size=(150, 24)),  # a chain-like cloud
            centres[2] * np.linspace(0.1, 50, 20)[:, None],  # one direction
            random.normal(size=(200, 24)),
            centres + 0.05 * random.normal(size=(12, 24)),
        ]
    ).astype(np.float32)
    return rows


def usable(frame):
    rows = {}
    for row in frame.collect():
        vector = row.embedding
        if row.vec_id is None or not vector or any(x is None for x in vector):
            continue
        array = np.array(vector, dtype=np.float64)
        if np.isfinite(array).all() and array.any():
            rows[row.vec_id] = array
    return rows


@pytest.fixture(scope="module")
def frame(spark, vectors):
    awkward = [
        (5000, None, None, None),
        (5001, [], None, None),
        (5002, [0.0] * 24, None, None),
        (5003, [float("nan")] + [1.0] * 23, None, None),
        (5004, [float("inf")] + [1.0] * 23, None, None),
        (5005, [None] + [1.0] * 23, None, None),
        (None, [1.0] * 24, None, None),
        (5006, [1.0, 2.0], None, None),
        (5007, [2.0, 4.0], None, None),
    ]
    rows = rows_of(vectors)
    return spark.createDataFrame([*rows, rows[3], *awkward], SCHEMA)


def brute_links(rows, threshold=0.95):
    ids = sorted(rows)
    links = {i: 0 for i in ids}
    root = {i: i for i in ids}
    for a in ids:
        for b in ids:
            x, y = rows[a], rows[b]
            if a < b and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((root[a], root[b]))
                    if low != high:
                        root = {i: low if r == high else r for i, r in root.items()}
    return links, root


def test_links_equal_brute_force(frame, monkeypatch):
    links, root = brute_links(usable(frame))
    monkeypatch.setattr(embedding_dedup.vectors, "TILE_BYTES", 64 * 24 * 4)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    found = embedding_dedup.near_duplicates(frame).collect()
    assert len(found) == frame.select("vec_id").distinct().count()
    for row in found:
        assert row.n_links == links.get(row.vec_id, 0)
        assert row.component_id == root.get(row.vec_id, row.vec_id)
        assert row.kept == (row.vec_id is not None and row.component_id == row.vec_id)


def test_links_of_no_rows(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_of_the_table(spark):
    folder = "/root/testdata/sf0.001"
    links, root = brute_links(usable(frames.table(spark, folder, "embeddings")))
    for row in queries.op1_embedding_near_dedup(spark, folder).collect():
        assert (row.n_links, row.component_id) == (links[row.vec_id], root[row.vec_id])


def test_nearest_equal_brute_force(frame, monkeypatch):
    monkeypatch.setattr(nearest.vectors, "TILE_BYTES", 64 * 24 * 4)
    rows = usable(frame)
    found = {}
    for row in nearest.nearest(frame, F.col("vec_id") % 7 == 0, k=20).collect():
        found.setdefault(row.query_id, []).append(row)
    expected = {}
    for query in rows:
        if query % 7 == 0:
            scores = [
                (-(rows[i] * rows[query]).sum(), i)
                for i in rows
                if i != query and len(rows[i]) == len(rows[query])
            ]
            if scores:
                expected[query] = sorted(scores)[:20]
    assert set(found) == set(expected)
    for query, own in found.items():
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(own) + 1))
        assert [r.vec_id for r in own] == [i for _, i in expected[query]]
        assert np.allclose([r.score for r in own], [-s for s, _ in expected[query]], rtol=1e-13)


def test_nearest_of_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(200, 200 + k) for k in range(1, 80)] + [(250, 190)]
    frame = spark.createDataFrame(chain + star + [(300, 300)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(frame, "a", "b").collect()}
    assert found == {k: 0 for k in range(61)} | {k: 190 for k in [190, *range(200, 280)]}
