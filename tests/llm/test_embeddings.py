import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.checks.compare import supplied_views
from playstream.llm import embeddings
from tests.conftest import SMALL
from tests.llm.helpers import rows, supplied, with_clashes

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(data):
    """From pairs of rows of one label; ids are distinct."""
    good = {}
    for i, label, vector in data:
        if label is not None and vector and None not in vector and np.isfinite(vector).all() and any(vector):
            good[i] = label, np.array(vector, np.float32).astype(float)
    links = {i: set() for i, _, _ in data}
    for i, (label, v) in good.items():
        for j, (other, w) in good.items():
            if i < j and label == other and len(v) == len(w):
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                    links[i].add(j)
                    links[j].add(i)
    root = {i: i for i in links}
    for _ in links:
        for i, near in links.items():
            root[i] = min([root[i], *(root[j] for j in near)])
    return sorted((i, len(links[i]), root[i], i == root[i]) for i in links)


def clusters(n=160, width=24):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, width))
    data = []
    for i in range(n):
        vector = centres[rng.integers(6)] + rng.normal(scale=rng.choice([0.0, 0.15, 0.3]), size=width)
        data.append((i + 5, int(rng.integers(2)), [float(np.float32(x)) for x in vector]))
    return data + [(900 + i, 1, data[0][2]) for i in range(20)]


@pytest.mark.parametrize("tile", [7, 1024])
def test_against_all_pairs(spark, tile):
    data = clusters()
    got = rows(embeddings.near_duplicates(spark.createDataFrame(data, SCHEMA), tile))
    assert sorted(got) == plain(data)
    assert max(r[1] for r in got) > 20


def test_supplied_vectors_against_sql(spark):
    con = supplied_views(SMALL)
    want = sorted(con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({embeddings.near_duplicates_sql()})").fetchall())
    assert sorted(rows(embeddings.near_duplicates(supplied(spark, "embeddings")))) == want


ODD = [
    (1, 1, [1.0, 0.0]),
    (2, 1, [0.99, 0.1]),
    (3, 1, [0.0, 0.0]),
    (4, None, [1.0, 0.0]),
    (5, 1, None),
    (6, 1, []),
    (7, 1, [1.0, None]),
    (8, 1, [float("nan"), 1.0]),
    (9, 1, [float("inf"), 1.0]),
    (10, 1, [1.0, 0.0, 0.0]),
    (11, 2, [1.0, 0.0]),
    (12, 1, [-0.0, 1.0]),
    (13, 1, [0.0, 1.0]),
]


def test_odd_vectors(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    assert sorted(rows(embeddings.near_duplicates(frame))) == plain(ODD)
    clashing = with_clashes(frame, "node", "copies", "n_links", "component_id", "kept")
    assert sorted(rows(embeddings.near_duplicates(clashing))) == plain(ODD)


def test_repeated_and_nameless_rows(spark):
    data = [(1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (None, 1, [1.0, 0.1]), (None, 2, [1.0, 0.1])]
    got = rows(embeddings.near_duplicates(spark.createDataFrame(data, SCHEMA)))
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (None, 2, 1, False)]


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.floats(0.01, 1.0))
def test_no_pair_is_lost_to_rounding(seed, width, noise):
    rng = np.random.default_rng(seed)
    left = rng.normal(size=(20, width)) * 10.0 ** rng.integers(-3, 3)
    right = left[rng.integers(20, size=25)] + noise * rng.normal(size=(25, width)) * np.abs(left).max() / 3
    cosines = (left @ right.T) / np.linalg.norm(left, axis=1)[:, None] / np.linalg.norm(right, axis=1)
    i, j = embeddings.close_pairs(left, right)
    clear = np.abs(cosines - 0.93) > 1e-12
    found = np.zeros_like(clear)
    found[i, j] = True
    assert (found == (cosines >= 0.93))[clear].all()
