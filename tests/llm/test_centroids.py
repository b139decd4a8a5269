"""Clustering against plain k-means on whole numbers."""

from hashlib import sha256

import numpy as np

from playstream.checks.compare import compare, supplied_views
from playstream.llm import centroids
from tests.conftest import SMALL
from tests.llm.helpers import rows, supplied, with_clashes


def plain(vectors, count=40, rounds=5):
    """``vectors``: ``(vec_id, 64 floats)``; one row per usable vector."""
    usable = [
        (i, [int(np.floor(256 * np.float64(x))) for x in v])
        for i, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]

    def hashed(row):
        return sha256(f"2:{'' if row[0] is None else row[0]}".encode()).hexdigest()

    first = sorted(usable, key=lambda r: (hashed(r), centroids.spectrum(np.array(r[1])).tolist()))[:count]
    middle = [v for _, v in first]

    def assign():
        found = []
        for _, v in usable:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        of = assign()
        for k in range(len(middle)):
            members = [v for (_, v), (c, _) in zip(usable, of, strict=True) if c == k]
            if members:
                middle[k] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    of = assign()
    inertia = [sum(d for c, d in of if c == k) for k in range(len(middle))]
    result = [
        (i, c, d, inertia[c], sum(inertia), sha256(",".join(map(str, middle[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(usable, of, strict=True)
    ]
    return sorted(result, key=lambda r: tuple((v is None, str(v)) for v in r))


def frame(spark, values):
    return spark.createDataFrame(values, "vec_id long, embedding array<float>, label int")


def test_supplied_vectors(spark):
    table = supplied(spark, "embeddings").repartition(5)
    expected = plain([(r.vec_id, r.embedding) for r in table.collect()])
    assert rows(centroids.clustered(table)) == expected


def test_odd_input(spark):
    chooser = np.random.default_rng(4)
    some = [[float(x) for x in chooser.normal(size=64).astype(np.float32)] for _ in range(60)]
    values = [(i, v, 1) for i, v in enumerate(some)]
    values += [(100, None, 1), (101, [], 1), (102, some[0][:63], 1), (103, [*some[0], 0.0], None)]
    values += [(104, [*some[0][:63], None], 1), (105, [*some[0][:63], float("nan")], 1)]
    values += [(106, [*some[0][:63], float("-inf")], 1), (107, [0.0] * 64, 1), (None, some[3], 2), (None, some[4], 2)]
    values += [(5, some[5], 1)] * 4 + [(6, some[7], 1)] * 2
    table = frame(spark, values)
    expected = plain([(i, v) for i, v, _ in values])
    assert rows(centroids.clustered(with_clashes(table, "cluster", "spectrum", "n"))) == expected
    assert centroids.clustered(table.limit(0)).collect() == []
    few = frame(spark, values[:3])
    assert rows(centroids.clustered(few)) == plain([(i, v) for i, v, _ in values[:3]])


def test_large_components_count_as_the_bound(spark):
    found = centroids.clustered(frame(spark, [(1, [3e38] * 64, 1), (2, [-3e38] * 64, 1), (3, [65536.0] * 64, 1)]))
    assert {r.vec_id: r.distance for r in found.collect()} == {1: 0, 2: 0, 3: 0}


def test_nearest_with_ties_and_one_hot_vector():
    chooser = np.random.default_rng(9)
    middle = chooser.integers(-3, 3, (40, 64))
    middle[7] = middle[3]
    vectors = np.concatenate([chooser.integers(-3, 3, (500, 64)), np.repeat(middle[7:8], 400, axis=0), middle])
    best, distance = centroids.nearest(centroids.spectrum(vectors), centroids.spectrum(middle))
    every = ((vectors[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_transform_is_exact():
    vectors = np.random.default_rng(1).integers(-centroids.BOUND, centroids.BOUND + 1, (50, 64))
    assert (centroids.H @ centroids.H.T == 64 * np.eye(64, dtype=np.int64)).all()
    assert (centroids.vectors_of(centroids.spectrum(vectors)) == vectors).all()
    assert ((centroids.H[:, 1:] != centroids.H[:, :-1]).sum(axis=1) == np.arange(64)).all()


def test_sql(spark):
    good, note = compare(spark, supplied_views(SMALL), "op13_centroid_clustering", SMALL)
    assert good, note
