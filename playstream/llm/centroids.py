"""Centroid clustering of whole-number vectors; centroids are compared coefficient by coefficient, coarse to fine."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import settled

WIDTH = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
#: Largest component after scaling; beyond it a component counts as this, so that sums of squares fit 64 bits.
BOUND = 1 << 24
#: Coefficients compared before the first look, and where centroids are ruled out after that.
_STEPS = (8, 16, 32, WIDTH)
#: Vectors compared at once.
_AT_ONCE = 8192


def _transform() -> np.ndarray:
    """The Walsh-Hadamard matrix with rows from none to 63 changes of sign: coarse to fine."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < WIDTH:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((matrix[:, 1:] != matrix[:, :-1]).sum(axis=1))]


H = _transform()


def spectrum(vectors: np.ndarray) -> np.ndarray:
    """Coefficients of whole-number vectors, exactly; squared distances become 64 times as large."""
    return vectors @ H.T


def vectors_of(coefficients: np.ndarray) -> np.ndarray:
    """The vectors of coefficients; the division leaves no rest."""
    return coefficients @ H // WIDTH


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    apart = left - right
    return np.einsum("...d,...d->...", apart, apart)


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the smaller number of equals, and the squared distance; all by coefficients.

    After the coarsest coefficients the most promising centroid of each row is worked out to the end. A centroid
    whose differences so far already exceed that distance is strictly worse, as squares only add, and is
    dropped; what is left after each step goes on to the next until all 64 coefficients are in.
    """
    best, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for at in range(0, len(rows), _AT_ONCE):
        x = rows[at : at + _AT_ONCE]
        sums = _squares(x[:, None, : _STEPS[0]], centroids[None, :, : _STEPS[0]])
        hopeful = sums.argmin(axis=1)
        limit = sums[np.arange(len(x)), hopeful] + _squares(x[:, _STEPS[0] :], centroids[hopeful, _STEPS[0] :])
        row, number = np.nonzero(sums <= limit[:, None])
        sums = sums[row, number]
        for low, high in zip(_STEPS[:-1], _STEPS[1:], strict=True):
            sums += _squares(x[row, low:high], centroids[number, low:high])
            left = sums <= limit[row]
            row, number, sums = row[left], number[left], sums[left]
        # pairs come by row and number, so the first of a row's least sums has the smallest number
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(sums, starts)
        ties = np.flatnonzero(sums == least[row])
        best[at : at + len(x)] = number[ties[np.searchsorted(row[ties], np.arange(len(x)))]]
        distance[at : at + len(x)] = least // WIDTH
    return best, distance


def whole_vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, spectrum)`` of the usable vectors: 64 components, none null or non-finite.

    A component ``x`` counts as ``floor(256 * x)``, cut to ``BOUND`` on both sides.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            right = np.array([n == WIDTH for n in lists.value_lengths().to_pylist()], bool)
            chosen = batch.filter(pa.array(right))
            flat = chosen.column("embedding").flatten().cast(pa.float64())
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            finite = np.isfinite(values).all(axis=1)
            with np.errstate(over="ignore"):
                scaled = np.floor(values[finite] * SCALE)
            found = spectrum(np.clip(scaled, -BOUND, BOUND).astype(np.int64)).astype(np.int32)
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * WIDTH)
            arrays = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            ids = chosen.column("vec_id").filter(pa.array(finite))
            yield pa.record_batch([ids, arrays], names=["vec_id", "spectrum"])

    wanted = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    return wanted.mapInArrow(run, "vec_id long, spectrum array<int>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("spectrum").flatten().to_numpy().astype(np.int64).reshape(-1, WIDTH)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list[tuple]:
    """``(cluster, n, sum of each coefficient)``; at most one row per centroid comes back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((len(centroids), WIDTH), np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            rows = _matrix(batch)
            best, _ = nearest(rows, centroids)
            order = np.argsort(best, kind="stable")
            used, starts = np.unique(best[order], return_index=True)
            if len(used):
                totals[used] += np.add.reduceat(rows[order], starts, axis=0)
                counts += np.bincount(best, minlength=len(centroids))
        used = np.flatnonzero(counts)
        columns = [pa.array(used), pa.array(counts[used]), *(pa.array(totals[used, j]) for j in range(WIDTH))]
        yield pa.record_batch(columns, names=["cluster", "n", *names])

    names = [f"s{j}" for j in range(WIDTH)]
    schema = ", ".join(f"{c} long" for c in ("cluster", "n", *names))
    each = vectors.select("spectrum").mapInArrow(run, schema)
    # summed as decimals, as a corpus may overflow longs
    summed = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", *names)]
    return each.groupBy("cluster").agg(*summed).collect()


def first_centroids(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """Coefficients of the vectors whose ids have the smallest hashes; equal ids are ordered by their coefficients."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = vectors.select(F.sha2(text, 256).alias("hash"), "spectrum").orderBy("hash", "spectrum").limit(centroids)
    return np.array([r.spectrum for r in found.collect()], np.int64).reshape(-1, WIDTH)


def trained(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Coefficients of the centroids after ``rounds`` rounds; one that no vector is nearest to stays as it is."""
    current = first_centroids(vectors, centroids, seed)
    for _ in range(rounds if len(current) else 0):
        current = current.copy()
        for cluster, n, *sums in _sums(vectors, current):
            # every sum of 64 coefficients is 64 times a sum of components: plain whole numbers, so nothing is rounded
            totals = [sum(int(s) * int(h) for s, h in zip(sums, H[:, j], strict=True)) // WIDTH for j in range(WIDTH)]
            current[int(cluster)] = spectrum(np.array([[t // int(n) for t in totals]], np.int64))[0]
    return current


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of each vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = nearest(_matrix(batch), centroids)
            columns = [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)]
            yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(table: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each usable vector.

    Rows whose vector is null, has another length, or holds null or non-finite components give no row. Rows without an id
    are clustered like all others and hashed as an empty id. Repeated rows count as often as they occur. Equal
    distances go to the smaller number. With fewer vectors than ``centroids`` each starts a cluster. Components beyond
    65,536 in size count as 65,536. Other columns are not read. An empty table gives no rows.
    """
    vectors = settled(whole_vectors(table), "centroid-vectors")
    final = trained(vectors, centroids, rounds, seed)
    rows = settled(assigned(vectors, final), "centroid-clusters")
    digests = [sha256(",".join(map(str, v)).encode()).hexdigest() for v in vectors_of(final).tolist()]
    # one row per centroid
    inertia = {r.cluster: r.inertia for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    overall = sum(inertia.values())
    about = [(c, own, overall, digests[c]) for c, own in sorted(inertia.items())]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    named = table.sparkSession.createDataFrame(about, schema)
    return rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def clustered_sql() -> str:
    """``clustered`` for DuckDB: every vector against every centroid in each round."""

    def assign(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
  SELECT r, c, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, m.x) + list_inner_product(m.x, m.x) AS d
  FROM kept v, c{k} m) GROUP BY r)"""

    def move(k: int) -> str:
        return f"""
m{k} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS x FROM (
  SELECT best.c AS c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM a{k - 1} JOIN (SELECT r, unnest(x)::BIGINT AS x, generate_subscripts(x, 1) AS j FROM kept) USING (r) GROUP BY ALL) GROUP BY c),
c{k} AS MATERIALIZED (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{k - 1} o LEFT JOIN m{k} m USING (c))"""

    rounds = ",".join(assign(k - 1) + "," + move(k) for k in range(1, ROUNDS + 1))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)) AS x
  FROM embeddings WHERE len(list_filter(embedding, lambda e: isfinite(e))) = {WIDTH} AND len(embedding) = {WIDTH}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
  FROM (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM kept) ORDER BY c LIMIT {CENTROIDS}),{rounds},{assign(ROUNDS)}
SELECT vec_id, best.c::INT AS cluster, best.d::BIGINT AS distance,
  (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(m.x, lambda e: e::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN c{ROUNDS} m ON m.c = best.c"""
