"""Near-duplicate embeddings: int8 tile products with error bounds, and full precision where the bound leaves doubt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import settled
from playstream.llm.graph import components
from playstream.llm.simhash import forest

THRESHOLD = 0.93
#: Different vectors of one label in a tile; a task compares two tiles.
TILE = 1024
#: Products of int8 values are exact in float32 up to so many components, and pairs rechecked at once.
_EXACT, _AT_ONCE = 1024, 1 << 16
_SLACK = 1e-9


def quantized(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers up to 127 for unit vectors, their scales, the lengths of what they stand for, and of the error."""
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    stands_for = whole * scale[:, None]
    return whole, scale, np.linalg.norm(stands_for, axis=1), np.linalg.norm(unit - stands_for, axis=1)


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(i, j)`` of ``left`` and ``right`` whose cosine is at least ``threshold``.

    With ``v = s q + e`` the product of two unit vectors is off ``s s' (q q')`` by at most ``|e'| + |e| |s' q'|``; only
    pairs that this leaves possible are worked out in double precision.
    """
    norms = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    (q, s, _, e), (p, t, size, f) = (quantized(x / n[:, None]) for x, n in zip((left, right), norms, strict=True))
    products = np.zeros((len(q), len(p)), np.float64)
    for at in range(0, q.shape[1], _EXACT):
        products += q[:, at : at + _EXACT].astype(np.float32) @ p[:, at : at + _EXACT].astype(np.float32).T
    products *= s[:, None] * t[None]
    products += f[None] + e[:, None] * size[None] + _SLACK
    i, j = np.nonzero(products >= threshold)
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), _AT_ONCE):
        a, b = i[at : at + _AT_ONCE], j[at : at + _AT_ONCE]
        dots = np.einsum("nd,nd->n", left[a], right[b])
        good[at : at + _AT_ONCE] = dots / (norms[0][a] * norms[1][b]) >= threshold
    return i[good], j[good]


def _compare(table: pa.Table) -> pa.Table:
    """Links of one pair of tiles: per vector the copies it links to, and the smallest node it hangs together with."""
    table = table.sort_by("node")
    node, own, low = (table.column(c).to_numpy() for c in ("node", "own", "low"))
    copies, high = table.column("copies").to_numpy(), table.column("high").to_numpy()
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(node), -1)
    if low[0] == high[0]:
        i, j = close_pairs(vectors, vectors)
        i, j = i[i < j], j[i < j]
    else:
        here, there = np.flatnonzero(own == low), np.flatnonzero(own == high)
        i, j = close_pairs(vectors[here], vectors[there])
        i, j = here[i], there[j]
    linked = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    root = node[forest(len(node), i, j)]
    touched = linked > 0
    return pa.table({"node": node[touched], "linked": linked[touched].astype(np.int64), "root": root[touched]})


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def near_duplicates(embeddings: DataFrame, tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each row of ``embeddings``.

    Null labels, and vectors that are null, empty, zero or hold a null or non-finite component, link with nothing and
    are kept; neither do vectors of different lengths. Equal vectors of a label are compared once and counted as often
    as they occur, so copies are never expanded into pairs. A row without ``vec_id`` links too; its component is the
    smallest id it reaches, null if there is none, and it is kept only then. Other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn(
        "usable", F.coalesce(_usable(F.col("embedding"), F.col("label")), F.lit(False))
    )
    good = rows.where("usable")
    classes = settled(
        good.groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    ).withColumn("width", F.size("embedding"))
    sizes = classes.groupBy("label", "width").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    dealt = (
        classes.join(sizes, ["label", "width"])
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )
    links = settled(
        dealt.groupBy("label", "width", "low", "high").applyInArrow(_compare, "node long, linked long, root long"),
        "vector-links",
    )
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    placed = settled(
        classes.drop("width")
        .join(counted, "node", "left")
        .join(roots, "node", "left")
        .select(
            "label",
            "embedding",
            "vec_id",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        ),
        "vector-classes",
    )
    smallest = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    found = placed.join(smallest, "root").select("label", "embedding", "n_links", "component_id")
    linked = rows.where("usable").join(found, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates_sql() -> str:
    """``near_duplicates`` for DuckDB: all pairs of a label, and reachability by recursion."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= {THRESHOLD}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id"""
