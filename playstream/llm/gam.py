"""Document quality by a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other and adds a shallow tree over its bins to the feature's lookup table;
afterwards the strongest pairs of features get tables of their own. A score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, remainder_of_id, small_batches
from playstream.llm.samples import labelled_sample

FEATURES = (
    "log_words",
    "word_length",
    "symbols_per_word",
    "marks_per_word",
    "stops_per_word",
    "upper_share",
    "digit_share",
    "other_share",
    "entropy",
    "log_words_per_line",
    "repeated_lines",
    "distinct_words",
    "repeated_4grams",
    "short_words",
)
#: Labelled documents that the model is fitted on at most.
TRAIN_ROWS = 20_000
FOLDS = 5
PASS_AT = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)


def features(text: bytes | None) -> np.ndarray:
    """Values of FEATURES for a whole text; zeros without a word."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, n)
    grams = ids[: n - 3].copy()
    for k in range(1, 4):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[k : n - 3 + k] if n > 3 else grams
    share = counts[counts > 0] / len(text)
    solid = max(1, int(lengths.sum()))
    return np.array(
        [
            np.log1p(n),
            solid / n,
            counts[_SYMBOLS].sum() / n,
            counts[_MARKS].sum() / n,
            counts[_STOPS].sum() / n,
            counts[65:91].sum() / solid,
            counts[48:58].sum() / solid,
            counts[128:].sum() / solid,
            -(share * np.log(share)).sum(),
            np.log1p(n / len(lines)),
            1 - len(set(lines)) / len(lines),
            len(number) / n,
            1 - len(np.unique(grams)) / len(grams) if n > 3 else 0.0,
            (lengths <= 3).sum() / n,
        ]
    )


@dataclass
class AdditiveModel:
    """Lookup tables over binned features and over pairs of them."""

    cuts: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    start: float = 0.0

    def logits(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.start)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], values[:, j], side="right")]
        for (a, b), table in self.pairs.items():
            x, y = (np.searchsorted(self.coarse[j], values[:, j], side="right") for j in (a, b))
            total += table[x, y]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(values)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of about equally filled bins."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best cut of consecutive bins into two groups: its gain and the first bin of the right one."""
    g, h = np.cumsum(gradient), np.cumsum(weight)
    if len(g) < 2:
        return 0.0, 0
    left = g[:-1] ** 2 / (h[:-1] + ridge)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
    gain = left + right - g[-1] ** 2 / (h[-1] + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step values per bin of a tree of at most ``leaves`` leaves."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        found = [(*_split(gradient[a:b], weight[a:b], ridge), a, b) for a, b in parts]
        gain, at, a, b = max(found)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    step = np.zeros(len(gradient))
    for a, b in parts:
        step[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + ridge)
    return step


def fit(
    values: np.ndarray,
    labels: np.ndarray,
    rounds: int = 150,
    rate: float = 0.1,
    bins: int = 32,
    coarse_bins: int = 8,
    n_pairs: int = 6,
    leaves: int = 3,
    ridge: float = 2.0,
) -> AdditiveModel:
    """Boosted tables for 0/1 ``labels``. Without rows, or with one label only, the model is that constant, smoothed."""
    model = AdditiveModel()
    share = (labels.sum() + 1) / (len(labels) + 2)
    model.start = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return model
    width = values.shape[1]
    model.cuts = [_cuts(values[:, j], bins) for j in range(width)]
    model.coarse = [_cuts(values[:, j], coarse_bins) for j in range(width)]
    binned = [np.searchsorted(model.cuts[j], values[:, j], side="right") for j in range(width)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(labels), model.start)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = residual()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(binned[j], g, size), np.bincount(binned[j], h, size), leaves, ridge)
            model.tables[j] += step
            total += step[binned[j]]
    rough = [np.searchsorted(model.coarse[j], values[:, j], side="right") for j in range(width)]

    def cells(a: int, b: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        return rough[a] * shape[1] + rough[b], shape

    g, h = residual()
    strength = {}
    for a, b in combinations(range(width), 2):
        cell, shape = cells(a, b)
        n = shape[0] * shape[1]
        strength[a, b] = (np.bincount(cell, g, n) ** 2 / (np.bincount(cell, h, n) + ridge)).sum()
    for a, b in sorted(strength, key=lambda k: (-strength[k], k))[:n_pairs]:
        model.pairs[a, b] = np.zeros(cells(a, b)[1])
    for _ in range(rounds // 3):
        for (a, b), grid in model.pairs.items():
            g, h = residual()
            cell, shape = cells(a, b)
            n = shape[0] * shape[1]
            gs, hs = (np.bincount(cell, x, n).reshape(shape) for x in (g, h))
            # a tree of depth two: the better feature is cut first, then each side along the other one
            if _split(gs.sum(1), hs.sum(1), ridge)[0] >= _split(gs.sum(0), hs.sum(0), ridge)[0]:
                step = _two_level(gs, hs, ridge)
            else:
                step = _two_level(gs.T, hs.T, ridge).T
            grid += rate * step
            total += rate * step[rough[a], rough[b]]
    return model


def _two_level(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    _, cut = _split(g.sum(1), h.sum(1), ridge)
    step = np.zeros_like(g)
    for rows in (slice(0, cut), slice(cut, len(g))):
        if len(g[rows]):
            step[rows] = _tree(g[rows].sum(0), h[rows].sum(0), 2, ridge)
    return step


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Model of ``labels.quality`` from at most ``rows`` documents outside the held-out fold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [features(t).tolist() for t in bytes_of(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, names=["doc_id", "label", "features"])

    sample = labelled_sample(docs, labels, "quality", rows, remainder_of_id(FOLDS) != 0)
    got = sample.mapInArrow(run, "doc_id long, label int, features array<double>").toPandas()
    got = got.assign(key=[tuple(x) for x in got["features"]]).sort_values(["doc_id", "key"])
    values = np.array([list(x) for x in got["features"]], float).reshape(-1, len(FEATURES))
    return fit(values, got["label"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """``docs`` with ``score``, the probability of good quality; an equally named column of ``docs`` is replaced."""
    names = [c for c in docs.columns if c != "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            values = np.array([features(t) for t in bytes_of(batch.column("text"))]).reshape(-1, len(FEATURES))
            columns = [batch.column(c) for c in names] + [pa.array(model.scores(values))]
            yield pa.record_batch(columns, names=[*names, "score"])

    kept = docs.select(*names)
    schema = kept.limit(0).withColumn("score", F.lit(0.0)).schema
    return kept.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``docs``.

    Null, empty and blank texts are scored as having no word. A null ``doc_id`` is not held out and never trains.
    Equal texts get equal scores. Columns other than id and text are not read. Without labels every score is 0.5.
    An empty table gives no rows.
    """
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder_of_id(FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PASS_AT).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model passes, with their columns."""
    scored = score(docs.withColumnRenamed("score", "_score"), train(docs, labels))
    return scored.where(F.col("score") >= PASS_AT).drop("score").withColumnRenamed("_score", "score")
