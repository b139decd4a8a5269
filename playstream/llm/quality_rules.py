"""Quality rules: word and line counts, and a calibrated logistic regression over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, small_batches
from playstream.llm.samples import labelled_sample

#: Hash cells of character trigrams, and as many of words and word pairs.
CELLS = 4096
#: Labelled documents that the regression is fitted on at most.
TRAIN_ROWS = 3_000
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Documents whose calibrated probability of good quality is lower are not kept.
KEEP_AT = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_DOWN = np.uint64(64 - 12)  # CELLS is two to the power 12
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_TURNS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a run of ``window`` words found twice or more; the first find counts too."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = (mixed + ids[k : k + n] + np.uint64(1)) * _ODD
        mixed ^= mixed >> np.uint64(29)
    _, group, times = np.unique(mixed, return_inverse=True, return_counts=True)
    suspects = np.flatnonzero(times[group] > 1)
    if not len(suspects):
        return 0
    runs: dict[bytes, list[int]] = {}
    for at in suspects.tolist():  # equal hashes are held against the words themselves
        runs.setdefault(ids[at : at + window].tobytes(), []).append(at)
    edges = np.zeros(len(words) + 1, np.int64)
    for found in runs.values():
        if len(found) > 1:
            np.add.at(edges, found, 1)
            np.add.at(edges, np.array(found) + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    seen = np.bincount(raw, minlength=256)
    starts_char = np.ones(256, bool)
    starts_char[128:192] = False
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        int(seen[starts_char & ~_SPACE].sum()),
        int(seen[_SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ngrams(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed character trigrams, then of hashed words and word pairs."""
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(2 * CELLS, np.float32)
    if len(raw) > 2:
        wide = raw.astype(np.uint64)
        codes = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
        out[:CELLS] = np.bincount(((codes + np.uint64(1)) * _ODD) >> _DOWN, minlength=CELLS) / len(codes)
    inside = ~_SPACE[raw]
    starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]]) if len(raw) else np.zeros(0, np.int64)
    if len(starts):
        lengths = np.add.reduceat(inside, starts, dtype=np.int64)
        solid = np.flatnonzero(inside)
        place = np.arange(len(solid)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        parts = (raw[solid].astype(np.uint64) + np.uint64(1)) * _TURNS[place & 63]
        words = np.add.reduceat(parts, np.cumsum(lengths) - lengths) * _ODD
        pairs = (words[:-1] * np.uint64(3) + words[1:]) * _ODD
        both = np.concatenate([words, pairs])
        out[CELLS:] = np.bincount((both ^ (both >> np.uint64(31))) * _ODD >> _DOWN, minlength=CELLS) / len(both)
    return np.sqrt(out)


@dataclass
class Regression:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * (values @ self.weights + self.bias) + self.shift)))


def _descend(values: np.ndarray, labels: np.ndarray, ridge: float, steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over all rows at once."""
    w, b = np.zeros(values.shape[1], np.float32), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(values @ w + b))) - labels) / max(1, len(labels))
        gradient = np.r_[values.T @ error.astype(np.float32) + ridge * w, error.sum()]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - move[-1]
    return w, float(b)


def fit(values: np.ndarray, labels: np.ndarray, ridge: float = 1e-5, steps: int = 300, rate: float = 0.05) -> Regression:
    """Regression whose probabilities are calibrated on halves of the rows that it was not fitted on.

    Without rows, or with one label only, it is that constant, smoothed.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return Regression(np.zeros(values.shape[1], np.float32), float(np.log(share / (1 - share))))
    half = np.arange(len(labels)) % 2 == 0
    outside = np.zeros(len(labels))
    for fitted in (half, ~half):
        w, b = _descend(values[fitted], labels[fitted], ridge, steps, rate)
        outside[~fitted] = values[~fitted] @ w + b
    smooth = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    scale = max(1e-6, float(np.abs(outside).mean()))
    slope, shift = _descend((outside / scale)[:, None].astype(np.float32), smooth, 0.0, 2_000, 0.02)
    w, b = _descend(values, labels, ridge, steps, rate)
    return Regression(w, b, max(0.0, float(slope[0]) / scale), shift)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Regression:
    """Regression on ``labels.quality`` of at most ``rows`` documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [ngrams(t or b"").astype(np.float16).tobytes() for t in bytes_of(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "label", "grams"])

    got = labelled_sample(docs, labels, "quality", rows).mapInArrow(run, "doc_id long, label int, grams binary")
    got = got.toPandas().sort_values(["doc_id", "grams"], ignore_index=True)
    values = np.frombuffer(b"".join(got["grams"]), np.float16).reshape(-1, 2 * CELLS).astype(np.float32)
    return fit(values, got["label"].to_numpy(float))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    probability, kept.

    A null or empty text has no word, so it fails the base rules; its probability is that of no n-grams. Repeated
    rows are judged alike, ids may be null, and columns other than id and text are not read. Without labels the
    probability is 0.5 and the base rules decide. An empty table gives no rows.
    """
    model = train(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = [t or b"" for t in bytes_of(batch.column("text"))]
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5).T
            chances = np.array([model.probability(ngrams(t)[None])[0] for t in texts], float)
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, counts), pa.array(chances)], names=names)

    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", *counted, "probability"]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counted) + ", probability double"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.select(
        "doc_id",
        *counted,
        failed.alias("base_failed"),
        "probability",
        (~failed & (F.col("probability") >= KEEP_AT)).alias("kept"),
    )
