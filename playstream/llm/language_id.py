"""Language of a text by a bidirectional gated recurrent network over its bytes, in numpy.

The network labels every position of a text; the probabilities of the positions that hold letters are averaged over the
whole text. It is trained here, by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, remainder_of_id, small_batches
from playstream.llm.samples import one_per_id

#: Bytes that the network reads in one piece, in either direction; a text is cut into such pieces, none left out.
PIECE = 64
HIDDEN = 8
#: Documents, and evenly spread pieces of each, that the network is trained on at most.
TRAIN_ROWS, TRAIN_PIECES = 2_000, 6
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_BLOCK = 4_096
_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123, 128:256]] = True

Array = np.ndarray


def _sigmoid(x: Array) -> Array:
    return 1 / (1 + np.exp(-x))


class Direction:
    """Gated recurrent layer over bytes, read in one direction. Gates: update, reset, candidate."""

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.hidden = hidden
        self.of_byte = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.of_state = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)

    def parameters(self) -> list[Array]:
        return [self.of_byte, self.of_state]

    def forward(self, steps: Array, real: Array, memory: list | None = None) -> Array:
        """States after each step; ``steps`` and ``real`` are (time, piece). Padding leaves the state at zero."""
        h = self.hidden
        state = np.zeros((steps.shape[1], h), np.float32)
        states = np.empty((*steps.shape, h), np.float32)
        for t, byte in enumerate(steps):
            given = self.of_byte[byte]
            carried = state @ self.of_state
            gates = _sigmoid(given[:, : 2 * h] + carried[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(given[:, 2 * h :] + reset * carried[:, 2 * h :])
            if memory is not None:
                memory.append((state, update, reset, candidate, carried[:, 2 * h :]))
            state = (candidate + update * (state - candidate)) * real[t][:, None]
            states[t] = state
        return states

    def backward(self, steps: Array, real: Array, memory: list, wanted: Array) -> list[Array]:
        """Gradients of the parameters, from those of the states, back through time."""
        h = self.hidden
        to_byte, to_state = np.zeros_like(self.of_byte), np.zeros_like(self.of_state)
        later = np.zeros_like(wanted[0])
        for t in range(len(steps) - 1, -1, -1):
            state, update, reset, candidate, carried = memory[t]
            d = (wanted[t] + later) * real[t][:, None]
            d_candidate = d * (1 - update) * (1 - candidate**2)
            d_update = d * (state - candidate) * update * (1 - update)
            d_reset = d_candidate * carried * reset * (1 - reset)
            inner = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            np.add.at(to_byte, steps[t], np.concatenate([d_update, d_reset, d_candidate], axis=1))
            to_state += state.T @ inner
            later = d * update + inner @ self.of_state.T
        return [to_byte, to_state]


@dataclass
class Network:
    languages: list[str]
    onward: Direction
    back: Direction
    output: Array
    bias: Array

    @staticmethod
    def new(languages: list[str], seed: int = 5, hidden: int = HIDDEN) -> Network:
        rng = np.random.default_rng(seed)
        layers = Direction(rng, hidden), Direction(rng, hidden)
        output = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        return Network(languages, *layers, output, np.zeros(len(languages), np.float32))

    def _states(self, steps: Array, real: Array, memories: tuple[list, list] | None = None) -> Array:
        first, second = memories or (None, None)
        ahead = self.onward.forward(steps, real, first)
        behind = self.back.forward(steps[::-1], real[::-1], second)[::-1]
        return np.concatenate([ahead, behind], axis=2)

    def _chances(self, states: Array) -> Array:
        score = states @ self.output + self.bias
        score = np.exp(score - score.max(axis=2, keepdims=True))
        return score / score.sum(axis=2, keepdims=True)

    def pooled(self, pieces: Array, lengths: Array) -> tuple[Array, Array]:
        """Sums over the letters of each piece of the probabilities by language, and the number of letters."""
        steps = np.ascontiguousarray(pieces.T)
        real = (np.arange(pieces.shape[1])[:, None] < lengths).astype(np.float32)
        letters = _LETTER[steps] * real
        return np.einsum("tbk,tb->bk", self._chances(self._states(steps, real)), letters), letters.sum(axis=0)

    def train(self, pieces: Array, lengths: Array, labels: Array, n_steps: int = 300, batch: int = 256, rate: float = 0.02) -> None:
        """Steps of Adam on the mean cross-entropy over the letters, as many for any number of pieces."""
        parameters = [*self.onward.parameters(), *self.back.parameters(), self.output, self.bias]
        first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        rng, order = np.random.default_rng(9), np.zeros(0, np.int64)
        for done in range(1, n_steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(pieces))])
            rows, order = order[:batch], order[batch:]
            pace = rate * (1 - 0.9 * done / n_steps)
            gradients = self._gradients(pieces[rows], lengths[rows], labels[rows])
            for p, g, m, v in zip(parameters, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-7)

    def _gradients(self, pieces: Array, lengths: Array, labels: Array) -> list[Array]:
        steps = np.ascontiguousarray(pieces.T)
        real = (np.arange(pieces.shape[1])[:, None] < lengths).astype(np.float32)
        letters = _LETTER[steps] * real
        memories: tuple[list, list] = [], []
        states = self._states(steps, real, memories)
        error = self._chances(states)
        error[:, np.arange(len(labels)), labels] -= 1
        error *= (letters / max(1.0, letters.sum()))[:, :, None]
        flat, width = error.reshape(-1, error.shape[2]), self.onward.hidden
        to_output = states.reshape(-1, states.shape[2]).T @ flat
        to_states = error @ self.output.T
        ahead = self.onward.backward(steps, real, memories[0], to_states[:, :, :width])
        behind = self.back.backward(steps[::-1], real[::-1], memories[1], to_states[::-1, :, width:])
        return [*ahead, *behind, to_output, flat.sum(axis=0)]


def cut(texts: list[bytes], piece: int = PIECE) -> tuple[Array, Array, Array]:
    """Pieces of all texts, zero-padded; their lengths; the number of pieces of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // piece)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * piece
    lengths = np.minimum(piece, sizes[owner] - place)
    joined = np.frombuffer(b"".join(texts) + bytes(piece), np.uint8)
    starts = (np.cumsum(sizes) - sizes)[owner] + place
    pieces = joined[starts[:, None] + np.arange(piece)]
    pieces[np.arange(piece) >= lengths[:, None]] = 0
    return pieces, lengths, counts


def predict(network: Network, texts: list[bytes]) -> Array:
    """Mean probability of each language over the letters of each whole text; zeros without a letter."""
    pieces, lengths, counts = cut(texts)
    sums, letters = np.zeros((len(pieces), len(network.languages))), np.zeros(len(pieces))
    for at in range(0, len(pieces), _BLOCK):
        rows = slice(at, at + _BLOCK)
        sums[rows], letters[rows] = network.pooled(pieces[rows], lengths[rows])
    owner = np.repeat(np.arange(len(texts)), counts)
    total = np.stack([np.bincount(owner, sums[:, k], len(texts)) for k in range(sums.shape[1])], axis=1)
    return total / np.maximum(1, np.bincount(owner, letters, len(texts)))[:, None]


def train(docs: DataFrame, rows: int = TRAIN_ROWS, pieces_each: int = TRAIN_PIECES) -> Network | None:
    """Network from at most ``rows`` documents with a language and outside the held-out fold; None without any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            spread = []
            for text in bytes_of(batch.column("text")):
                text = text or b""
                starts = np.unique(np.linspace(0, max(0, len(text) - PIECE), pieces_each).astype(int))
                spread.append([text[i : i + PIECE] for i in starts if text])
            columns = [batch.column("doc_id"), batch.column("label"), pa.array(spread, pa.list_(pa.binary()))]
            yield pa.record_batch(columns, names=["doc_id", "label", "pieces"])

    usable = docs.where(F.col("lang").isNotNull() & (remainder_of_id(FOLDS) != HELD_OUT)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("label")
    )
    chosen = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id").limit(rows)
    # at most ``rows`` ids, so the broadcast has a fixed bound; rows of an id that have no language are not learned
    sample = one_per_id(usable.join(F.broadcast(chosen), "doc_id"), "text", "label")
    got = sample.mapInArrow(run, "doc_id long, label string, pieces array<binary>").collect()
    examples = sorted((r.label, bytes(p)) for r in got for p in r.pieces)
    if not examples:
        return None
    languages = sorted({label for label, _ in examples})
    network = Network.new(languages)
    pieces, lengths, _ = cut([p for _, p in examples])
    network.train(pieces, lengths, np.array([languages.index(label) for label, _ in examples]))
    return network


def languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row for each row of ``docs``.

    Null, empty and other texts without a letter get ``und`` and the score 0; so does every text if there is nothing to
    learn from. A null id is not held out and never trains. Repeated rows get equal answers; ties go to the
    language that comes first by name. Other columns are not read. An empty table gives no rows.
    """
    network = train(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = [t or b"" for t in bytes_of(batch.column("text"))]
            if network is None:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                chances = predict(network, texts)
                names, scores = [network.languages[k] for k in chances.argmax(axis=1)], chances.max(axis=1)
            columns = [batch.column(0), batch.column("letters"), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.record_batch(columns, names=["doc_id", "letters", "name", "chance"])

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    found = wanted.mapInArrow(run, "doc_id long, letters boolean, name string, chance double")
    return found.select(
        "doc_id",
        F.coalesce(remainder_of_id(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.when(F.col("letters"), F.col("name")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.least("chance", F.lit(1.0))).otherwise(0.0).alias("score"),
    )
