"""Scores of the trained models against versions that go through one text, word or byte at a time."""

import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from playstream.llm import gam, language_id, quality_rules
from playstream.llm.samples import labelled_sample
from tests.llm.helpers import LABELS, odd_documents, supplied

FULL = 2**64


def plain_features(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return [0.0] * len(gam.FEATURES)
    n, solid, seen = len(words), sum(map(len, words)), Counter(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = [tuple(words[i : i + 4]) for i in range(n - 3)]
    of = lambda signs: sum(seen[b] for b in signs)
    entropy = -math.fsum(k / len(raw) * math.log(k / len(raw)) for k in seen.values())
    return [
        math.log(1 + n), solid / n, of(b"#*$%&|<>") / n, of(b"!?") / n, of(b".,;:") / n, of(range(65, 91)) / solid,
        of(range(48, 58)) / solid, of(range(128, 256)) / solid, entropy, math.log(1 + n / len(lines)),
        1 - len(set(lines)) / len(lines), len(set(words)) / n, 1 - len(set(grams)) / len(grams) if grams else 0.0,
        sum(len(w) <= 3 for w in words) / n,
    ]


def test_additive_model(spark):
    docs = supplied(spark).unionByName(odd_documents(spark))
    model = gam.train(supplied(spark), supplied(spark, "labels"))
    scores = Counter((r.doc_id, r.score) for r in gam.score(docs, model).collect())
    for r in docs.collect():
        values = gam.features(None if r.text is None else r.text.encode()).tolist()
        assert values == pytest.approx(plain_features(r.text), rel=1e-9, abs=1e-12)
        total = model.start
        for j, table in enumerate(model.tables):
            total += table[bisect_right(model.cuts[j].tolist(), values[j])]
        for (a, b), table in model.pairs.items():
            total += table[bisect_right(model.coarse[a].tolist(), values[a]), bisect_right(model.coarse[b].tolist(), values[b])]
        (score,) = {s for d, s in scores if d == r.doc_id and s == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)}
        scores[r.doc_id, score] -= 1
    assert not any(scores.values())


def plain_ngrams(text):
    raw, odd = (text or "").encode(), 0x9E3779B97F4A7C15
    turns = [pow(0xD6E8FEB86659FD93, k + 1, FULL) for k in range(64)]
    chars = Counter(((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) + 1) * odd % FULL >> 52 for i in range(len(raw) - 2))
    words = [
        sum((b + 1) * turns[i & 63] for i, b in enumerate(w)) * odd % FULL for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)
    ]
    both = words + [(a * 3 + b) * odd % FULL for a, b in zip(words, words[1:])]
    named = Counter((x ^ x >> 31) * odd % FULL >> 52 for x in both)
    found = np.zeros(2 * quality_rules.CELLS)
    for offset, counts, n in ((0, chars, len(raw) - 2), (quality_rules.CELLS, named, len(both))):
        for cell, k in counts.items():
            found[offset + cell] = math.sqrt(k / n)
    return found


def test_regression_on_ngrams(spark):
    docs, labels = supplied(spark), supplied(spark, "labels")
    model = quality_rules.train(docs, labels)
    judged = {r.doc_id: r.probability for r in quality_rules.judge(docs, labels).collect()}
    for r in docs.where("length(text) < 6000").orderBy("doc_id").limit(80).collect():
        values = plain_ngrams(r.text)
        assert np.abs(values - quality_rules.ngrams(r.text.encode())).max() < 1e-6
        logit = sum(float(w) * x for w, x in zip(model.weights, values, strict=True) if x) + model.bias
        assert judged[r.doc_id] == pytest.approx(1 / (1 + math.exp(-(model.slope * logit + model.shift))), abs=1e-4)


def plain_states(layer, piece):
    h, state, states = layer.hidden, np.zeros(layer.hidden), []
    for byte in piece:
        given, carried = layer.of_byte[byte].astype(float), state @ layer.of_state.astype(float)
        update, reset = (1 / (1 + np.exp(-(given[k : k + h] + carried[k : k + h]))) for k in (0, h))
        candidate = np.tanh(given[2 * h :] + reset * carried[2 * h :])
        state = (1 - update) * candidate + update * state
        states.append(state)
    return states


def plain_chances(network, text):
    total, letters = np.zeros(len(network.languages)), 0
    for at in range(0, len(text), language_id.PIECE):
        piece = text[at : at + language_id.PIECE]
        behind = plain_states(network.back, piece[::-1])[::-1]
        for byte, ahead, back in zip(piece, plain_states(network.onward, piece), behind, strict=True):
            if byte >= 128 or chr(byte).isalpha():
                score = np.concatenate([ahead, back]) @ network.output.astype(float) + network.bias
                score = np.exp(score - score.max())
                total, letters = total + score / score.sum(), letters + 1
    return total / max(1, letters)


def test_language_network(spark):
    docs = supplied(spark)
    network = language_id.train(docs, rows=60)
    short = [r.text.encode() for r in docs.where("length(text) < 1500").orderBy("doc_id").limit(40).collect()]
    got = language_id.predict(network, short)
    want = np.array([plain_chances(network, text) for text in short])
    assert len(short) > 20 and np.abs(got - want).max() < 1e-3
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all()


def test_samples_hold_one_row_of_an_id(spark):
    """However often an id is repeated, and with the language of the row that is taken."""
    docs = spark.range(5000).selectExpr("1 AS doc_id", "concat('text ', id) AS text", "IF(id < 2, 'en', NULL) AS lang")
    more = spark.range(40).selectExpr("id + 2 AS doc_id", "concat('words of ', id) AS text", "IF(id % 2 = 0, 'de', 'en') AS lang")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 42)], LABELS)
    sample = labelled_sample(docs.unionByName(more), labels, "quality", 10)
    assert sample.count() == sample.select("doc_id").distinct().count() == 10
    assert labelled_sample(docs, labels, "quality", 41).count() == 1
    clashing = more.unionByName(more.selectExpr("doc_id", "'qq zz xx' AS text", "CAST(NULL AS STRING) AS lang"))
    one, other = language_id.train(more, rows=30), language_id.train(clashing, rows=30)
    assert (one.output == other.output).all() and one.languages == other.languages
