"""Resampling against counts, weights and an order made one n-gram at a time."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np

from playstream.llm import resampling
from tests.llm.helpers import documents, odd_documents, rows, supplied, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(g.encode()) % 10_000 for g in grams]


def plain(texts, target, percent=5, min_words=20):
    found = [(i, *plain_features(t)) for i, t in texts]
    raw = Counter(b for _, _, buckets in found for b in buckets)
    wanted = Counter(b for t in target for b in plain_features(t)[1])
    s, t = sum(raw.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((raw[b] + 1) * (t + 10000)))) for b in range(10_000)
    ]
    scored = []
    for i, n_words, buckets in found:
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(buckets), weight, weight + noise, n_words))
    able = sorted((r for r in scored if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    result = [(*r[:4], k) for k, r in enumerate(drawn, 1)]
    rest = Counter(r[:4] for r in scored) - Counter(r[:4] for r in drawn)
    return sorted(result + [(*r, None) for r in rest.elements()], key=lambda r: tuple((v is None, str(v)) for v in r))


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_supplied_documents(spark):
    docs, target = supplied(spark).repartition(6), supplied(spark, "benchmark")
    expected = plain(texts_of(docs), [r.text for r in target.collect()])
    assert rows(resampling.resampled(docs, target)) == expected
    assert sum(r[4] is not None for r in expected) > 5


def test_odd_input(spark):
    docs = with_clashes(odd_documents(spark), "score", "rank", "weight", "bucket")
    target = documents(spark, ["alpha beta", None, ""])
    for percent, least in ((5, 20), (50, 1), (100, 0)):
        expected = plain(texts_of(docs), ["alpha beta", None, ""], percent, least)
        assert rows(resampling.resampled(docs, target, percent, least)) == expected
    none = documents(spark, [])
    assert resampling.resampled(none, target).collect() == []
    assert rows(resampling.resampled(docs, none, 50, 1)) == plain(texts_of(docs), [], 50, 1)


def test_ties_and_one_text_in_most_rows(spark):
    """Equal scores of one id, of rows without an id, and one text in nearly all rows."""
    text = "the same words in a text that nearly all rows share with each other here"
    values = [(7, text)] * 300 + [(None, text)] * 300 + [(i, f"{text} {i}") for i in range(40)]
    docs = spark.createDataFrame(values, "doc_id long, text string").repartition(9)
    target = documents(spark, ["words that rows share"])
    assert rows(resampling.resampled(docs, target, 50, 5)) == plain(values, ["words that rows share"], 50, 5)


def test_parts_of_long_texts(monkeypatch):
    """Cuts lose no run of words, whatever lies around them, and words longer than any table."""
    chooser = random.Random(5)
    texts = [" ".join(chooser.choice(["Ab", "c", "x" * 70, "é-ü", "9", "\x00", "…"]) for _ in range(200)) for _ in range(5)]
    texts += ["", "  ", "one", "x" * 5000, "a " * 3]
    for size in (7, 50, 1 << 20):
        monkeypatch.setattr(resampling, "_AT_ONCE", size)
        buckets = [Counter() for _ in texts]
        words = [0] * len(texts)
        for owners, parts, carried in resampling._segments([t.encode() for t in texts]):
            found = resampling.Features(parts, carried)
            for at, n in enumerate(found.words.tolist()):
                words[owners[at]] += n
            for b, o in zip(found.bucket.tolist(), found.owner.tolist(), strict=True):
                buckets[owners[o]][b] += 1
        for text, n, counted in zip(texts, words, buckets, strict=True):
            expected = plain_features(text)
            assert (n, counted) == (expected[0], Counter(expected[1]))


def test_crc_of_strings_put_together():
    chooser = random.Random(2)
    left = [chooser.randbytes(chooser.randint(0, 30)) for _ in range(300)]
    right = [chooser.randbytes(chooser.choice([0, 1, 5, 63, 64, 65, 1000, 70_000])) for _ in range(300)]
    sums = resampling.moved(np.array([crc32(x) for x in left], np.uint32), np.array([len(x) for x in right]))
    assert [int(s) ^ crc32(r) for s, r in zip(sums, right, strict=True)] == [crc32(a + b) for a, b in zip(left, right, strict=True)]


def test_least_drawn(spark):
    chooser = random.Random(8)
    values = [chooser.choice([-(2**62), 2**62, chooser.randint(-(10**9), 10**9), 5]) for _ in range(500)]
    scores = spark.createDataFrame([(v,) for v in values], "score long")
    for k in (1, 2, 130, 250, 499, 500):
        assert resampling.least_drawn(scores, k) == sorted(values, reverse=True)[k - 1]
