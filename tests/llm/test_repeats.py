import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from playstream.llm import repeats, suffixes
from tests.llm.helpers import documents, odd_documents, rows, supplied, with_clashes


def plain(pairs, length):
    seen = Counter(t[i : i + length] for _, t in pairs for i in range(len(t) - length + 1))
    out = []
    for doc, text in pairs:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((doc, len(text), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def check(docs, sorted_at_once=repeats.SORTED):
    found = repeats.without_repeats(docs, sorted_at_once=sorted_at_once)
    got = rows(found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))
    want = plain([(r.doc_id, (r.text or "").encode()) for r in docs.collect()], repeats.LENGTH)
    assert got == want
    return sum(r[2] for r in got)


@pytest.fixture(scope="module")
def passages():
    pick = random.Random(8)
    text = lambda n: "".join(pick.choice("abcdefgh ijklé") for _ in range(n))
    shared, other = text(450), text(230)
    out = [text(pick.randint(0, 300)) + shared[pick.randint(0, 200) :] + text(pick.randint(0, 300)) for _ in range(30)]
    out += [other + text(99) + other, shared + other, text(199), "z" * 700, "z" * 150, text(200)]
    return out


@pytest.mark.parametrize("sorted_at_once", [2048, 1])
def test_against_counted_strings(spark, passages, sorted_at_once):
    """With buckets sorted, and with all of them taken as too large for that."""
    assert check(documents(spark, passages), sorted_at_once) > 5000


def test_supplied_documents(spark):
    assert check(supplied(spark).limit(100)) > 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check(docs)
    clashing = with_clashes(docs, "kept", "spans", "key_id", "h", "r")
    assert rows(repeats.report(clashing)) == rows(repeats.report(docs))


def test_empty_table(spark):
    assert repeats.report(documents(spark, ["a"]).limit(0)).collect() == []


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcdef", bytes(range(245))])
def test_suffix_arrays(alphabet):
    pick = random.Random(3)
    for _ in range(25):
        length = pick.choice([8, 9, 13, 20])
        base = bytes(pick.choice(alphabet) for _ in range(60))
        strings = [
            bytes(pick.choice(alphabet) for _ in range(pick.randint(0, 30))) + base[pick.randint(0, 30) :]
            for _ in range(pick.randint(1, 9))
        ]
        text, starts = suffixes.joined(strings)
        order = suffixes.suffix_array(text, length)
        assert sorted(order.tolist()) == list(range(len(text)))
        raw = text.tobytes()
        tops = [raw[i : min(raw.index(0, i), i + length)] for i in order.tolist()]
        assert tops == sorted(tops)
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = [i + length <= len(s) and seen[s[i : i + length]] > 1 for s in strings for i in range(len(s) + 1)]
        assert suffixes.repeated(text, length).tolist() == want
        assert starts.tolist() == np.cumsum([0, *[len(s) + 1 for s in strings]])[:-1].tolist()
