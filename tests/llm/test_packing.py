"""Packing against a plain concatenation of every document's ids."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from playstream.llm import packing
from playstream.llm.offsets import before_parts
from tests.llm.helpers import documents, odd_documents, supplied, with_clashes

PATH = public_tokenizers.path(packing.VOCABULARY)


PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True


def plain_ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


def check(docs):
    texts = sorted(((r.doc_id, plain_ids(r.text)) for r in docs.collect()), key=str)
    found = packing.pieces(docs).collect()
    total = sum(len(ids) for _, ids in texts)
    cells = sorted((r.sequence_id, r.offset, r.length) for r in found)
    at = 0
    for sequence, offset, length in cells:  # gapless, and every sequence but the last is full
        assert sequence * packing.WIDTH + offset == at and length > 0 and offset + length <= packing.WIDTH
        at += length
    assert at == total
    # the pieces of one document are those between its begin and its end in the whole
    whole = []
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        if r.start == 0:
            whole.append((r.doc_id, r.doc_tokens, []))
        doc_id, n, parts = whole[-1]
        assert (doc_id, n) == (r.doc_id, r.doc_tokens) and r.start == sum(size for _, size in parts)
        parts.append((r.ids_crc32, r.length))
    unused = list(texts)
    for doc_id, n, parts in whole:
        assert sum(size for _, size in parts) == n
        for key in unused:
            if key[0] == doc_id and len(key[1]) == n and sums(key[1], parts) == [c for c, _ in parts]:
                unused.remove(key)
                break
        else:
            raise AssertionError(doc_id)
    assert not unused
    return whole


def sums(ids, parts):
    packed, at, found = np.array(ids, "<u4").tobytes(), 0, []
    for _, size in parts:
        found.append(crc32(packed[4 * at : 4 * (at + size)]))
        at += size
    return found


def test_supplied_documents(spark):
    assert len(check(supplied(spark).repartition(7))) == 200


def test_odd_input(spark):
    check(with_clashes(odd_documents(spark), "part", "at", "n", "ids", "place"))
    assert packing.pieces(documents(spark, [])).collect() == []
    assert packing.sequences(documents(spark, [])).collect() == []


def test_long_token_and_long_text(spark):
    words = random.Random(3)
    text = " ".join("".join(words.choice("abcdeé漢") for _ in range(words.randint(1, 9))) for _ in range(60_000))
    check(documents(spark, ["x" * 30_000, text, "", None, "ab " * 1000]))


def test_stretches_equal_whole_texts():
    """Runs of any white space, at the ends too, special strings, contractions."""
    stretches, chooser = packing.Stretches(PATH), random.Random(1)
    signs = [" ", "\n", "\t", "a", "B", "1", ".", "é", " ", "　", "'s", "\x1d", "​", "\x85", "<|endoftext|>"]
    texts = ["".join(chooser.choice(signs) for _ in range(chooser.randint(0, 40))) for _ in range(2000)]
    ids, counts = stretches.encode(pa.array(texts), 0)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == plain_ids(text), repr(text)
        at += n
    assert at == len(ids) and 50256 not in ids


def test_sequences_hold_all_ids(spark):
    docs = supplied(spark).repartition(5)
    stored = packing.placed(packing.encoded(docs)).orderBy("place").collect()
    whole = np.frombuffer(b"".join(bytes(r.ids) for r in stored), "<u4")
    found = packing.sequences(docs).orderBy("sequence_id").collect()
    assert [r.sequence_id for r in found] == list(range(-(-len(whole) // packing.WIDTH)))
    assert sum(r.n for r in found) == len(whole) and all(r.n == packing.WIDTH for r in found[:-1])
    last = found[-1]
    assert len(last.ids) == 4 * (last.n if last.n.bit_count() == 1 else packing.WIDTH)


def test_padding_stops_at_a_power_of_two(spark):
    for n in (3, 4, 7):
        text = " ".join(["a"] * n)
        assert len(PLAIN.encode(text).ids) == n
        (row,) = packing.sequences(documents(spark, [text])).collect()
        assert row.n == n + 1 and len(row.ids) == 4 * (n + 1 if n in (3, 7) else packing.WIDTH)


def test_offsets_over_many_blocks(spark):
    frame = spark.createDataFrame([(p, 10 * p + i) for p in (0, 1, 2, 5, 9, 30) for i in range(3)], "part long, amount long")
    rows = {r.part: (r.before, r.overall) for r in before_parts(frame, "amount", block=2).collect()}
    totals = {p: 30 * p + 3 for p in (0, 1, 2, 5, 9, 30)}
    assert rows == {p: (sum(t for q, t in totals.items() if q < p), sum(totals.values())) for p in totals}
