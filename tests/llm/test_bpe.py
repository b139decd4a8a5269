import base64
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.llm import bpe
from tests.llm.helpers import documents, odd_documents, rows, supplied, with_clashes


@pytest.fixture(scope="module")
def codec():
    return bpe._codec(None, None)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


TEXTS = ["", " ", "a  b", "a   b", "x\n y", "x\n \n y", "tab\t \t end ", "<|endoftext|>", "don't 'll 12345 !!!", "é漢字😀 \u0085x", "a" * 999]


@pytest.mark.parametrize("text", TEXTS)
def test_fixed_texts(codec, library, text):
    (packed,) = codec.encode([text])
    assert ids(packed) == library.encode_ordinary(text)
    assert codec.decode(packed) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sab1!é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    codec = bpe._codec(None, None)
    (packed,) = codec.encode([text])
    whole = b"".join(np.array(codec.merge(p.encode()) if codec.whole.find([p.encode()]) == [-1] else [codec.ranks[p.encode()]], "<u4").tobytes() for p in codec.split(text))
    assert packed == whole and codec.decode(packed) == text.encode()


def test_kept_ids_may_be_dropped(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 1)
    for text in ("some words here", "words of another text", "some words here"):
        assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)


def test_perfect_hash_has_a_slot_for_each_key():
    keys = [b"%d" % i for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.value_at.tolist()) == list(range(5000))
    assert table.find(keys) == list(range(5000))
    assert table.find([b"x%d" % i for i in range(5000)]) == [-1] * 5000
    assert bpe.PerfectHash([]).find([b"a"]) == [-1]


def expected(docs, library):
    out = []
    for r in docs.collect():
        found = library.encode_ordinary(r.text or "")
        packed = np.array(found, "<u4").tobytes()
        out.append((r.doc_id, len(found), sha256(packed).hexdigest(), sha256((r.text or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_documents(spark, library):
    for docs in (supplied(spark).limit(80), odd_documents(spark)):
        assert rows(bpe.round_trip(docs)) == expected(docs, library)
    clashing = with_clashes(odd_documents(spark), "ids", "decoded", "n_tokens")
    assert rows(bpe.round_trip(clashing)) == rows(bpe.round_trip(odd_documents(spark)))
    assert bpe.round_trip(documents(spark, ["a"]).limit(0)).collect() == []


def test_the_two_ways_of_encoding_and_decoding_agree(spark):
    docs = odd_documents(spark)
    assert rows(bpe.decode(bpe.encode(docs))) == rows(bpe.encode_and_decode(docs))
    arrays = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.tokenized(docs).collect()}
    assert arrays == {(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.round_trip(docs).collect()}
    assert all(len(r.ids) == r.n_tokens for r in bpe.tokenized(docs).collect())


def test_pieces_merged_side_by_side(codec):
    draw = np.random.default_rng(3)
    parts = ["a", "e", "th", "ing", " ", "x1", "é", "漢", "#", "aaaa", "tion", "0", "\n", "😀"]
    texts = ["a", "é", "aa", "a" * 64, *{"".join(draw.choice(parts, n)) for n in draw.integers(1, 17, 3000)}]
    pieces = [t.encode() for t in texts]
    expected = [np.array(codec.merge(p), "<u4").tobytes() for p in pieces]
    assert codec.merge_all(pieces) == expected
    assert codec.merge_all(pieces[:1]) == expected[:1]
    assert all(codec.decode(found) == p for found, p in zip(expected, pieces, strict=True))


def test_new_words_of_a_batch_take_no_heap(monkeypatch, library):
    codec = bpe.Codec(public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)
    text = "one " + " ".join(f"qz{i:x}vkw" for i in range(500))
    taken = []
    monkeypatch.setattr(codec, "merge", lambda piece, merge=codec.merge: taken.append(piece) or merge(piece))
    assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)
    assert len(taken) < 10


def test_ranks_without_every_byte_are_merged_by_the_heap(tmp_path):
    lines = [(b"a", 0), (b"b", 1), (b"ab", 2)]
    (tmp_path / "ranks").write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in lines))
    codec = bpe.Codec(str(tmp_path / "ranks"), r"b+a*|a+b*")
    words = ["a" * i + "b" * j for i in range(1, 9) for j in range(1, 9)]
    assert not codec.paired
    for word, packed in zip(words, codec.encode(words), strict=True):
        assert ids(packed) == codec.merge(word.encode()) and codec.decode(packed) == word.encode()
