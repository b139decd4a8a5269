"""Packing by concatenating and cutting: prefix sums give each document its place, fixed windows cut the whole."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playstream.llm.common import bytes_of, settled, small_batches
from playstream.llm.offsets import before_parts

VOCABULARY = "byte_bpe_50k.json"
#: Ids in a sequence, and the id that ends each document and fills up the last sequence.
WIDTH, END = 1024, 0
#: Stretches that are tokenized as one text, and bytes of ids that are handled at once.
_JOINED, _AT_ONCE = 4096, 8 << 20


#: White space, more of it than the vocabulary's pattern knows.
_WHITE = r"[\s\x0b\x1c-\x1f\x85\pZ]"


class Stretches:
    """Ids of texts by a byte-level ``tokenizers`` vocabulary, each different stretch of a batch tokenized once.

    The vocabulary's pattern starts a match at each space that follows anything but white space. Texts are cut
    there; ids of the stretches, put together, are the ids of the text. A stretch holds one space, its first
    byte, unless white space lies before a later one. Many stretches are therefore tokenized as one
    text, and tokens that begin with a space tell them apart.
    """

    _cut = re.compile(r"(?<=\S) ").split

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        tokens = self.tokenizer.get_vocab()
        space = self.tokenizer.encode(" a", add_special_tokens=False).tokens[0][0]
        self.leads = np.zeros(max(tokens.values()) + 1, bool)
        self.leads[[i for token, i in tokens.items() if token.startswith(space)]] = True

    def _ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def _known(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different stretches, in an order of its own; the number of ids of each; which stretch each is.

        A stretch that begins or ends in white space would run into its neighbour, and one that holds a space would
        count as two: these are tokenized alone.
        """
        alone = pc.match_substring_regex(stretches, f"^{_WHITE}|{_WHITE}$|^$| ").to_numpy(zero_copy_only=False)
        together, apart = np.flatnonzero(~alone), np.flatnonzero(alone)
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        texts = stretches.take(pa.array(together)).to_pylist()
        for at in range(0, len(texts), _JOINED):
            found = self._ids(" " + " ".join(texts[at : at + _JOINED]))
            starts = np.flatnonzero(self.leads[found])
            ids.append(found)
            counts.append(np.diff(starts, append=len(found)))
        for text in stretches.take(pa.array(apart)).to_pylist():
            ids.append(self._ids(" " + text))
            counts.append(np.array([len(ids[-1])]))
        return np.concatenate(ids), np.concatenate(counts), np.concatenate([together, apart])

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text in which white space meets a space."""
        first, *rest = self._cut(text)
        stretches = pa.array(rest, pa.large_string()).dictionary_encode()
        ids, counts, which = self._known(stretches.dictionary)
        place = np.argsort(which)
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), pa.array(ids))
        taken = place[stretches.indices.to_numpy(zero_copy_only=False)]
        return np.concatenate([self._ids(first), lists.take(pa.array(taken)).flatten().to_numpy(zero_copy_only=False)])

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, ``end`` after each, and the number of ids of each text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        crossing = pc.match_substring_regex(texts, f"{_WHITE} |^ ")
        pieces = pc.split_pattern(pc.if_else(crossing, "", texts), " ")
        offsets = pieces.offsets.to_numpy()[: len(texts) + 1]
        firsts = pieces.values.take(pa.array(offsets[:-1])).to_pylist()
        odd = np.flatnonzero(crossing.to_numpy(zero_copy_only=False))
        heads = [self._ids(first) for first in firsts]
        for i, text in zip(odd, texts.take(pa.array(odd)).to_pylist(), strict=True):
            heads[i] = self._whole(text)
        is_first = np.zeros(len(pieces.values), bool)
        is_first[offsets[:-1]] = True
        coded = pieces.values.filter(pa.array(~is_first)).dictionary_encode()
        known, known_counts, which = self._known(coded.dictionary)
        # lists to choose from: the different stretches, the closing id, the heads
        last = [] if end is None else [np.array([end], "<u4")]
        choice = np.concatenate([known, *last, *heads]).astype("<u4", copy=False)
        counts = np.concatenate([known_counts, np.array([len(x) for x in (*last, *heads)], np.int64)])
        # what each text takes of them, in order: its head, its stretches, the closing id
        per_text = np.diff(offsets) - 1
        each = 1 + len(last)
        heads_at = np.cumsum(per_text) - per_text + each * np.arange(len(texts))
        taken = np.full(len(coded) + each * len(texts), len(known_counts), np.int64)
        taken[heads_at] = len(known_counts) + len(last) + np.arange(len(texts))
        others = np.ones(len(taken), bool)
        others[heads_at] = False
        if last:
            others[heads_at + 1 + per_text] = False
        taken[others] = np.argsort(which)[coded.indices.to_numpy(zero_copy_only=False)]
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), pa.array(choice))
        ids = lists.take(pa.array(taken)).flatten().to_numpy(zero_copy_only=False)
        totals = np.add.reduceat(counts[taken], heads_at) if len(texts) else np.zeros(0, np.int64)
        return ids, totals


@lru_cache(maxsize=2)
def _stretches(path: str) -> Stretches:
    """One per worker process."""
    return Stretches(path)


def encoded(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """``(part, at, n, doc_id, ids)`` per row, written: the partition, the ids before the row there, the row's ids.

    ``ids`` are packed little-endian 32-bit integers with ``end`` last. A partition's rows come from the one
    attempt of its task that was committed, so ``at`` counts the rows that are there.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches, part, at = _stretches(path or public_tokenizers.path(VOCABULARY)), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, "text"):
            ids, counts = stretches.encode(batch.column("text"), end)
            stops = np.cumsum(counts)
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                len(counts),
                [None, pa.py_buffer(np.concatenate([[0], 4 * stops]).astype(np.int64)), pa.py_buffer(ids)],
            )
            columns = [
                pa.array(np.full(len(counts), part, np.int64)),
                pa.array(at + stops - counts),
                pa.array(counts),
                batch.column("doc_id"),
                raw.cast(pa.binary()),
            ]
            yield pa.record_batch(columns, names=["part", "at", "n", "doc_id", "ids"])
            at += int(stops[-1]) if len(stops) else 0

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settled(wanted.mapInArrow(run, "part long, at long, n long, doc_id long, ids binary"), "packing-ids")


def placed(stored: DataFrame) -> DataFrame:
    """``(doc_id, n, ids, place, overall)``: ``place`` counts the ids before the document in the whole corpus."""
    return stored.join(before_parts(stored, "n"), "part").select(
        "doc_id", "n", "ids", (F.col("before") + F.col("at")).alias("place"), "overall"
    )


def pieces(docs: DataFrame, width: int = WIDTH, path: str | None = None, end: int = END) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece of a document.

    All ids lie one after the other, partition by partition, and are cut each ``width`` ids, so all
    sequences but the last are full. Null and empty texts are the closing id alone. Repeated rows and rows without an
    id are documents of their own. Long texts are cut like all others. Other columns are not read. An empty table
    gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "ids", _AT_ONCE):
            place, n = (batch.column(c).to_numpy() for c in ("place", "n"))
            first = place // width
            count = (place + n - 1) // width - first + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(place[row], sequence * width)
            stop = np.minimum((place + n)[row], (sequence + 1) * width)
            start = begin - place[row]
            whole = [memoryview(x) for x in bytes_of(batch.column("ids"))]
            ends = (4 * (start + stop - begin)).tolist()
            sums = [crc32(whole[r][a:b]) for r, a, b in zip(row.tolist(), (4 * start).tolist(), ends, strict=True)]
            columns = [start, stop - begin, np.array(sums, np.int64), n[row], sequence, begin - sequence * width]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), *map(pa.array, columns)], names=names)

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return placed(encoded(docs, path, end)).select("doc_id", "n", "ids", "place").mapInArrow(run, schema)


def _windows(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Windows that lie whole in one stretch of neighbouring rows, and boundary records of the others."""
    held, begin = bytearray(), 0

    def cut(final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, begin
        rows = []
        at = 0
        while at < len(held) // 4:
            place = begin + at
            size = min(width - place % width, len(held) // 4 - at)
            if not final and place % width + size < width:
                break
            rows.append((place // width, place % width, bytes(held[4 * at : 4 * (at + size)])))
            at += size
        del held[: 4 * at]
        begin += at
        if rows:
            sequence, offset, ids = zip(*rows, strict=True)
            columns = [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.record_batch(columns, names=["sequence_id", "offset", "ids"])

    for batch in small_batches(batches, "ids", _AT_ONCE):
        for place, ids in zip(batch.column("place").to_pylist(), bytes_of(batch.column("ids")), strict=True):
            if place != begin + len(held) // 4:
                yield from cut(True)
                begin = place
            held += ids
            if len(held) >= _AT_ONCE:
                yield from cut(False)
    yield from cut(True)


def sequences(docs: DataFrame, width: int = WIDTH, path: str | None = None, end: int = END) -> DataFrame:
    """``(sequence_id, n, ids)``: the packed ids of each sequence, ``n`` of them from documents.

    Only windows over a border between two stretches of rows are put together by a shuffle, of at most one record
    per id. Where ``n`` is no power of two the sequence is filled up to ``width`` with ``end``.
    """
    spread = placed(encoded(docs, path, end)).select("place", "ids")
    cut = spread.mapInArrow(lambda b: _windows(b, width), "sequence_id long, offset long, ids binary")
    records = settled(cut, "packing-windows")
    full = F.octet_length("ids") == 4 * width
    joined = (
        records.where(~full)
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("found"))
        .select("sequence_id", F.expr("aggregate(found, x'', (a, x) -> concat(a, x.ids))").alias("ids"))
    )
    n = (F.octet_length("ids") / 4).cast("long")
    fill = F.expr(f"unhex(repeat('{end.to_bytes(4, 'little').hex()}', cast({width} - n as int)))")
    whole = records.where(full).select("sequence_id", "ids").unionByName(joined).withColumn("n", n)
    power = F.bit_count("n") == 1
    return whole.select("sequence_id", "n", F.when(power, F.col("ids")).otherwise(F.concat("ids", fill)).alias("ids"))
