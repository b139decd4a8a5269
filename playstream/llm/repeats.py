"""Repeated passages: bytes covered by a string that also starts elsewhere, found by suffix arrays.

A corpus has no suffix array that one machine could hold, so its places are first dealt to buckets that can be sorted
by themselves. Among the hashes of the short strings within a window of ``length`` bytes the smallest one is the window's
anchor. Equal windows have equal anchors at the same place in them, so all windows that may be equal meet in
the bucket of their anchor's hash. What follows works on *stretches*: the runs of windows that share one anchor.

* An anchor hash that occurs once is not looked at again.
* Equal stretches are repeated as a whole; one of them is kept for the others to be held against.
* Different stretches of one bucket are sorted: a two-stage suffix array over their bytes, where equal windows are
  neighbours with a common prefix of ``length`` at least.
* A bucket of too many different stretches is dealt out by more of their content (``_split``): windows of about the same
  place relative to the anchor have a longer string in common than the anchor, so equal windows stay together. Its
  parts are treated in the same way.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, settled, small_batches
from playstream.llm.suffixes import joined, repeated

LENGTH = 200
#: Length of the strings whose hashes are compared; shorter ones make more buckets hold nothing but chance.
GRAM = 32
#: Different stretches of a bucket that are sorted in one place; more are dealt out by more of their content.
SORTED = 2048
#: How many neighbouring places of the anchor within a window share a part, step by step. At 1 a part's windows are equal.
WIDTHS = (43, 11, 3, 1)
#: Bytes that are sorted, or hashed, together.
_AT_ONCE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_KEYS = ("key_id", "key_text")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of two numbers; rows with one key are equal and get equal answers."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select("*", F.coalesce("doc_id", F.lit(-(2**63))).alias("key_id"), F.xxhash64("text").alias("key_text"))


def _rolling(raw: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of the ``gram`` bytes from each position."""
    n = len(raw)
    with np.errstate(over="ignore"):
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE_INVERSE, np.uint64)], dtype=np.uint64)
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)], dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down, dtype=np.uint64)]
        mixed = (sums[gram:] - sums[:-gram]) * up[: n - gram + 1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    return mixed


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Owner, anchor hash, anchor, and first and last window start of each stretch; places count within the text."""
    nothing = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw) < length:
        return nothing
    hashes = _rolling(raw, gram)
    # the leftmost of the smallest upper halves
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(packed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
    if not len(starts):
        return nothing
    anchors, owners = anchor[starts], owner[starts]
    first = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (owners[1:] != owners[:-1])])
    last = np.r_[first[1:] - 1, len(starts) - 1]
    of, at = owners[first], anchors[first]
    begin = (ends - sizes)[of]
    return of, hashes[at], at - begin, starts[first] - begin, starts[last] - begin


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """Stretches of all documents: key, anchor hash ``h``, digest ``r`` of bytes and form, ``low`` and ``high`` window start."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _AT_ONCE):
            texts = bytes_of(batch.column("text"))
            of, h, anchor, low, high = stretches(texts, length)
            digest, owners = xxhash.xxh3_64_intdigest, of.tolist()
            r = [
                digest(texts[o][a : b + length], p - a)
                for o, p, a, b in zip(owners, anchor.tolist(), low.tolist(), high.tolist(), strict=True)
            ]
            keys = [batch.column(c).to_numpy()[of] for c in _KEYS]
            columns = [*keys, h.view(np.int64), np.array(r, np.uint64).view(np.int64), low.astype(np.int32), high.astype(np.int32)]
            yield pa.record_batch([pa.array(c) for c in columns], names=[*_KEYS, "h", "r", "low", "high"])

    schema = "key_id long, key_text long, h long, r long, low int, high int"
    return docs.select(*_KEYS, "text").where(F.octet_length("text") >= length).mapInArrow(run, schema)


def _texts_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` stretches with their bytes, cut out of ``docs``."""
    listed = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("h", "low", "high", "copies")).alias("listed"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _AT_ONCE):
            texts = bytes_of(batch.column("text"))
            lists = batch.column("listed")
            of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            h, low, high, copies = (flat.field(k) for k in range(4))
            cut = [
                texts[o][a : b + length]
                for o, a, b in zip(of.tolist(), low.to_pylist(), high.to_pylist(), strict=True)
            ]
            keys = [pa.array(batch.column(c).to_numpy()[of]) for c in _KEYS]
            yield pa.record_batch([*keys, h, low, high, copies, pa.array(cut, pa.binary())], names=names)

    names = [*_KEYS, "h", "low", "high", "copies", "bytes"]
    schema = "key_id long, key_text long, h long, low int, high int, copies long, bytes binary"
    # a key's rows are equal texts, so one of them will do
    joined_ = docs.select(*_KEYS, "text").join(listed, list(_KEYS))
    return joined_.mapInArrow(run, schema)


def _runs(flags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set ``flags`` within strings that begin at ``starts``: string, first and last place in it."""
    at = np.flatnonzero(flags)
    of = np.searchsorted(starts, at, side="right") - 1
    fresh = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])]) if len(at) else at
    last = np.r_[fresh[1:] - 1, len(at) - 1] if len(at) else at
    return of[fresh], at[fresh] - starts[of[fresh]], at[last] - starts[of[last]]


def _sorted_buckets(cut: DataFrame, length: int) -> DataFrame:
    """Windows of stretches that occur once, equal to windows of other stretches of their bucket, by suffix arrays."""

    def whole(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held)
        strings = table.column("bytes").to_pylist()
        text, starts = joined(strings)
        of, first, last = _runs(repeated(text, length), starts)
        low, copies = table.column("low").to_numpy(), table.column("copies").to_numpy()
        once = copies[of] == 1
        of, first, last = of[once], first[once], last[once]
        if len(of):
            keys = [table.column(c).to_numpy()[of] for c in _KEYS]
            begin, stop = low[of] + first, low[of] + last + length
            columns = [*keys, begin.astype(np.int32), stop.astype(np.int32)]
            yield pa.record_batch([pa.array(c) for c in columns], names=[*_KEYS, "begin", "stop"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, last = 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            h = batch.column("h").to_numpy()
            cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else []
            sizes = np.cumsum(np.r_[0, pc.binary_length(batch.column("bytes")).to_numpy()])
            for a, b in zip(cuts, [*cuts[1:], len(h)], strict=True):  # bucket by bucket; one may go on in the next batch
                if h[a] != last and size > _AT_ONCE:
                    yield from whole(held)
                    held, size = [], 0
                held.append(table.slice(a, b - a))
                size, last = size + int(sizes[b] - sizes[a]), h[a]
        if held:
            yield from whole(held)

    dealt = cut.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "key_id long, key_text long, begin int, stop int")


def _split(cut: DataFrame, width: int, length: int) -> DataFrame:
    """Stretches cut up by their windows' place relative to the anchor, ``width`` places a part.

    A part's windows all hold the same string of ``length - width + 1`` bytes around the anchor, whose hash, with the
    number of the part, is the new ``h``. Equal windows have their anchor at the same place, so they meet again.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", 64 << 10):
            strings = bytes_of(batch.column("bytes"))
            of, _, anchors, first, last = stretches(strings, length)
            low = batch.column("low").to_numpy()
            owners, begins, stops, h, r, parts = [], [], [], [], [], []
            for o, p, a, b in zip(of.tolist(), anchors.tolist(), first.tolist(), last.tolist(), strict=True):
                for part in range((p - b) // width, (p - a) // width + 1):
                    begin, stop = max(a, p - (part + 1) * width + 1), min(b, p - part * width) + length
                    shared = strings[o][p - part * width : p - (part + 1) * width + 1 + length]
                    owners.append(o)
                    begins.append(int(low[o]) + begin)
                    stops.append(int(low[o]) + stop - length)
                    h.append(xxhash.xxh3_64_intdigest(shared, part))
                    r.append(xxhash.xxh3_64_intdigest(strings[o][begin:stop], p - begin))
                    parts.append(strings[o][begin:stop])
            keys = [batch.column(c).to_numpy()[owners] for c in _KEYS]
            places = [np.array(c, np.int32) for c in (begins, stops)]
            hashes = [np.array(c, np.uint64).view(np.int64) for c in (h, r)]
            copies = batch.column("copies").to_numpy()[owners]
            columns = [*map(pa.array, (*keys, *hashes, *places, copies)), pa.array(parts, pa.binary())]
            yield pa.record_batch(columns, names=[*_KEYS, "h", "r", "low", "high", "copies", "bytes"])

    schema = "key_id long, key_text long, h long, r long, low int, high int, copies long, bytes binary"
    return cut.mapInArrow(run, schema)


def _dealt_out(cut: DataFrame, length: int, most: int, widths: tuple[int, ...]) -> list[DataFrame]:
    """Repeated ranges of stretches that occur once, in buckets of more than ``most`` different stretches."""
    if not widths or cut.isEmpty():
        return []
    parts = settled(_split(cut, widths[0], length), "parts")
    one = F.min(F.struct(*_KEYS, "low", "high")).alias("one")
    totals = parts.groupBy("h", "r").agg(F.sum("copies").alias("n"), one)
    kinds = settled(totals, "part-kinds")
    twice = settled(kinds.where("n > 1").select("h", "r"), "equal-parts")
    equal = parts.where("copies = 1").join(twice, ["h", "r"], "left_semi")
    ranges = equal.select(*_KEYS, F.col("low").alias("begin"), (F.col("high") + length).alias("stop"))
    different = settled(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"), "part-sizes")
    wanted = kinds.join(different, "h").select("h", "r", "kinds", "n", "one.*")
    left = parts.drop("copies").join(wanted, ["h", "r", *_KEYS, "low", "high"]).dropDuplicates(["h", "r"])
    return [ranges, *_repeats_within(left.withColumnRenamed("n", "copies").drop("r"), length, most, widths[1:])]


def _repeats_within(cut: DataFrame, length: int, most: int, widths: tuple[int, ...]) -> list[DataFrame]:
    """Repeated ranges among the different stretches of each bucket: sorted, or dealt out first."""
    cut = settled(cut, "stretch-bytes")
    found = _sorted_buckets(cut.where(F.col("kinds") <= most).drop("kinds"), length)
    return [found, *_dealt_out(cut.where(F.col("kinds") > most).drop("kinds"), length, most, widths)]


def spans(docs: DataFrame, length: int = LENGTH, sorted_at_once: int = SORTED) -> DataFrame:
    """``(key_id, key_text, begin, stop)``: repeated byte ranges of the keyed ``docs``; they may overlap."""
    anchored = settled(_anchored(docs, length), "anchors")
    seen = anchored.groupBy("h").agg(F.count("*").alias("n"), F.min("r").alias("a"), F.max("r").alias("b"))
    # settled, so that both sides of the join are shuffles of their own and Spark can split a hot hash
    shared = settled(seen.where("n > 1").select("h", (F.col("a") != F.col("b")).alias("mixed")), "shared-hashes")
    candidates = settled(anchored.join(shared, "h"), "shared-anchors")
    one = F.min(F.struct(*_KEYS, "low", "high"))
    kinds = settled(
        candidates.where("mixed").groupBy("h", "r").agg(F.count("*").alias("copies"), one.alias("one")), "stretches"
    )
    # a stretch that occurs twice is repeated as a whole; settled, so that a small list is sent to the candidates
    # and these are not dealt by a hash that many of them share
    twice = settled(kinds.where("copies > 1").select("h", "r"), "equal-stretches")
    plain = candidates.where("not mixed").unionByName(candidates.where("mixed").join(twice, ["h", "r"], "left_semi"))
    ranges = plain.select(*_KEYS, F.col("low").alias("begin"), (F.col("high") + length).alias("stop"))
    different = kinds.groupBy("h").agg(F.count("*").alias("kinds"))
    wanted = kinds.select("h", "one.*", "copies").join(different, "h")
    cut = _texts_of(docs, wanted, length).join(different, "h")
    widths = tuple(w for w in WIDTHS if w <= length - GRAM + 1)
    return reduce(DataFrame.unionByName, [ranges, *_repeats_within(cut, length, sorted_at_once, widths)])


def merged(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by ranges; ranges that touch are one run."""
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order]) if len(stop) else stop
    fresh = np.flatnonzero(np.r_[True, begin[1:] > stop[:-1]]) if len(begin) else begin
    return begin[fresh], stop[np.r_[fresh[1:] - 1, len(stop) - 1]] if len(stop) else stop


def without_repeats(docs: DataFrame, length: int = LENGTH, sorted_at_once: int = SORTED) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)``, one row for each row of ``docs``.

    ``kept`` is what is left of the text's UTF-8 bytes after every byte is removed that a string of ``length`` bytes covers
    which also starts anywhere else, in the same text or another. A null text is taken as empty, and texts shorter than
    ``length`` lose nothing. Repeated rows, also of one id, remove each other. Null ids do not matter, other
    columns are not read, and an empty table gives no rows.
    """
    keyed = _keyed(docs)
    ranges = spans(keyed, length, sorted_at_once)
    listed = ranges.groupBy(*_KEYS).agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts, lists = bytes_of(batch.column("text")), batch.column("spans").to_pylist()
            kept, removed, counts = [], [], []
            for text, found in zip(texts, lists, strict=True):
                pairs = np.array([(s["begin"], s["stop"]) for s in found or ()], np.int64).reshape(-1, 2)
                begin, stop = merged(pairs[:, 0], pairs[:, 1])
                edges = [0, *np.stack([begin, stop], axis=1).ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(int((stop - begin).sum()))
                counts.append(len(begin))
            columns = [batch.column("doc_id"), pa.array(kept, pa.binary()), *map(pa.array, ([len(t) for t in texts], removed, counts))]
            yield pa.record_batch(columns, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    return keyed.join(listed, list(_KEYS), "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of each document."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
