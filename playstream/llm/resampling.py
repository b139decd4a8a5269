"""Importance resampling towards a target: hashed n-gram counts of a corpus against those of target texts."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, settled, small_batches
from playstream.llm.offsets import before_parts

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1000
#: Bins in a step of the search for the least drawn score.
_BINS = 4096
#: Bytes of text that are handled together, and word lengths with a table of their own.
_AT_ONCE, _SHORT = 4 << 20, 64
_SENTINEL = b"\x00"
_words = re.compile(rb"[0-9a-z\x80-\xff]+|\x00").findall


def _letters() -> bytes:
    """What each byte becomes: A-Z in lower case, bytes that belong to no word a space."""
    kept = bytearray(b" " * 256)
    for byte in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        kept[byte] = byte
    kept[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(kept)


_LETTERS = _letters()


@lru_cache(maxsize=None)
def _behind(log_length: int) -> np.ndarray:
    """Tables (4, 256) that turn the crc32 of a string into that of the string with ``2 ** log_length`` bytes behind
    it, but for the crc32 of these bytes, which is xor-ed to it."""
    if log_length:
        half = _behind(log_length - 1)
        return _apply(half, half.ravel()).reshape(4, 256)
    return np.array(
        [[crc32(b"\0", b << 8 * j) ^ crc32(b"\0") for b in range(256)] for j in range(4)], np.uint32
    )


def _apply(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    octets = (sums[:, None] >> np.arange(0, 32, 8, dtype=np.uint32)) & np.uint32(255)
    return table[0][octets[:, 0]] ^ table[1][octets[:, 1]] ^ table[2][octets[:, 2]] ^ table[3][octets[:, 3]]


@lru_cache(maxsize=1)
def _short_tables() -> np.ndarray:
    """The tables of all lengths below ``_SHORT``, as (4, length * 256 + byte)."""
    one = _behind(0)
    tables = [np.array([[b << 8 * j for b in range(256)] for j in range(4)], np.uint32)]
    for _ in range(_SHORT - 1):
        tables.append(_apply(one, tables[-1].ravel()).reshape(4, 256))
    return np.stack(tables, axis=1).reshape(4, -1)


def moved(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the crc32 of a string adds to that of the string followed by ``lengths`` bytes."""
    tables = _short_tables()
    short = lengths < _SHORT
    at = np.where(short, lengths, 0) << 8
    found = tables[0][at + (sums & 255)]
    for j in range(1, 4):
        found ^= tables[j][at + ((sums >> np.uint32(8 * j)) & 255)]
    rest = np.flatnonzero(~short)
    if len(rest):
        far, size = sums[rest], lengths[rest]
        for k in range(int(size.max()).bit_length()):
            chosen = (size >> k) & 1 == 1
            far[chosen] = _apply(_behind(k), far[chosen])
        found[rest] = far
    return found


class Features:
    """The n-gram buckets of some texts: ``bucket``, and the text each belongs to (``owner``); words per text."""

    def __init__(self, segments: list[bytes], carried: list[int]) -> None:
        """``segments`` are cleaned texts, or parts of one; the first ``carried`` words of each are counted elsewhere.

        All segments are joined with sentinels and split by one pass. The places of the sentinels tell which segment
        a word is in, and mask runs of words that would cross from one to the next.
        """
        found = _words(_SENTINEL.join([*segments, b""]))
        coded = pa.array(found, pa.large_binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sentinel = words.index(_SENTINEL)
        borders = np.flatnonzero(code == sentinel)
        place = np.flatnonzero(code != sentinel)
        owner = np.searchsorted(borders, place)
        code = code[place]
        new = place - np.concatenate([[0], borders[:-1] + 1])[owner] >= np.array(carried, np.int64)[owner]
        alone = np.array([crc32(w) for w in words], np.uint32)
        after = np.array([crc32(b" " + w) for w in words], np.uint32)
        length = np.array([len(w) + 1 for w in words], np.int64)
        sums = alone[code]
        buckets, owners = [sums[new]], [owner[new]]
        for n in range(1, LONGEST):
            sums = moved(sums[:-1], length[code[n:]]) ^ after[code[n:]]
            inside = (owner[n:] == owner[: len(owner) - n]) & new[n:]
            buckets.append(sums[inside])
            owners.append(owner[n:][inside])
        self.bucket = (np.concatenate(buckets) % np.uint32(BUCKETS)).astype(np.int64)
        self.owner = np.concatenate(owners)
        self.words = np.bincount(owner[new], minlength=len(segments))


def _segments(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Cleaned texts, or parts of long ones, in groups of about ``_AT_ONCE`` bytes: rows, parts, words carried over.

    A part begins with the last words of the part before it, so that no run of words is lost at a cut.
    """
    rows: list[int] = []
    parts: list[bytes] = []
    carried: list[int] = []
    held = 0
    for row, text in enumerate(texts):
        rest, over = (text or b"").translate(_LETTERS), []
        while True:
            cut = -1 if len(rest) <= _AT_ONCE else rest.find(b" ", _AT_ONCE)
            part, rest = (rest, None) if cut < 0 else (rest[:cut], rest[cut:])
            rows.append(row)
            parts.append(b" ".join([*over, part]))
            carried.append(len(over))
            held += len(part)
            if held >= _AT_ONCE:
                yield rows, parts, carried
                rows, parts, carried, held = [], [], [], 0
            if rest is None:
                break
            over = (over + part.rsplit(None, LONGEST - 1)[-(LONGEST - 1) :])[-(LONGEST - 1) :]
    if rows:
        yield rows, parts, carried


def bucket_counts(texts: DataFrame) -> DataFrame:
    """``(bucket, n)``: how many features of all rows of ``texts.text`` fall into each bucket that holds one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in small_batches(batches, "text", _AT_ONCE):
            for _, parts, carried in _segments(bytes_of(batch.column("text"))):
                counts += np.bincount(Features(parts, carried).bucket, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    each = texts.select("text").mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log ratio of target to raw frequency of each bucket, one added to all counts, in thousandths."""
    of_raw, of_target = float(raw.sum()) + len(raw), float(target.sum()) + len(raw)
    ratios = [(float(t) + 1) * of_raw / ((float(s) + 1) * of_target) for s, t in zip(raw, target, strict=True)]
    return np.array([math.floor(SCALE * math.log(x)) for x in ratios], np.int64)


def _collected(texts: DataFrame) -> np.ndarray:
    """All counts; at most one row per bucket reaches the driver."""
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in bucket_counts(texts).collect():
        counts[bucket] = n
    return counts


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row: the sum of ``gain`` over the text's features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _AT_ONCE):
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, parts, carried in _segments(bytes_of(batch.column("text"))):
                found = Features(parts, carried)
                n = len(parts)
                np.add.at(words, rows, found.words)
                np.add.at(features, rows, np.bincount(found.owner, minlength=n))
                # whole numbers below 2 ** 53, so the sums in doubles are exact
                sums = np.bincount(found.owner, weights=gain[found.bucket].astype(np.float64), minlength=n)
                np.add.at(weight, rows, sums.astype(np.int64))
            columns = [batch.column("doc_id"), *map(pa.array, (words, features, weight))]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_features", "weight"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def perturbed(weight: Column, doc_id: Column, seed: int = SEED) -> Column:
    """``weight`` with Gumbel noise by the hash of the id, so that the highest scores are a weighted draw."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def least_drawn(scores: DataFrame, k: int) -> int:
    """The ``k``-th highest ``score``, by counts over ever narrower bins; no step brings over ``_BINS`` rows here."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low < high:
        width = (high - low) // _BINS + 1
        inside = scores.where(F.col("score").between(low, high))
        # the difference of two longs may not fit a long
        bins = F.expr(f"cast((cast(score as decimal(20, 0)) - {low}) div {width} as long)")
        counted = sorted(inside.groupBy(bins.alias("bin")).count().collect(), reverse=True)
        for bin_, n in counted:
            if n >= k:
                low, high = low + bin_ * width, min(high, low + (bin_ + 1) * width - 1)
                break
            k -= n
    return low


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, one row for each row of ``docs``.

    ``rank`` numbers the drawn documents from the highest score on, the smaller id first among equals, a missing
    id last; it is null for all others. Null and empty texts have no features, weight 0 and are never drawn. A row without an
    id gets the noise of an empty id. Repeated rows are scored alike and ranked one after the other. Long texts are
    counted in parts, none of their features lost. Other columns are not read. An empty table gives no rows, and an empty
    target leaves the counts of the corpus alone to decide.
    """
    gain = gains(_collected(docs), _collected(target))
    scored = settled(
        weights(docs, gain).withColumn("score", perturbed(F.col("weight"), F.col("doc_id"), seed)), "resampling-scores"
    )
    able = F.col("n_words") >= min_words
    n = scored.where(able).count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*columns, unranked)
    drawn = able & (F.col("score") >= F.lit(least_drawn(scored.where(able).select("score"), k)))
    # rows that are equal in score and id are told apart, so that the sort can spread them
    spot = F.monotonically_increasing_id()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("spot")]
    at = F.monotonically_increasing_id()
    in_order = scored.where(drawn).select(*columns, spot.alias("spot")).orderBy(*order)
    part, row = F.shiftright(at, 33).cast("long"), at.bitwiseAND(F.lit((1 << 33) - 1))
    spread = in_order.select(*columns, part.alias("part"), row.alias("at"))
    spread = settled(spread.withColumn("one", F.lit(1).cast("long")), "resampling-order")
    rank = F.col("before") + F.col("at") + 1
    ranked = spread.join(before_parts(spread, "one"), "part").select(*columns, F.when(rank <= k, rank).alias("rank"))
    return ranked.unionByName(scored.where(~drawn).select(*columns, unranked))
