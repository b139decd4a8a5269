"""Near-duplicate documents by 64-bit SimHash, compared in vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, settled, small_batches
from playstream.llm.graph import components

BITS = 64
RADIUS = 2
SHINGLE = 3
HASH_SEED = 42
#: Fingerprints of one bucket that are compared in one place; larger buckets are dealt out as pairs of tiles.
TILE = 512
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes | None, words_in_shingle: int) -> list[int]:
    """XXH64 of each shingle in text order; a text of fewer words is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_in_shingle:
        return [digest(joined, HASH_SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - words_in_shingle + 1].tolist()
    stops = ends[words_in_shingle - 1 :].tolist()
    return [digest(joined[i:j], HASH_SEED) for i, j in zip(starts, stops, strict=True)]


def fingerprint(text: bytes | None, words_in_shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64; 0 without a word."""
    hashes = shingle_hashes(text, words_in_shingle)
    if not hashes:
        return 0
    octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for each row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [fingerprint(t) for t in bytes_of(batch.column("text"))]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("text_hash"), values]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "fp"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return wanted.mapInArrow(run, "doc_id long, text_hash long, fp long")


def close_pairs(
    values: np.ndarray, first: np.ndarray, radius: int = RADIUS
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``(i, j)``, ``first[i] <= j < i``, whose values differ in at most ``radius`` (up to 3) bits.

    The values lie in 64 bit planes of one lane per row. Each row is compared with one word (64 lanes) at a time, one
    plane after the other; a carry-save counter of two bits and an overflow mark per lane holds the distances.
    A word in which every lane is beyond the radius is abandoned.
    """
    n = len(values)
    words = -(-n // 64)
    bits = np.unpackbits(values.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    lanes = np.zeros((BITS, words * 64), np.uint8)
    lanes[:, :n] = bits.T
    planes = np.packbits(lanes, axis=1, bitorder="little").view(np.uint64).reshape(BITS, words)
    masks = (np.uint64(0) - bits.astype(np.uint64)).T.copy()
    row = np.arange(n)
    begin, span = first >> 6, (row >> 6) - (first >> 6)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    for step in range(int(span.max(initial=-1)) + 1):
        rows = np.flatnonzero(span >= step)
        word = begin[rows] + step
        one, two, over = (np.zeros(len(rows), np.uint64) for _ in range(3))
        for plane in range(BITS):
            differs = planes[plane][word] ^ masks[plane][rows]
            carry = one & differs
            one ^= differs
            over |= two & carry
            two ^= carry
            if plane % 8 == 7:
                beyond = over | _beyond(one, two, radius)
                alive = beyond != _FULL
                if not alive.all():
                    rows, word, one, two, over = (x[alive] for x in (rows, word, one, two, over))
                    if not len(rows):
                        break
        if not len(rows):
            continue
        near = ~(over | _beyond(one, two, radius))
        hit, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        i, j = rows[hit], word[hit] * 64 + lane
        wanted = (j < i) & (j >= first[i])
        left.append(i[wanted])
        right.append(j[wanted])
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *left]), np.concatenate([nothing, *right])


def _beyond(one: np.ndarray, two: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose two-bit count is over ``radius``."""
    return (one | two, two, one & two, np.zeros_like(one))[radius]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row linked to each of ``n`` rows, directly or not."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        moved = label.copy()
        np.minimum.at(moved, left, low)
        np.minimum.at(moved, right, low)
        np.minimum.at(moved, label[left], low)
        np.minimum.at(moved, label[right], low)
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def _links(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links between the fingerprints of each bucket; rows come sorted by bucket, and a bucket may span batches."""
    held = None

    def whole(bucket: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(values):
            return
        starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]).any(axis=1)])
        first = np.repeat(starts, np.diff(np.r_[starts, len(values)]))
        root = forest(len(values), *close_pairs(values.view(np.uint64), first, radius))
        linked = np.flatnonzero(root != np.arange(len(root)))
        if len(linked):
            yield pa.record_batch([pa.array(values[linked]), pa.array(values[root[linked]])], names=["a", "b"])

    for batch in batches:
        bucket = np.stack([batch.column(c).to_numpy() for c in ("bucket", "low", "high")], axis=1)
        values = batch.column("fp").to_numpy()
        if held:
            bucket, values = np.concatenate([held[0], bucket]), np.concatenate([held[1], values])
        if not len(values):
            continue
        last = len(values) - int(np.argmax(np.r_[(bucket[::-1] != bucket[-1]).any(axis=1), True]))
        yield from whole(bucket[:last], values[:last])
        held = bucket[last:], values[last:]
    if held:
        yield from whole(*held)


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that join all distinct values of ``fps.fp`` within ``radius`` bits, directly or through others.

    The bits are cut into ``radius + 2`` blocks: two values within the radius agree in two blocks at least, so each
    pair of blocks gives a table of buckets. Buckets are counted first; one of ``n`` values is dealt as pairs of
    ``n / tile`` tiles, so that no task holds more than two tiles of it.
    """
    blocks = radius + 2
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    part = [
        F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)) for k in range(blocks)
    ]
    buckets = F.array(
        *[F.xxhash64(F.lit(k), part[x], part[y]) for k, (x, y) in enumerate(combinations(range(blocks), 2))]
    )
    keyed = fps.select("fp").distinct().select("fp", F.explode(buckets).alias("bucket"))
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile)
    dealt = (
        keyed.join(crowded, "bucket")
        .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), tiles))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    )
    grouped = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "fp")
    return grouped.mapInArrow(lambda batches: _links(batches, radius), "a long, b long").distinct()


def _grouped(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` for each row; ``root`` is a fingerprint of the group."""
    fps = settled(fingerprints(docs), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = settled(components(links(fps)), "components")
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return fps.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    Null and empty texts have no word and the fingerprint zero, which links like any other. Equal rows share a
    fingerprint and so a component. A row without ``doc_id`` links too but names no component; its
    component_id is null if no linked row has an id. Other columns are not read. An empty table gives no rows.
    """
    return _grouped(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The row of each group that has the group's smallest id, all columns kept.

    Rows repeated under one id stay once; where an id has several texts in one group, the one with the least hash
    stays. Rows without an id cannot be named as copies and stay.
    """
    firsts = _grouped(docs).where("doc_id = component_id").groupBy("root")
    kept = firsts.agg(F.min(F.struct("doc_id", "text_hash")).alias("_first")).select("_first").distinct()
    named = docs.where("doc_id is not null").withColumn(
        "_first", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    )
    one = named.join(kept, "_first", "left_semi").dropDuplicates(["_first"]).drop("_first")
    return one.unionByName(docs.where("doc_id is null"))
