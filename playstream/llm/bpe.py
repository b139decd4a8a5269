"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the short rest of a batch side by side, the long one by a heap
over linked bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import batched, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of, small_batches

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Bytes of pre-tokens, and of space-led stretches, that a worker keeps with their ids; beyond it they are worked out
#: again. An entry counts as its characters and ids and what Python adds to them.
KEPT, _ENTRY = 48 << 20, 200
#: Pre-tokens of up to so many bytes are merged side by side, if there are so many of them: a round of this takes as long
#: as some merges by the heap, and there are as many rounds as the longest has merges. Memory follows how many go at once.
SHORT, MANY, AT_ONCE = 64, 32, 1 << 14


class PerfectHash:
    """Slot of each key, without gaps: ``n`` keys fill ``n`` slots.

    Keys are dealt to small buckets. From the largest bucket on, a displacement is searched that sends all of its
    keys to free slots; a bucket of one key is given a free slot itself (kept as ``-1 - slot``).
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4) -> None:
        self.n = len(keys)
        self.buckets = max(1, self.n // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_at: list[bytes | None] = [None] * self.n
        self.value_at = np.full(self.n, -1, np.int64)
        bucket, base = self._parts(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        taken = np.zeros(self.n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[ends[b] - sizes[b] : ends[b]]
            if len(members) < 2:
                break
            self.shift[b], slots = self._search(base[members], taken)
            taken[slots] = True
            self._fill(slots, members, keys)
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.shift[b] = -1 - slot
            self._fill([slot], order[ends[b] - 1 : ends[b]], keys)

    def _fill(self, slots: Iterable[int], members: Iterable[int], keys: list[bytes]) -> None:
        for slot, member in zip(slots, members, strict=True):
            self.key_at[slot], self.value_at[slot] = keys[member], member

    def _parts(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each key, and the number that a displacement turns into a slot."""
        raw = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k) for k in keys), ">u8").reshape(-1, 2)
        return (raw[:, 0].astype(np.uint64) % np.uint64(self.buckets)).astype(np.int64), raw[:, 1].astype(np.uint64)

    def _slots(self, base: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Each displacement sends a key to a slot that is independent of the others'."""
        mixed = base + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(max(1, self.n))).astype(np.int64)

    def _search(self, base: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        start, block = 0, 64
        while True:
            slots = self._slots(base, np.arange(start, start + block)[:, None])
            ordered = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                return start + at, slots[at]
            start, block = start + block, min(4096, 2 * block)

    def find(self, keys: list[bytes]) -> list[int]:
        """Index of each key among those given at first, or -1."""
        if not keys or not self.n:
            return [-1] * len(keys)
        bucket, base = self._parts(keys)
        shift = self.shift[bucket]
        slots = np.where(shift < 0, -1 - shift, self._slots(base, np.maximum(shift, 0))).tolist()
        return [int(self.value_at[s]) if self.key_at[s] == k else -1 for s, k in zip(slots, keys, strict=True)]


class Kept:
    """Packed ids by text, and about how many bytes all this takes. ``ids`` is a plain dict: sets are compared with no
    other mapping without going through all of it."""

    def __init__(self) -> None:
        self.ids: dict[str, bytes] = {}
        self.size = 0

    def add(self, found: dict[str, bytes]) -> None:
        self.ids.update(found)
        self.size += sum(map(len, found)) + sum(map(len, found.values())) + _ENTRY * len(found)

    def forget(self) -> None:
        self.ids.clear()
        self.size = 0


class Codec:
    """Ids of texts and bytes of ids under one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token_of = dict(zip(self.ranks.values(), self.ranks, strict=True))
        self.tokens = list(self.ranks)
        self.packed = [np.array([rank], "<u4").tobytes() for rank in self.ranks.values()]
        self.whole = PerfectHash(self.tokens)
        self.split = regex.compile(pattern).findall
        # Under the public pattern a match ends before each space, unless white space lies on both sides of it.
        self.at_spaces = pattern == public_tokenizers.PATTERN
        self.crossing = regex.compile(r"\s \s|\s \Z").search
        self.kept = Kept()
        self.stretches = Kept()
        self.none = max(self.ranks.values(), default=0) + 1
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)])
        # Without every byte, or with a rank that comes twice, a pair of ids does not stand for its bytes.
        self.paired = bool((self.of_byte >= 0).all()) and len(self.token_of) == len(self.ranks)
        self.pairs, self.pair_ranks = self._pairs()

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Each two ids whose bytes make up a token, as one number, ascending; and the ranks of these tokens."""
        get, found = self.ranks.get, [(np.iinfo(np.int64).max, self.none)]
        for token, rank in self.ranks.items() if self.paired else ():
            for cut in range(1, len(token)):
                left = get(token[:cut])
                if left is not None and (right := get(token[cut:])) is not None:
                    found.append((left * self.none + right, rank))
        keys, ranks = np.array(sorted(found), np.int64).T
        return np.ascontiguousarray(keys), np.ascontiguousarray(ranks)

    def _wanted(self, ids: np.ndarray, owner: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Rank of the merge of the parts at ``where`` with the next of the same piece."""
        ranks = np.full(len(where), self.none)
        inner = np.flatnonzero(owner[where] == owner[np.minimum(where + 1, len(owner) - 1)])
        inner = inner[where[inner] + 1 < len(owner)]
        keys = ids[where[inner]] * self.none + ids[where[inner] + 1]
        at = np.searchsorted(self.pairs, keys)
        ranks[inner] = np.where(self.pairs[at] == keys, self.pair_ranks[at], self.none)
        return ranks

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each of some pre-tokens, none of them empty, as ``merge`` finds them. In each round every
        piece merges its pair of lowest rank, the leftmost of equals, and those without one are done."""
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        wanted = self._wanted(ids, owner, np.arange(len(ids)))
        done = []
        while len(ids):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(wanted, first)
            lowest = np.repeat(lowest, np.diff(first, append=len(ids)))
            going = lowest != self.none
            if not going.all():
                done.append((ids[~going], owner[~going]))
                ids, owner, wanted, lowest = ids[going], owner[going], wanted[going], lowest[going]
            at = np.flatnonzero(wanted == lowest)
            at = at[np.diff(owner[at], prepend=-1) != 0]
            ids[at] = wanted[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, owner, wanted = ids[stay], owner[stay], wanted[stay]
            at -= np.arange(len(at))  # one part has gone from each piece before
            changed = np.concatenate([at, at[at > 0] - 1])
            wanted[changed] = self._wanted(ids, owner, changed)
        ids, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        packed = ids[order].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(owner, minlength=len(pieces)))
        return [packed[a:b] for a, b in pairwise([0, *ends.tolist()])]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token: neighbours of lowest rank are merged first, the leftmost of equals."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i stops
        before = list(range(-1, n - 1))
        wanted = [-1] * n  # rank of the merge of part i with the next
        heap = []
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2], -1)
            if rank >= 0:
                wanted[i] = rank
                heap.append((rank, i))
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            if wanted[i] != rank:
                continue
            middle = end[i]
            stop = end[i] = end[middle]
            wanted[middle] = -1
            if stop < n:
                before[stop] = i
            for left in (before[i], i):
                if left < 0:
                    continue
                right = end[left]
                got = ranks.get(piece[left : end[right]], -1) if right < n else -1
                wanted[left] = got
                if got >= 0:
                    heappush(heap, (got, left))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Keep the ids of ``pieces``, packed as little-endian 32-bit integers."""
        texts = list(pieces)
        keys = [t.encode() for t in texts]
        found, rest = {}, []
        for text, key, at in zip(texts, keys, self.whole.find(keys), strict=True):
            if at >= 0:
                found[text] = self.packed[at]
            elif self.paired and len(key) <= SHORT:
                rest.append((text, key))
            else:
                found[text] = np.array(self.merge(key), "<u4").tobytes()
        for some in batched(rest, AT_ONCE):
            if len(some) < MANY:
                found.update((text, np.array(self.merge(key), "<u4").tobytes()) for text, key in some)
            else:
                found.update(zip([text for text, _ in some], self.merge_all([key for _, key in some]), strict=True))
        self.kept.add(found)

    def _packed(self, pieces: list[str]) -> bytes:
        unseen = set(pieces).difference(self.kept.ids)
        if unseen:
            self.learn(unseen)
        return b"".join(map(self.kept.ids.__getitem__, pieces))

    def _learn_stretches(self, stretches: set[str]) -> None:
        """Keep the ids of each stretch with the space before it."""
        # ASCII letters are one match after a space; of others, Python and the pattern may know different ones.
        split = {s: [" " + s] if s.isascii() and s.isalpha() else self.split(" " + s) for s in stretches}
        unseen = {p for pieces in split.values() for p in pieces}.difference(self.kept.ids)
        if unseen:
            self.learn(unseen)
        of = self.kept.ids.__getitem__
        self.stretches.add({s: b"".join(map(of, pieces)) for s, pieces in split.items()})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; none for a null."""
        for kept in (self.kept, self.stretches):
            if kept.size > KEPT:
                kept.forget()
        packed: list[bytes] = []
        parted: dict[int, list[str]] = {}
        unseen: set[str] = set()
        for at, text in enumerate(texts):
            if not text:
                packed.append(b"")
            elif self.at_spaces and not self.crossing(text):
                first, *parted[at] = text.split(" ")
                packed.append(self._packed(self.split(first)))
                unseen.update(parted[at])
            else:
                packed.append(self._packed(self.split(text)))
        unseen.difference_update([s for s in unseen if s in self.stretches.ids])
        self._learn_stretches(unseen)
        of = self.stretches.ids.__getitem__
        for at, stretches in parted.items():
            packed[at] += b"".join(map(of, stretches))
        return packed

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.token_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(path: str | None, pattern: str | None) -> Codec:
    """One per worker process."""
    return Codec(path or public_tokenizers.path(RANK_FILE), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids)``, one row for each row of ``docs``: the whole text's ids as packed little-endian 32-bit integers.

    Null and empty texts give no ids. Repeated rows, null ids and other columns do not matter; an empty table gives
    no rows. ``path`` is a rank file each executor can open, by default the installed one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in small_batches(batches, "text"):
            packed = codec.encode(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the packed ``ids``; null ids give no bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in small_batches(batches, "ids"):
            found = [codec.decode(ids or b"") for ids in bytes_of(batch.column("ids"))]
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(found, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def encode_and_decode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """What ``decode(encode(docs))`` gives, in one pass, so that a task needs one worker with one vocabulary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in small_batches(batches, "text"):
            packed = codec.encode(batch.column("text").to_pylist())
            decoded = [codec.decode(ids) for ids in packed]
            columns = [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "ids", "decoded"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of each document's encoding and of what it decodes to."""
    return encode_and_decode(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenized(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256)`` with the ids as an array, for training."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(None, None)
        for batch in small_batches(batches, "text"):
            packed = codec.encode(batch.column("text").to_pylist())
            offsets = np.cumsum([0] + [len(x) // 4 for x in packed])
            values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            digests = pa.array([sha256(x).hexdigest() for x in packed], pa.string())
            yield pa.record_batch([batch.column("doc_id"), lists, digests], names=["doc_id", "ids", "ids_sha256"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    arrays = wanted.mapInArrow(run, "doc_id long, ids array<int>, ids_sha256 string")
    return arrays.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_sha256")
