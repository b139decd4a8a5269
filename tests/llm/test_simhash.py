import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.llm import simhash
from playstream.llm.graph import components
from tests.llm.helpers import documents, odd_documents, rows, supplied, with_clashes


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable, by id; ids may be null or repeat."""
    label = list(range(len(prints)))
    for _ in prints:
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if bin(a ^ b).count("1") <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for (doc, _), k in zip(prints, label, strict=True):
        if doc is not None:
            least[k] = min(least.get(k, doc), doc)
    return [(d, f"{p:016x}", least.get(k)) for (d, p), k in zip(prints, label, strict=True)]


def check(docs):
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    want = sorted(plain_components(prints), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(simhash.near_duplicates(docs)) == want


def near_copies(n=40):
    words = [f"w{i}" for i in range(400)]
    return [" ".join(words[: 200 + k] + words[k : 150 + k]) for k in range(n // 2)] * 2


def test_against_all_pairs(spark):
    check(documents(spark, [*near_copies(), "other words here", "x", "", None, "OTHER words HERE"]))


def test_supplied_documents(spark):
    check(supplied(spark).limit(150))


def test_odd_rows(spark):
    check(odd_documents(spark))
    clashing = with_clashes(odd_documents(spark), "fingerprint", "component_id", "fp", "bucket", "root")
    assert rows(simhash.near_duplicates(clashing)) == rows(simhash.near_duplicates(odd_documents(spark)))


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, ["a"]).limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=90), st.integers(0, 3), st.integers(1, 70))
def test_bit_planes_find_all_pairs(values, radius, bucket):
    values += [v ^ 5 for v in values[:30]] + [v ^ (1 << 63) for v in values[:9]]
    first = np.arange(len(values)) // bucket * bucket
    i, j = simhash.close_pairs(np.array(values, np.uint64), first, radius)
    want = {
        (a, b)
        for a in range(len(values))
        for b in range(first[a], a)
        if bin(values[a] ^ values[b]).count("1") <= radius
    }
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)


def test_large_buckets_are_dealt_in_tiles(spark):
    base = 0x0123456789ABCDEF
    values = [(base ^ (1 << a) ^ (1 << b)) - (1 << 63) for a in range(12) for b in range(a)]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    for tile in (8, 512):
        found = components(simhash.links(fps, tile=tile)).collect()
        assert {r.root for r in found} == {min(values)} and len(found) == len(set(values))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_one_of_each_group_stays(spark):
    docs = documents(spark, ["same text of words", "same text of words", "another one", None], start=7)
    again = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 9").selectExpr("CAST(NULL AS LONG) AS doc_id", *docs.columns[1:]))
    kept = simhash.first_of_each_group(again)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows(kept)] == [10, 7, 9, None]
