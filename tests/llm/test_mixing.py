import pytest

from playstream.checks.compare import supplied_views
from playstream.llm import mixing
from tests.conftest import SMALL
from tests.llm.helpers import DOCUMENTS, documents, odd_documents, rows, supplied, with_clashes


def water(budget, children):
    """Whole tokens for (name, weight, capacity): filled children leave what they cannot use to the others."""
    out, left = {}, budget
    active = sorted((c for c in children if c[1] > 0), key=lambda c: (c[2] / c[1], c[0]))
    total = sum(w for _, w, _ in active)
    while active and active[0][2] * total <= left * active[0][1]:
        name, w, capacity = active.pop(0)
        out[name], left, total = capacity, left - capacity, total - w
    out |= {name: min(w * left // total, c) for name, w, c in active}
    return {name: out.get(name, 0) for name, _, _ in children}


def plain_budgets(leaves, weights, percent, epochs):
    budget, out = sum(leaves.values()) * percent // 100, {}
    capacity = lambda path: epochs * sum(t for p, t in leaves.items() if p[: len(path)] == path)

    def down(path, given):
        if len(path) == 3:
            out[path] = given
            return
        below = sorted({p[: len(path) + 1] for p in leaves if p[: len(path)] == path})
        parts = water(given, [("/".join(p), weights.get("/".join(p), 1), capacity(p)) for p in below])
        for p in below:
            down(p, parts["/".join(p)])

    down((), budget)
    return out


LEAVES = {
    ("d0", "en", "a"): 1000,
    ("d0", "en", "b"): 10,
    ("d0", "fr", "a"): 70,
    ("d1", "en", "c"): 5000,
    ("d1", "de", "c"): 1,
    ("d2", "en", "x"): 0,
    ("other", "en", "y"): 40,
}


@pytest.mark.parametrize("percent", [0, 3, 60, 100, 180, 250])
@pytest.mark.parametrize("weights", [{}, {"d0": 5, "d0/fr": 9, "d1": 0}, {"other": 100, "d0/en/b": 50}])
def test_budgets(spark, percent, weights):
    leaves = spark.createDataFrame([(*p, t) for p, t in LEAVES.items()], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, weights, percent, 2).collect()}
    assert got == plain_budgets(LEAVES, weights, percent, 2)


def test_supplied_documents_against_sql(spark):
    want = supplied_views(SMALL).execute(f"SELECT doc_id, domain, lang, source, tokens, copies FROM ({mixing.report_sql()})").fetchall()
    got = rows(mixing.report(supplied(spark)))
    assert sorted(got) == sorted(want) and {r[-1] for r in got} == {0, 1, 2}


def many(spark, n=3000):
    rows_ = [(i, "x" * (4 * (i % 7) + 4), "en", "src1" if i % 3 else "src2", None) for i in range(n)]
    return spark.createDataFrame(rows_, DOCUMENTS)


def test_a_leaf_takes_a_prefix_of_its_epoch(spark):
    docs = many(spark)
    found = mixing.mixed(docs, {}, 75, 1, "s").collect()
    total = sum(r._tokens for r in found)
    taken = sum(r._tokens * r._copies for r in found)
    assert total * 0.75 - 2 * 7 - 2 <= taken <= total * 0.75
    for leaf in {r._leaf for r in found}:
        order = spark.createDataFrame([(r.doc_id, r._copies) for r in found if r._leaf == leaf], "doc_id long, c long")
        place = mixing.place_in_epoch(order.doc_id, mixing.F.lit(0), "s")
        copies = [r.c for r in order.orderBy(place).collect()]
        assert copies == sorted(copies, reverse=True)
    other = {r.doc_id for r in mixing.mixed(docs, {}, 75, 1, "t").collect() if r._copies}
    assert other != {r.doc_id for r in found if r._copies}


def test_rows_are_repeated_by_epoch(spark):
    docs = many(spark, 100)
    got = mixing.mixture(docs)
    assert got.columns == docs.columns
    assert got.count() == sum(r._copies for r in mixing.mixed(docs).collect())
    everything = mixing.mixed(docs, {}, 300, 2)
    assert {r._copies for r in everything.collect()} == {2}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = rows(mixing.report(docs))
    assert len(got) == docs.count() and got.count(got[-1]) == 2
    assert rows(mixing.report(with_clashes(docs, "domain", "tokens", "copies", "_leaf", "_tokens"))) == got
    assert mixing.report(documents(spark, ["a"]).limit(0)).collect() == []


def test_no_python(spark):
    plan = mixing.report(supplied(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_rows_that_share_a_place(spark):
    """All rows without an id have one place in an epoch: equal ones are taken together or not at all, short ones first."""
    sizes = [None, "x" * 4, "x" * 8, "x" * 12]
    docs = spark.createDataFrame([(None, sizes[i % 4], "en", "src1", None) for i in range(2000)], DOCUMENTS)
    for percent, kept in ((10, {0}), (20, {0, 1}), (60, {0, 1, 2}), (100, {0, 1, 2, 3})):
        found = mixing.mixed(docs, {}, percent, 1, "s").groupBy("_tokens", "_copies").count().collect()
        assert {r._tokens for r in found if r._copies == 1} >= kept - {0} and len(found) == 4
        assert {r["count"] for r in found} == {500}
        assert sum(r._tokens * r._copies * 500 for r in found) <= 3000 * percent // 100
