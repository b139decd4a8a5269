import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.checks.compare import supplied_views
from playstream.llm import url_filter
from tests.conftest import SMALL
from tests.llm.helpers import rows, supplied, with_clashes

ODD = [
    (1, None),
    (2, ""),
    (3, "example.net/en/"),
    (4, "http://NET"),
    (5, "http://net/"),
    (6, "http://a.example.org/x.net/y"),
    (7, "https://X.example.net/en/a?b#c"),
    (8, "a://b://c/d"),
    (9, "http://casino-x.de/\nline"),
    (10, "http://ü.ORG/fr/é"),
    (11, "http://notnet/"),
    (12, "http://example.net/EN/"),
    (13, "http://example.net:80/en/"),
    (14, "http://www.example.com?x=/de/"),
    (None, "http://w.example.com/de/1#y"),
    (None, "http://w.example.com/de/1#y"),
    (15, "http://" + "a." * 3000 + "net/" + "p/" * 3000),
]


def matches(glob, text):
    parts = [{"**": ".*", "*": "[^/]*"}.get(x) or re.escape(x) for x in re.findall(r"\*\*|\*|[^*]+", glob)]
    return re.fullmatch("".join(parts), text, re.S) is not None


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.lists(st.sampled_from(["a", "b", "/", "*", "**", "."]), max_size=9).map("".join), min_size=1, max_size=30
    ),
    st.lists(st.text(st.sampled_from("ab/."), max_size=12), max_size=8),
)
def test_automaton_equals_regular_expressions(globs, texts):
    found = url_filter.Automaton(globs).matches([t.encode() for t in texts])
    assert found.tolist() == [[matches(re.sub(r"\*{3,}", "**", g), t) for g in globs] for t in texts]


@pytest.mark.parametrize("odd", [False, True])
def test_against_sql(spark, odd):
    con = supplied_views(SMALL)
    pages = supplied(spark, "pages")
    if odd:
        pages = spark.createDataFrame(ODD, "page_id long, url string")
        con.execute("CREATE OR REPLACE TEMP TABLE pages (page_id BIGINT, url VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?)", ODD)
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.judge_sql()})").fetchall()
    key = lambda r: str(r)
    assert sorted(rows(url_filter.judge(pages)), key=key) == sorted(want, key=key)


def test_verdicts(spark):
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(ODD, "page_id long, url string")).collect()}
    assert got[5] == ("net/", "block") and got[4] == (None, "allow") and got[6] == (None, "allow")
    assert got[7] == ("example.net/en/", "allow") and got[12] == ("net/", "block") and got[13] == (None, "allow")
    assert got[9] == (None, "block") and got[10] == ("org/fr/", "allow") and got[None] == ("example.com/de/", "block")
    assert got[15] == ("net/", "block") and got[11] == (None, "allow") and got[1] == (None, "allow")


def test_clashing_columns_and_empty_table(spark):
    pages = supplied(spark, "pages")
    assert rows(url_filter.judge(with_clashes(pages, "host", "path", "rule"))) == rows(url_filter.judge(pages))
    assert url_filter.judge(pages.limit(0)).collect() == []
