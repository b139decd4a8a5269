"""Small inputs with what operators have to bear: nulls, empty and long texts, repeated rows, clashing columns."""

import random

from playstream.llm.common import table
from tests.conftest import SMALL

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, texts, start=1):
    rows = [(i, t, "en", f"src{i % 5}", None if t is None else len(t)) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, DOCUMENTS)


def supplied(spark, name="documents", folder=SMALL):
    return table(spark, folder, name)


def odd_documents(spark):
    """Null and empty texts, null ids, rows twice, a long text, null language and source."""
    long_text = " ".join(random.Random(4).choice(["alpha", "beta", "gamma", "delta,"]) for _ in range(20_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "src1", 0),
        (3, " \n\t ", "en", "src1", 4),
        (4, "one", "en", "src2", 3),
        (4, "one", "en", "src2", 3),
        (None, "a text without an id, of some words", "de", None, 35),
        (None, "a text without an id, of some words", "de", None, 35),
        (5, long_text, None, "src3", len(long_text)),
        (6, "grüße, 漢字 😀 und mehr\nzweite Zeile", "de", "source", 30),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(frame, *names):
    """``frame`` with columns named like those that an operator makes."""
    for name in names:
        frame = frame.selectExpr("*", f"'taken' AS `{name}`")
    return frame


def rows(frame, *columns):
    columns = columns or frame.columns
    found = [tuple(r) for r in frame.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
