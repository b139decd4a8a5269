import random
import re
from collections import Counter

import numpy as np
import pytest

from playstream.llm import gam, quality_rules
from tests.llm.helpers import LABELS, documents, odd_documents, rows, supplied, with_clashes


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def texts():
    pick = random.Random(6)
    phrase = " ".join(pick.choice("abc") for _ in range(9))
    made = [" ".join(pick.choice(["a", "bb", "é<", "\n", "x|y"]) for _ in range(pick.randint(0, 80))) for _ in range(60)]
    return [*made, f"{phrase} {phrase}", "a " * 30, "x\ny\nx\n\n\n x", "\x1c\x85 \u2003 z", ""]


@pytest.mark.parametrize("text", texts())
def test_counts(text):
    assert quality_rules.base_counts(text.encode()) == plain_counts(text)


@pytest.fixture(scope="module")
def judged(spark):
    return quality_rules.judge(supplied(spark), supplied(spark, "labels")).toPandas()


def test_rules_on_supplied_documents(spark, judged):
    text = {r.doc_id: r.text for r in supplied(spark).collect()}
    for r in judged.itertuples():
        n, _, _, _, again = counts = plain_counts(text[r.doc_id])
        assert counts == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (n < 20 or 100 * again > 30 * n)
        assert r.kept == (not r.base_failed and r.probability >= quality_rules.KEEP_AT)


def test_the_regression_tells_labels_apart(spark, judged):
    found = judged.merge(supplied(spark, "labels").toPandas(), on="doc_id")
    right = (found.probability >= quality_rules.KEEP_AT) == (found.quality == 1)
    assert right.mean() > 0.95


def test_probabilities_are_calibrated():
    rng = np.random.default_rng(1)
    signal = rng.normal(size=4000)
    values = np.c_[signal, rng.normal(size=(4000, 30))].astype(np.float32)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-signal))).astype(float)
    chances = quality_rules.fit(values[:2000], labels[:2000]).probability(values[2000:])
    for low in (0.2, 0.4, 0.6):
        inside = (chances >= low) & (chances < low + 0.2)
        assert abs(labels[2000:][inside].mean() - chances[inside].mean()) < 0.1


@pytest.mark.parametrize("values", [np.zeros((0, 4), np.float32), np.ones((5, 4), np.float32)])
def test_a_regression_of_one_label_is_constant(values):
    n = len(values)
    assert quality_rules.fit(values, np.ones(n)).probability(np.ones((1, 4)))[0] == pytest.approx((n + 1) / (n + 2))


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0), (77, 7, None)], LABELS)
    docs = odd_documents(spark)
    got = rows(quality_rules.judge(docs, none))
    assert len(got) == docs.count() and {r[-2] for r in got} == {0.5}
    assert rows(quality_rules.judge(with_clashes(docs, "kept", "n_words", "label"), none)) == got
    assert {r[-1] for r in got if r[0] in (1, 2, 3)} == {False}
    assert quality_rules.judge(docs.limit(0), none).collect() == []
    scored = gam.quality(docs, none)
    assert {r.score for r in scored.collect()} == {0.5} and scored.count() == docs.count()
    assert {r.held_out for r in scored.where("doc_id IS NULL").collect()} == {False}
    assert gam.quality(docs.limit(0), none).collect() == []


def test_additive_model_on_held_out_documents(spark):
    docs, labels = (supplied(spark, name, "/root/testdata/sf0.01") for name in ("documents", "labels"))
    got = gam.quality(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) and (held.predicted == held.quality).mean() > 0.9
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_ids_labels_and_other_columns_do_not_matter(spark):
    docs, labels = supplied(spark), supplied(spark, "labels")
    model = gam.train(docs, labels)
    moved = docs.selectExpr("text", "doc_id + 1000 AS doc_id", "'zz' AS lang", "'other' AS source", "0 AS n_chars")
    score = lambda d: sorted(r.score for r in gam.score(d, model).collect())
    assert score(docs) == score(moved)
    held = labels.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0")
    other = labels.join(held, "doc_id", "left_anti").unionByName(held.selectExpr("doc_id", "1 - quality AS quality", "toxic"))
    again = gam.train(docs, other)
    assert all((a == b).all() for a, b in zip(model.tables, again.tables, strict=True))


def test_pairs_are_learned_where_single_features_say_nothing():
    rng = np.random.default_rng(3)
    values = rng.normal(size=(3000, 4))
    labels = ((values[:, 0] > 0) ^ (values[:, 1] > 0)).astype(float)
    model = gam.fit(values[:2000], labels[:2000])
    assert (0, 1) in model.pairs
    assert ((model.scores(values[2000:]) > 0.5) == labels[2000:]).mean() > 0.9


def test_good_documents_keep_their_columns(spark):
    docs = with_clashes(supplied(spark), "score")
    kept = gam.good_documents(docs, supplied(spark, "labels"))
    assert sorted(kept.columns) == sorted(docs.columns)
    assert {r.score for r in kept.collect()} == {"taken"} and 0 < kept.count() < docs.count()
