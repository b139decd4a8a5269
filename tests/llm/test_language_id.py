import numpy as np
import pytest

from playstream.llm import language_id
from tests.llm.helpers import odd_documents, rows, supplied, with_clashes


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = language_id.Network.new(["a", "b", "c"], hidden=4)
    for layer in (net.onward, net.back):
        layer.of_byte, layer.of_state = layer.of_byte.astype(float), layer.of_state.astype(float)
    net.output, net.bias = net.output.astype(float), net.bias.astype(float)
    pieces = rng.integers(65, 90, (5, 7)).astype(np.uint8)
    lengths, labels = np.array([7, 7, 4, 6, 1]), np.array([0, 1, 2, 1, 0])
    pieces[np.arange(7) >= lengths[:, None]] = 0

    def loss():
        steps, real = np.ascontiguousarray(pieces.T), (np.arange(7)[:, None] < lengths).astype(float)
        letters = language_id._LETTER[steps] * real
        chances = net._chances(net._states(steps, real))
        return -(np.log(chances[:, np.arange(5), labels]) * letters).sum() / letters.sum()

    parameters = [*net.onward.parameters(), *net.back.parameters(), net.output, net.bias]
    for p, g in zip(parameters, net._gradients(pieces, lengths, labels), strict=True):
        for at in np.argsort(-np.abs(g).ravel())[:4]:
            spot = np.unravel_index(at, g.shape)
            kept, p[spot] = p[spot], p[spot] + 1e-4
            up = loss()
            p[spot] = kept - 1e-4
            assert (up - loss()) / 2e-4 == pytest.approx(g[spot], rel=1e-3, abs=1e-6)
            p[spot] = kept


def test_every_byte_is_in_a_piece():
    texts = [b"", b"abc", bytes(range(200)), b"x" * 64]
    pieces, lengths, counts = language_id.cut(texts)
    assert counts.tolist() == [0, 1, 4, 1]
    assert b"".join(p[:n].tobytes() for p, n in zip(pieces, lengths, strict=True)) == b"".join(texts)


def test_held_out_documents(spark):
    docs = supplied(spark)
    got = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_held_out_languages_are_not_learned(spark):
    docs = supplied(spark)
    held = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"
    changed = docs.selectExpr("doc_id", "text", f"IF({held}, 'xx', lang) AS lang", "source")
    one, other = language_id.train(docs, rows=60), language_id.train(changed, rows=60)
    assert one.languages == other.languages and (one.output == other.output).all()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = rows(language_id.languages(docs))
    assert len(got) == docs.count()
    assert {r[2:] for r in got if r[0] in (1, 2, 3)} == {("und", 0.0)}
    assert {r[2] for r in got if r[0] in (4, 5, 6)} <= {"en", "de"}
    assert rows(language_id.languages(with_clashes(docs, "letters", "score", "label"))) == got
    unknown = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r[2:] for r in rows(language_id.languages(unknown))} == {("und", 0.0)}
    assert language_id.languages(docs.limit(0)).collect() == []
