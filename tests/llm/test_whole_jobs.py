"""Cases in which operators once did less than the whole job."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm import context_tree, language_id


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    C.ship(spark)


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = {f"l{k:02}": [letters[k % 26] * 2 + letters[k // 26] * 3 + letters[i] * 2 for i in range(6)] for k in range(66)}
    docs = spark.createDataFrame([(k * 10 + d, " ".join(w * 2), lang) for k, (lang, w) in enumerate(word.items()) for d in range(2)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == sorted(word)
    assert language_id.label(docs, model, spans=False).filter("lang_pred <> lang").count() == 0


def test_unknown_text_is_rejected_with_two_languages(spark):
    docs = spark.createDataFrame([(d, ("alpha beta gamma delta " if d % 2 else "mumu nunu roro soso ") * 6, "xy"[d % 2]) for d in range(20)], "doc_id long, text string, lang string")
    asked = docs.limit(4).union(spark.createDataFrame([(99, "\u6f22\u5b57 \u6f22\u5b57", None)], docs.schema))
    assert 99 not in {r.doc_id for r in language_id.keep_known(asked, language_id.fit(docs)).collect()}
    assert language_id.keep_known(docs, language_id.fit(docs)).count() == 20


def test_context_tree_gives_the_same_figures_by_both_ways(spark):
    docs = spark.createDataFrame([(d, f"some words {d} " * (d + 1) + "and others") for d in range(40)], "doc_id long, text string")
    a, b = ({r.doc_id: r for r in context_tree.score(docs, F.col("doc_id") % 3 != 1, sent=n).collect()} for n in (context_tree.SENT, 0))
    assert a.keys() == b.keys()
    for d, r in a.items():
        assert r.score == pytest.approx(b[d].score, rel=1e-12) and r.bits_per_byte == pytest.approx(b[d].bits_per_byte, rel=1e-12)
