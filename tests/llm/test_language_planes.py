"""Code points above the basic plane in language identification."""

import numpy as np
from conftest_llm import SF

from cohortviews.llm import language, queries


def _codes(text):
    codes, _ = language.characters([text], language._letters())
    return codes.tolist()


def test_only_letters_count():
    assert _codes("a😀b") == _codes("a b") and _codes("😀😀!🎉 7") == [language.BLANK, language.EDGE]
    letter = "\U00020000"  # an ideograph
    assert letter.isalpha() and _codes(f"a{letter}") == [ord("a"), language.STAND_IN, language.EDGE]
    texts = ["😀", "x" + letter, "", "é🎉"]
    codes, of = language.characters(texts, language._letters())
    assert np.bincount(of[(codes != language.EDGE) & (codes != language.BLANK)], minlength=4).tolist() == [0, 2, 0, 1]


def test_emoji_alone_are_no_language(spark):
    docs = queries.documents(spark, SF)
    model = language.learn(docs)
    plain = docs.filter("lang = 'en'").orderBy("doc_id").first().text
    rows = [(1, "😀😀 12 ... 🎉!" * 30), (2, "\U00020000" * 60), (3, plain), (4, plain.replace(" ", " 😀 "))]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()}
    assert (got[1].lang_pred, got[1].score, got[1].accepted) == (language.UNKNOWN, 0.0, False)
    assert got[2].lang_pred != language.UNKNOWN and not got[2].accepted
    assert got[3].accepted and got[3][1:] == got[4][1:]
