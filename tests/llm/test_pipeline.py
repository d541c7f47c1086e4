"""The pipeline stage by stage against plain versions of its operators."""

import os
import sys

from conftest_llm import SF, words

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from cohortviews.llm import language, mixing, pieces, queries, secret_scan, simhash  # noqa: E402
from cohortviews.llm.common import stage  # noqa: E402


def _one_of_each(rows):
    """Rows by doc_id without those linked, directly or not, to one with a smaller doc_id."""
    prints = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in rows}
    low = {i: i for i in prints}
    for _ in range(len(low)):
        new = {a: min(low[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4) for a in prints}
        if new == low:
            break
        low = new
    return {i for i in low if low[i] == i}


def test_stages(spark):
    docs = queries.documents(spark, SF)
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "secret_scan", "mixing", "sentencepiece"]

    known = stage(steps["language_id"](spark, docs, SF), "t")
    accepted = {r.doc_id for r in language.identify(docs).filter("accepted").collect()}
    assert {r.doc_id for r in known.collect()} == accepted and known.columns == corpus_pipeline.COLUMNS

    single = stage(steps["simhash_near_dedup"](spark, known, SF), "t")
    assert {r.doc_id for r in single.collect()} == _one_of_each(known.collect())

    clean = stage(steps["secret_scan"](spark, single, SF), "t")
    before = {r.doc_id: r for r in single.collect()}
    for r in clean.collect():
        text, at, out = before[r.doc_id].text, 0, ""
        for start, end, kind in secret_scan.scan(text):
            if start >= at:
                out += text[at:start] + f"<{kind}>"
            at = max(at, end)
        assert (r.text, r.n_chars, r.source) == (out + text[at:], len(out + text[at:]), before[r.doc_id].source)
    assert clean.count() == single.count()

    mixed = stage(steps["mixing"](spark, clean, SF), "t")
    taken = {r.doc_id: r.taken for r in mixing.mix_counts(clean).collect()}
    got = {}
    texts = {r.doc_id: words(r.text) for r in clean.collect()}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert set(words(r.text)) <= set(texts[r.doc_id])
    assert got == {i: n for i, n in taken.items() if n} and mixed.columns == corpus_pipeline.COLUMNS

    encoder = pieces.Encoder(pieces.vocabulary(queries.piece_model()))
    last = steps["sentencepiece"](spark, mixed, SF).collect()
    want = sorted((r.doc_id, encoder.encode(r.text)[0]) for r in mixed.collect())
    assert sorted((r.doc_id, ",".join(map(str, r.ids))) for r in last) == want


def test_stages_over_edge_cases(spark, edge, none):
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, none, SF).count() == 0
    docs = edge
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), "t")
    assert {r.doc_id for r in docs.select("doc_id").collect()} <= {1, 5, 7, 8, None}


def test_run_is_registered(spark):
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert len([n for n in contract.queries() if n.startswith("op")]) == 13
    assert corpus_pipeline.run(spark, SF).count() > 0
