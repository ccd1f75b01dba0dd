"""The pipeline against a plain version, its stages on odd tables, and the registered queries."""

import collections
import inspect

import plain
import pytest
import test_models

import __spark_entry__ as contract
import corpus_pipeline
from fareline.llm import mixing, quality
from fareline.llm.common import stored


def test_stages_and_their_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0] == "quality classifier" and names[-1].startswith("SentencePiece")
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_pipeline_equals_the_plain_version(spark):
    import sentencepiece

    docs = plain.sample(spark)
    rows = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    judged = {r.id: r.kept for r in quality.classify(docs).collect()}  # accuracy: test_models
    good = [(i, t) for i, t in rows.items() if judged[i]]
    last = {}
    for i, t in good:
        last[t or ""] = max(i, last.get(t or "", i))
    single = [(i, t) for i, t in good if last[t or ""] == i]
    kept = [(i, rows[i]) for i, _, component in plain.jaccard(single) if component == i]
    sizes = {i: len(plain.words(t)) for i, t in kept}
    per_source = collections.Counter()
    for i, n in sizes.items():
        per_source[source[i]] += n
    goal = test_models.plain_targets(per_source)
    out = corpus_pipeline.run(spark, plain.SF).collect()
    times = collections.Counter(r.doc_id for r in out)
    assert set(times) <= set(sizes)
    for s, target in goal.items():
        own = [i for i in sizes if source[i] == s]
        taken = sum(sizes[i] * times[i] for i in own)
        assert abs(taken - target) <= max(sizes[i] for i in own)
        assert max(times[i] for i in own) - min(times[i] for i in own) <= 1
    library = sentencepiece.SentencePieceProcessor(model_file=test_models.PIECES)
    for r in out:
        ids = library.encode(rows[r.doc_id], add_bos=True, add_eos=True)
        assert list(r.piece_ids) == ids and r.decoded_text == library.decode(ids) and r.text == rows[r.doc_id]


@pytest.mark.parametrize("which", ["odd", "clashing", "empty"])
def test_stages_on_odd_tables(spark, which):
    docs = plain.empty(spark) if which == "empty" else plain.edge(spark, which == "clashing")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, plain.SF), "stage")
        assert docs.columns == columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, plain.SF)
    assert last.columns == [*columns, "piece_ids", "decoded_text"]
    assert (last.count() == 0) == (which == "empty")


def test_documents_with_the_names_of_the_last_stage(spark):
    docs = plain.edge(spark).selectExpr("*", "'p' AS piece_ids", "'d' AS Decoded_Text", "1 AS decoded_text_2")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[-2:]:
        docs = stored(stage(spark, docs, plain.SF), "stage")
    assert docs.columns == [*columns, "piece_ids_2", "decoded_text_3"]
    rows = docs.collect()
    assert rows and all((r.piece_ids, r.Decoded_Text, r.decoded_text_2) == ("p", "d", 1) for r in rows)
    assert all(list(r.piece_ids_2) and r.decoded_text_3 is not None for r in rows)


def test_mixed_rows_are_whole_rows(spark):
    docs = plain.edge(spark)
    rows = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in mixing.mixed(docs).collect()} <= rows


def test_every_operator_is_registered():
    names = list(contract.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
