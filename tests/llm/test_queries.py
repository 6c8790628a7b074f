"""The registered queries: SQL where there is some, and the pipeline's stages in turn."""

import pytest

import corpus_pipeline
from checks.compare import database, sorted_rows
from outagelens.llm import queries
from outagelens.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(ready, name):
    df = queries.QUERIES[name](ready, SF)
    columns, rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = database(SF).execute(queries.ORACLES[name])
    assert (columns, rows) == sorted_rows([c[0] for c in result.description], result.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_token_counts", "op6_bpe_round_trip", "op8_bottom_k", "op9_language_id", "op10_toxicity", "op11_license_scan"])
def test_a_row_for_each_document(ready, name):
    ids = [r.doc_id for r in queries.QUERIES[name](ready, SF).collect()]
    assert sorted(ids) == sorted(r.doc_id for r in table(ready, SF, "documents").collect())


def test_stages_keep_columns_and_take_rows_away(ready):
    docs = table(ready, SF, "documents")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.kept(stage(ready, docs, SF), "test-stage")
        assert after.columns == docs.columns
        assert after.join(docs, docs.columns, "left_anti").count() == 0
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](ready, docs, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())


def test_run_goes_through_all_stages(ready):
    first = corpus_pipeline.run(ready, SF).collect()
    assert first and set(first[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert len({r.doc_id for r in first}) == len(first)
