"""Queries with SQL against DuckDB, and the pipeline against its stages done by hand."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op4_warc", "op9_exact_topk", "op11_source_divergence"])
def test_same_rows_as_sql(spark, name):
    from shelfspark.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("conversations", "pages", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    expected = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(map(str, (tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()))) == sorted(map(str, expected.fetchall()))


def test_pipeline_keeps_what_its_stages_keep(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = spark.createDataFrame(after.collect(), after.schema)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected
