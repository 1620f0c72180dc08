"""The pipeline on documents with columns named like those that operators add."""

import corpus_pipeline
from telemetra.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
EXTRA = {
    "score": "concat('s', doc_id)",
    "lang_pred": "doc_id % 7",
    "predicted": "concat('p', doc_id)",
    "n_words": "concat('w', doc_id)",
    "n_hit": "concat('h', doc_id)",
    "spans": "concat('x', doc_id)",
    "items": "doc_id + 0.5D",
    "simhash": "concat('f', doc_id)",
    "group": "doc_id * 3",
    "text_hash": "concat('t', doc_id)",
}


def test_columns_stay_through_all_stages(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    docs.selectExpr("*", *[f"{e} AS `{c}`" for c, e in EXTRA.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF_DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    wide = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert out.dtypes == wide.dtypes, name
        kept = sorted(r["doc_id"] for r in stage(spark, docs, SF_DIR).collect())
        rows = out.selectExpr("doc_id", *[f"`{c}` <=> {e} AS `{c}`" for c, e in EXTRA.items()]).collect()
        assert rows and sorted(r["doc_id"] for r in rows) == kept, name
        assert all(r[c] for r in rows for c in EXTRA), name
    whole = {r["doc_id"]: tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert whole and {r["doc_id"]: tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == whole
