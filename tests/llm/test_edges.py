"""Every operator and stage on NULLs, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from telemetra.llm import decontaminate, langid, licenses, mixing, order_minhash, quality, simhash, token_counts, toxicity, url_filter
from telemetra.llm.common import tokenizer_path

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, n_words STRING, size STRING, simhash STRING"
NOTICE = licenses.NOTICES["gpl-3.0"]
ROWS = [
    (1, "Some plain words of a text that is long enough to be read by all. " * 3, "en", "a", 5),
    (1, "Some plain words of a text that is long enough to be read by all. " * 3, "en", "a", 5),
    (2, None, "en", None, None),
    (None, "Some plain words of a text that is long enough to be read by all. " * 3, None, "b", 1),
    (None, None, None, None, None),
    (3, "", None, "a", 0),
    (4, "word " * 60_000, "en", "b", 300_000),
    (5, "x" * 200_000, "de", "b", 200_000),
    (6, f"before it {NOTICE} after it", "de", "a", 1),
    (7, " \n\t ", "fr", "a", 4),
    (8, "\x1c \x00 1234 ... \U0001f600 中文", "fr", None, 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", "w", "z", "f") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 0, 1), (4, None, None), (None, 1, 1), (99, 0, 0)], "doc_id LONG, quality INT, toxic INT")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "plain words of a text that is long enough to be read"), (1, None), (None, "before it"), (3, "")]
    return spark.createDataFrame(rows, "item_id LONG, text STRING")


def operators(docs, labels, benchmark):
    spark = docs.sparkSession
    return {
        "leaks": lambda: decontaminate.digest(decontaminate.find_leaks(docs, benchmark)),
        "simhash": lambda: simhash.near_duplicates(docs),
        "quality": lambda: quality.score(docs, quality.train(docs, labels)),
        "tokens": lambda: token_counts.count_tokens(docs, tokenizer_path("word_bpe_49k.json")),
        "toxicity": lambda: toxicity.score(docs, toxicity.train(docs, labels)),
        "mixing": lambda: mixing.mix(docs),
        "language": lambda: langid.predict(docs, langid.train(docs)),
        "prints": lambda: order_minhash.fingerprints_with_edits(docs),
        "licenses": lambda: licenses.scan(docs, licenses.notices(spark)),
    }


NAMES = ["leaks", "simhash", "quality", "tokens", "toxicity", "mixing", "language", "prints", "licenses"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, labels, benchmark, name):
    rows = operators(docs, labels, benchmark)[name]().collect()
    if name == "licenses":
        assert [(r["doc_id"], r["license_id"], r["containment"], r["position"]) for r in rows] == [(6, "gpl-3.0", 1.0, 2)]
        return
    key = lambda i: (i is None, i)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((r[0] for r in ROWS), key=key)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(docs, labels, benchmark, name):
    nothing = [t.filter("false") for t in (docs, labels, benchmark)]
    assert operators(*nothing)[name]().collect() == []


@pytest.mark.parametrize("name", ["leaks", "quality", "toxicity"])
def test_nothing_to_compare_with(docs, labels, benchmark, name):
    assert operators(docs, labels.filter("false"), benchmark.filter("false"))[name]().count() == len(ROWS)


def test_leaks_in_repeated_and_null_rows(docs, benchmark):
    rows = decontaminate.find_leaks(docs, benchmark).filter("n_hit > 0").select("doc_id", "n_hit", "items").collect()
    found = sorted((str(r["doc_id"]), r["n_hit"], tuple(r["items"])) for r in rows)
    assert found == [("1", 36, ("1",)), ("1", 36, ("1",)), ("6", 2, ()), ("None", 36, ("1",))]  # three times twelve words


def test_urls(spark):
    pages = spark.createDataFrame([(1, None, "h"), (1, None, "h"), (2, "", "h"), (3, "no scheme", "h"), (None, "http://A.COM/x?y", "h"), (4, "http://", "h")], "page_id LONG, url STRING, host STRING")
    rules = spark.createDataFrame([("com", "/", "block"), ("com", "/", "block"), (None, "/", "block"), ("a", None, None)], "host STRING, path STRING, verdict STRING")
    rows = url_filter.judge(pages, rules).collect()
    found = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"]), r["verdict"]) for r in rows)
    none = [(i, "", "", "None", "allow") for i in ("1", "1", "2", "3", "4")]
    assert found == [*none, ("None", "a.com", "/x", "com/", "block")]
    assert url_filter.judge(pages, rules.filter("false")).filter("verdict = 'allow'").count() == 6
    assert url_filter.judge(pages.filter("false"), rules).count() == 0


def test_stages(spark, docs, labels, benchmark, tmp_path):
    for name, table in (("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if "mixing" not in name:
            assert out.columns == docs.columns
        assert out.count() <= len(ROWS)
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0
    kept = simhash.keep_first(docs).select("doc_id", "text").collect()
    assert sorted(str(r["doc_id"]) for r in kept if r["text"] and r["text"].startswith("Some")) == ["1"]
    assert [r["doc_id"] for r in kept if not (r["text"] or "").strip()] == [2]
