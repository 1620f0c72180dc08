"""The pipeline replayed outside Spark, row by row: trained models are its own, everything they decide is done again plainly."""

import re

import duckdb
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import langid, quality, queries
from telemetra.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))


def first_of_groups(texts):
    """The smallest id of each group of fingerprints linked by at most four bits, by all pairs."""
    ids = sorted(texts)
    prints = np.array([fingerprint(texts[i]) for i in ids], np.uint64)
    group = list(range(len(ids)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for k in range(len(ids)):
        for other in np.flatnonzero(np.bitwise_count(prints[k + 1 :] ^ prints[k]) <= 4) + k + 1:
            a, b = sorted((root(k), root(int(other))))
            group[b] = a
    return [ids[k] for k in range(len(ids)) if root(k) == k]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def without_windows(texts, items):
    windows = {}
    for item in items:
        words = words_of(item)
        n = min(len(words), 10)
        if n:
            windows.setdefault(n, set()).update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return [i for i, t in texts.items() if not any(tuple(w[k : k + n]) in some for w in [words_of(t)] for n, some in windows.items() for k in range(len(w) - n + 1))]


def test_pipeline_against_a_replay(spark):
    whole = table(spark, SF_DIR, "documents")
    docs = {r["doc_id"]: r for r in whole.collect()}
    counts = [len(docs)]

    model = langid.train(whole.filter(~queries.held_out(4, 2)))
    kept = [i for i, r in docs.items() if (found := model.predict(r["text"]))[0] != "und" and found[1] >= corpus_pipeline.LEAST_SURE]
    counts.append(len(kept))

    trees = quality.train(whole.filter(whole["doc_id"].isin(kept)), table(spark, SF_DIR, "labels").filter(~queries.held_out(4, 2)))
    scores = trees.score(np.array([quality.statistics((docs[i]["text"] or "").encode()) for i in kept]))
    kept = [i for i, s in zip(kept, scores) if s >= 0.7]
    counts.append(len(kept))

    kept = first_of_groups({i: docs[i]["text"] for i in kept})
    counts.append(len(kept))

    kept = without_windows({i: docs[i]["text"] for i in kept}, [r["text"] for r in table(spark, SF_DIR, "benchmark").collect()])
    counts.append(len(kept))
    assert all(a > b for a, b in zip(counts[1:], counts[2:])), counts  # all but the first, whose texts all have a language here, reject some

    duck = duckdb.connect()
    documents = pd.DataFrame([docs[i].asDict() for i in kept])  # noqa: F841
    duck.register("documents", documents)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    expected = duck.sql(queries.MIX_SQL).select(*columns).fetchall()
    found = corpus_pipeline.run(spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert [r["doc_id"] for r in sorted(found)] == sorted(kept)


def test_stages_one_by_one(spark):
    """Each stage on the whole table: what it keeps has all columns and values as they were."""
    given = table(spark, SF_DIR, "documents")
    # all given texts have a language that the first stage is sure of; these have none
    wordless = given.where("doc_id < 3").withColumns({"doc_id": F.expr("-1 - doc_id"), "text": F.expr("concat('12:30, ', doc_id)")})
    whole = given.unionByName(wordless)
    rows = {r["doc_id"]: r for r in whole.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, whole, SF_DIR).collect()
        assert 0 < len(kept) < len(rows), name
        assert all(r == rows[r["doc_id"]] for r in kept), name
