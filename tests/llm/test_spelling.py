"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from telemetra.llm import queries, spelling

SCHEMA = "doc_id LONG, text STRING, word STRING, n STRING"


def plain_words(rows, least=5, count=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_forms(words, times=2):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, words[w], form[w], root, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(rows)


def some_texts(seed, words, texts=60, alphabet="abcdefgé"):
    rng = random.Random(seed)
    bases = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 10))) for _ in range(words)]

    def changed(w):
        for _ in range(rng.randrange(3)):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:i] + (rng.choice(alphabet) if kind else "") + w[i + (kind != 1) :]
        return w

    variants = [changed(b) for b in bases for _ in range(6)]
    return [(i, " ".join(rng.choice(rng.choice([bases[:20], bases, variants])) for _ in range(80)).title()) for i in range(texts)]


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, "w", "n") for r in rows], SCHEMA)
    return docs, spelling.with_forms(spelling.count_words(docs, edit=queries.without_a_letter, **settings))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 6)  # divided blocks too
    rows = some_texts(seed, 60)
    rows += [(None, rows[0][1]), (3, None), (4, ""), (5, "12 中文 ... \x00"), (6, "×÷Éab ×÷Éab ×÷Éab ×÷éab " * 3), rows[1], rows[1]]
    result = found(spark, rows)[1].collect()
    expected = plain_forms(plain_words(rows))
    assert sorted(tuple(r) for r in result) == expected
    assert sum(r[2] is not None for r in expected) > 30 and any(r[3] != r[2] is not None for r in expected)


def test_long_runs_and_no_rows(spark):
    long = "x" * 150_000 + "ab" * 20_000
    rows = [(1, f"{long} {long} {long}y {long}y {long[1:]} "), (2, f"{long} {long}y {long[:-1]} {long[1:]} {long[1:]}")]
    docs, result = found(spark, rows, least_count=1)
    assert sorted(tuple(r) for r in result.collect()) == plain_forms(plain_words(rows, count=1))
    empty = docs.filter("false")
    assert spelling.with_forms(spelling.count_words(empty)).collect() == []
    with pytest.raises(ValueError):
        spelling.with_forms(spelling.count_words(empty), times=1)


def test_all_documents_of_the_smallest_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([tuple(r) for r in rows])
    result = {r["word"]: r for r in queries.QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.001").collect()}
    assert {w: r["n"] for w, r in result.items()} == words
    deleted = {}
    for w in words:  # words one edit apart share a form with one letter replaced by a gap, or one is the other's with a letter less
        for i in range(len(w)):
            deleted.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for w, r in result.items():
        near = {v for i in range(len(w)) for v in deleted[w[:i], w[i + 1 :]] if v != w}
        near |= {w[:i] + w[i + 1 :] for i in range(len(w))} & words.keys()
        near |= {v for i in range(len(w) + 1) for v in deleted.get((w[:i], w[i:]), [])}
        assert r["n_near"] == len(near), w
        best = min(near, key=lambda v: (-words[v], v), default=None)
        assert r["form"] == (best if best is not None and words[best] >= 2 * words[w] else None)


def test_blocks_are_bounded(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.sample("abcdefghijkl", 12)) for _ in range(3000)})  # anagrams: one block
    table = spark.createDataFrame([(w, 3) for w in words], "word STRING, n LONG")
    blocks = spelling.blocks(table, spelling.letter_classes(table, 4)).collect()
    assert len(blocks) == 3 and all(len(b["counts"]) < 1.2 * spelling.BLOCK_WORDS for b in blocks)
    assert spelling.near_words(table).count() == 0


def test_pairs_of_blocks():
    rng = np.random.default_rng(3)
    own, other = rng.integers(97, 100, (60, 6)).astype(np.uint8), rng.integers(97, 100, (50, 5)).astype(np.uint8)
    words = lambda rows: [r.tobytes().decode() for r in rows]
    pairs = set(zip(*map(list, spelling.near_pairs(own, other, False))))
    assert pairs == {(i, j) for i, a in enumerate(words(own)) for j, b in enumerate(words(other)) if one_edit(a, b)}
