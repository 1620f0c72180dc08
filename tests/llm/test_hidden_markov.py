"""The language model against plain sums over paths, a plain Baum-Welch, and plain counts."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.llm import hidden_markov as hm, queries

SCHEMA = "doc_id LONG, text STRING, score STRING, n_known STRING, row STRING"


def a_model(symbols, states, seed=1):
    rng = np.random.default_rng(seed)
    share = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    return hm.Markov(share(rng.random(states), 0), share(rng.random((states, states)), 1), share(rng.random((symbols, states)), 0))


def over_all_paths(model, text):
    total = 0.0
    for path in itertools.product(range(len(model.first)), repeat=len(text)):
        p = model.first[path[0]] * model.emit[text[0], path[0]]
        for t in range(1, len(text)):
            p *= model.step[path[t - 1], path[t]] * model.emit[text[t], path[t]]
        total += p
    return math.log(total)


def test_likelihood_is_the_sum_over_paths():
    model, rng = a_model(5, 3), np.random.default_rng(2)
    texts = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 6, 3, 6, 2)]
    side = hm.Side(texts)
    found = np.empty(5)
    found[side.order] = hm.forward(model, side)[0]
    assert np.allclose(found, [over_all_paths(model, t) for t in texts])


def plain_counts(model, texts):
    first, step, emit = np.zeros_like(model.first), np.zeros_like(model.step), np.zeros_like(model.emit)
    for text in texts:
        n, states = len(text), len(model.first)
        a, b = np.zeros((n, states)), np.ones((n, states))
        for t in range(n):
            a[t] = (model.first if t == 0 else a[t - 1] @ model.step) * model.emit[text[t]]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = model.step @ (model.emit[text[t + 1]] * b[t + 1])
            b[t] /= b[t].sum()
        for t in range(n):
            share = a[t] * b[t] / (a[t] * b[t]).sum()
            emit[text[t]] += share
            if t == 0:
                first += share
            else:
                both = a[t - 1][:, None] * model.step * (model.emit[text[t]] * b[t])
                step += both / both.sum()
    return first, step, emit


@pytest.mark.parametrize("segment, tokens", [(256, 1 << 17), (4, 30), (1, 1)])
def test_expected_counts(monkeypatch, segment, tokens):
    monkeypatch.setattr(hm, "SEGMENT", segment)
    monkeypatch.setattr(hm, "SEGMENT_TOKENS", tokens)
    model, rng = a_model(7, 3), np.random.default_rng(3)
    texts = [rng.integers(0, 7, n).astype(np.uint16) for n in (1, 4, 5, 8, 9, 33, 2, 40)]
    found = hm.expected_counts(model, texts)
    for mine, plain in zip(found, plain_counts(model, texts)):
        assert np.allclose(mine, plain)


def test_baum_welch_never_gets_worse():
    rng = np.random.default_rng(4)
    texts = [np.where(rng.random(60) < 0.8, rng.integers(0, 5, 60) + 5 * (i % 2), 10).astype(np.uint16) for i in range(40)]
    overall = np.full(11, 1 / 11)
    model, seen = hm.start_values(overall, 2), []
    for _ in range(15):
        counts = hm.expected_counts(model, texts)
        seen.append(counts.likelihood)
        first, step, emit = counts.first + 1e-9, counts.step + 1e-9, counts.emit + 1e-9
        model = hm.Markov(first / first.sum(), step / step.sum(axis=1)[:, None], emit / emit.sum(axis=0))
    assert all(b >= a - 1e-6 for a, b in zip(seen, seen[1:]))
    assert seen[-1] > seen[0] + 500  # the two kinds of text are told apart


def learns(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def tokens_of(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


def by_loop(rows, model, own, head):
    """All columns from plain counts and the trained model."""
    learnt = [tokens_of(t) for i, t in rows if learns(i)]
    counts = Counter(w for t in learnt for w in t)
    total, distinct = sum(counts.values()) + len(learnt), len(counts) + (len(learnt) > 0)
    symbol = {w: k + 1 for k, w in enumerate(head[:own])}
    bucket = lambda w: zlib.crc32(w[-3:]) % hm.BUCKETS
    in_bucket = Counter()
    for w, n in counts.items():
        if w not in symbol:
            in_bucket[bucket(w)] += n + 1
    result = []
    for i, text in rows:
        words = tokens_of(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words) + math.log10((len(learnt) + 1) / (total + distinct + 1))
        share = sum(math.log10((counts[w] + 1) / (in_bucket[bucket(w)] + 1)) for w in words if w not in symbol)
        symbols = [symbol.get(w, own + 1 + bucket(w)) for w in words] + [0]
        side = hm.Side([np.array(symbols, np.uint16)])
        known = sum(counts[w] > 0 for w in words) + (len(learnt) > 0)
        result.append((i, len(symbols), known, total, base, share + hm.forward(model, side)[0][0] / math.log(10)))
    return result


def some_rows():
    rng = random.Random(6)
    words = ["Der", "die", "das", "the", "of", "and"] + [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(rng.choice(words if rng.random() < 0.5 else words[:6]) for _ in range(rng.randrange(1, 120)))) for i in range(80)]
    long = "y" * 5000
    odd = [(100, None), (101, ""), (102, " \n\t"), (None, "the new words"), (None, None), (103, "the " * 30_000), (104, f"{long} {long}z"), (105, f"{long}z never-seen \x1c\x85"), (106, f"{long} ab")]
    return rows + odd + rows[:2] * 2


def test_scores_against_loop(spark, monkeypatch):
    rows = some_rows()
    docs = spark.createDataFrame([(*r, "s", "k", "r") for r in rows], SCHEMA).repartition(3)
    learn = ~queries.held_out(7, 2)
    vocabulary = hm.count_words(docs.where(learn), own=4, head=40)
    assert len(vocabulary.words) <= 40 and vocabulary.own == 4
    texts = hm.encoded(docs, learn, vocabulary, ["doc_id", "score"])
    model = hm.train(texts, vocabulary.overall, states=3, rounds=2)
    assert np.allclose(model.step.sum(axis=1), 1) and np.allclose(model.emit.sum(axis=0), 1) and model.emit.min() > 0
    found = hm.score(texts, model, vocabulary, ["doc_id"]).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    expected = sorted(by_loop(rows, model, 4, vocabulary.words), key=key)
    assert len(found) == len(rows)
    for mine, plain in zip(sorted((tuple(r) for r in found), key=key), expected):
        assert mine[:4] == plain[:4] and np.allclose(mine[4:], plain[4:])


def test_long_words_among_the_frequent(spark):
    long = ["a" * 70 + "end", "b" * 90 + "tail"]
    rows = [(i, " ".join(long * 9 + ["x"] * 20 + [f"v{i}"])) for i in range(9)]
    docs = spark.createDataFrame([(*r, "s", "k", "r") for r in rows], SCHEMA)
    for own in (0, 1, 2, 3):
        vocabulary = hm.count_words(docs, own=own, head=5)
        model = a_model(1 + vocabulary.own + hm.BUCKETS, 2)
        found = hm.score(hm.encoded(docs, F.lit(True), vocabulary, ["doc_id"]), model, vocabulary, ["doc_id"])
        spelt = {hm._key(w.encode()): w.encode() for w in long}
        plain = by_loop([(None, t) for _, t in rows], model, own, [spelt.get(w, w) for w in vocabulary.words])
        assert np.allclose(sorted(r["score"] for r in found.collect()), sorted(p[5] for p in plain))


def test_nothing_to_learn_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "k", "r"), (2, None, "s", "k", "r")], SCHEMA)
    rows = hm.language_scores(docs, F.lit(False)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) for r in rows)
    assert hm.language_scores(docs.filter("false"), F.lit(True)).collect() == []


def test_probabilities_of_words_add_up():
    """Over all words of a bucket and one word never learnt the shares are one."""
    counts = [5, 3, 1]
    whole = sum(counts) + len(counts) + 1
    assert math.isclose(sum((c + 1) / whole for c in [*counts, 0]), 1)


def test_query(spark):
    rows = queries.QUERIES["op13_language_model"](spark, "/root/testdata/sf0.01").collect()
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    learnt = [tokens_of(r["text"]) for r in texts if learns(r["doc_id"])]
    counts = Counter(w for t in learnt for w in t)
    total, distinct = sum(counts.values()) + len(learnt), len(counts) + 1
    plain = {r["doc_id"]: tokens_of(r["text"]) for r in texts}
    assert len(rows) == len(texts)
    for r in rows:
        words = plain[r["doc_id"]]
        base = sum(math.log10(counts[w] + 1) for w in words) + math.log10(len(learnt) + 1) - (len(words) + 1) * math.log10(total + distinct + 1)
        assert r["held_out"] != learns(r["doc_id"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(w in counts for w in words) + 1, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    held = [r for r in rows if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens + 0.25  # of 4.07
