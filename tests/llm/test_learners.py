"""What the classifiers compute against plain loops: trees, gradients, scores of windows, follow-the-regularised-leader."""

import math
import random

import numpy as np
import pytest

from telemetra.llm import langid, quality, queries, toxicity
from telemetra.llm.common import table


def test_trees_against_a_descent_by_row():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 6))
    x[::7] = np.round(x[::7])  # values on thresholds
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] > 0).astype(float)
    trees = quality.fit(x, y, trees=20, depth=3)
    inner = trees.feature.shape[1]
    for row, score in zip(x, trees.score(x)):
        total = trees.base
        for t in range(20):
            node = 0
            while node < inner:
                node = 2 * node + (2 if row[trees.feature[t, node]] > trees.threshold[t, node] else 1)
            total += trees.leaf[t, node - inner]
        assert math.isclose(score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.85


def test_a_tree_takes_the_best_split():
    """Depth one, one tree: its split has the largest gain of all splits, tried one by one."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, (150, 3)), 1)
    y = (x[:, 1] + 0.3 * rng.normal(0, 1, 150) > 0.4).astype(float)
    trees = quality.fit(x, y, trees=1, depth=1, ridge=2.0, least=3.0)
    p = y.mean()
    g, h = y - p, np.full(150, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 2) if m.any() else 0.0
    best = 0.0
    for f in range(3):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS)[1:-1])):
            right = x[:, f] > cut
            if min(h[right].sum(), h[~right].sum()) >= 3:
                best = max(best, gain(right) + gain(~right))
    chosen = x[:, trees.feature[0, 0]] > trees.threshold[0, 0]
    assert math.isclose(gain(chosen) + gain(~chosen), best)
    assert np.allclose(trees.leaf[0], [0.12 * g[m].sum() / (h[m].sum() + 2) for m in (~chosen, chosen)])


def test_query_scores_are_the_trees(spark):
    """The whole query at sf0.001 from collected texts, one at a time."""
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r["score"] for r in queries.QUERIES["op3_quality"](spark, sf).collect()}
    trees = quality.train(table(spark, sf, "documents"), table(spark, sf, "labels").filter(~queries.held_out(4, 2)))
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        assert math.isclose(found[r["doc_id"]], trees.score(np.array([quality.statistics(r["text"].encode())]))[0])


def some_network(seed=3):
    net = toxicity.Network(seed)
    rng = np.random.default_rng(seed)
    net.p["word"] = rng.normal(0, 0.5, net.p["word"].shape)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    return net


def plain_logit(net, words, shown=None):
    """One window, one step and one state at a time."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h, inputs = toxicity.HIDDEN, []
    for w in words:
        vector = net.vectors([w])[1].astype(float)
        inputs.append(vector if shown is None or shown[w] else np.concatenate([np.zeros(toxicity.WORD_SIZE), vector[toxicity.WORD_SIZE :]]))
    inputs += [np.zeros(toxicity.WORD_SIZE + toxicity.GRAM_SIZE)] * (toxicity.WINDOW - len(words))
    states = {}
    for name, order in (("f", range(toxicity.WINDOW)), ("b", range(toxicity.WINDOW - 1, -1, -1))):
        state = np.zeros(h)
        for t in order:
            gates, u = inputs[t] @ net.p["w" + name] + net.p["b" + name], net.p["u" + name]
            z, r = sigmoid(gates[:h] + state @ u[:, :h]), sigmoid(gates[h : 2 * h] + state @ u[:, h : 2 * h])
            new = np.tanh(gates[2 * h :] + r * (state @ u[:, 2 * h :]))
            state = new + z * (state - new)
            states[name, t] = state
    if not words:
        return net.p["bias"][0]
    both = [np.concatenate([states["f", t], states["b", t]]) for t in range(len(words))]
    weight = np.exp([s @ net.p["attend"] for s in both])
    return (weight / weight.sum()) @ np.array(both) @ net.p["out"] + net.p["bias"][0]


def test_scores_against_a_loop():
    rng, net = random.Random(4), some_network()
    net.slope, net.offset = 1.3, -0.2
    words = [b"one", b"two", b"a", b"longer", b"xyz9", "größe".encode()]
    texts = [b" ".join(rng.choice(words) for _ in range(n)) for n in (1, 5, 31, 32, 33, 48, 49, 100, 300)] + [b"", None, b"?! --", "中文字 and ไทย words".encode()]
    found = toxicity.Scorer(net).score(texts)
    for text, score in zip(texts, found):
        split = toxicity.words_of(text)
        top = max(plain_logit(net, split[s : s + toxicity.WINDOW]) for s in range(0, max(len(split) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE))
        assert math.isclose(score, 1 / (1 + math.exp(-(1.3 * top - 0.2))), rel_tol=1e-4)


def test_gradients_against_differences():
    net, rng = some_network(), np.random.default_rng(6)
    words = [b"alpha", b"beta", b"gamma", b"x", b"delta1"]
    vocabulary = toxicity.Vocabulary(words)
    ids = rng.integers(1, 6, (7, toxicity.WINDOW))
    ids[0, 5:], ids[1, 20:], ids[2, 1:] = 0, 0, 0
    labels = np.array([1, 0, 1, 1, 0, 0, 1], np.float32)
    grad = net.gradients(ids, labels, vocabulary, seed=8)
    distinct = np.unique(ids)
    drawn = np.random.default_rng(8).random(len(distinct)) < 0.5
    shown = {words[i - 1]: bool(s) for i, s in zip(distinct, drawn) if i}

    def loss():
        logits = [plain_logit(net, [words[i - 1] for i in row if i], shown) for row in ids]
        return float(np.mean([np.log1p(np.exp(-v)) if y else np.log1p(np.exp(v)) for v, y in zip(logits, labels)]))

    buckets, grams, _ = toxicity.word_features(words)
    places = {"word": [(b, 2) for b in buckets[:3]], "gram": [(g, 1) for g in grams[:6]], "wf": [(0, 1), (11, 20)], "wb": [(3, 9), (14, 5)],
              "uf": [(1, 2), (3, 10), (5, 20)], "ub": [(0, 0), (2, 17)], "bf": [(4,), (12,), (18,)], "bb": [(1,), (9,), (23,)], "attend": [(0,), (9,)], "out": [(3,), (12,)], "bias": [(0,)]}
    assert places.keys() == grad.keys() == net.p.keys()
    for name, some in places.items():
        for at in some:
            kept, step = net.p[name][at], 1e-4
            net.p[name][at] = kept + step
            above = loss()
            net.p[name][at] = kept - step
            below = loss()
            net.p[name][at] = kept
            assert math.isclose(grad[name][at], (above - below) / (2 * step), rel_tol=5e-3, abs_tol=2e-6), (name, at)


def test_scripts_without_spaces_have_a_word_for_each_character():
    for text in ("我喜欢这本书", "これは本です", "ภาษาไทย", "ພາສາລາວ", "ភាសាខ្មែរ", "မြန်မာ", "𠀀𠀁"):
        assert toxicity.words_of(text.encode()) == [c.encode() for c in text]
    assert toxicity.words_of("größe naïve 한국어 слово λόγος עברית".encode()) == [w.encode() for w in "größe naïve 한국어 слово λόγος עברית".split()]
    text = "字" * 5000
    assert len(toxicity.window_starts(len(toxicity.words_of(text.encode())))) == math.ceil((5000 - toxicity.WINDOW) / toxicity.STRIDE) + 1


def test_a_toxic_passage_is_learnt_wherever_it_is(spark):
    """Long texts with one toxic window among hundreds: beyond any few windows taken by chance."""
    rng = random.Random(7)
    clean, bad = [f"word{i}" for i in range(200)], ["zorgle", "fnarp", "quib"]
    rows, labels = [], []
    for i in range(160):
        words = [rng.choice(clean) for _ in range(6000 if i % 2 else 60)]
        if i % 4 < 2:
            at = rng.randrange(len(words) - 8)
            words[at : at + 8] = [rng.choice(bad) for _ in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 < 2)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    net = toxicity.train(docs.filter("doc_id < 120"), spark.createDataFrame(labels, "doc_id LONG, toxic INT"))
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, net, keep=["doc_id"]).collect()}
    right = [found[i] == label for i, label in labels if i >= 120]
    assert sum(right) >= 38  # of 40


def test_errors_by_length(spark):
    """Held-out toxicity at sf0.1, short and long texts apart: long clean texts are not pushed up."""
    sf = "/root/testdata/sf0.1"
    labels = dict(table(spark, sf, "labels").select("doc_id", "toxic").collect())
    n_words = {r["doc_id"]: len(r["text"].split()) for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    rows = [r for r in queries.QUERIES["op5_toxicity"](spark, sf).filter("held_out").collect() if labels.get(r["doc_id"]) is not None]
    for low, high, most in ((0, 400, 0.06), (400, 1 << 30, 0.06)):
        some = [r for r in rows if low <= n_words[r["doc_id"]] < high]
        clean = [r for r in some if not labels[r["doc_id"]]]
        toxic = [r for r in some if labels[r["doc_id"]]]
        print(low, len(clean), sum(r["predicted"] for r in clean), len(toxic), sum(r["predicted"] for r in toxic))
        assert sum(r["predicted"] for r in clean) <= most * len(clean)
        assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)


def test_ftrl_against_a_plain_loop():
    rng = np.random.default_rng(9)
    classes, rows = 3, []
    for i in range(30):
        at = rng.choice(12, 4, replace=False)
        rows.append((at, rng.random(4), int(rng.integers(0, classes))))
    weights, bias = langid.train_ftrl(rows, classes, updates=90)
    alpha, beta, l1, l2 = 0.6, 1.0, 1e-3, 1e-3
    z, n = {}, {}

    def weight(f, c):
        value = z.get((f, c), 0.0)
        return 0.0 if abs(value) <= l1 else -(value - math.copysign(l1, value)) / ((beta + math.sqrt(n.get((f, c), 0.0))) / alpha + l2)

    for epoch in range(3):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, value, label = rows[i]
            features = [*zip(at.tolist(), value.tolist()), ("bias", 1.0)]
            raw = [sum(weight(f, c) * v for f, v in features) for c in range(classes)]
            p = np.exp(raw - np.max(raw))
            p /= p.sum()
            old = {(f, c): weight(f, c) for f, _ in features for c in range(classes)}
            for f, v in features:
                for c in range(classes):
                    g = v * (p[c] - (c == label))
                    before = n.get((f, c), 0.0)
                    sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / alpha
                    z[f, c] = z.get((f, c), 0.0) + g - sigma * old[f, c]
                    n[f, c] = before + g * g
    assert np.allclose(weights[:12], [[weight(f, c) for c in range(classes)] for f in range(12)])
    assert np.allclose(bias, [weight("bias", c) for c in range(classes)])


def test_scores_of_whole_texts_by_plain_frequencies(spark):
    """TF-IDF and softmax of one text, n-gram by n-gram."""
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 10)], "doc_id LONG, text STRING, lang STRING")
    model = langid.train(docs)
    for text in ("The dog!", "die Katze " * 400, "x"):
        lower = text.lower()
        found = [lower[i : i + n] for n in (1, 2, 3) for i in range(len(lower) - n + 1)]
        buckets = [int(langid.grams(g)[len(g) - 1][0]) for g in found]
        raw = np.array(model.bias, float) + sum(model.weights[b].astype(float) for b in buckets) / len(found)
        p = np.exp(raw / model.temperature - np.max(raw / model.temperature))
        lang, score = model.predict(text)
        assert lang == model.languages[int(p.argmax())] and math.isclose(score, p.max() / p.sum(), rel_tol=1e-6)


def test_many_languages_of_one_script(spark):
    """Forty languages of the same letters, told apart by their words only; learnt from twelve texts each."""
    rng, rows, n = random.Random(10), [], 40
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    words = {k: ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(60)] for k in range(n)}
    text = lambda k: " ".join(rng.choice(words[k]) for _ in range(40))
    for k in range(n):
        rows += [(len(rows) + j, text(k), f"l{k:02d}") for j in range(12)]
    model = langid.train(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING"))
    right = [model.predict(text(k))[0] == f"l{k:02d}" for k in range(n) for _ in range(5)]
    assert sum(right) / len(right) > 0.95
