"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word is an input of two parts, both hashed and learnt: a vector of the word itself, and the mean of
the vectors of its character n-grams (3 and 5 bytes, with marks for both ends). Words are runs of letters and digits; of scripts
that are written without spaces (Chinese, Japanese, Thai and others) each character is one. The network reads windows of ``WINDOW`` words, which
overlap by half and together cover the whole text; attention pools the states of
both directions, and a logistic unit scores the window. A text's score is that of its highest
window, calibrated by logistic regression.

Only texts are labelled, not windows. The sample to learn from is a bounded number of documents, ``TRAIN_TOXIC`` and
``TRAIN_OTHER`` first in the order of a hash. Training starts with ``FIRST_WINDOWS`` random distinct windows of each, bearing its text's label.
Then, in ``LOOKS`` rounds, tasks score all windows of all these documents with the network so far and return of each the
highest two and ``MORE_WINDOWS`` random ones; of toxic texts the highest are learnt, and of others those that score wrongly high and a
random share. So no window is beyond what is learnt, and the driver holds a few windows of each document. The calibration
takes each document's highest window of all. Scoring reads all windows of
every text. NULL and empty texts, and those without letters or digits, score as one empty window.
Without both kinds of labels the score is the share of toxic labels (0.5 without any). Repeated rows score alike,
empty tables give empty results, columns named like an added one are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import WORDS_ONLY, map_texts
from telemetra.llm.quality import labelled_sample
from telemetra.sources.staging import stage

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, WORD_SIZE = 1 << 14, 10
GRAM_BITS, GRAM_SIZE, GRAMS = 14, 6, (3, 5)
GRAM_BUCKETS = 1 << GRAM_BITS
HIDDEN = 8
TRAIN_TOXIC, TRAIN_OTHER = 1600, 2400
FIRST_WINDOWS, MORE_WINDOWS = 24, 4
#: Epochs before which all windows of the sample are looked at.
LOOKS = (1, 3, 5)
#: Windows scored at once, and distinct words whose inputs a task remembers.
CHUNK, REMEMBERED = 2048, 150_000


#: A character of a script without spaces, in UTF-8. Thai, Lao, Myanmar, Khmer, kana, Chinese characters and what goes with them.
UNSPACED = re.compile(
    rb"\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xe2[\xba-\xbf][\x80-\xbf]|[\xe3-\xe9][\x80-\xbf]{2}"
    rb"|\xea[\x80-\x93][\x80-\xbf]|\xef[\xa4-\xab][\x80-\xbf]|\xf0[\xa0-\xbf][\x80-\xbf]{2}"
)


def words_of(text: bytes | None) -> list[bytes]:
    text = (text or b"").translate(WORDS_ONLY)
    if not text.isascii():
        text = UNSPACED.sub(rb" \g<0> ", text)
    return text.split()


def window_starts(n: int) -> np.ndarray:
    """The first words of windows that cover ``n`` words; one window if there are none."""
    return np.arange(max(-(-(n - WINDOW) // STRIDE), 0) + 1) * STRIDE


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word; buckets of all its character n-grams, one word after the other; where each word's begin."""
    buckets = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in words), np.int64, len(words))
    flat = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    begin = np.cumsum(sizes) - sizes
    owner, code = [], []
    for n in GRAMS:
        counts = np.maximum(sizes - n + 1, 0)
        word = np.repeat(np.arange(len(words)), counts)
        at = begin[word] + np.arange(len(word)) - (np.cumsum(counts) - counts)[word]
        key = np.full(len(word), n, np.uint64)
        for i in range(n):
            key = (key << np.uint64(8)) | flat[at + i]
        owner.append(word)
        code.append((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return buckets, np.concatenate(code)[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(words)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters are float32 arrays in ``p``; index 0 of a window's words means no word."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        size, h = WORD_SIZE + GRAM_SIZE, HIDDEN
        self.p = {
            "word": np.zeros((WORD_BUCKETS, WORD_SIZE)),
            "gram": rng.normal(0, 0.1, (GRAM_BUCKETS, GRAM_SIZE)),
            "wf": rng.normal(0, 0.3, (size, 3 * h)), "wb": rng.normal(0, 0.3, (size, 3 * h)),
            "bf": np.zeros(3 * h), "bb": np.zeros(3 * h),
            "uf": rng.normal(0, 0.3, (h, 3 * h)), "ub": rng.normal(0, 0.3, (h, 3 * h)),
            "attend": rng.normal(0, 0.3, 2 * h), "out": rng.normal(0, 0.3, 2 * h), "bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.slope, self.offset = 1.0, 0.0

    def vectors(self, words: list[bytes]) -> np.ndarray:
        """Inputs of distinct words; row 0 is that of no word."""
        out = np.zeros((len(words) + 1, WORD_SIZE + GRAM_SIZE), np.float32)
        if words:
            buckets, grams, first = word_features(words)
            out[1:, :WORD_SIZE] = self.p["word"][buckets]
            counts = np.diff(np.append(first, len(grams)))
            out[1:, WORD_SIZE:] = np.add.reduceat(self.p["gram"][grams], first, axis=0) / counts[:, None]
        return out

    def direction(self, gates: np.ndarray, u: np.ndarray, back: bool, keep: bool = False):
        """States of one direction, time first. gates: time x windows x 3 HIDDEN."""
        steps, n, _ = gates.shape
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((steps, n, HIDDEN), np.float32)
        held = []
        uzr, un = np.ascontiguousarray(u[:, : 2 * HIDDEN]), np.ascontiguousarray(u[:, 2 * HIDDEN :])
        for t in reversed(range(steps)) if back else range(steps):
            g = gates[t]
            zr = sigmoid(g[:, : 2 * HIDDEN] + h @ uzr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            hu = h @ un
            c = np.tanh(g[:, 2 * HIDDEN :] + r * hu)
            new = c + z * (h - c)
            if keep:
                held.append((t, h, z, r, hu, c))
            h = states[t] = new
        return states, held

    def pool(self, states: np.ndarray, present: np.ndarray):
        weight = states @ self.p["attend"]
        weight = np.where(present, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0)) * present
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        context = np.einsum("tn,tnh->nh", weight, states)
        return weight, context, context @ self.p["out"] + self.p["bias"][0]

    def logits(self, windows: np.ndarray, gates_f: np.ndarray, gates_b: np.ndarray) -> np.ndarray:
        """windows: windows x time, rows of the gate tables of distinct words."""
        out = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), CHUNK):
            ids = np.ascontiguousarray(windows[at : at + CHUNK].T)
            forward, _ = self.direction(gates_f[ids], self.p["uf"], False)
            backward, _ = self.direction(gates_b[ids], self.p["ub"], True)
            out[at : at + CHUNK] = self.pool(np.concatenate([forward, backward], axis=2), ids > 0)[2]
        return out

    def gates(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors @ self.p["wf"] + self.p["bf"], vectors @ self.p["wb"] + self.p["bb"]

    def gradients(self, ids: np.ndarray, labels: np.ndarray, vocabulary: "Vocabulary", seed: int) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of windows (windows x time) of words of the vocabulary."""
        distinct, back = np.unique(ids, return_inverse=True)
        ids = back.reshape(ids.shape).T
        x = vocabulary.vectors(self, distinct)
        shown = (np.random.default_rng(seed).random(len(distinct)) < 0.5)[:, None].astype(np.float32)
        x[:, :WORD_SIZE] *= shown  # half of the words are read by their characters alone
        gf, gb = self.gates(x)
        forward, held_f = self.direction(gf[ids], self.p["uf"], False, True)
        backward, held_b = self.direction(gb[ids], self.p["ub"], True, True)
        states = np.concatenate([forward, backward], axis=2)
        present = distinct[ids] > 0
        weight, context, logit = self.pool(states, present)
        d_logit = (sigmoid(logit) - labels).astype(np.float32) / len(labels)
        grad = {"out": context.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
        d_context = d_logit[:, None] * self.p["out"]
        d_states = weight[..., None] * d_context
        d_weight = np.einsum("tnh,nh->tn", states, d_context)
        d_attend = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_states += d_attend[..., None] * self.p["attend"]
        grad["attend"] = np.einsum("tn,tnh->h", d_attend, states)
        d_x = np.zeros_like(x)
        for name, held, part in (("f", held_f, slice(0, HIDDEN)), ("b", held_b, slice(HIDDEN, 2 * HIDDEN))):
            u = self.p["u" + name]
            d_u, d_table = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), np.float32)
            d_h = np.zeros((ids.shape[1], HIDDEN), np.float32)
            all_g = np.empty((ids.shape[0], ids.shape[1], 3 * HIDDEN), np.float32)
            for t, h, z, r, hu, c in reversed(held):
                d = d_states[t, :, part] + d_h
                d_c = d * (1 - z) * (1 - c * c)
                d_z = d * (h - c) * z * (1 - z)
                d_r = d_c * hu * r * (1 - r)
                d_hu = d_c * r
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_u[:, : 2 * HIDDEN] += h.T @ d_zr
                d_u[:, 2 * HIDDEN :] += h.T @ d_hu
                d_h = d * z + d_zr @ u[:, : 2 * HIDDEN].T + d_hu @ u[:, 2 * HIDDEN :].T
                all_g[t, :, : 2 * HIDDEN], all_g[t, :, 2 * HIDDEN :] = d_zr, d_c
            flat = ids.ravel()
            for k in range(3 * HIDDEN):
                d_table[:, k] = np.bincount(flat, all_g[..., k].ravel(), len(x))
            grad["u" + name], grad["w" + name], grad["b" + name] = d_u, x.T @ d_table, d_table.sum(axis=0)
            d_x += d_table @ self.p["w" + name].T
        d_x[distinct == 0] = 0
        d_x[:, :WORD_SIZE] *= shown
        grad["word"], grad["gram"] = vocabulary.scatter(distinct, d_x)
        return grad


class Vocabulary:
    """Distinct words of the training windows, numbered from 1."""

    def __init__(self, words: list[bytes]):
        self.buckets, self.grams, self.first = word_features(words) if words else (np.zeros(0, np.int64),) * 3
        self.counts = np.diff(np.append(self.first, len(self.grams)))

    def _grams(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[at]
        starts = np.cumsum(counts) - counts
        return self.grams[np.repeat(self.first[at] - starts, counts) + np.arange(counts.sum())], starts

    def vectors(self, net: Network, ids: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ids), WORD_SIZE + GRAM_SIZE), np.float32)
        real = ids > 0
        at = ids[real] - 1
        if len(at):
            grams, starts = self._grams(at)
            out[real, :WORD_SIZE] = net.p["word"][self.buckets[at]]
            out[real, WORD_SIZE:] = np.add.reduceat(net.p["gram"][grams], starts, axis=0) / self.counts[at][:, None]
        return out

    def scatter(self, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word, gram = np.zeros((WORD_BUCKETS, WORD_SIZE), np.float32), np.zeros((GRAM_BUCKETS, GRAM_SIZE), np.float32)
        real = ids > 0
        at, d = ids[real] - 1, d[real]
        if len(at):
            np.add.at(word, self.buckets[at], d[:, :WORD_SIZE])
            grams, _ = self._grams(at)
            np.add.at(gram, grams, np.repeat(d[:, WORD_SIZE:] / self.counts[at][:, None], self.counts[at], axis=0))
        return word, gram


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, grad: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grad.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)


#: Takes the network and a round, returns more windows of each document.
Look = Callable[["Network", int], list[list[list[bytes]]]]


class Pool:
    """The windows learnt from: their words by number, and the document of each; none twice."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.ids, self.of = np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64)
        self.seen: set[tuple[int, bytes]] = set()

    def add(self, documents: list[list[list[bytes]]]) -> None:
        rows, of = [], []
        for at, windows in enumerate(documents):
            for window in windows:
                row = np.zeros(WINDOW, np.int64)
                row[: len(window)] = [self.number.setdefault(w, len(self.number) + 1) for w in window]
                if (key := (at, row.tobytes())) not in self.seen:
                    self.seen.add(key)
                    rows.append(row)
                    of.append(at)
        if rows:
            of = np.concatenate([self.of, of])
            order = np.argsort(of, kind="stable")
            self.ids, self.of = np.concatenate([self.ids, rows])[order], of[order]
        self.vocabulary = Vocabulary(list(self.number))

    def logits(self, net: Network) -> np.ndarray:
        return net.logits(self.ids, *net.gates(self.vocabulary.vectors(net, np.arange(len(self.number) + 1))))


def fit(documents: list[list[list[bytes]]], labels: np.ndarray, look: Look | None = None, epochs: int = 8, batch: int = 128, least_steps: int = 48) -> Network:
    """``documents``: the first windows (lists of words) of each. An epoch repeats its windows up to ``least_steps`` batches."""
    net = Network()
    if not len(labels) or labels.min() == labels.max():
        mean = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
        net.slope, net.offset = 0.0, float(np.log(mean / (1 - mean)))
        return net
    pool, adam, rng = Pool(), Adam(net.p), np.random.default_rng(5)
    pool.add(documents)
    for epoch in range(epochs):
        if look is not None and epoch in LOOKS:
            pool.add(look(net, epoch))
        of, label = pool.of, labels[pool.of].astype(np.float32)
        if epoch == 0:
            positive = np.flatnonzero(label == 1)
            negative = rng.permutation(np.flatnonzero(label == 0))[: 2 * len(positive)]
        else:
            adam.rate = 0.01 * 0.75**epoch
            scores = pool.logits(net)
            order = np.lexsort((-scores, of))
            rank = np.empty(len(of), np.int64)
            rank[order] = np.arange(len(of)) - np.repeat(np.searchsorted(of, np.unique(of)), np.bincount(of)[np.unique(of)])
            positive = np.flatnonzero((label == 1) & ((rank == 0) | ((rank == 1) & (scores > 0))))
            other = np.flatnonzero(label == 0)
            wrong = other[np.argsort(-scores[other], kind="stable")][: len(positive) // 2]
            negative = np.unique(np.concatenate([wrong, rng.permutation(other)[: 2 * len(positive)]]))
        chosen = np.concatenate([positive, negative])
        chosen = np.concatenate([rng.permutation(chosen) for _ in range(-(-least_steps * batch // len(chosen)))])
        for at in range(0, len(chosen), batch):
            some = chosen[at : at + batch]
            adam.step(net.gradients(pool.ids[some], label[some], pool.vocabulary, adam.t))
    return net


def calibrate(logit: np.ndarray, labels: np.ndarray, ridge: float = 0.01, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic regression by Newton's method; both kinds weigh the same."""
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(np.clip(x @ w, -30, 30))
        gradient = x.T @ (weight * (p - labels)) / len(labels) + ridge * (w - [1.0, 0.0])
        w -= np.linalg.solve((x.T * (weight * p * (1 - p))) @ x / len(labels) + ridge * np.eye(2), gradient)
    return float(max(w[0], 1e-3)), float(w[1])


def distinct_windows(words: list[bytes]) -> list[bytes]:
    """The text's different windows, in the order of the text."""
    return list(dict.fromkeys(b" ".join(words[s : s + WINDOW]) for s in window_starts(len(words)).tolist()))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit to ``labels`` (``doc_id``, ``toxic``); the caller leaves out labels that must not be learnt."""
    picked = labelled_sample(docs, labels.filter("toxic = 1"), "toxic", TRAIN_TOXIC).unionByName(
        labelled_sample(docs, labels.filter("toxic = 0"), "toxic", TRAIN_OTHER)
    )
    sample = stage(picked.select("doc_id", "__label__", "text", F.xxhash64("text").alias("text_hash")))
    key = ["doc_id", "__label__", "text_hash"]
    in_order = [F.xxhash64("doc_id"), *key]

    def first():
        def compute(texts):
            out = [sorted(distinct_windows(words_of(text)), key=zlib.crc32)[:FIRST_WINDOWS] for text in texts]
            return {"windows": pa.array(out, pa.list_(pa.binary()))}

        return compute

    rows = map_texts(sample, first, "windows ARRAY<BINARY>", keep=key, as_bytes=True).orderBy(*in_order).limit(TRAIN_TOXIC + TRAIN_OTHER).collect()
    number = {k: i for i, k in enumerate(dict.fromkeys(tuple(row[k] for k in key) for row in rows))}  # rows alike in all are one text
    labels_of, start = np.zeros(len(number)), [[] for _ in number]
    for row in rows:
        i = number[tuple(row[k] for k in key)]
        labels_of[i], start[i] = row["__label__"], [bytes(w).split() for w in row["windows"]]

    def highest(net: Network, round_: int) -> tuple[list[list[list[bytes]]], np.ndarray]:
        """Of all windows of each document the two highest and a few others, and the highest score."""
        shared = sample.sparkSession.sparkContext.broadcast(net)

        def begin():
            scorer = Scorer(shared.value)

            def compute(texts):
                logits, starts = scorer.windows(texts)
                out, top = [], []
                for text, scores, begins in zip(texts, logits, starts):
                    words = words_of(text)
                    window = lambda at: b" ".join(words[at : at + WINDOW])
                    best = [window(begins[k]) for k in np.argsort(-scores, kind="stable")[:2]]
                    others = sorted(range(len(begins)), key=lambda k: zlib.crc32(b"%d %d" % (round_, k)))[:MORE_WINDOWS]
                    out.append(best + [window(begins[k]) for k in others])
                    top.append(float(scores.max()))
                return {"windows": pa.array(out, pa.list_(pa.binary())), "top": pa.array(top)}

            return compute

        found, tops = [[] for _ in number], np.zeros(len(number))
        for row in map_texts(sample, begin, "windows ARRAY<BINARY>, top DOUBLE", keep=key, as_bytes=True).collect():  # a row for each learnt document
            i = number[tuple(row[k] for k in key)]
            found[i], tops[i] = [bytes(w).split() for w in row["windows"]], row["top"]
        return found, tops

    net = fit(start, labels_of, lambda net, epoch: highest(net, epoch)[0])
    if len(labels_of) and labels_of.min() < labels_of.max():
        net.slope, net.offset = calibrate(highest(net, 0)[1], labels_of)
    return net


class Scorer:
    """Scores of texts; remembers the gate inputs of distinct words."""

    def __init__(self, net: Network):
        self.net, self.number = net, {}
        width = 3 * HIDDEN
        self.gf, self.gb = np.zeros((0, width), np.float32), np.zeros((0, width), np.float32)
        self.reset()

    def reset(self) -> None:
        self.number.clear()
        self.gf, self.gb = self.net.gates(self.net.vectors([]))

    def windows(self, texts: list[bytes | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text the logits of its windows, and the windows' first words."""
        if len(self.number) > REMEMBERED:
            self.reset()
        number, known = self.number, len(self.number)
        per_text = [[number.setdefault(w, len(number) + 1) for w in words_of(t)] for t in texts]
        if len(number) > known:
            gf, gb = self.net.gates(self.net.vectors(list(number)[known:])[1:])
            self.gf, self.gb = np.concatenate([self.gf, gf]), np.concatenate([self.gb, gb])
        lengths = np.array([len(w) for w in per_text], np.int64)
        flat = np.concatenate([np.array(w, np.int64) for w in per_text] + [np.zeros(1, np.int64)])
        starts = [window_starts(n) for n in lengths.tolist()]
        counts = np.array([len(s) for s in starts])
        inside = np.concatenate(starts)[:, None] + np.arange(WINDOW)
        first, size = np.repeat(np.cumsum(lengths) - lengths, counts)[:, None], np.repeat(lengths, counts)[:, None]
        windows = np.where(inside < size, flat[np.minimum(first + inside, len(flat) - 1)], 0)
        logits = self.net.logits(windows, self.gf, self.gb)
        return np.split(logits, np.cumsum(counts)[:-1]), starts

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        top = np.array([logits.max() for logits in self.windows(texts)[0]], np.float64)
        return sigmoid(np.clip(self.net.slope * top + self.net.offset, -60, 60))


def score(docs: DataFrame, net: Network, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Documents with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def begin():
        scorer = Scorer(shared.value)

        def compute(texts):
            scores = scorer.score(texts)
            return {"score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32))}

        return compute

    return map_texts(docs, begin, "score DOUBLE, predicted INT", keep=keep, as_bytes=True)
