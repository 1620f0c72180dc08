"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

Every text becomes a few dozen numbers (lengths, shares of kinds of characters, repetition of
words and lines). Trees are grown level by level on binned features with gradients and hessians of
the logistic loss, then flattened: node k of a tree has children 2k+1 and 2k+2, so that all
documents of a batch descend all trees together in ``depth`` numpy steps.

The trees are fitted to a bounded sample, ``TRAIN_ROWS`` labelled documents first in the order of
a hash of their ids; it goes to the driver as numbers. Scoring reads every whole text. NULL and empty
texts have all-zero statistics and get their score like others. Labels that are NULL or whose
document is missing are not learnt; of contradicting labels of an id the larger holds. Without
labels, or with one kind only, every score is the share of ones (0.5 without any). Columns named like an
added one are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import map_texts

TRAIN_ROWS = 12_000
BINS = 48
_SIGNS = [ord(c) for c in "|!?.,;:*#$%&@/\\<>{}[]()_=+~^\"'-"]


def statistics(text: bytes | None) -> list[float]:
    text = text or b""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digit, space, newline = (int(c) for c in (counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[32], counts[10]))
    beyond = int(counts[128:].sum())
    signs = counts[_SIGNS]
    words, lines = text.split(), text.split(b"\n")
    of_word, of_line = Counter(words), Counter(lines)
    w, ln, m = max(len(words), 1), max(len(lines), 1), max(n, 1)
    share = counts[counts > 0] / m
    repeated = sum(len(x) * c for x, c in of_line.items() if c > 1)
    ends = sum(c for x, c in of_word.items() if not (x[-1:].isalnum() or x[-1] >= 128))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)),
        upper / m, lower / m, digit / m, space / m, newline / m, beyond / m,
        signs.sum() / m, *(signs[:12] / m), signs[12:].sum() / m,
        n / w, len(of_word) / w, max(of_word.values(), default=0) / w,
        sum(c for x, c in of_word.items() if len(x) <= 3) / w, sum(c for x, c in of_word.items() if len(x) >= 12) / w, ends / w,
        sum(c for x, c in of_word.items() if x.isupper()) / w,
        n / ln, len(of_line) / ln, repeated / m, max(map(len, lines)) / m,
        float(-(share * np.log2(share)).sum()),
    ]


@dataclass
class Trees:
    """``feature``, ``threshold``: trees x inner nodes; ``leaf``: trees x leaves; a value above the threshold goes right."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        trees, inner = self.feature.shape
        tree = np.arange(trees)
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range(inner.bit_length()):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, node - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, ridge: float = 2.0, least: float = 3.0) -> Trees:
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    inner, n_features = (1 << depth) - 1, x.shape[1]
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)  # x > edges[b] iff bin > b
    offset = np.arange(n_features) * BINS
    raw = np.full(len(y), base)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            at = ((node - first)[:, None] * (n_features * BINS) + offset + binned).ravel()
            size = width * n_features * BINS
            gs = np.bincount(at, np.repeat(g, n_features), size).reshape(width, n_features, BINS).cumsum(axis=2)
            hs = np.bincount(at, np.repeat(h, n_features), size).reshape(width, n_features, BINS).cumsum(axis=2)
            gr, hr = gs[..., -1:] - gs, hs[..., -1:] - hs
            gain = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - gs[..., -1:] ** 2 / (hs[..., -1:] + ridge)
            gain[(hs < least) | (hr < least)] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    out.feature[t, first + k], out.threshold[t, first + k] = f, edges[f][b]
            feature, threshold = out.feature[t, node], out.threshold[t, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature] > threshold)
        leaf = node - inner
        gl, hl = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        out.leaf[t] = rate * gl / (hl + ridge)
        raw += out.leaf[t][leaf]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int = 7) -> DataFrame:
    """Up to ``rows`` documents with ``label``: those whose ids come first in the order of a hash.

    The chosen labels have a proven bound and are broadcast; the texts aren't shuffled.
    """
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("__label__"))
    # Hashes are even, so a share of them leaves about twice the rows to sort, however many labels there are.
    share = min(1.0, 2 * (rows + 500) / max(chosen.count(), 1))
    chosen = chosen.filter(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20))).orderBy(order, "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Fit to ``labels`` (``doc_id``, ``quality``); the caller leaves out labels that must not be learnt."""
    sample = labelled_sample(docs, labels, "quality", rows)

    def begin():
        return lambda texts: {"x": pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))}

    numbers = map_texts(sample, begin, "x ARRAY<DOUBLE>", keep=["doc_id", "__label__"], as_bytes=True)
    found = numbers.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(rows).toPandas()  # repeated ids too stay within the bound
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(statistics(b"")))
    return fit(x, found["__label__"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Documents with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def begin():
        def compute(texts):
            scores = shared.value.score(np.array([statistics(t) for t in texts], float))
            return {"score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32))}

        return compute

    return map_texts(docs, begin, "score DOUBLE, predicted INT", keep=keep, as_bytes=True)
