"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

An n-gram (one to ``LONGEST`` code points of the lower-cased text) falls into one of ``BUCKETS``
hashed features. Its term frequency is its share of the text's n-grams; its inverse document frequency
comes from all documents that may be learnt from. The weights are trained by
follow-the-regularised-leader with L1 and L2 penalties, per coordinate, on a bounded sample
(``TRAIN_ROWS`` documents first in the order of a hash of their ids, an equal bound for each language; the number
of languages has no bound), and a temperature is fitted on a fifth of it that training doesn't see. As a term frequency
is a share, a text's score is one sum over its n-grams: whole texts are scored in numpy
without being cut.

``und`` with score 0: NULL texts, empty ones and those without a letter, and all texts if nothing can be learnt.
Rows with a NULL language aren't learnt. Repeated rows get equal predictions; empty tables give
empty results; columns named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from telemetra.llm.common import KEPT, map_texts, pieces

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
LONGEST = 3
TRAIN_ROWS = 800
SLICES = 64
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(0x9E3779B1)


def grams(text: str) -> list[np.ndarray]:
    """The buckets of all n-grams, an array for each n."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found, hashed = [], np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            break
        hashed = (hashed[: len(codes) - n + 1] ^ codes[n - 1 :]) * _MIX
        hashed ^= hashed >> np.uint32(15)
        found.append((hashed * _MIX) >> np.uint32(32 - BUCKET_BITS))
    return found


def all_grams(text: str | None) -> np.ndarray:
    return np.concatenate(grams(text)) if text else np.zeros(0, np.uint32)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many of them each bucket occurs; over all of ``docs``."""

    def count(batches):
        total, n = np.zeros(BUCKETS + 1, np.int64), 0
        last = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                for text in piece.column("text").to_pylist():
                    found = all_grams(text)
                    if len(found):
                        position = np.arange(len(found))
                        last[found] = position
                        total[found[last[found] == position]] += 1  # each bucket once
                    n += 1
        total[BUCKETS] = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket LONG, n LONG").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows
    values = np.zeros(BUCKETS + 1, np.int64)
    values[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return int(values[BUCKETS]), values[:BUCKETS]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, times the inverse document frequency
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for found in grams(text):
            for at in range(0, len(found), 1 << 15):
                block = found[at : at + (1 << 15)]
                total += self.weights[block].sum(axis=0, dtype=np.float64)
            n += len(found)
        return self.bias + total / max(n, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = 0.6, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3, updates: int = 12_000) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x classes) and bias. A row: features, values, class. Feature ``BUCKETS`` is the bias.

    The rows are passed over, each time in another order, until there have been ``updates`` of them.
    """
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weight(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(-(-updates // max(len(rows), 1)) if rows else 0):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, value, label = rows[i]
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            w = weight(at)
            p = softmax(value @ w)
            p[label] -= 1
            g = value[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = np.concatenate([weight(slice(at, at + (1 << 12))) for at in range(0, BUCKETS + 1, 1 << 12)])
    return w[:BUCKETS], w[BUCKETS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, on a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit to ``text`` and ``lang`` of ``docs``; the caller leaves out documents that must not be learnt from."""
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''").select("doc_id", "lang", "text")
    n, frequency = document_frequencies(usable)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    if not n:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    # Rows of a language in the order of a hash, first within slices of it, so that no task has a whole language.
    order = [F.xxhash64("doc_id", F.lit(3)).alias("h"), F.xxhash64("text").alias("t")]
    first = usable.select("doc_id", "lang", *order)
    for by in (["lang", F.pmod("h", F.lit(SLICES))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id", "t"))
        first = first.withColumn("r", place).filter(F.col("r") <= rows).drop("r")
    first = first.groupBy("lang", "doc_id", "t").agg(F.min("h").alias("h"))
    languages = [r["lang"] for r in first.select("lang").distinct().orderBy("lang").collect()]
    chosen = first.select("doc_id", "lang", "t")  # at most rows x languages

    def begin():
        def compute(texts):
            found = [np.unique(all_grams(t), return_counts=True) for t in texts]
            return {
                "at": pa.array([a.astype("<u4").tobytes() for a, _ in found], pa.binary()),
                "times": pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
            }

        return compute

    texts = usable.join(F.broadcast(chosen.withColumnRenamed("t", "__t")), ["doc_id", "lang"]).filter(F.xxhash64("text") == F.col("__t"))
    sparse = map_texts(texts, begin, "at BINARY, times BINARY", keep=["doc_id", "lang", "__t"]).dropDuplicates(["doc_id", "lang", "__t"])
    data, held, number, learnt = [], [], {name: i for i, name in enumerate(languages)}, set()
    for row in sparse.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "lang", "at").toLocalIterator():
        at, times = np.frombuffer(row["at"], "<u4").astype(np.int64), np.frombuffer(row["times"], "<u4")
        item = (at, times / times.sum() * idf[at], number[row["lang"]])
        (held if (len(data) + len(held)) % 5 == 4 and item[2] in learnt else data).append(item)  # each language's first row is learnt
        learnt.add(item[2])
    weights, bias = train_ftrl(data, len(languages))
    logits = np.array([bias + v @ weights[a] for a, v, _ in held]).reshape(len(held), len(languages))
    temperature = fit_temperature(logits, np.array([c for *_, c in held], np.int64))
    weights *= idf[:, None]
    return Model(languages, weights.astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, least_score: float | None = None) -> DataFrame:
    """Documents with ``lang_pred`` and ``score``; with ``least_score`` only those identified at least so surely."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        def compute(texts):
            found = [shared.value.predict(t) for t in texts]
            new = {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}
            if least_score is not None:
                new[KEPT] = [f[0] != UNKNOWN and f[1] >= least_score for f in found]
            return new

        return compute

    return map_texts(docs, begin, "lang_pred STRING, score DOUBLE", keep=keep)
