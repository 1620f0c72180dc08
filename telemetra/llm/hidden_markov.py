"""A hidden Markov language model: trained by Baum-Welch over all texts, scored by the scaled forward recursion.

Tokens are runs of other bytes than ASCII white space, A-Z lower-cased, and one end per text.

1. Tasks add up the tokens of the learnt texts, a shuffle makes one row of each: its count ``c``. Counts are never cut off.
2. States emit symbols: the end, each of the ``OWN`` most frequent words, and for all other words one of ``BUCKETS`` word
   endings (a hash of their last ``ENDING`` bytes). A bucket emits a word with probability
   ``(c + 1) / (sum of its c + its distinct words + 1)``, so a word never learnt has a share too. A text's probability
   is thus that of its symbols times that of its words in their buckets.
3. Texts become symbols once, in a written table. Each round of Baum-Welch is one pass over those of all learnt texts:
   tasks return expected counts for each symbol and state, Spark adds them up, and the driver holds the model, whose size is fixed.
   Start values come from ``FIRST_ROUNDS`` rounds on a random sample of about ``FIRST_TEXTS`` texts of up to ``FIRST_TOKENS`` tokens.
4. The forward recursion gives the exact likelihood of the symbols. Counts of the ``HEAD`` most frequent words (at most as
   many as that) go to all tasks; all other words meet their counts in an equi-join, and their logarithms are added up for each row.

Long texts: the recursions step through any length, and expected counts are exact too, as only every ``SEGMENT``-th
vector of the forward and backward run is kept, between which all segments run side by side. Words of over ``LONG_WORD`` bytes
are known by their SHA-256.

NULL and empty texts are one end. Repeated rows all learn and are all scored, NULL ids too. With nothing to learn from,
counts are 0 and symbols equally likely. Empty tables give empty results. Input columns named like a result's give way to it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from telemetra.llm.common import LOWER_ASCII, pieces
from telemetra.sources.staging import stage

STATES, ROUNDS = 8, 4
OWN, BUCKETS, ENDING = 4096, 1024, 3
HEAD = 1 << 17
LONG_WORD = 64
#: Pseudo-tokens of the overall frequencies that each state's emissions start from; pseudo-steps to each state.
SMOOTH, SMOOTH_STEPS = 50.0, 1.0
FIRST_TEXTS, FIRST_TOKENS, FIRST_ROUNDS = 400, 2048, 20
SEGMENT = 1024
#: Tokens of the texts that are run side by side, and of the segments among them.
RUN_TOKENS, SEGMENT_TOKENS = 1 << 23, 1 << 18
#: Rows of emissions looked up at once.
LOOKED_UP = 1 << 16
#: Distinct words, and their bytes, that a task adds up before it hands them on.
HELD, HELD_BYTES = 400_000, 32 << 20
#: Expected counts are added up as whole numbers of this fraction, so that their order doesn't matter.
FRACTION = 1 << 20


class Markov(NamedTuple):
    """Probabilities: of the first state, of the next state (row: from), and of symbols (row: symbol)."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray


class Side:
    """Texts of symbols, the longest first, to be stepped through side by side."""

    def __init__(self, texts: Sequence[np.ndarray]):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.symbols = np.concatenate([texts[i] for i in self.order]) if len(texts) else np.zeros(0, np.uint16)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        longest = int(self.lengths.max(initial=0))
        #: how many texts reach step t
        self.active = np.searchsorted(-self.lengths, -np.arange(longest + 1), side="left")

    def rows(self, table: np.ndarray, backwards: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """Each step t with the table's rows for its symbols; several steps are looked up at once, the more the fewer texts go on."""
        steps = len(self.active) - 1
        at = steps if backwards else 0
        while at > 0 if backwards else at < steps:
            # backwards more texts are met from step to step, so the span is chosen for those at its beginning
            span = max(1, LOOKED_UP // max(self.active[max(at - 256, 0)] if backwards else self.active[at], 1))
            low, high = (max(at - min(span, 256), 0), at) if backwards else (at, min(at + min(span, 256), steps))
            n = self.active[low]
            inside = np.minimum(np.arange(low, high)[:, None], self.lengths[:n] - 1)
            found = table.take(self.symbols.take(self.starts[:n] + inside), axis=0)
            for t in range(high - 1, low - 1, -1) if backwards else range(low, high):
                yield t, found[t - low, : self.active[t]]
            at = low if backwards else high


def forward(model: Markov, side: Side, every: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """Natural logarithm of each text's likelihood, and the state probabilities after each ``every`` steps."""
    found, kept, ones = np.zeros(len(side.lengths)), [], np.ones(len(model.first))
    state, scales = np.zeros((0, len(model.first))), np.ones(len(side.lengths))
    for t, seen in side.rows(model.emit):
        n = len(seen)
        state = seen * (model.first if t == 0 else state[:n] @ model.step)
        scale = state @ ones
        state /= scale[:, None]
        scales[:n] *= scale
        if t % 8 == 7:  # products of a few scales can't vanish
            found += np.log(scales)
            scales[:] = 1
        if every and t % every == every - 1:
            kept.append(state.copy())
    return found + np.log(scales), kept


def backward(model: Markov, side: Side, every: int) -> list[np.ndarray]:
    """Scaled backward values after each ``every`` steps."""
    states = len(model.first)
    value, ones, back = np.ones((len(side.lengths), states)), np.ones(states), np.ascontiguousarray(model.step.T)
    kept = {}
    following = None  # emissions of the step after, of the texts that have one
    for t, seen in side.rows(model.emit, backwards=True):
        if following is not None:
            n = len(following)
            on = (following * value[:n]) @ back
            on /= (on @ ones)[:, None]
            value[:n] = on
        if t % every == every - 1:
            kept[t // every] = value[: len(seen)].copy()
        following = seen
    return [kept[k] for k in sorted(kept)]


class Expected(NamedTuple):
    """Expected numbers of first states, steps and emissions (row: symbol), and the summed log-likelihood."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    likelihood: float


def expected_counts(model: Markov, texts: Sequence[np.ndarray]) -> Expected:
    """Exact expected counts of all texts.

    A text of up to ``SEGMENT`` tokens is one segment. Longer ones are run through forwards and backwards once, which
    gives the values at the ends of their segments; then all segments are alike.
    """
    states, symbols = len(model.first), len(model.emit)
    first, step, emit, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)), 0.0
    ones, back = np.ones(states), np.ascontiguousarray(model.step.T)
    side, long = Side(texts), Side([t for t in texts if len(t) > SEGMENT])  # the long ones are the first of all
    after, beyond = forward(model, long, SEGMENT)[1], backward(model, long, SEGMENT)

    # one row for each segment: its length, its text and its number in it
    counts = -(-side.lengths // SEGMENT)
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    length = np.minimum(SEGMENT, side.lengths[text] - number * SEGMENT)
    order = np.argsort(-length, kind="stable")
    blocks = np.cumsum(length[order]) // SEGMENT_TOKENS
    for some in np.split(order, np.flatnonzero(np.diff(blocks)) + 1):
        if not len(some):
            continue
        texts_of, numbers, lengths = text[some], number[some], length[some]
        starts = side.starts[texts_of] + numbers * SEGMENT
        steps = int(lengths[0])
        active = np.searchsorted(-lengths, -np.arange(steps + 1), side="left")
        at = [slice(e - n, e) for n, e in zip(active[:-1], np.cumsum(active[:-1]))]
        symbol = side.symbols[np.concatenate([starts[: active[t]] + t for t in range(steps)])]
        seen = model.emit.take(symbol, axis=0)

        later = numbers > 0
        before = np.tile(model.first, (len(some), 1))  # state probabilities before the segment, for its first step
        value = np.ones((len(some), states))  # backward values at its end
        ends = side.lengths[texts_of] > (numbers + 1) * SEGMENT
        for k in np.unique(numbers[later]):
            of = numbers == k
            before[of] = after[k - 1][texts_of[of]]
        for k in np.unique(numbers[ends]):
            of = ends & (numbers == k)
            value[of] = beyond[k][texts_of[of]]

        prior, state = np.empty_like(seen), np.empty_like(seen)
        prior[at[0]] = np.where(later[:, None], before @ model.step, before)
        for t, now in enumerate(at):
            if t:
                np.matmul(state[at[t - 1]][: active[t]], model.step, out=prior[now])
            np.multiply(prior[now], seen[now], out=state[now])
            scale = state[now] @ ones
            state[now] /= scale[:, None]
            likelihood += float(np.log(scale).sum())
        for t in range(steps - 1, -1, -1):
            now, n = at[t], active[t]
            here = seen[now]
            here *= value[:n]
            here /= ((prior[now] * here) @ ones)[:, None]
            if t:
                step += state[at[t - 1]][:n].T @ here
                on = here @ back
                on /= (on @ ones)[:, None]
                value[:n] = on
        step += before[later].T @ seen[at[0]][later]
        prior *= seen  # the probability of each state at each step
        first += prior[at[0]][~later].sum(axis=0)
        for s in range(states):
            emit[:, s] += np.bincount(symbol, weights=prior[:, s], minlength=symbols)
    return Expected(first, step * model.step, emit, likelihood)


def improved(model: Markov, counts: Expected, overall: np.ndarray) -> Markov:
    """The model that the expected counts give, smoothed towards the overall frequencies of symbols."""
    first = counts.first + SMOOTH_STEPS
    step = counts.step + SMOOTH_STEPS
    emit = counts.emit + SMOOTH * overall[:, None]
    return Markov(first / first.sum(), step / step.sum(axis=1)[:, None], emit / emit.sum(axis=0))


def start_values(overall: np.ndarray, states: int, seed: int = 0) -> Markov:
    random = np.random.default_rng(seed)
    emit = overall[:, None] * np.exp(random.normal(0, 0.5, (len(overall), states)))
    step = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Markov(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def _key(word: bytes) -> bytes:
    """The word, or for a long one what no word can be: a space and its digest."""
    return word if len(word) <= LONG_WORD else b" " + hashlib.sha256(word).hexdigest().encode()


def _bucket(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % BUCKETS


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER_ASCII).split()


class Vocabulary(NamedTuple):
    """Counts over the learnt texts, and the frequent words of them."""

    counts: DataFrame  # word, n: one row for each distinct word
    tokens: int
    distinct: int
    ends: int
    words: list[bytes]  # by falling count; the first ``own`` of them are symbols
    log_count: np.ndarray  # log10(c + 1) of each of those words
    in_bucket: np.ndarray  # log10 of the denominators of buckets
    overall: np.ndarray  # frequencies of symbols
    own: int


def count_words(docs: DataFrame, text: str = "text", own: int = OWN, head: int = HEAD) -> Vocabulary:
    """All counts of the learnt texts. Only the ``head`` most frequent words, fewer if counts tie, come to the driver."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = ends = 0

        def hand_on() -> pa.RecordBatch:
            words = pa.array([_key(w) for w in held], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([_bucket(w) for w in held], pa.int32()), pa.array(list(held.values()), pa.int64())], names=["word", "bucket", "n"])

        for batch in batches:
            for piece in pieces(batch, "text"):
                for whole in piece.column("text").to_pylist():
                    tokens = _tokens(whole)
                    held.update(tokens)
                    ends += 1
                    size += len(whole or "")
                    if len(held) >= HELD or size >= HELD_BYTES:
                        yield hand_on()
                        held.clear()
                        size = 0
        yield hand_on()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([None], pa.int32()), pa.array([ends], pa.int64())], names=["word", "bucket", "n"])

    source = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    counted = source.mapInArrow(add_up, "word STRING, bucket INT, n LONG").groupBy("word", "bucket").agg(F.sum("n").alias("n"))
    # classes of counts, 32 for each doubling: few rows, from which a bound for the frequent words is read
    counted = stage(counted.where("n > 0").withColumn("class", F.floor(32 * F.log2("n")).cast("int")))
    words = counted.where("word IS NOT NULL")
    ends = sum(r["n"] for r in counted.where("word IS NULL").collect())
    classes = sorted(words.groupBy("class").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect(), key=lambda r: -r["class"])
    within, least = 0, None
    for row in classes:
        within += row["words"]
        if within > head:
            break
        least = row["class"]
    frequent = [] if least is None else words.where(F.col("class") >= least).select("word", "n", "bucket").collect()
    frequent.sort(key=lambda r: (-r["n"], r["word"]))
    own = min(own, len(frequent))
    bucket_n, bucket_words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in words.groupBy("bucket").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect():
        bucket_n[r["bucket"]], bucket_words[r["bucket"]] = r["n"], r["words"]
    for r in frequent[:own]:
        bucket_n[r["bucket"]] -= r["n"]
        bucket_words[r["bucket"]] -= 1
    symbols = np.concatenate([[ends], [r["n"] for r in frequent[:own]], bucket_n]) + 1.0
    return Vocabulary(
        words.select("word", "n"),
        sum(r["n"] for r in classes) + ends,
        sum(r["words"] for r in classes) + (ends > 0),
        ends,
        [r["word"].encode() for r in frequent],
        np.array([math.log10(r["n"] + 1) for r in frequent]),
        np.log10(bucket_n + bucket_words + 1),
        symbols / symbols.sum(),
        own,
    )


_ENCODED = "row LONG, learn BOOLEAN, n_tokens LONG, symbols BINARY, n_head LONG, log_counts DOUBLE, in_buckets DOUBLE, tail ARRAY<STRUCT<word: STRING, n: LONG>>"


def encoded(docs: DataFrame, learn: Column, vocabulary: Vocabulary, keep: Sequence[str], text: str = "text") -> DataFrame:
    """A written table of ``keep`` (prefixed ``kept_``), symbols, sums over frequent words, and the other words of every text."""
    source = docs.select(
        *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep],
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kept = [source.schema[f"kept_{c}"] for c in keep]
    schema = T.StructType([*kept, *T._parse_datatype_string(_ENCODED).fields])
    words, own, size = vocabulary.words, vocabulary.own, len(vocabulary.words)
    end_log = math.log10(vocabulary.ends + 1)
    log_count, in_bucket, ends = vocabulary.log_count, vocabulary.in_bucket, vocabulary.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = {w: i for i, w in enumerate(words)}
        bucket_of = np.array([_bucket(w) for w in words], np.int64)
        symbol = np.where(np.arange(size) < own, np.arange(size) + 1, own + 1 + bucket_of)
        share = np.where(np.arange(size) < own, 0.0, log_count - in_bucket[bucket_of])
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [_tokens(text) for text in piece.column("text").to_pylist()]
                lengths = np.array([len(t) for t in texts], np.int64)
                tokens = [w for t in texts for w in t]
                of = np.repeat(np.arange(len(texts)), lengths)
                place = np.fromiter(map(place_of.get, tokens, repeat(-1)), np.int64, len(tokens))
                common = place >= 0
                symbols, logs, shares = np.zeros(len(tokens), np.int64), np.zeros(len(tokens)), np.zeros(len(tokens))
                symbols[common], logs[common], shares[common] = symbol[place[common]], log_count[place[common]], share[place[common]]

                # other words: numbered, so that each distinct one is looked at once
                number: defaultdict[bytes, int] = defaultdict()
                number.default_factory = number.__len__
                rest = np.flatnonzero(~common)
                ids = np.fromiter(map(number.__getitem__, [tokens[i] for i in rest]), np.int64, len(rest))
                keys = [_key(w) for w in number]
                bucket = np.array([_bucket(w) for w in number], np.int64)
                known = np.array([place_of.get(k, -1) if len(w) > LONG_WORD else -1 for w, k in zip(number, keys)], np.int64)
                log = np.where(known >= 0, np.append(log_count, 0.0)[known], 0.0)
                own_word = (known >= 0) & (known < own)
                symbols[rest] = np.where(own_word, known + 1, own + 1 + bucket)[ids]
                logs[rest], shares[rest] = log[ids], np.where(own_word, 0.0, log - in_bucket[bucket])[ids]
                joined = known[ids] < 0
                pairs, times = np.unique(of[rest[joined]] * len(number) + ids[joined], return_counts=True)
                tail_row, tail_id = np.divmod(pairs, max(len(number), 1))
                tail = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(tail_row, np.arange(len(texts) + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(keys, pa.binary()).cast(pa.string()).take(pa.array(tail_id)), pa.array(times, pa.int64())], names=["word", "n"]),
                )

                with_ends = np.zeros(len(tokens) + len(texts), np.uint16)
                with_ends[np.arange(len(tokens)) + of] = symbols
                offsets = np.append(0, np.cumsum(2 * (lengths + 1))).astype(np.int32)
                total = lambda values: np.bincount(of, values, len(texts)).astype(float)
                n_rest = np.bincount(of[rest[joined]], minlength=len(texts))
                arrays = [
                    *[piece.column(f.name) for f in kept],
                    piece.column("row"),
                    piece.column("learn"),
                    pa.array(lengths + 1),
                    pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(with_ends.tobytes())]),
                    pa.array(lengths - n_rest + (ends > 0)),
                    pa.array(total(logs) + end_log),
                    pa.array(total(shares)),
                    tail,
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return stage(source.mapInArrow(run, schema))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with about ``RUN_TOKENS`` symbols, one text at least."""
    for batch in batches:
        texts = [np.frombuffer(s, np.uint16) for s in batch.column("symbols").to_pylist()]
        block = np.cumsum([len(t) for t in texts], dtype=np.int64) // RUN_TOKENS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start), texts[start:end]


def _round(texts: DataFrame, model: Markov) -> Expected:
    """Expected counts over all texts, added up by Spark."""
    symbols, states = model.emit.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows: symbols; then steps from each state; then first states
        total = np.zeros((symbols + states + 1, states))
        for _, some in _runs(batches):
            found = expected_counts(model, some)
            total += np.concatenate([found.emit, found.step, found.first[None, :]])
        whole = np.round(total * FRACTION).astype(np.int64)
        places = np.flatnonzero(whole.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), *[pa.array(whole[places, s]) for s in range(states)]], names=["place", *[f"s{s}" for s in range(states)]])

    names = [f"s{s}" for s in range(states)]
    sums = texts.select("symbols").mapInArrow(count, "place LONG, " + ", ".join(f"{n} LONG" for n in names))
    total = np.zeros((symbols + states + 1, states))
    for row in sums.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).collect():  # a row for each symbol and state
        total[row["place"]] = [row[n] / FRACTION for n in names]
    return Expected(total[-1], total[symbols:-1], total[:symbols], 0.0)


def train(texts: DataFrame, overall: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Markov:
    """Baum-Welch over all of an ``encoded`` table's learnt texts."""
    learnt = texts.where("learn")
    model = start_values(overall, states)
    short = learnt.where(F.col("n_tokens") <= FIRST_TOKENS)
    total = short.count()
    if total:
        share = int(min(1.0, FIRST_TEXTS / total) * (1 << 30))
        rows = short.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share).select("symbols").limit(2 * FIRST_TEXTS).collect()
        sample = [np.frombuffer(bytes(r["symbols"]), np.uint16) for r in rows]
        for _ in range(FIRST_ROUNDS if sample else 0):
            model = improved(model, expected_counts(model, sample), overall)
    for _ in range(rounds if not learnt.isEmpty() else 0):
        model = improved(model, _round(learnt, model), overall)
    return model


def score(texts: DataFrame, model: Markov, vocabulary: Vocabulary, keep: Sequence[str]) -> DataFrame:
    """``keep`` and n_tokens, n_known, train_tokens, base_score, score (log10) of every row of an ``encoded`` table."""

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, some in _runs(batches):
            side = Side(some)
            found = np.empty(len(some))
            found[side.order] = forward(model, side)[0] / math.log(10)
            columns = [c for c in piece.schema.names if c != "symbols"]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in columns], pa.array(found)], names=[*columns, "likelihood"])

    narrow = texts.drop("learn", "tail").select("*").drop("symbols")
    with_symbols = texts.select(*narrow.columns, "symbols")
    scored = with_symbols.mapInArrow(likelihoods, T.StructType([*narrow.schema.fields, T.StructField("likelihood", T.DoubleType())]))
    rest = texts.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
    rest = rest.join(vocabulary.counts, "word").groupBy("row").agg(F.sum("times").alias("n_rest"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest"))
    base = F.col("n_tokens") * F.lit(math.log10(vocabulary.tokens + vocabulary.distinct + 1))
    more = F.coalesce("rest", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        *[F.col(f"kept_{c}").alias(c) for c in keep],
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + more - base).alias("base_score"),
        (F.col("likelihood") + F.col("in_buckets") + more).alias("score"),
    )


def language_scores(docs: DataFrame, learn: Column, keep: Sequence[str] = ("doc_id",), text: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """The whole of it: counts, training on the rows that ``learn`` picks, and the scores of all rows."""
    vocabulary = count_words(docs.where(learn), text)
    texts = encoded(docs, learn, vocabulary, keep, text)
    return score(texts, train(texts, vocabulary.overall, states, rounds), vocabulary, keep)
