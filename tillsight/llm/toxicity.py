"""Toxicity: a convolutional text classifier on hashed word embeddings, in numpy.

A word's embedding is the sum of two hashed ones, of the word and of its first four bytes, so that
inflected forms share what they learn. Filters of several widths run over the words of the whole
text; each filter's largest response, with a floor of zero, is a feature of a logistic output. Only
the positions of those maxima carry gradients. The model is fitted first on some labelled
documents, then by all tasks at once on every one, and small enough to be sent to each; scores use the text alone. Thresholds per
language are calibrated on labelled documents kept out of the fit, and reported beside the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import scratch, settle, sized
from tillsight.llm.hashing import Texts, chunks

WORD_ROWS, STEM_ROWS = 1 << 16, 1 << 14
STEM_BYTES = 4
SIZE = 16  # of an embedding
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
SAMPLE = 6_000  # labelled documents that the first fit takes, at most; half of them toxic if there are so many
STEPS, EPOCHS = 30_000, (6, 40)  # documents seen while fitting, and the least and most passes that takes
ROUNDS, MOST_PARTS = 2, 64  # passes over all labelled documents where there are more, and the most partitions of one
MOVE_BLOCKS = 32
BINS = 64  # of the log odds, a unit, in which calibration documents are counted
RATE = 0.08
SCORE_BYTES = 1 << 19  # of text scored at once
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def word_rows(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of each word and of its stem, and each text's first word."""
    starts, ends, first = texts.words()
    words = texts.spans_hash(starts, ends)
    stems = texts.spans_hash(starts, np.minimum(ends, starts + STEM_BYTES))
    return ((words >> np.uint64(20)) % np.uint64(WORD_ROWS)).astype(np.int32), (
        WORD_ROWS + ((stems >> np.uint64(20)) % np.uint64(STEM_ROWS)).astype(np.int32)), first


@dataclass
class Network:
    """Embeddings, filters as one matrix per width and offset, and the output layer."""

    table: np.ndarray
    filters: list  # per width: (width, SIZE, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        return Network(
            rng.normal(0, 0.01, (WORD_ROWS + STEM_ROWS, SIZE)).astype(np.float32),
            [rng.normal(0, 0.4, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.full(len(WIDTHS) * FILTERS, 0.05, np.float32),
            rng.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def responses(self, words: np.ndarray, stems: np.ndarray, first: np.ndarray):
        """Largest response of each filter in each text, and the word where it begins (-1: none above zero)."""
        lead = max(WIDTHS) - 1
        embedded = self.table[words] + self.table[stems]
        count, texts = len(words), len(first) - 1
        tall = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
        where = np.full((texts, len(WIDTHS) * FILTERS), -1, np.int64)
        some = np.flatnonzero(np.diff(first))
        if not count:
            return tall, where, embedded
        last = np.repeat(first[1:], np.diff(first))
        padded = np.concatenate((embedded, np.zeros((lead, SIZE), np.float32)))
        for n, (width, matrix) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            cols = slice(n * FILTERS, (n + 1) * FILTERS)
            value = padded[:count] @ matrix[0] + self.bias[cols]
            for step in range(1, width):
                part = padded[step : step + count] @ matrix[step]
                part[np.arange(count) + step >= last] = 0  # words of the next text
                value += part
            best = np.maximum.reduceat(value, first[some], axis=0)
            tall[some, cols] = np.maximum(best, 0)
            if texts == 1:  # while fitting
                spot = value.argmax(axis=0)
                where[0, cols] = np.where(best[0] > 0, spot, -1)
        return tall, where, embedded

    def probability(self, words, stems, first) -> np.ndarray:
        tall, _, _ = self.responses(words, stems, first)
        return 1 / (1 + np.exp(-np.clip(tall.astype(np.float64) @ self.out + self.shift, -40, 40)))


def fresh_sums(net: Network) -> dict:
    """AdaGrad's sums of squares before the first step."""
    return {"table": np.full(len(net.table), 1e-2, np.float32), "out": np.full(len(net.out), 1e-2), "shift": 1e-2,
            "bias": np.full(len(net.bias), 1e-2), "filters": [np.full(f.shape, 1e-2, np.float32) for f in net.filters]}


def learn(net: Network, grads: dict, words: np.ndarray, stems: np.ndarray, y: int, share: dict, rate: float) -> None:
    """One AdaGrad step on one document."""
    tall, where, embedded = net.responses(words, stems, np.array([0, len(words)]))
    p = 1 / (1 + np.exp(-np.clip(float(tall[0] @ net.out) + net.shift, -40, 40)))
    error = (p - y) * share[y]
    if abs(error) < 1e-3:
        return
    back = error * net.out
    step = error * tall[0]
    grads["out"] += step * step
    net.out -= (rate * step / np.sqrt(grads["out"])).astype(np.float32)
    grads["shift"] += error * error
    net.shift -= rate * error / np.sqrt(grads["shift"])
    for n, width in enumerate(WIDTHS):
        for f in range(FILTERS):
            col = n * FILTERS + f
            at = int(where[0, col])
            if at < 0:
                continue
            g = np.float32(back[col])
            reach = min(width, len(words) - at)
            span = embedded[at : at + reach]
            kernel = net.filters[n][:reach, :, f].copy()
            step = g * span
            grads["filters"][n][:reach, :, f] += step * step
            net.filters[n][:reach, :, f] -= rate * step / np.sqrt(grads["filters"][n][:reach, :, f])
            grads["bias"][col] += g * g
            net.bias[col] -= rate * g / np.sqrt(grads["bias"][col])
            for k in range(reach):
                move = g * kernel[k]
                for row in (words[at + k], stems[at + k]):
                    grads["table"][row] += float(move @ move) / SIZE
                    net.table[row] -= rate * move / np.sqrt(grads["table"][row])


def fit(sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int | None = None, rate: float = RATE,
        state: tuple[Network, dict] | None = None, share: dict | None = None) -> Network:
    """Fit by AdaGrad, one document at a time; classes weigh the same. A ``state`` of network and sums is fitted on, in place."""
    net, grads = state or ((start := Network.fresh()), fresh_sums(start))
    rng = np.random.default_rng(9)
    positive = sum(y for *_, y in sample)
    share = share or {1: len(sample) / (2 * max(1, positive)), 0: len(sample) / (2 * max(1, len(sample) - positive))}
    passes = epochs or min(max(STEPS // len(sample), EPOCHS[0]), EPOCHS[1])
    for _ in range(passes):
        for i in rng.permutation(len(sample)):
            words, stems, y = sample[i]
            if len(words):
                learn(net, grads, words, stems, y, share, rate)
    return net


def packed(net: Network, grads: dict) -> np.ndarray:
    """All numbers of a network and its sums, as one row."""
    parts = [net.table, *net.filters, net.bias, net.out, net.shift, grads["table"], *grads["filters"], grads["bias"], grads["out"], grads["shift"]]
    return np.concatenate([np.ravel(np.asarray(p, np.float32)) for p in parts])


def unpacked(row: np.ndarray) -> tuple[Network, dict]:
    """The network and the sums of ``packed``."""
    net = Network.fresh()
    grads, at = fresh_sums(net), 0

    def take(like):
        nonlocal at
        at += np.size(like)
        return row[at - np.size(like) : at].reshape(np.shape(like)).copy()

    net.table, net.filters = take(net.table), [take(f) for f in net.filters]
    net.bias, net.out, net.shift = take(net.bias), take(net.out), float(take(0.0))
    grads["table"], grads["filters"] = take(grads["table"]), [take(f) for f in grads["filters"]]
    grads["bias"], grads["out"], grads["shift"] = take(grads["bias"]).astype(float), take(grads["out"]).astype(float), float(take(0.0))
    return net, grads


def _one_pass(shared, share: dict):
    """Task code: fit on the partition's (text, toxic) rows as they come; the moves of all numbers, cut into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = None, 0
        for batch in batches:
            marks = batch.column(1).to_pylist()
            for row, texts in chunks(batch.column(0)):
                words, stems, first = word_rows(texts)
                state = state or unpacked(shared.value)
                bags = [(words[a:b], stems[a:b], marks[row + n]) for n, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True))]
                fit(bags, 1, state=state, share=share)
                seen += len(bags)
        if seen:
            moves = np.array_split(packed(*state) - shared.value, MOVE_BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.array(range(MOVE_BLOCKS), pa.int32()), pa.array([m.tobytes() for m in moves], pa.binary())], ["block", "moves"])

    return run


def _mean_moves(group: pa.Table) -> pa.Table:
    """Task code: a number's mean move over the partitions that moved it."""
    total, times = 0.0, 0
    for moves in group["moves"]:
        move = np.frombuffer(moves.as_buffer(), np.float32)
        total, times = total + move.astype(np.float64), times + (move != 0)
    mean = (total / np.maximum(times, 1)).astype(np.float32)
    return pa.table([group["block"].slice(0, 1), pa.array([mean.tobytes()], pa.binary())], names=["block", "moves"])


def fit_on(rows: DataFrame, state: tuple[Network, dict], counts: dict) -> Network:
    """Fit a network on all (i, text, toxic) rows: passes over partitions at once, whose moves are averaged after each."""
    total = sum(counts.values())
    share = {y: total / (2 * max(1, counts.get(y, 0))) for y in (0, 1)}
    parts = min(-(-total // SAMPLE), MOST_PARTS)
    dealt = settle(rows.repartition(parts, F.xxhash64("i", "text")).sortWithinPartitions(F.xxhash64("text", "i")).select("text", "toxic"), "train")
    context, row = rows.sparkSession.sparkContext, packed(*state)
    for _ in range(ROUNDS):
        shared = context.broadcast(row)
        moved = dealt.mapInArrow(_one_pass(shared, share), "block int, moves binary").groupBy("block").applyInArrow(
            _mean_moves, "block int, moves binary").orderBy("block").collect()
        row = row + np.concatenate([np.frombuffer(m.moves, np.float32) for m in moved])
        shared.unpersist()
    return unpacked(row)[0]


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            scores = [net.probability(*word_rows(texts)) for _, texts in chunks(batch.column(0), SCORE_BYTES)]
            column = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.RecordBatch.from_arrays([column, *batch.columns[1:]], ["score", *batch.schema.names[1:]])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, part: str,
                    size: int) -> list:
    """(text, label, lang) rows: at most ``size`` of the labelled documents that ``part`` selects, by id hash."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(f"not ({HELD_OUT})").filter(part)
    rank = F.xxhash64(F.lit("toxic"), F.col("doc_id"))
    picks = [known.filter(F.col("toxic") == y).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(rank, "doc_id").limit(size // 2) for y in (1, 0)]
    picked = settle(picks[0].union(picks[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "picked")
    picked = sized(picked.withColumnRenamed("doc_id", mark := scratch("id")), size)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("text"), lang.alias("lang")).join(
        picked, F.col("i") == F.col(mark)).select("i", "text", "toxic", "lang").orderBy("i", "text").collect()


def labelled(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, part: str) -> DataFrame:
    """(i, text, toxic) of all labelled documents that ``part`` selects; texts are shuffled only where labels are too many to broadcast."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(f"not ({HELD_OUT})").filter(part)
    known = known.groupBy(F.col("doc_id").alias("i")).agg(F.max("toxic").alias("toxic"))
    known = sized(settle(known, "known"))  # ids and labels alone: the texts stay where they lie
    return docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("text"), *[c for c in ("lang",) if c in docs.columns]).join(known, "i")


class ToxicityModel:
    """A fitted network with a threshold per language; language None is for all others."""

    def __init__(self, net: Network, thresholds: dict):
        self.net, self.thresholds = net, thresholds

    def score(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """The documents' other columns and ``score``, the probability that the whole text is toxic.

        Null and empty texts get the score of no words. Rows are scored one by one, repeated or not;
        an empty table gives an empty one. A column named score is replaced.
        """
        others = [c for c in docs.columns if c not in (text_column, "score")]
        fields = "".join(f", `{n}` {t}" for n, t in docs.select(*others).dtypes)
        shared = docs.sparkSession.sparkContext.broadcast(self.net)
        return docs.select(text_column, *others).mapInArrow(_score(shared), f"score double{fields}")

    def threshold(self, lang):
        """Calibrated threshold of a language column."""
        out = F.lit(self.thresholds[None])
        for name, value in self.thresholds.items():
            if name is not None:
                out = F.when(lang == name, F.lit(value)).otherwise(out)
        return out


def calibrated(places: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The place between bins of fewest errors, both classes weighing the same; of several the one nearest 0.

    A bin spans its place and the next whole step above; ``counts`` are its documents.
    """
    edges, at = np.unique(places, return_inverse=True)
    below = {y: np.concatenate(([0], np.cumsum(np.bincount(at, counts * (labels == y), len(edges))))) for y in (0, 1)}
    if not len(edges) or not below[0][-1] or not below[1][-1]:
        return 0.0
    middles = np.concatenate(([0.0], (edges[:-1] + 1 + edges[1:]) / 2))
    before = np.searchsorted(edges, middles)
    cost = 1 - below[0][before] / below[0][-1] + below[1][before] / below[1][-1]
    best = middles[cost <= cost.min() + 1e-12]
    return float(best[np.abs(best).argmin()])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id",
                 text_column: str = "text") -> ToxicityModel:
    """Fit on all labelled documents, after a first fit on at most ``sample``; calibrate per language on all others.

    Labels come only from rows whose crc32(doc_id as text) mod 5 is not 0; of those remainder 1 is
    for calibration. ``labels`` has doc_id and toxic; null ids and other labels are left out, of
    contradicting labels toxic counts, and rows that repeat an id all train. Without labels the
    score is that of an untrained network's output for no words: 0.5.
    """
    remainder = "crc32(cast(doc_id as string)) % 5"
    train = labelled_sample(docs, labels, id_column, text_column, f"{remainder} <> 1", sample)
    bags = [(words[a:b], stems[a:b], int(train[row + n].toxic)) for row, texts in chunks(pa.array([r.text for r in train], pa.string()))
            for words, stems, first in [word_rows(texts)] for n, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True))]
    net = Network.fresh()
    sums = fresh_sums(net)
    if bags:
        fit(bags, state=(net, sums))
    else:
        net.out[:] = 0
    rows = labelled(docs, labels, id_column, text_column, f"{remainder} <> 1")
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if sum(counts.values()) > len(bags):
        net = fit_on(rows, (net, sums), counts)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    held = labelled(docs.withColumn("lang", lang), labels, id_column, text_column, f"{remainder} = 1")
    odds = F.ln(F.col("score") / (1 - F.col("score")))
    place = F.floor(F.least(F.greatest(odds, F.lit(-40.0)), F.lit(40.0)) * BINS).cast("int")
    # every calibration document counts; what comes back is a row per language, label and bin
    found = ToxicityModel(net, {}).score(held).groupBy("lang", "toxic", place.alias("place")).agg(F.count("*").alias("n")).collect()
    places, marks, counts = (np.array([r[c] for r in found], float) for c in ("place", "toxic", "n"))
    # The score itself is moved so that the threshold for all languages together is one half.
    move = calibrated(places, marks, counts)
    net.shift -= move / BINS
    thresholds = {None: 0.5}
    for name in sorted({r.lang for r in found if r.lang is not None}):
        own = np.array([r.lang == name for r in found])
        thresholds[name] = float(1 / (1 + np.exp(-calibrated(places[own] - move, marks[own], counts[own]) / BINS)))
    return ToxicityModel(net, thresholds)
