"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Byte n-grams are hashed to ``BUCKETS``; pairs of equal and of different neighbouring words have a
bucket each. One model counts the raw documents, all of them, the other those labelled good. A
document's log weight is the mean over its n-grams of log p_target - log p_raw, with ``LEAN``
neutral n-grams added so that a few words decide little. Sampling k documents without replacement
with probability proportional to their weight is taking the k largest of log weight + Gumbel noise.
The noise comes from a hash of the id, so that reruns agree; ``temperature`` scales it.

One labelled row in five is left out of the target. By default k is the number of documents above
the log weight that best parts those left out from the rows labelled bad.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import scratch, settle, sized
from tillsight.llm.hashing import Texts, chunks, runs

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
CELLS = BUCKETS + 2  # and two for word pairs
GRAM = 4  # bytes
MAX_LABELS = 500_000  # labelled rows that the target model is fitted on, at most
PRIOR = 20.0  # n-grams by which the target model leans on the raw one in every bucket
LEAN = 50  # neutral n-grams added to every document
KEEP = 10.0  # a good document lost counts as many bad ones kept
SALT = "gumbel-1"


HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def gram_buckets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte ``GRAM``-gram and word pair, and the number of each one's text.

    A pair counts as equal or different words only, so that runs of one word stand out whichever it is.
    """
    data, rows = texts.data, np.arange(len(texts.offsets) - 1)
    count = max(0, len(data) - GRAM + 1)
    code = np.zeros(count, np.uint64)
    for step in range(GRAM):
        code = (code << np.uint64(8)) | data[step : step + count]
    owner = np.repeat(rows, np.diff(texts.offsets))
    whole = owner[:count] == owner[GRAM - 1 :] if count else np.empty(0, bool)
    code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)
    starts, ends, first = texts.words()
    words = texts.spans_hash(starts, ends, lower=False)
    of_word = np.repeat(rows, np.diff(first))
    paired = of_word[1:] == of_word[:-1]
    pairs = np.where(words[1:] == words[:-1], BUCKETS, BUCKETS + 1)[paired]
    return np.concatenate((code[whole].astype(np.int64), pairs)), np.concatenate((owner[:count][whole], of_word[1:][paired]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, target) to (bucket, raw, target): one row per bucket and task."""
    raw, target = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    for batch in batches:
        marks = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for row, texts in chunks(batch.column(0)):
            buckets, owners = gram_buckets(texts)
            raw += np.bincount(buckets, minlength=CELLS)
            target += np.bincount(buckets[marks[row + owners]], minlength=CELLS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            sums, sizes = [], []
            for _, texts in chunks(batch.column(0)):
                buckets, owners = gram_buckets(texts)
                count = len(texts.offsets) - 1
                sums.append(np.bincount(owners, ratio[buckets], minlength=count))
                sizes.append(np.bincount(owners, minlength=count))
            columns = [pa.array(np.concatenate(sums), pa.float64()), pa.array(np.concatenate(sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns + batch.columns[1:], ["log_weight", "n_grams", *batch.schema.names[1:]])

    return run


def fit_log_ratio(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """log p_target - log p_raw per bucket, as a numpy array.

    ``labels`` has doc_id and quality; the target is quality 1. Of more than MAX_LABELS labelled
    rows those with the smallest id hash are used. Without any, all ratios are zero.
    """
    good = labels.filter("quality = 1 and doc_id is not null").filter(f"not ({HELD_OUT})").select("doc_id").distinct()
    target, mark = scratch("target"), scratch("mark")
    good = settle(good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS), "good")
    marked = docs.select(F.col(id_column).alias(mark), F.col(text_column).alias("text")).join(
        sized(good.select(F.col("doc_id").alias(mark), F.lit(True).alias(target)), MAX_LABELS), mark, "left")
    counts = (marked.select("text", F.coalesce(target, F.lit(False)).alias(target))
              .mapInArrow(_count, "bucket bigint, raw bigint, target bigint")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    rows = counts.toPandas()  # at most CELLS rows
    raw, aim = np.zeros(CELLS), np.zeros(CELLS)
    raw[rows["bucket"]] = rows["raw"].to_numpy(float)
    aim[rows["bucket"]] = rows["target"].to_numpy(float)
    if not aim.sum():
        return np.zeros(CELLS)
    return np.log((aim + PRIOR) / (raw * (aim.sum() / raw.sum()) + PRIOR))


def weigh(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          temperature: float = 0.001) -> DataFrame:
    """id, log_weight, n_grams and gumbel_score of every document row."""
    ratio = fit_log_ratio(docs, labels, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    kind = dict(docs.dtypes)[id_column]
    scored = docs.select(F.col(text_column), F.col(id_column).alias("doc_id")).mapInArrow(
        _score(shared), f"log_weight double, n_grams bigint, doc_id {kind}").withColumn(
        "log_weight", F.col("log_weight") / (F.col("n_grams") + LEAN))
    uniform = F.pmod(F.xxhash64(F.lit(SALT), F.col("doc_id")), F.lit(1 << 52)) + F.lit(0.5)
    noise = -F.log(-F.log(uniform / F.lit(float(1 << 52))))
    return scored.select("doc_id", "log_weight", "n_grams",
                         (F.col("log_weight") + F.lit(temperature) * noise).alias("gumbel_score"))


def select_quality(docs: DataFrame, labels: DataFrame, k: int | None = None, id_column: str = "doc_id",
                   text_column: str = "text", temperature: float = 0.001) -> DataFrame:
    """The k documents that importance resampling draws: doc_id, log_weight, n_grams, gumbel_score.

    Texts shorter than an n-gram have weight zero. Every row takes part: rows that repeat an id draw
    the same noise, rows with a null id one noise together, and ties at the cut all come along.
    Without good labels all weights are zero; without bad ones, or none of the good left out, k
    counts the weights of zero or more. An empty table gives no rows; other columns have no
    influence.
    """
    scored = settle(weigh(docs, labels, id_column, text_column, temperature), "weights")
    wanted = k if k is not None else scored.filter(F.col("log_weight") >= dividing_weight(scored, labels)).count()
    if wanted <= 0:
        return scored.limit(0)
    return scored.filter(F.col("gumbel_score") >= F.lit(kth_largest(scored, "gumbel_score", wanted)))


def dividing_weight(scored: DataFrame, labels: DataFrame) -> float:
    """The log weight that parts the good rows left out of the target from the bad ones; of several the middle."""
    marked = labels.filter("quality = 0 or quality = 1").filter("doc_id is not null").filter(
        f"quality = 0 or {HELD_OUT}").select("doc_id", "quality").distinct()
    marked = settle(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS), "marked")
    rows = scored.join(sized(marked, MAX_LABELS), "doc_id").select("log_weight", "quality").limit(2 * MAX_LABELS).toPandas()
    good = np.sort(rows["log_weight"][rows["quality"] == 1].to_numpy())
    bad = np.sort(rows["log_weight"][rows["quality"] == 0].to_numpy())
    if not len(good) or not len(bad):
        return 0.0
    values = np.unique(np.concatenate((good, bad)))
    values = np.append(values, values[-1] + 1)
    cost = KEEP * np.searchsorted(good, values) + len(bad) - np.searchsorted(bad, values)
    best = np.flatnonzero(cost == cost.min())
    top = values[best[0]]  # what is at or above stays
    below = values[best[0] - 1] if best[0] else top
    return float((top + below) / 2)


def kth_largest(df: DataFrame, column: str, k: int, cells: int = 4096) -> float:
    """The k-th largest value of a column: histograms of ``cells`` cells, narrowed until the cell is small.

    All of ``df`` at k beyond its rows. Only histograms and at most 20,000 values reach the driver.
    """
    low, high, total = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= total:
        return low if low is not None else 0.0
    inside = F.col(column).isNotNull()
    while True:
        size = df.filter(inside).count()
        if size <= 20_000 or high <= low:
            values = df.filter(inside).select(column).orderBy(F.desc(column)).limit(k).tail(1)
            return values[0][0]
        cell = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) / cells)), F.lit(cells - 1))
        counted = df.filter(inside).groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(counted, key=lambda r: -r["cell"]):
            if row["n"] >= k:
                inside = inside & F.col(column).between(row["low"], row["high"])
                low, high = row["low"], row["high"]
                break
            k -= row["n"]


def keep_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 **options) -> DataFrame:
    """The rows of the documents that ``select_quality`` draws."""
    drawn = select_quality(docs, labels, id_column=id_column, text_column=text_column, **options)
    mark = scratch("kept")
    drawn = sized(settle(drawn.select(F.col("doc_id").alias(mark)).distinct(), "drawn"))
    return docs.join(drawn, docs[id_column].eqNullSafe(drawn[mark]), "left_semi")
