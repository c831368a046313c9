"""Line dedup on levelled sorted runs of line hashes.

A run is a table of (line, docs): a 64-bit line hash and the number of documents that hold it,
bucketed by the hash and sorted in each bucket, so that runs merge without a shuffle. A batch of
documents is cut into (line, document) rows, summed to one row per line and merge-anti-joined
with the lines already known to be frequent; what is left becomes a run of level 0. When a level has
two runs, they are merged into one of the next level, and lines that have reached the threshold
move to the frequent runs. Only hashes and numbers are kept, never lines.

Runs are merged by an outer join on the line, never by a union and a sum: Spark 4.1 takes a union of
equally bucketed tables to be bucketed itself and leaves the shuffle out, but does not line the
buckets up when it scans by columns, so that the sums come out in parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.base import release, scratch, settle
from tillsight.llm.hashing import chunks
from tillsight.session import new_path

BATCHES = 4


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to one (id, line) per distinct non-blank line of a row."""
    for batch in batches:
        for row, texts in chunks(batch.column(1)):
            starts, ends, first = texts.lines()
            starts, ends = texts.stripped(starts, ends)
            hashes = texts.spans_hash(starts, ends)
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            some = ends > starts
            pairs = np.unique(np.rec.fromarrays([owner[some], hashes[some].view(np.int64)], names="o,h"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row + pairs.o)), pa.array(np.ascontiguousarray(pairs.h))],
                ["id", "line"])


def line_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, line): the distinct keys of every row's non-blank lines."""
    kind = dict(docs.dtypes)[id_column]
    pairs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return pairs.mapInArrow(_line_hashes, f"id {kind}, line bigint")


class LineRuns:
    """Levelled runs in the shared folder; ``close`` drops their catalog entries."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, buckets: int | None = None):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = {}
        self.frequent_runs: list[str] = []
        self.names: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.select("line", "docs").repartition(self.buckets, "line").write.bucketBy(self.buckets, "line")
         .sortBy("line").option("path", new_path(self.spark, "run")).saveAsTable(name))
        self.names.append(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """(line, docs) of several runs, one row per line, in a merge join of each next run."""
        out = self.spark.table(names[0]).select("line", "docs")
        for name in names[1:]:
            more = self.spark.table(name).select("line", F.col("docs").alias("more"))
            out = out.join(more, "line", "full_outer").select(
                "line", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))
        return out

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose ``line`` is in no run yet, for dedup as the batches come."""
        for name in [n for level in self.levels.values() for n in level] + self.frequent_runs:
            rows = rows.join(self.spark.table(name), "line", "left_anti")
        return rows

    def add(self, counts: DataFrame) -> None:
        """Add a batch's (line, docs); lines already frequent need no further count."""
        for name in self.frequent_runs:
            counts = counts.join(self.spark.table(name), "line", "left_anti")
        self.levels.setdefault(0, []).append(self._write(counts))
        level = 0
        while len(self.levels.get(level, ())) > 1:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """Merge the runs of a level into one of the next."""
        merged = settle(self._merged(self.levels[level]), "merged")
        self.levels[level] = []
        self.frequent_runs.append(self._write(merged.filter(F.col("docs") >= self.min_docs)))
        self.levels.setdefault(level + 1, []).append(
            self._write(merged.filter(F.col("docs") < self.min_docs)))
        release(merged)

    def frequent(self) -> DataFrame:
        """The lines found in at least ``min_docs`` documents of all batches together."""
        parts = [self.spark.table(name).select("line") for name in self.frequent_runs]
        names = [n for level in self.levels.values() for n in level]
        if names:
            rest = self._merged(names).filter(F.col("docs") >= self.min_docs).select("line")
            for name in self.frequent_runs:
                rest = rest.join(self.spark.table(name), "line", "left_anti")
            parts.append(rest)
        if not parts:
            return self.spark.createDataFrame([], "line bigint")
        return reduce(DataFrame.union, parts)  # no line is in two of them

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, gone, ...) to (kept, n_lines, n_dropped, ...): lines whose hash is in the list ``gone`` go."""
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        gone = batch.column(1)
        marks = gone.is_valid().to_numpy(zero_copy_only=False)
        for row, texts in chunks(batch.column(0)):
            starts, ends, first = texts.lines()
            bare_starts, bare_ends = texts.stripped(starts, ends)
            hashes = texts.spans_hash(bare_starts, bare_ends).view(np.int64)
            n_lines += np.diff(first).tolist()
            for i in range(len(first) - 1):
                lo, hi = first[i], first[i + 1]
                if not marks[row + i]:
                    kept.append(texts.column[i].as_py() or b"")
                    n_dropped.append(0)
                    continue
                drop = np.isin(hashes[lo:hi], np.asarray(gone[row + i].values)) & (bare_ends[lo:hi] > bare_starts[lo:hi])
                text = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
                base = texts.offsets[i]
                kept.append(b"\n".join(text[s - base : e - base] for s, e, d in zip(
                    starts[lo:hi].tolist(), ends[lo:hi].tolist(), drop.tolist(), strict=True) if not d))
                n_dropped.append(int(drop.sum()))
        columns = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                   pa.array(n_dropped, pa.int64())]
        names = ["kept", "n_lines", "n_dropped"]
        yield pa.RecordBatch.from_arrays(columns + batch.columns[2:], names + batch.schema.names[2:])


def frequent_lines(docs: DataFrame, min_docs: int = 10, id_column: str = "doc_id", text_column: str = "text",
                   batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """Rows (id, line) of the documents, and the lines found in at least ``min_docs`` of them.

    Documents come in ``batches`` by a hash of their id, so that all rows of an id are in one batch
    and count once.
    """
    spark = docs.sparkSession
    rows = line_rows(docs, id_column, text_column).withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)))
    rows = settle(rows, "lines")
    per_line = (rows.groupBy("batch", "line", "id").agg(F.lit(1).alias("one"))
                .groupBy("batch", "line").agg(F.count("*").alias("docs")))
    per_line = settle(per_line, "counts")
    runs = LineRuns(spark, min_docs)
    try:
        for batch in range(batches):
            runs.add(per_line.filter(F.col("batch") == batch).select("line", "docs"))
        found = settle(runs.frequent(), "frequent")
    finally:
        runs.close()
    release(per_line)
    return rows, found


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, id_column: str = "doc_id",
                        text_column: str = "text", batches: int = BATCHES) -> DataFrame:
    """The documents with every line gone whose key occurs in at least ``min_docs`` documents.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased; blank lines
    stay. Kept lines are joined by newline; ``n_lines`` and ``n_dropped`` are added. A null text is
    one empty line and becomes the empty text. Rows that repeat an id count as one document; rows
    without an id are one document together. Ties do not arise. All other columns pass through;
    columns of the input named n_lines or n_dropped are replaced. An empty table gives an empty one.
    """
    rows, found = frequent_lines(docs, min_docs, id_column, text_column, batches)
    gone, token = scratch("gone"), scratch("token")
    # Ids may be null, and null-safe keys are two plain ones.
    hits = rows.join(found, "line", "left_semi").groupBy("id").agg(F.collect_set("line").alias(gone))
    hits = settle(hits.withColumn(token, F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0))), "hits")
    release(rows, found)
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(*keep).withColumn(token, F.col(id_column).isNull())
    # Both sides are shuffled at every size: the lists grow with the documents.
    joined = keyed.hint("merge").join(
        hits.select(F.col("id").alias(scratch_id := scratch("id")), F.col(token).alias(flag := scratch("flag")), gone),
        (F.coalesce(keyed[id_column], F.lit(0)) == F.col(scratch_id)) & (F.col(token) == F.col(flag)), "left")
    others = [c for c in keep if c != text_column]
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.select(*others).dtypes)
    kept = joined.select(F.col(text_column), gone, *others).mapInArrow(
        _drop_lines, f"kept string, n_lines bigint, n_dropped bigint{', ' if others else ''}{fields}")
    return kept.select(*[F.col("kept").alias(c) if c == text_column else F.col(c) for c in keep], "n_lines", "n_dropped")
