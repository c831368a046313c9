"""Segments as bitmaps: unions, overlaps, differences and sizes without shuffling members again.

Members get dense numbers once. A segment is then a few rows (segment, bucket, bits) of 32,768 members
each, and set operations touch only those. ``merge`` adds members to segments that already stand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.factors import dense_index

BITS = 32_768  # members per bucket, fixed by Spark's bitmap functions
SLICE = 4_096  # members of a bucket compared at a time


def member_numbers(members: DataFrame) -> DataFrame:
    """(mobile, mobile_id) of all distinct members, numbered from 0 in order; null members have none."""
    return dense_index(members, "mobile")


def segment_bitmaps(segments: DataFrame, numbers: DataFrame) -> DataFrame:
    """(segment, bucket, bits) of (segment, mobile) rows; repeated rows count once, unnumbered members not at all."""
    placed = segments.select("segment", "mobile").join(numbers, "mobile")
    number = F.col("mobile_id").cast("bigint") + 1  # Spark's buckets start at number 1
    return placed.groupBy("segment", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merge(*bitmaps: DataFrame) -> DataFrame:
    """Segments of all parts, those of one name united."""
    whole = bitmaps[0]
    for part in bitmaps[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("segment", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def union(bitmaps: DataFrame, segments: Sequence[str], name: str) -> DataFrame:
    """Members of any of the segments, as one segment."""
    return _picked(bitmaps, segments).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).select(
        F.lit(name).alias("segment"), "bucket", "bits")


def intersection(bitmaps: DataFrame, segments: Sequence[str], name: str) -> DataFrame:
    """Members of all of the segments, as one segment; a bucket that one of them lacks is empty."""
    wanted = len(set(segments))
    both = _picked(bitmaps, segments).groupBy("bucket").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.countDistinct("segment").alias("n"))
    return both.filter((F.col("n") == wanted) & (F.bitmap_count("bits") > 0)).select(
        F.lit(name).alias("segment"), "bucket", "bits")


def difference(bitmaps: DataFrame, segment: str, others: Sequence[str], name: str) -> DataFrame:
    """Members of the segment that none of the others holds, as one segment."""
    own = bitmaps.filter(F.col("segment") == segment).select("bucket", "bits")
    out = union(bitmaps, others, name).select("bucket", F.col("bits").alias("other"))

    def minus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [np.frombuffer(bits, np.uint8) for bits in batch.column(1).to_pylist()]
            right = [np.frombuffer(bits or b"", np.uint8) for bits in batch.column(2).to_pylist()]
            rest = [(a & ~b if len(b) else a).tobytes() for a, b in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rest, pa.binary())], ["bucket", "bits"])

    left = own.join(out, "bucket", "left").mapInArrow(minus, "bucket bigint, bits binary")
    return left.filter(F.bitmap_count("bits") > 0).select(F.lit(name).alias("segment"), "bucket", "bits")


def _picked(bitmaps: DataFrame, segments: Sequence[str]) -> DataFrame:
    return bitmaps.filter(F.col("segment").isin(list(segments)))


def sizes(bitmaps: DataFrame) -> DataFrame:
    """(segment, members) of every segment."""
    return bitmaps.groupBy("segment").agg(F.sum(F.bitmap_count("bits")).alias("members"))


def overlaps(bitmaps: DataFrame) -> DataFrame:
    """(a, b, members) for every two segments a < b that share members.

    A bucket's segments form one bit matrix, whose product with itself counts all pairs; only
    those counts leave the task.
    """
    def shared(table: pa.Table) -> pa.Table:
        table = table.sort_by("segment")
        names = table["segment"].combine_chunks()
        bits = np.stack([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
        counts = np.zeros((len(names), len(names)), np.float32)  # exact: at most 32,768 each
        for start in range(0, bits.shape[1], SLICE // 8):
            part = np.unpackbits(bits[:, start:start + SLICE // 8], axis=1).astype(np.float32)
            counts += part @ part.T
        a, b = np.nonzero(np.triu(counts, 1))
        return pa.table([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(counts[a, b].astype(np.int64))],
                        ["a", "b", "members"])

    kind = dict(bitmaps.dtypes)["segment"]
    parts = bitmaps.groupBy("bucket").applyInArrow(shared, f"a {kind}, b {kind}, members bigint")
    return parts.groupBy("a", "b").agg(F.sum("members").alias("members"))


def members_of(bitmaps: DataFrame, numbers: DataFrame) -> DataFrame:
    """(segment, mobile) rows of the segments."""
    kind = dict(bitmaps.dtypes)["segment"]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (bucket, bits) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                places = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
                ids = (bucket - 1) * BITS + places
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(ids), row))), pa.array(ids.astype(np.int32))],
                    ["segment", "mobile_id"])

    held = bitmaps.select("segment", "bucket", "bits").mapInArrow(numbered, f"segment {kind}, mobile_id int")
    return held.join(numbers, "mobile_id").select("segment", "mobile")
