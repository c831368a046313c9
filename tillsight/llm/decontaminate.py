"""Benchmark decontamination: item-sized windows, SimHash fingerprints, exact weighted-shingle check.

Every document is slid over with a window of each benchmark item's length in words. A window and an
item are bags of word shingles with counts as weights. A weighted Jaccard similarity of num / den
needs a given number of positions whose shingle is one of the item's, so the item's own positions
leave out, without loss, all windows that cannot reach it. The others get a 128-bit SimHash, the sign of a sum
over positions, so running sums give those of neighbouring windows at once. An index over 16 blocks of the
fingerprints finds every item within the radius, as one block then differs in at most floor(radius / 16)
bits. The items found are compared exactly. An item of fewer words than a shingle has is one shingle
of its own length, and windows equal to it match.

Items are handled in blocks of at most ``BLOCK_ITEMS`` rows, each broadcast in turn, so that any
number of items is covered with bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import scratch, settle, sized
from tillsight.llm.hashing import U64, Texts, chunks, mix, runs

BLOCK_ITEMS = 5_000
BITS, BLOCKS = 128, 16
RADIUS = 40  # 4.5 standard deviations beyond the mean distance at a similarity of 0.8
WIDTH = BITS // BLOCKS
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 per shingle and bit of its 128-bit hash."""
    halves = np.stack([mix(shingles, 31), mix(shingles, 32)], axis=1)
    return 2 * np.unpackbits(halves.view(np.uint8).reshape(len(shingles), -1), axis=1).astype(np.int32) - 1


def simhash(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """128-bit SimHash of a weighted set, as 16 bytes."""
    return np.packbits((weights @ signs(shingles)) > 0)


def simhashes(shingles: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """SimHashes of the windows of ``span`` shingles from each of the sorted starts, by running sums."""
    low = int(starts[0])
    sums = np.cumsum(signs(shingles[low : int(starts[-1]) + span]), axis=0, dtype=np.int32)
    sums = np.concatenate((np.zeros((1, BITS), np.int32), sums))
    return np.packbits(sums[starts - low + span] - sums[starts - low] > 0, axis=1)


@dataclass
class Items:
    """A block of items: bags, fingerprints, and the index of the fingerprints' blocks."""

    ids: pa.Array
    width: int
    num: int
    den: int

    def build(self, texts: list) -> Items:
        found = Texts(pa.array(texts, pa.string()))
        starts, ends, first = found.words()
        words = found.spans_hash(starts, ends)
        shingles, _ = runs(words, first, self.width)
        self.lengths = np.diff(first)
        self.bags = []
        for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            self.bags.append(np.unique(shingles[begin : max(end - self.width + 1, begin)], return_counts=True))
        prints = [simhash(*bag) if len(bag[0]) else np.zeros(BLOCKS, np.uint8) for bag in self.bags]
        self.prints = np.array(prints, np.uint8).reshape(-1, BLOCKS)
        # every shingle of the block, and the items that hold it
        flat = np.concatenate([bag[0] for bag in self.bags]) if self.bags else np.empty(0, U64)
        owner = np.repeat(np.arange(len(self.bags)), [len(bag[0]) for bag in self.bags])
        order = np.argsort(flat, kind="stable")
        self.all, begin = np.unique(flat[order], return_index=True)
        self.owners, self.owned = owner[order], np.append(begin, len(flat))
        # items too short for a shingle, by length: hash and item
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, self.width):
            mine = np.flatnonzero(self.lengths == n)
            if len(mine):
                whole = np.concatenate([runs(words[first[i] : first[i + 1]], np.array([0, n]), n)[0] for i in mine])
                order = np.argsort(whole, kind="stable")
                self.short[n] = whole[order], mine[order]
        # near[block, value]: items whose byte in that block is within floor(RADIUS / BLOCKS) bits of the value
        distance = POPCOUNT[np.arange(256)[:, None, None] ^ self.prints[None]]
        self.near = np.packbits((distance <= RADIUS // BLOCKS).transpose(2, 0, 1), axis=2)
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.all >> U64(48)).astype(np.int64)] = True
        return self

    def within_radius(self, item: int, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints differ from the item's in at most RADIUS bits, of those the index holds for it."""
        found = self.near[np.arange(BLOCKS), prints, item >> 3] & (128 >> (item & 7))
        out = (found > 0).any(axis=1)
        out[out] = POPCOUNT[self.prints[item] ^ prints[out]].sum(axis=1) <= RADIUS
        return out

    def similarity(self, item: int, shingles: np.ndarray, weights: np.ndarray) -> tuple[int, int]:
        """Common and united weight of an item and a bag."""
        own, counts = self.bags[item]
        _, i, j = np.intersect1d(own, shingles, assume_unique=True, return_indices=True)
        common = int(np.minimum(counts[i], weights[j]).sum())
        return common, int(counts.sum() + weights.sum()) - common

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in an item of the block."""
        out = self.filter[(shingles >> U64(48)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            place = np.minimum(np.searchsorted(self.all, shingles[some]), len(self.all) - 1)
            out[some] = self.all[place] == shingles[some]
        return out

    def matches(self, shingles: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, first word, common, united) of a document's best window per item of full length."""
        places = np.flatnonzero(hits)
        known = np.searchsorted(self.all, shingles[places])
        times = self.owned[known + 1] - self.owned[known]
        rows = np.repeat(self.owned[known] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        items, places = self.owners[rows], np.repeat(places, times)
        order = np.argsort(items, kind="stable")  # places stay in order within an item
        items, places = items[order], places[order]
        numbers, first = np.unique(items, return_index=True)
        for item, begin, end in zip(numbers.tolist(), first.tolist(), [*first[1:].tolist(), len(items)], strict=True):
            size = int(self.lengths[item]) - self.width + 1
            span = min(size, len(shingles))  # a document shorter than the item is one window
            # common >= num/(num+den) of both bags' weights together
            need = -(-self.num * (size + span) // (self.num + self.den))
            own = places[begin:end]
            if len(own) < need:
                continue
            low, high = own[: len(own) - need + 1], own[need - 1 :]  # so many of the item's places in a row
            near = high - low < span
            froms = np.maximum(high[near] - span + 1, 0)
            tos = np.minimum(low[near], len(shingles) - span)
            steps = np.zeros(len(shingles) - span + 2, np.int64)
            np.add.at(steps, froms, 1)
            np.add.at(steps, np.maximum(tos + 1, froms), -1)
            starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
            if not len(starts):
                continue
            best = None
            for start in starts[self.within_radius(item, simhashes(shingles, starts, span))].tolist():
                bag, weights = np.unique(shingles[start : start + span], return_counts=True)
                common, united = self.similarity(item, bag, weights)
                if common * self.den >= united * self.num and (best is None or (-common / united, start) < best[0]):
                    best = (-common / united, start), start, common, united
            if best is not None:
                yield item, *best[1:]

    def short_matches(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
        """(text, match) of the first window of each text equal to each item too short for a shingle."""
        for n, (hashes, items) in self.short.items():
            windows, valid = runs(words, first, n)
            low, high = (np.searchsorted(hashes, windows, side) for side in ("left", "right"))
            seen = set()
            for at in np.flatnonzero(valid & (high > low)).tolist():
                text = int(np.searchsorted(first, at, side="right")) - 1
                for item in items[low[at] : high[at]].tolist():
                    if (text, item) not in seen:
                        seen.add((text, item))
                        yield text, (item, at - int(first[text]), 1, 1)


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            rows, found = [], []
            for row, texts in chunks(batch.column(1)):
                starts, ends, first = texts.words()
                words = texts.spans_hash(starts, ends)
                for text, match in items.short_matches(words, first):
                    rows.append(row + text)
                    found.append(match)
                shingles, valid = runs(words, first, items.width)
                if not len(shingles):
                    continue
                hits = items.known(shingles) & valid
                counts = np.concatenate(([0], np.cumsum(hits)))
                lo = np.minimum(first[:-1], len(hits))
                hi = np.minimum(np.maximum(first[1:] - items.width + 1, lo), len(hits))
                for i in np.flatnonzero(counts[hi] - counts[lo]).tolist():
                    for match in items.matches(shingles[lo[i] : hi[i]], hits[lo[i] : hi[i]]):
                        rows.append(row + i)
                        found.append(match)
            if rows:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    items.ids.take(pa.array([m[0] for m in found], pa.int64())),
                    pa.array([m[1] for m in found], pa.int64()),
                    pa.array([m[2] / m[3] for m in found], pa.float64()),
                ], ["doc_id", "item_id", "first_word", "similarity"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 5, num: int = 8, den: int = 10,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, similarity): the best window of each document and benchmark item.

    ``benchmark`` has item_id and text. Words are split at ASCII white space and A-Z lower-cased.
    A match needs a weighted Jaccard of num / den on ``width``-word shingles; of equally good windows
    the first is given. A document shorter than an item is one window. An item of fewer than ``width``
    words matches where all its words stand in a row, with similarity 1. Null and empty texts of either side match
    nothing. Ids of any type, and null ids, are carried along; repeated rows of either side repeat or collapse: one row per distinct (doc_id,
    item_id), the best. Empty tables give no rows. Other columns have no influence.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").filter("text is not null").distinct()
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    # a hash spreads the items; a block's size is checked again when it is fetched
    items = settle(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    kind, item_kind = dict(docs.dtypes)[id_column], dict(items.dtypes)["item_id"]
    pairs = docs.select(F.col(id_column), F.col(text_column))
    parts = []
    for block in range(blocks):
        held = items.filter(F.col("block") == block).orderBy("item_id", "text").limit(4 * BLOCK_ITEMS + 1).toArrow()
        if held.num_rows > 4 * BLOCK_ITEMS:
            raise ValueError("benchmark block too large")
        built = Items(held.column("item_id").combine_chunks(), width, num, den).build(held.column("text").to_pylist())
        parts.append(pairs.mapInArrow(
            _scan(spark.sparkContext.broadcast(built)),
            f"doc_id {kind}, item_id {item_kind}, first_word bigint, similarity double"))
    found = reduce(DataFrame.union, parts)
    best = F.max_by(F.struct("first_word", "similarity"), F.struct("similarity", -F.col("first_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.first_word", "best.similarity")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   **options) -> DataFrame:
    """The documents without those that hold a benchmark item; rows with a null id stay only if no such row leaks."""
    found = leaks(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    bad = scratch("bad")
    hit = sized(settle(found.select(F.col("doc_id").alias(bad)).distinct(), "leaks"))
    return docs.join(hit, docs[id_column].eqNullSafe(hit[bad]), "left_anti")
