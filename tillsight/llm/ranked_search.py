"""Ranked lexical search: hashed max-sketches bound every score, the highest bounds are scored exactly.

A term's *impact* in a document grows with its occurrences and falls with the document's length; a
score is the sum of the item's term weights times their impacts. A document's sketch has ``width``
coordinates; every term of the document is hashed to one, which keeps the highest impact among them.
Looking up an item's terms in the sketches of a group of documents and adding weight times coordinate
thus gives an upper bound of every score at once. Documents are then scored exactly by falling
bound, until a bound lies below the k-th best exact score so far. Nothing that can reach the result is left out,
whatever the hashing does.

The scan runs twice over the documents: once for the numbers of documents and terms and the document counts of
the items' terms, once for the search. Every task carries its best k per item through all its documents and gives out
no more; items are handled in blocks of bounded size, each sent to the tasks in turn.
"""

from __future__ import annotations

import math
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import settle
from tillsight.operators.ranking import top_n

WIDTH = 4096  # coordinates of a sketch
GROUP_DOCS, GROUP_BYTES = 256, 1 << 20  # documents sketched together; one longer text alone
BLOCK_ITEMS, BLOCK_BYTES = 4_000, 4 << 20  # items sent to the tasks at once, about
SLICE_TERMS = 1 << 13  # terms of items looked up together
N_DOCS, N_TERMS = -1, -2  # names of the two totals among the counts

# Fixed values of the ranking formula.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 8
LENGTH_SHARE = 90

_ALNUM = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _ALNUM or b >= 0x80 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def impact(tf, m):
    """Impact of a term that occurs tf times in a document of relative length m."""
    return IMPACT_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m)


@dataclass
class Items:
    """A block of items: their distinct terms, and after the first scan the terms' weights."""

    ids: pa.Array
    texts: list
    first: int  # number of the block's first item among all
    width: int
    n_docs: int = 0
    n_terms: int = 0
    number: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        self.lists = []
        for text in self.texts:
            own = dict.fromkeys(terms_of(text))
            self.lists.append([self.number.setdefault(t, len(self.number)) for t in own])
        self.texts = []

    def weigh(self, n_docs: int, n_terms: int, counts: dict[int, int]) -> Items:
        """Give each term its weight; terms that no document holds or that weigh nothing go."""
        self.n_docs, self.n_terms = n_docs, n_terms
        weight = {t: math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in counts.items()}
        names = list(self.number)
        self.items, self.queries = [], []
        for item, own in enumerate(self.lists):
            used = [(names[t], weight[t]) for t in own if weight.get(t)]
            if used:
                self.items.append(item)
                self.queries.append(used)
        sizes = [len(q) for q in self.queries]
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        flat = [pair for q in self.queries for pair in q]
        self.coords = np.array([zlib.crc32(t) % self.width for t, _ in flat], np.int64)
        self.weights = np.array([w for _, w in flat], np.int64)
        return self

    def relative_length(self, n: int) -> int:
        return 100 - LENGTH_SHARE + LENGTH_SHARE * n * self.n_docs // self.n_terms

    def sketch(self, counts: Counter, m: int) -> np.ndarray:
        """Highest impact among the document's terms at each coordinate."""
        out = np.zeros(self.width, np.int64)
        coords = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % self.width
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        np.maximum.at(out, coords, impact(tf, m))
        return out

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of all documents (rows) for all items with terms (columns)."""
        out = np.empty((len(sketches), len(self.queries)), np.int64)
        item = 0
        while item < len(self.queries):
            end = int(np.searchsorted(self.starts, self.starts[item] + SLICE_TERMS, side="right")) - 1
            end = min(max(end, item + 1), len(self.queries))
            part = slice(int(self.starts[item]), int(self.starts[end]))
            found = sketches[:, self.coords[part]] * self.weights[part]
            out[:, item:end] = np.add.reduceat(found, self.starts[item:end] - part.start, axis=1)
            item = end
        return out

    def score(self, query: int, counts: Counter, m: int) -> int:
        return sum(w * impact(tf, m) for term, w in self.queries[query] if (tf := counts.get(term)))


def _groups(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """Consecutive texts, few enough for one set of sketches, with the first one's row."""
    held, size, first = [], 0, 0
    for row in range(len(column)):
        text = column[row].as_py()
        if held and (len(held) >= GROUP_DOCS or size + len(text or b"") > GROUP_BYTES):
            yield first, held
            held, size, first = [], 0, row
        held.append(text)
        size += len(text or b"")
    if held:
        yield first, held


def _count(shared):
    """Numbers of documents and terms, and of documents that hold each of the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        found: Counter = Counter()
        for batch in batches:
            for row in range(batch.num_rows):
                terms = terms_of(batch.column(0)[row].as_py())
                if terms:
                    found[N_DOCS] += 1
                    found[N_TERMS] += len(terms)
                    found.update(map(items.number.__getitem__, items.number.keys() & set(terms)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], ["term", "n"])

    return run


def _search(shared, k: int):
    """Each task's best k documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        best: list[list] = [[] for _ in items.queries]  # (-score, id is given, id), ascending
        floors = np.ones(len(best), np.int64)
        kind = None
        for batch in batches if best else ():
            kind = batch.schema.field(0).type
            for first, texts in _groups(batch.column(1)):
                counted = [(row, len(terms), Counter(terms)) for row, text in enumerate(texts, first)
                           if (terms := terms_of(text))]
                if not counted:
                    continue
                lengths = [items.relative_length(n) for _, n, _ in counted]
                bounds = items.bounds(np.stack(
                    [items.sketch(c, m) for (_, _, c), m in zip(counted, lengths, strict=True)]))
                for query in np.flatnonzero((bounds >= floors).any(axis=0)).tolist():
                    column, mine = bounds[:, query], best[query]
                    able = np.flatnonzero(column >= floors[query])
                    for doc in able[np.argsort(-column[able], kind="stable")].tolist():
                        if column[doc] < floors[query]:
                            break
                        row, _, counts = counted[doc]
                        score = items.score(query, counts, lengths[doc])
                        if score >= floors[query]:
                            name = batch.column(0)[row].as_py()
                            insort(mine, (-score, name is not None, name if name is not None else 0))
                            del mine[k:]
                            if len(mine) == k:
                                floors[query] = -mine[-1][0]
        rows = [(items.items[query], hit) for query, hits in enumerate(best) for hit in hits]
        if rows:
            place = pa.array([item for item, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([items.first + item for item, _ in rows], pa.int64()), items.ids.take(place),
                pa.array([hit[2] if hit[1] else None for _, hit in rows], kind),
                pa.array([-hit[0] for _, hit in rows], pa.int64())], ["item", "item_id", "doc_id", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, width: int = WIDTH, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k highest-scoring documents of each item.

    Terms are runs of ASCII letters, digits and non-ASCII characters of the whole text, only A-Z
    lower-cased. Documents without terms do not count anywhere; scores are above 0, so an item
    without terms, or with none in any document, has no rows. Equal scores rank by ascending doc_id,
    null first. Every row of ``docs`` is a document, repeated ones too; rows of ``items`` that are alike in both
    columns are one item, others of the same or a null item_id each have their own ranks. Ids of any sortable type
    are carried along. Empty tables give no rows. Other columns have no influence.

    The items' block sizes are averages: a text, and all items that hash alike, are one block.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_column).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    wanted = settle(wanted.filter("text is not null").distinct(), "items")
    rows, size = wanted.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    texts = docs.select(F.col(text_column).cast("binary").alias("text"))
    pairs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    item_kind, doc_kind = (f.dataType.simpleString() for f in (wanted.schema["item_id"], pairs.schema["doc_id"]))
    parts, first = [], 0
    for block in range(blocks):
        held = wanted.filter(place == block).orderBy("item_id", "text").toArrow()
        own = Items(held.column("item_id").combine_chunks(), held.column("text").to_pylist(), first, width)
        first += held.num_rows
        counts = dict(texts.mapInArrow(_count(spark.sparkContext.broadcast(own)), "term bigint, n bigint")
                      .groupBy("term").agg(F.sum("n").alias("n")).collect())  # a row per term of the block
        own.weigh(counts.pop(N_DOCS, 0), counts.pop(N_TERMS, 0), counts)
        parts.append(pairs.mapInArrow(
            _search(spark.sparkContext.broadcast(own), k),
            f"item bigint, item_id {item_kind}, doc_id {doc_kind}, score bigint"))
    found = reduce(DataFrame.union, parts)
    return top_n(found, ["item"], F.desc("score"), ["doc_id"], k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
