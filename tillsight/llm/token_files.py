"""Token files: ids of whole documents in fixed-width bit packing, with block offsets.

An id takes the fewest bits that hold every id of the vocabulary, so ids are addressed by arithmetic and
unpacked by numpy without a loop. A *shard* is what one task of a range partition by document id
writes; it is a run of *blocks*, rows of a Parquet file with the packed ids, the ids and ends of the
block's documents, and the block's offset in its shard. A block ends with the first document that
brings it to ``BLOCK_IDS`` ids, so documents are never cut and a block can be read alone. The
manifest beside the blocks gives every shard's offset in the whole, so that any global position is
found by two searches: shard, then block.

Parquet and Spark's commit protocol are used instead of bare files, as tasks may be repeated and the
folder may lie in a store that only Spark writes to.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BLOCK_IDS = 1 << 16
KNOWN_PIECES = 1_000_000  # pieces remembered by a worker before it starts afresh
CELL = 8  # ids packed together: so many always begin and end at a byte

# Fixed values of byte-level BPE: how it splits a text, and the characters that stand for bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same split where Python's own classes agree with it: for ASCII, and for characters of the categories below.
SPLIT_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
SPLIT_COMMON = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
COMMON = frozenset(("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Nd", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So"))
VISIBLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))


def id_bits(largest: int) -> int:
    """Bits of the largest id, one at least."""
    return max(1, int(largest).bit_length())


def _overlaps(bits: int) -> list[tuple[int, int, int]]:
    """(id, byte, shift) of a cell: bit 0 of the id lies ``shift`` bits above bit 0 of the byte, or below it."""
    return [(j, k, j * bits - 8 * k) for j in range(CELL) for k in range(j * bits // 8, ((j + 1) * bits - 1) // 8 + 1)]


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids end to end in ``bits`` bits each, lowest bit first; raises ValueError for an id that does not fit."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} does not fit in {bits} bits")
    wide = np.zeros((-(-len(ids) // CELL), CELL), np.uint64)
    wide.ravel()[: len(ids)] = ids
    cells = np.zeros((len(wide), bits), np.uint8)
    for j, k, shift in _overlaps(bits):
        moved = wide[:, j] << np.uint64(shift) if shift >= 0 else wide[:, j] >> np.uint64(-shift)
        cells[:, k] |= moved.astype(np.uint8)
    return cells.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of packed bytes as unsigned 32-bit integers; only their cells are read."""
    if stop <= start:
        return np.empty(0, "<u4")
    first, last = start // CELL, -(-stop // CELL)
    raw = np.zeros((last - first) * bits, np.uint8)
    held = np.frombuffer(packed, np.uint8)[first * bits : last * bits]
    raw[: len(held)] = held
    cells = raw.reshape(-1, bits)
    wide = np.zeros((len(cells), CELL), np.uint64)
    for j, k, shift in _overlaps(bits):
        part = cells[:, k].astype(np.uint64)
        wide[:, j] |= part >> np.uint64(shift) if shift >= 0 else part << np.uint64(-shift)
    wide &= np.uint64((1 << bits) - 1)
    return wide.ravel()[start - first * CELL : stop - first * CELL].astype("<u4")


class Pieces(dict):
    """Ids of pieces, looked up by the model on first sight."""

    def __init__(self, model):
        super().__init__()
        plain, spare = set(itertools.chain(*VISIBLE)), itertools.count(256)
        self.shown = {b: b if b in plain else next(spare) for b in range(256)}
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.shown)
        self[piece] = ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids


class Encoder:
    """Ids of whole texts by a tokenizer of the tokenizers library, as little-endian unsigned 32-bit bytes.

    Special tokens inside a text are ordinary text. A plain byte-level BPE encodes every piece of its
    split by itself, so each distinct piece is encoded once and remembered. Other tokenizers, and
    texts with characters unknown to Python (on which two versions of the split may differ), get
    the texts whole.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        parts = json.loads(definition)
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        self.by_pieces = (
            parts["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "unk_token"))
            and all(token["special"] for token in parts["added_tokens"]))
        self.split, self.split_ascii, self.split_common = regex.compile(SPLIT), re.compile(SPLIT_ASCII, re.ASCII), re.compile(SPLIT_COMMON)
        self.known = Pieces(self.tokenizer.model)
        self.common = {chr(c) for c in range(128)} - {chr(c) for c in range(0x1C, 0x20)}  # white space to Python alone

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        split = self.split_of(text) if self.by_pieces else None
        if split is None:
            return self.whole(text)
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, split.findall(text)))

    def split_of(self, text: str):
        """The fastest pattern that splits the text as the tokenizer does; none if a character is unknown."""
        if text.isascii():
            return self.split_ascii
        odd = {c: unicodedata.category(c) for c in set(text) - self.common}
        self.common.update(c for c, kind in odd.items() if kind in COMMON and c > "\x7f")
        if all(kind in COMMON for kind in odd.values()):
            return self.split_common
        return None if "Cn" in odd.values() else self.split


@functools.lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    """One encoder per worker and tokenizer."""
    return Encoder(definition)


def _blocks(definition, end_id: int, bits: int, id_type: pa.DataType):
    """Packed blocks of the sorted documents of one range partition."""

    def row(shard: int, block: int, first: int, ids: list, ends: list, held: list) -> pa.RecordBatch:
        packed = pack(np.frombuffer(b"".join(held), "<u4"), bits)
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
            pa.array([ends[-1]], pa.int64()), pa.array([bits], pa.int32()), pa.array([ids], pa.list_(id_type)),
            pa.array([ends], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
            ["shard", "block", "first", "n_ids", "bits", "doc_ids", "ends", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = TaskContext.get().partitionId(), encoder(definition.value)
        last = np.array([end_id], "<u4").tobytes()
        block = first = size = 0
        ids, ends, held = [], [], []
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, name in enumerate(names):
                held.append(found.encode(batch.column(1)[i].as_py()) + last)
                size += len(held[-1]) // 4
                ids.append(name)
                ends.append(size)
                if size >= BLOCK_IDS:
                    yield row(shard, block, first, ids, ends, held)
                    block, first, size = block + 1, first + size, 0
                    ids, ends, held = [], [], []
        if ids:
            yield row(shard, block, first, ids, ends, held)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                 text_column: str = "text") -> None:
    """Write the ids of all documents below ``path``, in ascending order of the document id.

    ``tokenizer`` is the file of a tokenizers-library tokenizer on the driver; executors get its
    content. ``end_id`` ends every document. Null and empty texts are the end id alone. Null ids come
    first; rows that repeat an id stand in the order of their texts' hashes, then texts, and equal rows are all
    kept. Any sortable id type does. An empty table gives files without rows. Other columns are not
    read. A document's ids must fit in one row.

    ``path/blocks``: shard, block, first (ids of the shard before the block), n_ids, bits, doc_ids, ends
    (running ids of the block after each document), packed. ``path/manifest``: shard, start (ids of
    all shards before), n_ids; one row per shard, so as many as the range shuffle has partitions.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    bits = id_bits(max(Encoder(definition).vocabulary - 1, end_id))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    # equal rows of one id may be many: a fixed draw deals them over partitions, and their order says nothing
    ranged = rows.repartitionByRange(*order, F.rand(11)).sortWithinPartitions(*order, "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    blocks = ranged.mapInArrow(
        _blocks(spark.sparkContext.broadcast(definition), end_id, bits, rows.limit(0).toArrow().schema.field(0).type),
        f"shard int, block bigint, first bigint, n_ids bigint, bits int, doc_ids array<{kind}>, ends array<bigint>, "
        "packed binary")
    blocks.write.parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).collect()
    start, manifest = 0, []
    for shard, n_ids in sorted(sizes):  # one row per task of the write
        manifest.append((shard, start, n_ids))
        start += n_ids
    spark.createDataFrame(manifest, "shard int, start bigint, n_ids bigint").coalesce(1).write.parquet(f"{path}/manifest")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids = batch.column(0).slice(row, 1).flatten()
            ends = batch.column(1).slice(row, 1).flatten().to_numpy()
            bits, start = batch.column(3)[row].as_py(), batch.column(4)[row].as_py()
            begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
            ids = unpack(batch.column(2)[row].as_py(), bits, 0, int(ends[-1])).tobytes()
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array(start + begins, pa.int64()), pa.array(ends - begins, pa.int64()),
                pa.array([ids[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])


def placed_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of the whole before each."""
    blocks = spark.read.parquet(f"{path}/blocks")
    manifest = spark.read.parquet(f"{path}/manifest")
    # as many rows as the range shuffle had partitions
    joined = blocks.join(F.broadcast(manifest.select("shard", F.col("start").alias("shard_start"))), "shard")
    return joined.withColumn("start", F.col("shard_start") + F.col("first"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every written document; ids are little-endian unsigned 32-bit bytes.

    No shuffle: every block is unpacked by itself. Files without rows give none.
    """
    blocks = placed_blocks(spark, path).select("doc_ids", "ends", "packed", "bits", "start")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(_documents, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids at global positions ``start`` to ``stop``, which must be few enough for the driver.

    Only blocks that overlap are read: shards by the manifest, blocks by their offsets.
    """
    begin, end = F.col("start"), F.col("start") + F.col("n_ids")
    shards = spark.read.parquet(f"{path}/manifest").filter((begin < stop) & (end > start)).collect()
    out = []
    for shard, shard_start, _ in sorted(shards):
        first, after = F.col("first"), F.col("first") + F.col("n_ids")
        rows = spark.read.parquet(f"{path}/blocks").filter(
            (F.col("shard") == shard) & (first < stop - shard_start) & (after > start - shard_start))
        for block in sorted(rows.select("first", "n_ids", "bits", "packed").collect()):
            low = shard_start + block["first"]
            out.append(unpack(block["packed"], block["bits"], max(start - low, 0), min(stop - low, block["n_ids"])))
    return np.concatenate(out) if out else np.empty(0, "<u4")
