"""Jaccard join of documents on word shingles by vertical partitioning.

Shingles have one global order: rare ones first, going by how often the corpus holds a shingle of
the same bucket, then by their 64-bit hash. Of a set of size a, every partner of Jaccard J or more
shares at least ceil(J * a) shingles, so two such sets have one in common among the first
a - ceil(J * a) + 1 of each. This first fragment gives the keys under which sets meet; passages that
many documents share stand at the end of the order and bring nobody together.

Every set also has a sketch of ``BITS`` parities: each shingle flips the bit it hashes to. Two
sketches differ in at most as many bits as the sets in shingles, so that pairs too different are
left out at the join, without loss. Larger sets have a second sketch that grows with them. Met pairs are verified exactly: the sets are cut into fragments,
overlaps are counted per pair and fragment, and summed per pair. Equal sets are one class, of which
only one takes part. Under a key, every class first meets the smallest one only, and is verified
with the one it meets most often. What these links connect needs no further pair; only classes of
different components under one key are paired in the second round, which loses none. There every row
carries the few keys that its class has just before; two classes that have one of these in common have
met there already, so that a pair hardly comes out again under its later keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.base import release, scratch, settle, sized
from tillsight.llm.components import components
from tillsight.llm.hashing import U64, chunks, mix, shingle_sets
from tillsight.operators.matching import many_to_one

BUCKETS = 1 << 20  # of the shingle counts; their levels, a byte each, are all that is broadcast
PARTS = 256  # in which the counts are summed
SLICES = 4  # fragments in which overlaps are counted
GROUP = 100  # about so many partners meet one copy of their centre's fragment
BEFORE = 4  # keys of a class that travel with its next one
BITS = 512  # of a sketch
SKETCH = [f"s{i}" for i in range(BITS // 64)]


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    """Bucket of each shingle in the counts."""
    return (shingles % U64(BUCKETS)).astype(np.int64)


def fragment_of(shingles: np.ndarray, count: int) -> np.ndarray:
    """Fragment of each shingle when the hash order is cut into ``count`` equal ranges."""
    return (((shingles >> U64(32)) * U64(count)) >> U64(32)).astype(np.int64)


def prefix_keys(shingles: np.ndarray, levels: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first shingles, in the global order, of a sorted set of distinct ones."""
    size = len(shingles)
    count = size - -(-size * num // den) + 1
    return shingles[np.argsort(levels[bucket_of(shingles)], kind="stable")[:count]] if size else shingles


def set_signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set; its first half names the class, 0 for the empty set."""
    if not len(shingles):
        return 0, 0
    pair = [mix(mix(shingles, salt).sum(dtype=U64, keepdims=True) + U64(len(shingles)), salt) for salt in (21, 22)]
    return int(pair[0].view(np.int64)[0]) or 1, int(pair[1].view(np.int64)[0])


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """BITS parities as 64-bit numbers."""
    places = (mix(shingles, 41) & U64(BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> bytes | None:
    """As many parities as the set has shingles, rounded up to a power of two; None where BITS are as many."""
    if len(shingles) <= BITS:
        return None
    bits = 1 << (len(shingles) - 1).bit_length()
    places = (mix(shingles, 42) & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def sketches_apart(one: bytes, other: bytes) -> int:
    """Bits in which two wide sketches differ, the longer one folded to the length of the shorter."""
    x, y = sorted((np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sieve(num: int, den: int):
    """Of rows (a, b, both sizes, both wide sketches), the pairs that the sketches leave possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, size_a, size_b = (batch.column(i).to_numpy() for i in range(4))
            most = (size_a + size_b) * (den - num)
            stay = [sketches_apart(one.as_py(), other.as_py()) * (den + num) <= limit
                    for one, other, limit in zip(batch.column(4), batch.column(5), most.tolist(), strict=True)]
            keep = np.array(stay, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return run


def _profiles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sketches, wide = [], [], [], []
            for _, texts in chunks(batch.column(1)):
                for shingles in shingle_sets(texts, width):
                    sizes.append(len(shingles))
                    names.append(set_signature(shingles)[0])
                    sketches.append(parity_sketch(shingles))
                    wide.append(wide_sketch(shingles))
            bits = np.array(sketches, np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                 *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(SKETCH))], pa.array(wide, pa.binary())],
                ["doc_id", "n_shingles", "class", *SKETCH, "wide"])

    return run


def _classes(width: int):
    """The class of each row's text, the first column, in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [set_signature(shingles)[0] for _, texts in chunks(batch.column(0))
                     for shingles in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *batch.columns[1:]], batch.schema.names)

    return run


def _counts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                for shingles in shingle_sets(texts, width):
                    np.add.at(counts, bucket_of(shingles), 1)
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PARTS)), pa.array([part.tobytes() for part in np.split(counts, PARTS)], pa.binary())],
                ["part", "counts"])

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (part, counts), a byte per bucket of each part that rises with the logarithm of the summed count."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = np.frombuffer(counts, np.int64)
            sums[part] = sums[part] + more if part in sums else more
    if sums:
        levels = [(4 * np.log2(counts + 1)).astype(np.uint8).tobytes() for counts in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(levels, pa.binary())],
                                         ["part", "levels"])


def _keys(width: int, num: int, den: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                keys, names, sizes = [], [], []
                for shingles in shingle_sets(texts, width):
                    name = set_signature(shingles)[0]
                    if name in done:  # a copy in the same task
                        continue
                    done.add(name)
                    found = prefix_keys(shingles, levels.value, num, den)
                    keys.append(found.view(np.int64))
                    names.append(np.full(len(found), name, np.int64))
                    sizes.append(np.full(len(found), len(shingles), np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in (keys, names, sizes)], ["key", "class", "n_shingles"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, class, ...) sorted by both, the distinct ones whose key has at least two classes.

    Further columns belong to the class and stay with it.
    """
    last, given = None, False
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if last is not None:
            columns = [np.concatenate(pair) for pair in zip(last, columns, strict=True)]
        keys, names = columns[:2]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
        columns = [c[fresh] for c in columns]
        keys = columns[0]
        if not len(keys):
            continue
        same = keys[1:] == keys[:-1]
        several = np.append(same, False) | np.insert(same, 0, False)
        sent = bool(several[-1])
        if given:  # the row carried over has gone out already, its key is a shared one
            sent = sent or len(keys) == 1
            several[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[several]) for c in columns], batch.schema.names)
        last, given = [c[-1:] for c in columns], sent


def _slices(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                names, sizes, numbers, ends, values = [], [], [], [0], []
                for shingles in shingle_sets(texts, width):
                    if not len(shingles):
                        continue
                    edge = np.searchsorted(fragment_of(shingles, SLICES), np.arange(SLICES + 1))
                    names += [set_signature(shingles)[0]] * SLICES
                    sizes += [len(shingles)] * SLICES
                    numbers += range(SLICES)
                    ends += (ends[-1] + edge[1:]).tolist()
                    values.append(shingles.view(np.int64))
                if names:
                    arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64()),
                         arrays], ["class", "size", "slice", "part"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, slice, salt, member, class, size, part) sorted by the first five, the overlaps with the centre.

    The centre's fragment comes first and is all that is kept; its partners stream by. Rows that
    repeat a class are skipped.
    """
    group, last, centre, size_a = None, None, np.empty(0, np.uint64), 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        part = batch.column(6)
        ends, values = part.offsets.to_numpy(), part.values.to_numpy().view(np.uint64)
        out = []
        for row, (a, piece, salt, member, name, size) in enumerate(zip(*columns, strict=True)):
            own = values[ends[row] : ends[row + 1]]
            if not member:
                group, last, centre, size_a = (a, piece, salt), name, own.copy(), size
            elif group != (a, piece, salt):
                raise RuntimeError("a fragment came without its centre")
            elif name != last:
                last = name
                places = np.minimum(np.searchsorted(centre, own), max(len(centre) - 1, 0))
                out.append((a, name, size_a, size, int((centre[places] == own).sum()) if len(centre) else 0))
        found = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["a", "b", "size_a", "size_b", "common"])


class NgramJoin:
    """The join of one frame of documents; ``docs`` has the columns named by ``id_column`` and ``text_column``."""

    def __init__(self, docs: DataFrame, width: int, num: int, den: int, id_column: str, text_column: str):
        self.width, self.num, self.den = width, num, den
        self.docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        self.texts = self.docs.select("text").filter("text is not null")
        kind = dict(self.docs.dtypes)["doc_id"]
        self.profiles = settle(self.docs.mapInArrow(
            _profiles(width), f"doc_id {kind}, n_shingles bigint, class bigint" + "".join(
                f", {name} bigint" for name in SKETCH) + ", wide binary"), "profiles")

    def levels(self) -> np.ndarray:
        """How common the shingles of each bucket are in all documents: a byte per bucket, at every corpus size."""
        parts = (self.texts.mapInArrow(_counts(self.width), "part bigint, counts binary")
                 .repartition("part").mapInArrow(_levels, "part bigint, levels binary"))
        out = np.zeros(BUCKETS, np.uint8).reshape(PARTS, -1)
        for row in parts.collect():  # PARTS rows, BUCKETS bytes in all
            out[row["part"]] = np.frombuffer(row["levels"], np.uint8)
        return out.ravel()

    def shared_keys(self) -> DataFrame:
        """(key, class, n_shingles) of the keys that at least two classes have.

        One shuffle of 20-byte rows, sorted by key, which may spill, and streamed: a key that many
        classes share costs its task time but no memory.
        """
        schema = "key bigint, class bigint, n_shingles int"
        levels = self.docs.sparkSession.sparkContext.broadcast(self.levels())
        keys = self.texts.mapInArrow(_keys(self.width, self.num, self.den, levels), schema)
        return settle(keys.repartition("key").sortWithinPartitions("key", "class").mapInArrow(_met, schema), "keys")

    def sketched(self, rows: DataFrame, node: str, end: str) -> DataFrame:
        """Rows with the sketch of the class in column ``node``, their names ending in ``end``."""
        used = sized(settle(rows.select(F.col(node).alias("class")).distinct(), "used"))
        own = self.profiles.join(used, "class", "left_semi").groupBy("class").agg(
            *[F.first(c).alias(c + end) for c in SKETCH])
        return many_to_one(rows, own.withColumnRenamed("class", node), [node])

    def able(self, a: str, b: str):
        """Whether two classes may reach the threshold, going by their sizes and short sketches."""
        apart = sum((F.bit_count(F.col(c + a).bitwiseXOR(F.col(c + b))) for c in SKETCH[1:]),
                    F.bit_count(F.col(SKETCH[0] + a).bitwiseXOR(F.col(SKETCH[0] + b))))
        sizes = F.col("n_shingles" + a) + F.col("n_shingles" + b)
        # J >= num/den is (den - num) * (sizes together) >= (den + num) * shingles in one set only
        return self.near_size(a, b) & (apart * (self.den + self.num) <= sizes * (self.den - self.num))

    def near_size(self, a: str, b: str):
        """Whether two classes may reach the threshold, going by their sizes."""
        size_a, size_b = F.col("n_shingles" + a), F.col("n_shingles" + b)
        return F.least(size_a, size_b) * self.den >= F.greatest(size_a, size_b) * self.num

    def sieved(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that the wide sketches leave possible; 1/32 of a set at most travels for each."""
        pairs = settle(pairs.select("a", "b", "n_shingles_a", "n_shingles_b"), "met")
        # Sets of at most BITS shingles have been compared by as many parities before.
        large = F.least("n_shingles_a", "n_shingles_b") > BITS
        long_pairs = pairs.filter(large)
        used = sized(settle(long_pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "used"))
        wide = settle(self.profiles.join(used, "class", "left_semi").groupBy("class").agg(F.first("wide").alias("wide")),
                      "wide")
        both = many_to_one(
            many_to_one(long_pairs, wide.withColumnsRenamed({"class": "a", "wide": "wide_a"}), ["a"]),
            wide.withColumnsRenamed({"class": "b", "wide": "wide_b"}), ["b"])
        kept = both.select("a", "b", "n_shingles_a", "n_shingles_b", "wide_a", "wide_b").mapInArrow(
            _sieve(self.num, self.den), "a bigint, b bigint")
        out = settle(pairs.filter(~large).select("a", "b").unionByName(kept), "sieved")
        release(pairs, wide)
        return out

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose Jaccard reaches the threshold.

        One document of each class is cut into fragments, which are shuffled once, to the centres
        ``a`` of their pairs. A centre of many partners is repeated for every ``GROUP`` of them.
        """
        pairs = settle(pairs, "pairs")
        groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("bigint").alias("salts"))
        partners = many_to_one(pairs, groups, ["a"]).select(
            "a", F.col("b").alias("class"), F.pmod(F.xxhash64("b"), "salts").alias("salt"))
        centres = groups.select("a", F.col("a").alias("class"), F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"))
        wanted = settle(partners.unionByName(centres), "wanted")
        used = sized(settle(wanted.select("class").distinct(), "used"))
        holders = self.profiles.join(used, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("holder"))
        holders = sized(settle(holders.select("holder").distinct(), "holders"))
        texts = self.docs.join(holders, self.docs.doc_id.eqNullSafe(holders.holder), "left_semi").select("text")
        sets = texts.mapInArrow(_slices(self.width), "class bigint, size bigint, slice bigint, part array<bigint>")
        order = ["a", "slice", "salt", "member", "class"]
        routed = sets.join(sized(wanted), "class").withColumn("member", F.col("class") != F.col("a")).select(
            *order, "size", "part")
        partial = routed.repartition("a", "slice", "salt").sortWithinPartitions(*order).mapInArrow(
            _overlaps, "a bigint, b bigint, size_a bigint, size_b bigint, common bigint")
        summed = partial.groupBy("a", "b").agg(
            F.sum("common").alias("common"), F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"))
        good = settle(summed.filter(
            F.col("common") * self.den >= (F.col("size_a") + F.col("size_b") - F.col("common")) * self.num
        ).select("a", "b", "common"), "linked")
        release(wanted, pairs)
        return good

    def links(self) -> DataFrame:
        """Verified links between classes; their components are those of all links."""
        keys = self.shared_keys()
        shared = keys.withColumn("n_shingles", F.col("n_shingles").cast("bigint"))
        centre = shared.groupBy("key").agg(F.min(F.struct("class", "n_shingles")).alias("low")).select(
            "key", F.col("low.class").alias("a"), F.col("low.n_shingles").alias("n_shingles_a"))
        met = many_to_one(shared.withColumnsRenamed({"class": "b", "n_shingles": "n_shingles_b"}), centre, ["key"])
        met = met.filter("a < b").filter(self.near_size("_a", "_b")).groupBy("a", "b").agg(
            F.count("*").alias("keys"), *[F.first(c).alias(c) for c in ("n_shingles_a", "n_shingles_b")])
        met = settle(met, "met")
        near = self.sketched(self.sketched(met, "a", "_a"), "b", "_b").filter(self.able("_a", "_b"))
        # The possible centre that most of its keys lead to; all others stay for the second round.
        stars = settle(self.sieved(near).join(met.select("a", "b", "keys"), ["a", "b"]).groupBy("b").agg(
            F.max_by("a", F.struct("keys", "a")).alias("a")).select("a", "b"), "stars")
        release(met)
        first = self.verified(stars)
        labels = components(first)
        placed = many_to_one(shared.withColumnRenamed("class", "node"), labels, ["node"], "left").select(
            "key", "node", F.col("n_shingles").alias("n_shingles_a"), F.coalesce("label", "node").alias("label"))
        placed = settle(placed, "placed")
        release(keys)
        open_keys = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter(
            "low < high").select("key")
        rest = settle(many_to_one(placed, open_keys, ["key"], "left_semi"), "open")
        release(placed)
        # Under an open key, a component's classes meet those of other components only.
        own_keys = Window.partitionBy("node").orderBy("key")  # as many rows as one text's prefix
        before = F.collect_list("key").over(own_keys.rowsBetween(-BEFORE, -1))
        sketched = settle(self.sketched(rest.withColumn("before_a", before), "node", "_a"), "sketched")
        release(rest)
        other = sketched.select(
            F.col("key").alias("key_b"), F.col("node").alias("b"), F.col("label").alias("label_b"),
            *[F.col(c + "_a").alias(c + "_b") for c in ("n_shingles", "before", *SKETCH)])
        meet = (F.col("key") == F.col("key_b")) & (F.col("label") != F.col("label_b")) & (F.col("node") < F.col("b"))
        # The first common key has no common one before it, so every pair comes out there at least.
        pairs = sketched.join(other, meet & self.able("_a", "_b") & ~F.arrays_overlap("before_a", "before_b")).groupBy(
            F.col("node").alias("a"), "b").agg(*[F.first(c).alias(c) for c in ("n_shingles_a", "n_shingles_b")])
        pairs = self.sieved(pairs.join(stars, ["a", "b"], "left_anti"))
        links = first.unionByName(self.verified(pairs))
        release(stars, sketched)
        return links


def near_duplicates(docs: DataFrame, width: int = 3, num: int = 9, den: int = 10, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, class and component_id of every row of the documents.

    Two documents are linked when the Jaccard similarity of their sets of ``width``-word shingles is
    at least num / den; a component is what links reach. ``component_id`` is the smallest doc_id of
    the component. Words are split at ASCII white space, A-Z are lower-cased; with fewer words than
    a shingle has, the whole sequence is the one shingle.

    Null, empty and blank texts have an empty set, are linked with nothing and are their own
    component. Repeated rows and equal texts share a class and a component. A null doc_id takes part
    with its text; a component of null ids has a null id. Only as many links are verified as connect the
    components; links inside a component so found are neither verified nor counted. Rows, columns beside the two named and
    column names of the input have no influence; one row comes back per input row.
    """
    out = labelled_rows(docs, width, num, den, id_column, text_column)
    return out.select("doc_id", "n_shingles", "component_id", F.col("class").alias("class_id"))


def labelled_rows(docs: DataFrame, width: int, num: int, den: int, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_shingles, class, label and component_id of every row; the label names the component itself."""
    join = NgramJoin(docs, width, num, den, id_column, text_column)
    labels = components(join.links())
    profiles = join.profiles
    labelled = many_to_one(profiles, labels.withColumnRenamed("node", "class"), ["class"], "left").withColumn(
        "label", F.coalesce("label", "class"))
    labelled = settle(labelled, "labelled")
    lowest = labelled.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = many_to_one(labelled, lowest, ["label"], "left")
    return out.select("doc_id", "n_shingles", "class", "label",
                      F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                      .alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """The documents without near copies: of each component the row of the smallest doc_id stays.

    Of rows that repeat that doc_id in the component, one stays, of equal sets the one whose text comes
    first; a row of another component does not stay for its id. Documents without words stay. Only
    the rows of repeated ids are read by class, the others by id.
    """
    found = settle(labelled_rows(docs, width, num, den, id_column, text_column), "found")
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    repeated = settle(found.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select(
        F.col("doc_id").alias("repeated")), "repeated")
    some = not repeated.isEmpty()
    repeated = sized(repeated)
    if some:
        is_repeated = F.col("doc_id").eqNullSafe(F.col("repeated"))
        winners = kept.filter("n_shingles > 0").join(repeated, is_repeated, "left_semi").groupBy("label").agg(
            F.min(F.struct("class", "doc_id")).alias("row"))
        winners = sized(settle(winners.select(F.col("row.doc_id").alias("winner"), F.col("row.class").alias("of")), "winners"))
        kept = kept.join(repeated, is_repeated, "left_anti")
    kept = sized(settle(kept.select(F.col("doc_id").alias(id_column)), "kept"))
    slim = docs.join(kept, docs[id_column].eqNullSafe(kept[id_column]), "left_semi")
    if not some:
        return slim
    name = scratch("class")
    fields = "".join(f", `{n}` {t}" for n, t in docs.dtypes)
    again = docs.join(repeated, docs[id_column].eqNullSafe(F.col("repeated")), "left_semi").select(
        F.col(text_column).alias(name), *docs.columns).mapInArrow(_classes(width), f"`{name}` bigint{fields}")
    one = again.join(winners, F.col(id_column).eqNullSafe(F.col("winner")) & (F.col(name) == F.col("of")), "left_semi")
    one = one.groupBy(id_column, name).agg(F.min_by(F.struct(*docs.columns), F.col(text_column)).alias("row"))
    return slim.unionByName(again.filter(F.col(name) == 0).select(*docs.columns)).unionByName(one.select("row.*"))
