"""Merkle manifest of a data set: leaf places by bitmap ranks, levels by keyed slot arrays.

Every row is a leaf; the leaves of a group (a source) ascend by document id and form a tree, and the
groups' roots form one more tree above them.

*Places without sorting.* Each task folds its document ids into compressed bitmaps, one container per
group and ``LOW_BITS`` low bits of the id: a sorted array of the low bits while few are set, a bitset beyond. Containers
of one key are merged in a shuffle of the containers, and a popcount directory gives each the
number of rows before it. A row's place is then the directory's number plus its rank in the container.
Ids that occur more than once in a group, and null ids, carry their extra rows beside the bits; their rows
alone are put in order among each other, by leaf.

*Levels by slot arrays.* ``STEP`` levels need one shuffle: the 3**STEP nodes below a common node meet as
one array keyed by slot, and the levels within are hashed in place. The way back hands every array
the siblings above it, and each row's siblings inside its array are added there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.base import settle

FAN, STEP = 3, 6
ARRAY = FAN**STEP  # nodes of a slot array
LOW_BITS = 12
CELL = 1 << LOW_BITS
FEW = CELL // 16  # up to so many ids two bytes each are smaller than a bit for each possible one
EXPLODED = 1 << 16  # copies of one row given back at once
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
AGAIN = np.dtype([("low", "<u2"), ("more", "<i8")])

CONTAINER = "grp string, high bigint, held binary, again binary, n bigint"


def encoded(column: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon, and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256, in hex, of the encoded columns end to end."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above n leaves until one node is left."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * FAN
    return levels


def above(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]


# Containers: the set of low bits, and the extra rows of those that occur more than once.


def hold(lows: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Compressed container of sorted distinct low bits, and the extra rows of repeated ones."""
    if len(lows) <= FEW:
        held = b"a" + lows.astype("<u2").tobytes()
    else:
        bits = np.zeros(CELL, np.uint8)
        bits[lows] = 1
        held = b"b" + np.packbits(bits).tobytes()
    some = np.flatnonzero(counts > 1)
    again = np.empty(len(some), AGAIN)
    again["low"], again["more"] = lows[some], counts[some] - 1
    return held, again.tobytes()


def held_lows(held: bytes) -> np.ndarray:
    if held[:1] == b"a":
        return np.frombuffer(held, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8, offset=1)))


def ranks(held: bytes, again: bytes, lows: np.ndarray) -> np.ndarray:
    """Rows of the container that come before each of the given low bits."""
    if held[:1] == b"a":
        out = np.searchsorted(np.frombuffer(held, "<u2", offset=1), lows).astype(np.int64)
    else:
        bits = np.unpackbits(np.frombuffer(held, np.uint8, offset=1))
        out = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))[lows]
    if again:
        extra = np.frombuffer(again, AGAIN)
        out += np.concatenate(([0], np.cumsum(extra["more"])))[np.searchsorted(extra["low"], lows)]
    return out


def _container_rows(rows: list[tuple]) -> pa.RecordBatch:
    grp, high, held, again, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(grp, pa.string()), pa.array(high, pa.int64()), pa.array(held, pa.binary()),
         pa.array(again, pa.binary()), pa.array(n, pa.int64())], ["grp", "high", "held", "again", "n"])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of each batch of (grp, doc_id); null ids are counted under a null ``high``."""
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        codes = names.indices.to_numpy()
        known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        rows = [(names.dictionary[int(code)].as_py(), None, b"", b"", int(n))
                for code, n in zip(*np.unique(codes[~known], return_counts=True), strict=True)]
        ids, codes = batch.column(1).drop_null().to_numpy(), codes[known]
        order = np.lexsort((ids, codes))
        ids, codes = ids[order], codes[order]
        high = ids >> LOW_BITS
        cuts = np.flatnonzero((np.diff(high) != 0) | (np.diff(codes) != 0)) + 1
        for part in np.split(np.arange(len(ids)), cuts) if len(ids) else ():
            lows, counts = np.unique(ids[part] & (CELL - 1), return_counts=True)
            code, cell = int(codes[part[0]]), int(high[part[0]])
            rows.append((names.dictionary[code].as_py(), cell, *hold(lows, counts), len(part)))
        if rows:
            yield _container_rows(rows)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One container from all of a key: (grp, high, parts of held and again, n)."""
    for batch in batches:
        rows = []
        for grp, high, parts, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if high is None:
                rows.append((grp, None, b"", b"", n))
                continue
            lows, counts = [], []
            for part in parts:
                lows.append(held_lows(part["held"]))
                extra = np.frombuffer(part["again"], AGAIN)
                lows.append(extra["low"].astype(np.int64))
                counts += [np.ones(len(lows[-2]), np.int64), extra["more"]]
            distinct, place = np.unique(np.concatenate(lows), return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, place, np.concatenate(counts))
            rows.append((grp, high, *hold(distinct, total), n))
        if rows:
            yield _container_rows(rows)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, doc_id, first, n_group) of null ids and of those with more than one row."""
    for batch in batches:
        rows = []
        for grp, high, held, again, before, n_group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if high is None:
                rows.append((grp, None, before, n_group))
            elif again:
                lows = np.frombuffer(again, AGAIN)["low"].astype(np.int64)
                first = before + ranks(held, again, lows)
                rows += [(grp, (high << LOW_BITS) + low, at, n_group)
                         for low, at in zip(lows.tolist(), first.tolist(), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64()),
                                                strict=True)], ["grp", "doc_id", "first", "n_group"])


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of leaves that follow their container: (grp, high, doc_id, leaf, shown, held, again, before, n_group)."""
    key, held, again, before, n_group = None, b"", b"", 0, 0
    for batch in batches:
        grps, highs = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        codes = grps.indices.to_numpy()
        is_container = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
        # a piece is a container row, or a run of leaves
        cuts = np.flatnonzero(is_container[1:] | is_container[:-1]) + 1
        for piece in np.split(np.arange(batch.num_rows), cuts):
            begin = int(piece[0])
            here = grps.dictionary[int(codes[begin])].as_py(), int(highs[begin])
            if is_container[begin]:
                key, held, again = here, batch.column(5)[begin].as_py(), batch.column(6)[begin].as_py()
                before, n_group = batch.column(7)[begin].as_py(), batch.column(8)[begin].as_py()
                continue
            if here != key:
                raise RuntimeError(f"no container for {here}")
            part = batch.slice(begin, len(piece))
            ids = part.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(before + ranks(held, again, ids & (CELL - 1)), pa.int64()),
                pa.array(np.full(len(ids), n_group), pa.int64()), part.column(2), part.column(3), part.column(4)],
                ["grp", "idx", "n_group", "doc_id", "leaf", "shown"])


def directory(leaves: DataFrame) -> DataFrame:
    """grp, high, held, again, before and n_group of all containers of the leaves (grp, doc_id).

    ``before`` counts the rows of the group in earlier containers, null ids before all others. The
    running sum goes over range partitions, so neither a group nor a range of ids is one task's.
    """
    built = leaves.select("grp", "doc_id").mapInArrow(_build, CONTAINER)
    gathered = built.groupBy("grp", "high").agg(
        F.collect_list(F.struct("held", "again")).alias("parts"), F.sum("n").alias("n"))
    merged = settle(gathered.mapInArrow(_merge, CONTAINER), "bitmaps")
    ranged = settle(merged.repartitionByRange("grp", "high").withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("grp", "part").agg(F.sum("n").alias("part_n"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("grp", "part", F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("part_start"),
                         F.sum("part_n").over(group).alias("n_group"))
    own = Window.partitionBy("grp", "part").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0)))
    return settle(counted.join(starts, ["grp", "part"]).select(
        "grp", "high", "held", "again", (F.col("part_start") + F.col("own")).alias("before"), "n_group"), "directory")


def placed(leaves: DataFrame, found: DataFrame) -> DataFrame:
    """grp, idx, n_group, doc_id, leaf and shown: every leaf's place in its group."""
    repeated = settle(found.filter("high is null or octet_length(again) > 0").select(
        "grp", "high", "held", "again", "before", "n_group").mapInArrow(
        _repeated, "grp string, doc_id bigint, first bigint, n_group bigint"), "repeated")
    single = leaves.filter("doc_id is not null").join(repeated, ["grp", "doc_id"], "left_anti").select(
        "grp", F.shiftright("doc_id", LOW_BITS).alias("high"), "doc_id", "leaf", "shown",
        *[F.lit(None).cast(t).alias(c) for c, t in
          (("held", "binary"), ("again", "binary"), ("before", "bigint"), ("n_group", "bigint"))])
    containers = found.filter("high is not null").select(
        "grp", "high", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("leaf"),
        F.lit(None).cast("binary").alias("shown"), "held", "again", "before", "n_group")
    ranked = containers.unionByName(single).repartition("grp", "high").sortWithinPartitions(
        "grp", "high", F.col("held").isNull()).mapInArrow(
        _rank, "grp string, idx bigint, n_group bigint, doc_id bigint, leaf binary, shown binary")
    # Rows of repeated ids stand by leaf; alike ones are counted, and the running count goes over cells of leaves.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    twins = repeated.select(F.col("grp").alias("twin_grp"), key.alias("twin"), "first", "n_group")
    many = leaves.withColumn("id_key", key)
    many = many.join(twins, (many["grp"] == twins["twin_grp"]) & (many["id_key"] == twins["twin"]))
    many = settle(many.groupBy("grp", "id_key", "doc_id", "leaf", "shown", "first", "n_group").agg(
        F.count("*").alias("copies")).withColumn("cell", F.hex(F.substring("leaf", 1, 1))), "twins")
    cells = many.groupBy("grp", "id_key", "cell").agg(F.sum("copies").alias("cell_n"))
    earlier = Window.partitionBy("grp", "id_key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("grp", "id_key", "cell", F.coalesce(F.sum("cell_n").over(earlier), F.lit(0)).alias("cell_start"))
    own = Window.partitionBy("grp", "id_key", "cell").orderBy("leaf", "shown").rowsBetween(Window.unboundedPreceding, -1)
    told = many.withColumn("own", F.coalesce(F.sum("copies").over(own), F.lit(0))).join(cells, ["grp", "id_key", "cell"])
    told = told.withColumn("piece", F.explode(F.expr(f"sequence(0L, (copies - 1) div {EXPLODED})"))).withColumn(
        "copy", F.explode(F.expr(f"sequence(piece * {EXPLODED}, least(copies, (piece + 1) * {EXPLODED}) - 1)")))
    return ranked.unionByName(told.select(
        "grp", (F.col("first") + F.col("cell_start") + F.col("own") + F.col("copy")).alias("idx"), "n_group",
        "doc_id", "leaf", "shown"))


# Trees


def _slots(nodes: DataFrame, *columns: str) -> DataFrame:
    """Nodes of each array by slot: grp, chunk, n_group and arrays of the digest and of the other columns."""
    chunk = F.expr(f"idx div {ARRAY}L")
    slots = F.array_sort(F.collect_list(F.struct("idx", *columns)))
    return nodes.groupBy("grp", chunk.alias("chunk"), "n_group").agg(slots.alias("slots"))


def _reduce(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n_group, nodes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                nodes = [node.hex() for node in nodes]
                for _ in range(min(STEP, depth(n_group) - STEP * step)):
                    nodes = above(nodes)
                tops.append(bytes.fromhex(nodes[0]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(tops, pa.binary())], ["grp", "idx", "n_group", "leaf"])

    return run


def siblings(nodes: list[str], levels: int) -> list[list[tuple[str, str]]]:
    """For each node, the digests left and right of it in its run, level by level."""
    out = [[] for _ in nodes]
    places = list(range(len(nodes)))
    for _ in range(levels):
        for node, at in enumerate(places):
            run = at - at % FAN
            out[node].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FAN])))
        nodes, places = above(nodes), [at // FAN for at in places]
    return out


def _descend(step: int):
    """Paths of an array's nodes from the array's own path: (grp, chunk, n_group, idxs, nodes, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, _, n_group, idxs, nodes, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                levels = max(0, min(STEP, depth(n_group) - STEP * step))
                paths = siblings([node.hex() for node in nodes], levels)
                yield pa.RecordBatch.from_arrays([
                    pa.array([grp] * len(idxs), pa.string()), pa.array(idxs, pa.int64()),
                    pa.array([[pair[0] for pair in path] + left for path in paths], pa.list_(pa.string())),
                    pa.array([[pair[1] for pair in path] + right for path in paths], pa.list_(pa.string()))],
                    ["grp", "idx", "left", "right"])

    return run


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proof hash and refolded root of every leaf: (n_group, doc_ids, leaves, shown, left, right, grp)."""
    for batch in batches:
        for n_group, doc_ids, leaves, shown, left, right, grp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            nodes = [leaf.hex() for leaf in leaves]
            upper = list(zip(left, right, strict=True))
            tail = "".join(a + b for a, b in upper)
            proofs, roots = [], []
            for node, seen, path in zip(nodes, shown, siblings(nodes, min(STEP, depth(n_group))), strict=True):
                proofs.append(digest("".join(a + b for a, b in path) + tail))
                folded = node if seen is None else seen.hex()
                for before, after in path + upper:
                    folded = digest(before + folded + after)
                roots.append(folded)
            yield pa.RecordBatch.from_arrays([
                pa.array([grp] * len(nodes), pa.string()), pa.array(doc_ids, pa.int64()), pa.array(nodes, pa.string()),
                pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
                ["grp", "doc_id", "leaf", "proof_sha256", "folded_root"])


def grow(nodes: DataFrame, largest: int, *columns: str) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every step over the nodes (grp, idx, n_group, leaf, ...), and each group's root."""
    arrays = []
    for step in range(max(1, -(-depth(largest) // STEP))):
        arrays.append(settle(_slots(nodes, "leaf", *(columns if not step else ())), "slots"))
        nodes = settle(arrays[-1].select("grp", "chunk", "n_group", "slots.leaf").mapInArrow(
            _reduce(step), "grp string, idx bigint, n_group bigint, leaf binary"), "nodes")
    return arrays, nodes


def descend(arrays: list[DataFrame], paths: DataFrame, last: int) -> DataFrame:
    """Hand the paths (grp, idx, left, right) of the roots down to the arrays of step ``last``."""
    for step in range(len(arrays) - 1, last - 1, -1):
        own = arrays[step].select("grp", F.col("chunk").alias("idx"), "n_group", F.col("slots.idx").alias("idxs"),
                                  F.col("slots.leaf").alias("nodes"))
        paths = settle(own.join(paths, ["grp", "idx"]).select(
            "grp", "idx", "n_group", "idxs", "nodes", "left", "right").mapInArrow(
            _descend(step), "grp string, idx bigint, left array<string>, right array<string>"), "paths")
    return paths


def numbered(groups: DataFrame) -> DataFrame:
    """The groups with their place in order, counted by range partitions."""
    ranged = settle(groups.repartitionByRange("grp").withColumn("part", F.spark_partition_id()), "groups")
    sums = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("grp")) - 1
    return settle(ranged.withColumn("own", own).join(starts, "part").withColumn(
        "place", (F.col("own") + F.col("start")).cast("bigint")).drop("own", "start", "part"), "places")


def manifest(docs: DataFrame, shown: dict[str, Column] | None = None, columns: tuple[str, ...] = LEAF,
             id_column: str = "doc_id", group_column: str = "source") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A leaf is the SHA-256 of the ``columns``, each ``-`` if null, else UTF-8 byte count, colon and
    value. The leaves of a group ascend by id, null ids first, rows that repeat an id by leaf; every
    row is a leaf of its own, rows alike in all columns too. Runs of three become a node until one is left, the group's
    ``subroot``; subroots in order of the group, null first, likewise become ``root``. ``proof_sha256`` is the hash of
    all siblings from the leaf up. ``shown`` replaces columns by what somebody presents as the document:
    ``folded_root`` is folded from that leaf and the true siblings, and ``verified`` says whether it is the root.

    Ids must be of an integer type; others raise TypeError. Empty and long texts are values like any. An
    empty table gives no rows. Further columns have no influence.
    """
    kind = dict(docs.dtypes)[id_column]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_column} must be an integer column to be held in bitmaps, not {kind}")
    true = leaf_hash([F.col(c) for c in columns])
    seen = leaf_hash([(shown or {}).get(c, F.col(c)) for c in columns])
    source = F.col(group_column).cast("string")
    leaves = docs.select(
        F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("grp"),
        F.col(id_column).cast("bigint").alias("doc_id"), F.unhex(true).alias("leaf"), F.unhex(seen).alias("seen"))
    leaves = settle(leaves.select("grp", "doc_id", "leaf", F.when(F.col("seen") != F.col("leaf"), F.col("seen"))
                                  .alias("shown")), "leaves")
    found = directory(leaves)
    largest = found.agg(F.max("n_group")).first()[0] or 0
    arrays, subroots = grow(placed(leaves, found), largest, "doc_id", "shown")
    groups = numbered(subroots.select("grp", F.col("leaf").alias("subroot")))
    n_groups = groups.count()
    top = groups.select(F.lit("").alias("grp"), F.col("place").alias("idx"), F.lit(n_groups).cast("bigint").alias("n_group"),
                        F.col("subroot").alias("leaf"))
    top_arrays, roots = grow(top, n_groups)
    root = (roots.first() or {"leaf": None})["leaf"]
    empty = F.array().cast("array<string>")
    start = roots.select("grp", F.lit(0).cast("bigint").alias("idx"), empty.alias("left"), empty.alias("right"))
    top_paths = descend(top_arrays, start, 0).select(F.col("idx").alias("place"), "left", "right")
    paths = groups.join(top_paths, "place").select("grp", F.lit(0).cast("bigint").alias("idx"), "left", "right")
    paths = descend(arrays, paths, 1)
    proved = arrays[0].join(paths.withColumnRenamed("idx", "chunk"), ["grp", "chunk"]).select(
        "n_group", "slots.doc_id", "slots.leaf", "slots.shown", "left", "right", "grp").mapInArrow(
        _prove, "grp string, doc_id bigint, leaf string, proof_sha256 string, folded_root string")
    root = F.lit(root.hex() if root else None).cast("string")
    return proved.join(groups.select("grp", F.lower(F.hex("subroot")).alias("subroot")), "grp").select(
        F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
