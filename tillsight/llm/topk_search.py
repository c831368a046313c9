"""Exact top-k inner products over vectors in descending length, pruned by Cauchy-Schwarz bounds.

Vectors become integers, floor(scale * x). An orthogonal rotation, from the singular value
decomposition of all vectors' Gram matrix, puts the most of every product into the first dimensions.
Candidates are range-partitioned by falling length and packed into blocks, one matrix each. Groups of query
blocks meet groups of candidate blocks, a pair of groups a task: the queries stay in the task, the candidates pass by in
falling length. Rows are copied once per group of the other side, and there are few groups: pairs of blocks are never rows.
A query block goes to those groups only whose longest vector can still reach a query's k-th best score. Within a block, tiles
follow falling length. For each tile the bound is partial product over the first dimensions plus the product of both residual
lengths. Only pairs whose bound reaches the query's k-th best score so far get their exact integer product; after a tile
whose bounds left most pairs open, some tiles get products without bounds. The k-th best score starts from the longest
vectors, which every query is compared with first.

Results of groups are merged per query; each has at most k rows per query, so the merge is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.base import settle
from tillsight.operators.nearest import Best

BLOCK_ROWS = 16_384  # candidates of a block, about
QUERY_ROWS = 512  # queries of a block, about
QUERY_GROUP = 131_072  # queries a task holds, about
GROUPS = 64  # of candidates: a query goes to so many tasks, or as many as there are cores
TILE = 2_048
LEAD = 16  # rotated dimensions of the partial products
OPEN, MOST_WAIT = 0.5, 63  # a share of open pairs that bounds are not worth; tiles that then follow without them, at most
SAFE = 2**62


def scaled(column: str, scale: int):
    """floor(scale * x) of each component as bigint; null where any is null or not finite or the array is."""
    wide = F.transform(F.col(column), lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(wide, lambda x: F.floor(x * scale).cast("bigint")))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of ``dim`` numbers each as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _gram(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            rows = _rows(batch.column(0), dim).astype(float)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(list(total))], ["i", "row"])

    return run


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all vectors together, largest first."""
    parts = vectors.select("vec").mapInArrow(_gram(dim), "i bigint, row array<double>")
    rows = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros((dim, dim))
    for r in rows:  # dim * dim numbers
        gram[r["i"], r["j"]] = r["x"]
    _, _, turned = np.linalg.svd((gram + gram.T) / 2)
    return turned.T


PACKED = "ids binary, matrix binary, n int, longest double"


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(float) ** 2).sum(axis=1))


def _pack(dim: int, rows: int):
    """(id, vec) in order to one (ids, matrix, row count, longest length) row per run of at most ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids, matrix):
            most = max(int(matrix.max()), -int(matrix.min()) - 1)
            kind = next(x for x in (np.int16, np.int32, np.int64) if most <= np.iinfo(x).max)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()]), pa.array([matrix.astype(kind).tobytes()]), pa.array([len(ids)], pa.int32()),
                 pa.array([float(_lengths(matrix).max())])], ["ids", "matrix", "n", "longest"])

        ids, matrix = np.empty(0, np.int64), np.empty((0, dim), np.int64)
        for batch in batches:
            ids = np.concatenate((ids, batch.column(0).to_numpy(zero_copy_only=False)))
            matrix = np.concatenate((matrix, _rows(batch.column(1), dim)))
            for _ in range(len(ids) // rows):
                yield flush(ids[:rows], matrix[:rows])
                ids, matrix = ids[rows:], matrix[rows:]
        if len(ids):
            yield flush(ids, matrix)

    return run


def _unpack(line: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a packed row, whose integers are as wide as the largest asks for."""
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(line["matrix"]) // (line["n"] * dim)]
    return np.frombuffer(line["ids"], np.int64), np.frombuffer(line["matrix"], kind).reshape(-1, dim)


class Vectors:
    """Integer vectors, and for the bounds their first rotated dimensions with the length of the rest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, turned: np.ndarray):
        wide = rows.astype(float)
        rotated = wide @ turned
        rest = np.sqrt((rotated[:, LEAD:] ** 2).sum(axis=1))
        self.ids, self.rows, self.size = ids, rows, _lengths(rows)
        self.most = float(np.abs(wide).max(initial=0))
        self.bounds, self.kinds = np.column_stack((rotated[:, :LEAD], rest)), {}

    def of(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, bounds) as floating point numbers."""
        if kind not in self.kinds:
            self.kinds[kind] = self.rows.astype(kind), self.bounds.astype(kind)
        return self.kinds[kind]


def _products(queries: np.ndarray, rows: np.ndarray, most: float) -> np.ndarray:
    """Integer products of 2**53 or more, in Python's integers where sums may leave 64 bits."""
    if most < SAFE:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Search:
    """Best k of the candidates seen so far for a block of queries; k rows at most per query."""

    def __init__(self, queries: Vectors, k: int, floor: np.ndarray | None = None):
        self.queries, self.best = queries, Best(len(queries.ids), k, np.int64, floor)
        self.wait = self.pause = 0

    def offer(self, block: Vectors) -> None:
        """Candidates in falling length."""
        asked, ids = self.queries, self.queries.ids
        most = asked.most * block.most * block.rows.shape[1]
        # sums below 2**24 are exact in single precision, below 2**53 in double
        kind, error = (np.float32, 1e-4) if most < 2**24 else (float, 1e-9)
        (left, left_bound), (right, right_bound) = asked.of(kind), block.of(kind)
        for start in range(0, len(block.ids), TILE):
            part = slice(start, start + TILE)
            slack = error * (asked.size * block.size[part].max()) + 1e-6  # rounding of the bounds
            least = self.best.limit.astype(float) - slack
            lines = np.flatnonzero(asked.size * block.size[part].max() >= least)
            if not len(lines):
                return  # the whole rest of the block is shorter
            some = slice(None) if len(lines) == len(ids) else lines
            columns = np.arange(start, min(start + TILE, len(block.ids)))
            if self.wait:
                self.wait -= 1
            else:
                able = left_bound[some] @ right_bound[part].T >= least[some, None]
                if np.count_nonzero(able) > OPEN * able.size:
                    self.wait = self.pause = min(2 * self.pause + 1, MOST_WAIT)
                else:
                    self.pause = 0
                    columns, lines = columns[able.any(axis=0)], lines[able.any(axis=1)]
                    if not len(columns):
                        continue
                    some = lines
            seen = part if len(columns) == len(right[part]) else columns
            exact = left[some] @ right[seen].T if most < 2**53 else _products(asked.rows[some], block.rows[seen], most)
            at, column = self.best.reaching(lines, exact, self.best.limit[lines].astype(exact.dtype),
                                            lambda q, names=block.ids[seen]: ids[q, None] == names)
            score, name = exact[at, column].astype(np.int64), block.ids[columns[column]]
            other = ids[lines[at]] != name
            self.best.keep(lines[at][other], score[other], name[other])


def _compare(dim: int, k: int, turned: np.ndarray):
    """(pair, kind, block, ids, matrix, n, floor) in order of the first three to (query_id, vec_id, score): for each pair of groups
    the blocks of queries, of kind 0, then those of candidates."""

    def found(searches: list[Search]) -> Iterator[pa.RecordBatch]:
        for search in searches:
            q, n = search.best.entries()
            yield pa.RecordBatch.from_arrays(
                [pa.array(search.queries.ids[q]), pa.array(search.best.names[q, n]), pa.array(search.best.scores[q, n])],
                ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, searches = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                line = batch.slice(i, 1).to_pylist()[0]
                if line["pair"] != pair:
                    yield from found(searches)
                    pair, searches = line["pair"], []
                if line["kind"] and not searches:
                    continue
                vectors = Vectors(*_unpack(line, dim), turned)
                if line["kind"]:
                    for search in searches:
                        search.offer(vectors)
                else:
                    searches.append(Search(vectors, k, np.frombuffer(line["floor"], np.int64)))
        yield from found(searches)

    return run


def _floors(dim: int, k: int, turned: np.ndarray, longest):
    """Packed queries with the k-th score of each query among the longest vectors, or the least integer, and the length below
    which no candidate can matter to any of the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Vectors(*longest.value, turned)
        for batch in batches:
            for line in batch.to_pylist():
                queries = Vectors(*_unpack(line, dim), turned)
                search = Search(queries, k)
                search.offer(first)
                floor = search.best.limit
                reach = np.where(search.best.count == k, floor.astype(float), -np.inf)
                # the same slack as in the search: size * length * (1 + 1e-4) + 1e-6 reaches the floor
                least = np.full(len(floor), -np.inf)
                np.divide(reach - 1e-6, queries.size * (1 + 1e-4), out=least, where=(queries.size > 0) & (reach > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([line["ids"]]), pa.array([line["matrix"]]), pa.array([line["n"]], pa.int32()),
                     pa.array([floor.tobytes()]), pa.array([float(least.min())])], ["ids", "matrix", "n", "floor", "least"])

    return run


def _one_dimension(candidates: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """Top k for vectors of one dimension; both frames are (vec_id, vec)."""
    context = candidates.sparkSession.sparkContext
    turned = rotation(candidates, dim)
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, asking = candidates.count(), queries.count()
    parts = max(1, -(-count // BLOCK_ROWS))
    ordered = candidates.withColumn("length", -length).repartitionByRange(parts, "length", "vec_id")
    packed = ordered.sortWithinPartitions("length", "vec_id").select("length", "vec_id", "vec")
    blocks = settle(packed.select("vec_id", "vec").mapInArrow(_pack(dim, BLOCK_ROWS), PACKED)
                    .withColumn("block", F.monotonically_increasing_id()), "blocks")
    asked = queries.repartition(max(1, -(-asking // QUERY_ROWS)), "vec_id").sortWithinPartitions("vec_id")
    asked = settle(asked.select("vec_id", "vec").mapInArrow(_pack(dim, QUERY_ROWS), PACKED).select("ids", "matrix", "n"), "queries")
    # a row per BLOCK_ROWS candidates, longest first
    sizes = blocks.select("block", "n", "longest").orderBy("block").collect()
    # The longest vectors first, TILE of them: they set the score each query must reach.
    before = np.cumsum([0] + [r["n"] for r in sizes])
    first = [r["block"] for r, b in zip(sizes, before, strict=False) if b < TILE]
    head = [_unpack(r.asDict(), dim) for r in blocks.filter(F.col("block").isin(first)).orderBy("block").collect()]
    ids, rows = (np.concatenate(x)[:TILE] for x in zip(*head, strict=True))
    floors = settle(asked.mapInArrow(_floors(dim, k, turned, context.broadcast((ids, rows))),
                                     "ids binary, matrix binary, n int, floor binary, least double")
                    .withColumn("asked", F.xxhash64("ids")), "floors")
    # Groups of candidates are runs of blocks of about as many rows; a few numbers each.
    groups = min(len(sizes), max(GROUPS, context.defaultParallelism))
    group_of = [int(b) * groups // int(before[-1]) for b in before[:-1]]
    starts = [r for i, r in enumerate(sizes) if not i or group_of[i] != group_of[i - 1]]
    cuts, longest = (F.array(*[F.lit(r[c]) for r in starts]) for c in ("block", "longest"))
    crowds = max(1, -(-asking // QUERY_GROUP))
    floors = floors.withColumn("crowd", F.pmod("asked", F.lit(crowds)).cast("int"))
    needed = {r["crowd"]: r["least"] for r in floors.groupBy("crowd").agg(F.min("least").alias("least")).collect()}
    needed = F.array(*[F.lit(needed.get(c, float("inf"))) for c in range(crowds)])
    # A stated query set against all rows: queries go to the groups whose longest vector can reach a floor, candidates to
    # the crowds of queries that they can matter to.
    sent = floors.select("ids", "matrix", "n", "floor", "least", "crowd", F.posexplode(longest).alias("group", "longest"))
    sent = sent.filter("longest >= least").select("crowd", "group", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("block"),
                                                  "ids", "matrix", "n", "floor")
    met = blocks.select("ids", "matrix", "n", "block", "longest", F.posexplode(needed).alias("crowd", "least"),
                        (F.size(F.filter(cuts, lambda c: c <= F.col("block"))) - 1).alias("group"))
    met = met.filter("longest >= least").select("crowd", "group", F.lit(1).alias("kind"), "block", "ids", "matrix", "n",
                                                F.lit(None).cast("binary").alias("floor"))
    pair = (F.col("crowd") * len(starts) + F.col("group")).alias("pair")
    meetings = sent.union(met).select(pair, "kind", "block", "ids", "matrix", "n", "floor")
    meetings = meetings.repartitionById(crowds * len(starts), "pair").sortWithinPartitions("pair", "kind", "block")
    return meetings.mapInArrow(_compare(dim, k, turned), "query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of the
    query's own id. Components are floor(scale * x). Ties go to the smaller id. Fewer than k
    candidates give as many rows. Vectors that are null or empty or hold null or non-finite
    components take no part, nor do rows with a null id; a repeated row counts once, rows that
    repeat an id with another vector are candidates each, and as queries compete for one list.
    Vectors meet those of their own dimension only. Components and scores beyond 64 bits stop at the end of the
    range. An empty table gives no rows; other columns have no influence.
    """
    spark = vectors.sparkSession
    usable = settle(vectors.select(F.col(id_column).alias("vec_id"), scaled(vector_column, scale).alias("vec"))
                    .filter("vec_id is not null and vec is not null and size(vec) > 0").distinct(), "vectors")
    parts = [spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")]
    for row in usable.groupBy(F.size("vec").alias("dim")).count().orderBy("dim").collect():  # a few dimensions
        own = usable.filter(F.size("vec") == row["dim"])
        parts.append(_one_dimension(own, own.filter(F.col("vec_id") % every == 0), row["dim"], k))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
