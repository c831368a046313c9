"""URL filters by a sort-merge range join.

A host is written with its labels in reverse, each followed by a dot: ``com.example.``. Then a
rule's host is a prefix of the key of that host and all its subdomains, and covers an interval of the
key order. Urls are range-partitioned and sorted by key. Each task sweeps them together with the
sorted rules and keeps a stack of the rules whose interval the sweep is in; they are nested, as
prefixes are. Of the rules on the stack whose path the url's path starts with, the longest wins.

Rules are handled in sorted blocks of at most ``BLOCK_RULES``, each broadcast in turn; a url carries
its longest rule from one block to the next.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import scratch

BLOCK_RULES = 100_000


def ascii_lower(column):
    """A-Z lower-cased, nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url):
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url):
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: str) -> str:
    """Labels in reverse, each followed by a dot."""
    return ".".join(reversed(host.split("."))) + "."


def reversed_key(host):
    """``host_key`` of a column."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class RuleBlock:
    """Rules sorted by key, those of one host together: path to (rule, verdict)."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_key: dict[str, dict[str, tuple[str, str]]] = {}
        for host, path, verdict in sorted(rules):  # of equal rules the one that blocks stays
            by_key.setdefault(host_key(host), {})[path] = (host + path, verdict)
        self.keys = sorted(by_key)
        self.paths = [by_key[k] for k in self.keys]
        self.lengths = [sorted({len(p) for p in paths}, reverse=True) for paths in self.paths]

    def around(self, key: str) -> list[int]:
        """Rules whose interval holds a key, outermost first: where a sweep that starts there begins."""
        out = []
        at = -1
        while (at := key.find(".", at + 1)) >= 0:
            place = bisect.bisect_left(self.keys, key[: at + 1])
            if place < len(self.keys) and self.keys[place] == key[: at + 1]:
                out.append(place)
        return out

    def best(self, stack: list[int], path: str) -> tuple[str, str] | None:
        """Longest rule of the stack whose path the given one starts with; of equally long ones the inner host's."""
        found = None
        for place in reversed(stack):
            for length in self.lengths[place]:
                rule = self.paths[place].get(path[:length]) if length <= len(path) else None
                if rule:
                    if found is None or len(rule[0]) > len(found[0]):
                        found = rule
                    break
        return found


def _sweep(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: RuleBlock = shared.value
        stack: list[int] = []
        following, started, before = 0, False, None
        for batch in batches:
            keys, paths, known, verdicts = (batch.column(i).to_pylist() for i in range(4))
            for n, (key, path) in enumerate(zip(keys, paths, strict=True)):
                if key != before:
                    if not started:
                        started = True
                        stack = rules.around(key)
                        following = bisect.bisect_right(rules.keys, key)
                    while stack and not key.startswith(rules.keys[stack[-1]]):
                        stack.pop()
                    while following < len(rules.keys) and rules.keys[following] <= key:
                        if key.startswith(rules.keys[following]):
                            stack.append(following)
                        following += 1
                    before = key
                rule = rules.best(stack, path)
                if rule and (known[n] is None or len(rule[0]) > len(known[n])):
                    known[n], verdicts[n] = rule
            columns = [pa.array(known, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *columns, *batch.columns[4:]], batch.schema.names)

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_column: str = "url") -> DataFrame:
    """The pages with host, path, rule and verdict of their urls.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains
    if the url's path starts with the rule's path. The longest rule wins, measured as host and path
    together; of equally long ones the one of the longer host, of equal rules block. Without a rule,
    ``rule`` is null and the verdict is ``default``. Rules with a null or empty host are left out, a
    null path is empty, a null verdict is the default.

    Null urls and those without :// have an empty host and path and fit no rule. One row comes back
    per row; other columns pass through, but for those named host, path, rule or verdict.
    """
    spark = pages.sparkSession
    key, path, rule, verdict = (scratch(n) for n in ("key", "path", "rule", "verdict"))
    hosts, others = scratch("host"), [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.col(url_column)
    rows = pages.select(
        reversed_key(url_host(url)).alias(key), url_path(url).alias(path), F.lit(None).cast("string").alias(rule),
        F.lit(None).cast("string").alias(verdict), url_host(url).alias(hosts), *others)
    spread = F.xxhash64(path, hosts, *others[:1])  # so that one host can fill several partitions
    rows = rows.repartitionByRange(F.col(key), spread).sortWithinPartitions(key)
    clean = rules.select("host", F.coalesce("path", F.lit("")).alias("path"),
                         F.coalesce("verdict", F.lit(default)).alias("verdict")).filter("host <> ''").distinct()
    blocks = max(1, -(-clean.count() // BLOCK_RULES))
    clean = clean.withColumn("block", F.pmod(F.xxhash64("host"), F.lit(blocks)))
    for block in range(blocks):
        found = clean.filter(F.col("block") == block).limit(4 * BLOCK_RULES + 1).collect()
        if len(found) > 4 * BLOCK_RULES:
            raise ValueError("too many rules for one block")
        shared = spark.sparkContext.broadcast(RuleBlock([(r["host"], r["path"], r["verdict"]) for r in found]))
        rows = rows.mapInArrow(_sweep(shared), rows.schema)
    return rows.select(*others, F.col(hosts).alias("host"), F.col(path).alias("path"), F.col(rule).alias("rule"),
                       F.coalesce(verdict, F.lit(default)).alias("verdict"))
