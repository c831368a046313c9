"""Token files, Merkle manifest and ranked search against brute force on small, awkward tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import merkle as M
from tillsight.llm import ranked_search as R
from tillsight.llm import token_files as T
from tillsight.llm.base import prepare
from tillsight.llm.decontaminate import leaks
from tillsight.llm.mixing import mix, mixed
from tillsight.session import new_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


# ---- token files


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 9, 15, 16, 17, 24, 31, 32])
def test_packing_is_exact_and_read_from_anywhere(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000, 70_001):
        ids = rng.integers(0, 2**bits, n, dtype=np.uint64).astype("<u4")
        packed = T.pack(ids, bits)
        assert len(packed) == -(-n * bits // 8) and (T.unpack(packed, bits, 0, n) == ids).all()
        for _ in range(5):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert (T.unpack(packed, bits, a, b) == ids[a:b]).all()
    with pytest.raises(ValueError, match="does not fit"):
        T.pack(np.array([1 << bits], np.uint64), bits)


def test_bits_of_the_vocabulary():
    assert [T.id_bits(n) for n in (0, 1, 2, 255, 256, 50_256, 65_535, 65_536)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoder_equals_the_library_on_odd_texts(path):
    with open(path, encoding="utf-8") as file:
        found = T.Encoder(file.read())
    assert found.by_pieces == (path == BYTE_BPE)
    rng = random.Random(3)
    odd = [*"aZ09 _-'.\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x7f\x85\xa0²½Ⅷé́ß中文​ 　՘͸😀٣𞤀﻿", "'s", "'ll", "  ", "<|endoftext|>"]
    texts = ["", " ", "\n\n \n", "it's WE'LL they'Ve  x", "a" * 5000] + ["".join(rng.choices(odd, k=rng.randrange(1, 40))) for _ in range(400)]
    texts += [f"a{chr(c)}1 {chr(c)} !{chr(c)}  {chr(c)}{chr(c)} b's" for c in itertools.chain(range(1, 0x500), range(0x2000, 0x2070))]
    for text in texts:
        assert found.encode(text) == found.whole(text), repr(text)


def documents(spark, rows, kind="bigint"):
    return spark.createDataFrame([(a, t, "x", 1) for a, t in rows], f"doc_id {kind}, text string, ids string, shard int")


def expected(rows, path, end_id):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    out, at = [], 0
    for name, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((name, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_files_hold_every_document_in_order(spark, monkeypatch, kind):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta's", "ünder", "12", "\n", "中文"], k=rng.randrange(60)))) for i in range(-20, 180)]
    rows += [(500, "long " * 40_000), (501, None), (502, "")]
    rows = [(f"{a + 1000:05d}" if kind == "string" else a, t) for a, t in rows]
    shuffled = rng.sample(rows, len(rows))
    path = new_path(spark, "tokens")
    T.write_tokens(documents(spark, shuffled, kind).repartition(5), path, BYTE_BPE, 2)
    want = expected(rows, BYTE_BPE, 2)
    got = sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in T.read_tokens(spark, path).collect())
    assert got == want
    blocks = spark.read.parquet(f"{path}/blocks")
    assert {r.bits for r in blocks.collect()} == {16}
    assert all(len(r.packed) == 2 * r.n_ids and r.ends[-1] == r.n_ids for r in blocks.collect())
    whole = np.frombuffer(b"".join(w[3] for w in want), "<u4")
    for a, b in ((0, 1), (0, len(whole)), (len(whole) - 5, len(whole)), (1234, 40_321), (7, 7), (len(whole), len(whole) + 9)):
        assert T.read_span(spark, path, a, b).tolist() == whole[a:b].tolist()


def test_repeated_and_null_ids_and_the_empty_table(spark):
    rows = [(None, "b"), (None, "a"), (3, "x"), (3, "y z"), (3, "x"), (3, None), (1, "")]
    path = new_path(spark, "tokens")
    T.write_tokens(documents(spark, rows), path, BYTE_BPE, 50_256)
    got = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 3, 3, 3, 3]
    assert collections.Counter(bytes(r.ids) for r in got) == collections.Counter(w[3] for w in expected(rows, BYTE_BPE, 50_256))
    assert [r.start for r in got] == list(itertools.accumulate([r.n_tokens for r in got], initial=0))[:-1]
    empty = new_path(spark, "tokens")
    T.write_tokens(documents(spark, rows).limit(0), empty, WORD_BPE, 2)
    assert T.read_tokens(spark, empty).count() == 0 and T.read_span(spark, empty, 0, 10).tolist() == []
    assert T.read_tokens(spark, empty).columns == ["doc_id", "start", "n_tokens", "ids"]


def test_end_id_beyond_the_vocabulary_widens_the_ids(spark):
    path = new_path(spark, "tokens")
    T.write_tokens(documents(spark, [(1, "a b")]), path, BYTE_BPE, 70_000)
    assert spark.read.parquet(f"{path}/blocks").first().bits == 17
    assert np.frombuffer(T.read_tokens(spark, path).first().ids, "<u4")[-1] == 70_000


# ---- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tampered(name, text):
    odd = name is not None and text is not None and zlib.crc32(str(name).encode()) % 2 == 0
    return text.replace("\n", "") if odd else text


def tree(nodes):
    """Root, and each node's (left, right) siblings level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            run = at - at % 3
            path.append((nodes[run:at], nodes[at + 1:run + 3]))
        nodes, places = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], [at // 3 for at in places]
    return nodes[0], paths


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        name, source, lang, n, text = row
        leaf = sha(*map(field, row))
        groups[source].append((name is not None, name or 0, leaf, sha(*map(field, (name, source, lang, n, tampered(name, text)))), name))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    grown = {s: (sorted(groups[s], key=lambda t: t[:4]),) for s in order}
    grown = {s: (g, *tree([x[2] for x in g])) for s, (g,) in grown.items()}
    root, tops = tree([grown[s][1] for s in order]) if order else (None, [])
    out = []
    for source, top in zip(order, tops, strict=True):
        leaves, subroot, paths = grown[source]
        for leaf, path in zip(leaves, paths, strict=True):
            folded = leaf[3]
            for left, right in path + top:
                folded = sha(*left, folded, *right)
            proof = sha(*[s for left, right in path + top for s in left + right])
            out.append((leaf[4], leaf[2], subroot, root, proof, folded, folded == root))
    return out


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, "
                                                                  "text string, grp string, idx int").repartition(3)
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return [tuple(r) for r in M.manifest(docs, {"text": text}).collect()]


def merkle_cases():
    rng = random.Random(1)
    texts = ["x\ny", "z", "", None, "a\n\n", "é\n" * 3000]
    mixed = [(rng.randint(-30_000, 60_000) if rng.random() < 0.9 else None, rng.choice(["a", "b", "a", None, "", "é", "src0"]),
              rng.choice(["en", None]), rng.choice([5, None]), rng.choice(texts)) for _ in range(3000)]
    mixed += [(7, "a", "en", 1, "same")] * 50 + [(2**62 + i * 10**9, "b", "e", 1, "t\n") for i in range(40)]
    deep = [(i, "s", "en", 1, f"x\n{i}") for i in range(2300)] + [(5, f"s{i}", "en", 1, "t") for i in range(800)]
    return [[], [(1, None, None, None, None)], [(0, "a", "b", 2, "c\n")] * 2, mixed, deep]


@pytest.mark.parametrize("rows", merkle_cases(), ids=["empty", "null", "twins", "mixed", "deep"])
def test_manifest_equals_brute_force(spark, rows):
    assert sorted(manifest_of(spark, rows), key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_needs_integer_ids(spark):
    with pytest.raises(TypeError, match="integer"):
        M.manifest(spark.createDataFrame([("a", "s")], "doc_id string, source string"), columns=("doc_id", "source"))


def test_containers_keep_counts_and_ranks():
    rng = np.random.default_rng(0)
    for size in (1, 5, M.FEW, M.FEW + 1, 4000):
        lows = np.sort(rng.choice(M.CELL, size, replace=False))
        counts = rng.integers(1, 4, size)
        held, again = M.hold(lows, counts)
        assert len(held) <= min(1 + 2 * size, 1 + M.CELL // 8) and (M.held_lows(held) == lows).all()
        before = np.concatenate(([0], np.cumsum(counts)[:-1]))
        assert (M.ranks(held, again, lows) == before).all()


# ---- ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=10):
    counted = [(name, collections.Counter(terms(text)), len(terms(text))) for name, text in docs]
    counted = [c for c in counted if c[2]]
    n_docs, n_terms = len(counted), sum(c[2] for c in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in dict.fromkeys(i for i in items if i[1] is not None):
        hits = []
        for name, counts, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in set(terms(text)) if t in counts)
            if score > 0:
                hits.append((-score, name is not None, name or 0, name))
        out += [(item, rank, hit[3], -hit[0]) for rank, hit in enumerate(sorted(hits)[:k], 1)]
    return out


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "中文", "İ", "x1Y", "٣"]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=rng.randrange(1, 120)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (3, docs[3][1]), (2000, None), (2001, ""), (2002, "?! \x00\x7f")]
    docs += [(2003, "w299 " * 30_000), (2004, "W250--w250.w250_w251")]
    items = [(1, "w5 w17, w200?"), (2, docs[3][1]), (3, "nowhere to be seen"), (4, None), (5, ""), (6, "w0"), (7, "中文 ÜNÏ w299 w250"),
             (1, "w5 w17, w200?"), (1, "w44"), (None, "w250 w251 w251"), (9, "x" * 3 + " w9 " * 500)]
    return docs, items


@pytest.mark.parametrize("width", [1, 16, 4096])
def test_search_equals_brute_force_whatever_the_sketch(spark, monkeypatch, width):
    docs, items = corpus()
    frame = spark.createDataFrame([(a, t, 1, 2) for a, t in docs], "doc_id bigint, text string, score int, item int").repartition(4)
    wanted = spark.createDataFrame([(a, t, "x") for a, t in items], "item_id bigint, text string, doc_id string")
    got = [tuple(r) for r in R.ranked_search(frame, wanted, width=width).collect()]
    assert sorted(got, key=repr) == sorted(brute_search(docs, items), key=repr)


def test_items_in_many_blocks_and_other_ids(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ITEMS", 4)
    docs, items = corpus()
    docs = [(None if a is None else f"d{a:05d}", t) for a, t in docs]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in R.ranked_search(frame, wanted, k=3).collect()]
    numbers = {a: -1 if a is None else int(a[1:]) for a, _ in docs}
    want = brute_search([(numbers[a], t) for a, t in docs], items, 3)
    assert sorted(((i, r, numbers[d], s) for i, r, d, s in got), key=repr) == sorted(want, key=repr)


def test_search_of_empty_tables(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    for a, b in ((frame.limit(0), wanted), (frame, wanted.limit(0)), (frame.filter("doc_id in (2000, 2001, 2002)"), wanted)):
        found = R.ranked_search(a, b)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_below_the_scores():
    docs, items = corpus()
    items = R.Items(None, [t.encode() for _, t in items if t], 0, 32)
    counted = [collections.Counter(R.terms_of(t.encode())) for _, t in docs if t]
    df = collections.Counter(t for c in counted for t in c)
    items.weigh(len(counted), sum(sum(c.values()) for c in counted), {n: df[t] for t, n in items.number.items() if df[t]})
    lengths = [items.relative_length(sum(c.values())) for c in counted]
    bounds = items.bounds(np.stack([items.sketch(c, m) for c, m in zip(counted, lengths, strict=True)]))
    for query in range(len(items.queries)):
        assert all(b >= items.score(query, c, m) for b, c, m in zip(bounds[:, query].tolist(), counted, lengths, strict=True))


# ---- short benchmark items


def test_short_items_are_found_whole(spark):
    docs = [(1, "one TWO three four five six"), (2, "one two"), (3, "two one"), (4, None), (5, "x one two\nthree"), (5, "x one two\nthree")]
    bench = [("a", "one two three"), ("b", "Two"), ("c", "one two three four"), ("d", ""), ("e", None), (None, "one two")]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    found = leaks(frame, spark.createDataFrame(bench, "item_id string, text string"))
    got = sorted(((r.doc_id, r.item_id, r.first_word, r.similarity) for r in found.collect()), key=repr)
    assert got == sorted([(1, "a", 0, 1.0), (1, "b", 1, 1.0), (1, "c", 0, 1.0), (1, None, 0, 1.0), (2, "b", 1, 1.0), (2, None, 0, 1.0),
                          (3, "b", 0, 1.0), (5, "a", 1, 1.0), (5, "b", 2, 1.0), (5, None, 1, 1.0)], key=repr)


# ---- mixing rows that repeat an id


def test_a_share_belongs_to_a_row(spark):
    rows = [(1, "d e", "s"), (1, "d e f", "s"), (None, "x y", "s"), (None, "x", "t"), (2, "a", "t"), (2, "a", "t"), (2, "a", "t"),
            (3, None, "t"), (3, "", None)] + [(10 + i, "w " * (i % 7), "st"[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("copies", F.lit("clash"))
    for share in (0.2, 0.7, 1.5):
        shares = mix(docs, share=share)
        got = mixed(docs, share=share)
        words = sum(len((t or "").split()) for _, t, _ in rows)
        total = got.agg(F.sum("taken")).first()[0] or 0
        assert total <= share * words and total == (shares.agg(F.sum("taken")).first()[0] or 0)
        for row in got.collect():
            assert row.taken == row.copies * len((row.text or "").split()) and row.copies > 0
        key = ["doc_id", "size", "copies"]
        sized = got.withColumn("size", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != "")))
        assert sorted(map(tuple, sized.select(*key).collect()), key=repr) == sorted(
            map(tuple, shares.filter("copies > 0").select(*key).collect()), key=repr)
    assert mixed(docs.limit(0)).count() == 0
