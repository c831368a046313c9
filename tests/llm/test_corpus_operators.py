"""The corpus operators against brute force on small, awkward tables."""

import collections
import hashlib
import html
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from conftest import plan
from tillsight.llm import chat
from tillsight.llm.base import prepare
from tillsight.llm.components import components
from tillsight.llm.decontaminate import decontaminated, leaks
from tillsight.llm.hashing import Texts, chunks
from tillsight.llm.html_extract import extract, main_text
from tillsight.llm.line_runs import LineRuns, drop_frequent_lines
from tillsight.llm.mixing import mix
from tillsight.llm.ngram_join import _met, keep_one, near_duplicates, sketches_apart, wide_sketch
from tillsight.llm.quality import kth_largest, select_quality
from tillsight.llm.topk_search import top_k
from tillsight.llm import toxicity
from tillsight.llm.toxicity import fit_toxicity
from tillsight.llm.url_rules import judge

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `key` string, line string"
SPACE = r"[ \t-\r]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(SPACE, lower(text or "")) if w]


def doc(doc_id, text, source="s"):
    return doc_id, text, "en", source, len(text or ""), "clash", "clash"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, 400, n))


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    base = prose(1, 90).split()
    rows = [doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "one"), doc(5, "ONE"), doc(6, "one two"), doc(None, "one two")]
    rows += [doc(10 + i, " ".join(base[:i] + ["x"] + base[i + 1:])) for i in range(0, 40, 4)]
    rows += [doc(30, " ".join(base)), doc(31, " ".join(base).upper()), doc(31, " ".join(base)), doc(40, prose(2, 30_000))]
    rows += [doc(50 + i, prose(2 + i, 12 + i)) for i in range(20)]
    rows += [doc(80, " ".join(base) + " tail"), doc(81, " ".join(base + base))]
    return spark.createDataFrame(rows, DOCS)


def test_words_and_lines_of_texts():
    texts = ["a  b\u00a0c", None, "", "\x0bx\ry", "\n\n z \n", "é" * 5]
    for limit in (1, 7, 1000):
        found, lines = [], []
        for _, part in chunks(pa.array(texts), limit):
            starts, ends, first = part.words()
            found += [[part.data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                      for a, b in zip(first[:-1], first[1:], strict=True)]
            starts, ends, first = part.lines()
            lines += [[part.data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                      for a, b in zip(first[:-1], first[1:], strict=True)]
        assert found == [re.split(SPACE, t.strip(" \t\n\r\x0b\x0c")) if (t or "").strip() else [] for t in texts]
        assert lines == [(t or "").split("\n") for t in texts]


def test_span_hash_depends_on_the_bytes_only():
    part = Texts(pa.array(["ab AB xab", "ab"]))
    starts, ends, _ = part.words()
    plain, folded = part.spans_hash(starts, ends, lower=False), part.spans_hash(starts, ends)
    assert plain[0] == plain[3] != plain[1] and folded[0] == folded[1] and folded[2] != folded[0]


def expected_components(rows, width, num, den):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    lowest = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), lowest[find(i)]) for i in range(len(rows))]


@pytest.mark.parametrize(("width", "num", "den"), [(3, 9, 10), (5, 8, 10)])
def test_ngram_join_equals_brute_force(docs, width, num, den):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = near_duplicates(docs, width, num, den).collect()
    assert sorted(map(repr, (tuple(r)[:3] for r in found))) == sorted(map(repr, expected_components(rows, width, num, den)))


def test_ngram_join_of_chains_and_random_edits(spark):
    rng = np.random.default_rng(4)
    rows = []
    for family in range(4):
        base = [f"f{family}v{i}" for i in rng.integers(0, 500, 60)]
        for member in range(25):
            text = list(base)
            for at in rng.integers(0, 60, rng.integers(0, 4)):
                text[at] = f"e{rng.integers(0, 30)}"
            rows.append((family * 100 + member, " ".join(text)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(expected_components(rows, 3, 9, 10))


def test_near_copies_keep_one(docs):
    kept = [r.doc_id for r in keep_one(docs).collect()]
    assert {1, 2, 3, 40, 10} <= set(kept) and not {30, 31, 14} & set(kept)


def test_near_copies_keep_one_row_of_a_repeated_id(spark):
    a, b, c, d = (prose(50 + i, 40) for i in range(4))
    rows = [doc(1, a), doc(1, a), doc(1, a.upper()), doc(1, a + " tail"), doc(2, a),  # one of the first component
            doc(3, b), doc(1, b),  # smallest id 1: the repeated id is kept here too, once
            doc(4, c), doc(5, c + " tail"), doc(5, c), doc(5, d), doc(6, d), doc(5, ""), doc(4, None),
            doc(None, a), doc(None, "all alone"), doc(None, "all alone"), doc(None, "quite alone"), doc(None, "")]
    kept = sorted(((r.doc_id, r.text) for r in keep_one(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    first = [t for i, t in kept if i == 1 and t != b]
    assert len(first) == 1 and first[0] in (a, a.upper(), a + " tail")
    assert [r for r in kept if r[1] not in first] == sorted(
        [(1, b), (4, c), (5, d), (5, ""), (4, None), (None, "all alone"), (None, "quite alone"), (None, "")], key=repr)


def test_ngram_join_of_long_texts(spark):
    rng = np.random.default_rng(5)
    rows, base = [], [f"v{i}" for i in rng.integers(0, 5000, 1600)]
    for member, (size, edits) in enumerate([(1600, 0), (1600, 20), (1600, 45), (1600, 60), (1450, 5), (1500, 30), (1200, 0)]):
        text = base[:size]
        for at in rng.choice(size, edits, replace=False):
            text[at] = f"e{member}x{at}"
        rows.append((member, " ".join(text)))
    rows.append((90, " ".join(f"z{i}" for i in range(3000))))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(expected_components(rows, 3, 9, 10))


def test_wide_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for size, other in ((600, 600), (900, 1030), (513, 2100)):
        one = rng.integers(0, 1 << 63, size).astype(np.uint64)
        two = np.concatenate((one[: size // 2], rng.integers(0, 1 << 63, other - size // 2).astype(np.uint64)))
        apart = sketches_apart(wide_sketch(one), wide_sketch(two))
        assert apart == sketches_apart(wide_sketch(two), wide_sketch(one)) <= size + other - 2 * (size // 2)
        assert sketches_apart(wide_sketch(one), wide_sketch(one)) == 0 < apart
    assert wide_sketch(one[:512]) is None


def test_keys_met_across_batches():
    rows = [(1, 1), (1, 1), (2, 5), (2, 6), (2, 6), (3, 1), (4, 1), (4, 2)]
    for cut in range(len(rows) + 1):
        parts = [rows[:cut], rows[cut:]]
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in p], pa.int64()) for i in (0, 1)], ["key", "class"]) for p in parts]
        assert [tuple(r.values()) for b in _met(iter(batches)) for r in b.to_pylist()] == [(2, 5), (2, 6), (4, 1), (4, 2)]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(60, 50), (50, 70), (70, 60), (80, 80), (60, 50)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 50}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [doc(i, "\n".join(rng.choice(["", " ", "Common", " common\t", "rare" + str(i), "é", "é ", "Zed"], 6)))
            for i in range(30)]
    rows += [doc(100, None), doc(101, ""), doc(None, "Common\nzed"), doc(None, "x"), doc(5, "zed"), doc(102, "q " * 40_000)]
    frame = spark.createDataFrame(rows, DOCS)
    for least in (2, 10):
        holders = collections.defaultdict(set)
        key = lambda line: lower(line.strip(" \t\n\r\x0b\x0c"))
        for r in rows:
            for line in (r[1] or "").split("\n"):
                holders[key(line)].add(r[0])
        gone = {k for k, v in holders.items() if k and len(v) >= least}
        want = []
        for r in rows:
            lines = (r[1] or "").split("\n")
            kept = [x for x in lines if key(x) not in gone]
            want.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
        found = drop_frequent_lines(frame, least)
        assert found.columns == [*frame.columns, "n_lines", "n_dropped"]
        got = [tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_line_runs_merge_levels(spark):
    runs = LineRuns(spark, min_docs=3, buckets=2)
    for batch in ([(1, 1), (2, 2)], [(1, 1), (3, 1)], [(1, 1), (2, 1)]):
        runs.add(spark.createDataFrame(batch, "line bigint, docs bigint"))
    assert sorted(r.line for r in runs.frequent().collect()) == [1, 2]
    assert [r.line for r in runs.unseen(spark.createDataFrame([(3,), (9,)], "line bigint")).collect()] == [9]
    runs.close()


def weighted(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    return sum((a & b).values()), sum((a | b).values())


def test_leaks_equal_brute_force(spark):
    items = [(1, prose(11, 20)), (2, prose(12, 41)), (3, "too short item"), (4, None), (5, prose(12, 41)), (2, prose(12, 41))]
    near = items[1][1].split()
    near[0] = "other"
    far = list(near)
    far[20] = far[10] = "other"
    texts = [None, "", "a b", items[0][1].upper(), prose(13, 50) + "\n" + items[0][1] + " " + prose(14, 9), " ".join(near),
             prose(15, 30) + " " + " ".join(far), items[1][1] + " " + items[0][1], " ".join(items[1][1].split()[:39]), prose(16, 9000)]
    frame = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)] + [doc(4, texts[4]), doc(None, items[0][1])], DOCS)
    want = set()
    for i, text in [*enumerate(texts), (None, items[0][1])]:
        w = words(text)
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        for item, passage in items:
            p = words(passage)
            own = [tuple(p[k:k + 5]) for k in range(len(p) - 4)]
            span = min(len(own), len(grams))
            if own and span and any(
                    10 * c >= 8 * u for c, u in (weighted(own, grams[s:s + span]) for s in range(len(grams) - span + 1))):
                want.add((i, item))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = leaks(frame, bench).collect()
    assert sorted(map(repr, ((r.doc_id, r.item_id) for r in found))) == sorted(map(repr, want))
    assert {(r.doc_id, r.item_id): r.first_word for r in found}[(4, 1)] == 50
    left = {r.doc_id for r in decontaminated(frame, bench).collect()}
    assert left == {i for i in range(len(texts))} - {d for d, _ in want}
    assert leaks(frame, bench.limit(0)).count() == 0 and leaks(frame.limit(0), bench).count() == 0


def test_html_extraction():
    page = ("<html><head><title>T</title><style>p{}</style><script>x='</p>'</script></head><body><nav><ul><li>Menu</ul></nav>"
            "<header>Site</header><div class='cookie-notice'>Cookies!</div><article><h1>Head &amp;\n line</h1><p><b>One &lt; two<br>three"
            "<p>Short.</p><aside>side</aside><form>name<input></form><p>" + "long text " * 30 + "</p><div id='comments'><p>me too</p></div>"
            "</article><footer>&copy; foot</footer>")
    assert main_text(page) == "Head & line\nOne < two three\nShort.\n" + ("long text " * 30).strip()
    plain = ("<body><div id=menu><a>a</a><a>b</a></div><div><p>" + "words here " * 20 + "</p><p>No.</p><p>" + "more words " * 20
             + "</p></div><div class='sidebar'>x</div></body>")
    assert main_text(plain) == "\n".join([("words here " * 20).strip(), "No.", ("more words " * 20).strip()])
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>a</script>") == ""


def test_html_of_malformed_and_deep_pages():
    assert main_text("<body><p>one text</p><![foo[x]]><p>and more</p>") == "one text\nand more"
    assert main_text("<div><b class='ad'>x<div>y</b> z</div>d</div>") == "d"  # closed below an open block, b hides no later text
    for start in ("<div>", "<b>", "<p><b>", "<b><div>"):
        for end in ("", "</div>", "</b>", "</p></b>", "<p>x</i>"):
            page = start * 20_000 + "abc def" + end * 20_000
            begun = time.time()
            assert main_text(page).startswith("abc def")
            assert time.time() - begun < 5


def test_html_cores_choose_the_regions():
    long = ("words of the text " * 20).strip()
    links = "<div><a href=/a>one</a><a href=/b>two</a><a href=/c>three</a></div>" * 4
    body = f"<p>{long}</p><p>Short.</p><p>{long}</p>"
    want = f"{long}\nShort.\n{long}"
    teaser = "<article><a href=/n>Next</a> <a href=/m>More</a></article>"
    # of several articles, those with a core
    assert main_text(f"<body><article>{body}</article>{links}{teaser}") == want
    assert main_text(f"<body><article>{body}</article>{links}<article>{body}</article>{links}{teaser}") == f"{want}\n{want}"
    # an article element that holds only links does not hide the text beside it
    assert main_text(f"<body>{teaser}{links}<div>{body}</div>") == want
    # a core outside stays beside the article's
    assert main_text(f"<body><article>{body}</article>{links}<div>{body}</div>") == f"{want}\n{want}"
    # the smallest of nested ones
    assert main_text(f"<body><main>{links}<article>{body}</article>{links}</main>") == want
    # without an article, a block without a core counts to the container around it
    quote = "<blockquote><b>So</b> <i>it</i> <b>is</b></blockquote>"
    pad = "<p><a>x</a> <a>y</a> <a>z</a></p>" * 6
    found = main_text(f"<body><div>{body}{pad}{quote}{pad}{body}</div>{links}")
    assert found.startswith(want) and found.endswith(want) and "So it is" in found and "one" not in found
    found = main_text(f"<body>{body}{pad}{quote}{pad}{body}{links}")
    assert found.endswith(want) and "So it is" in found and "onetwothree" not in found.split("\n")[-3:]


def test_html_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    def want(page):
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        inner = re.sub(r"</?b>", "", inner).replace("<br>", " ")
        blocks = [re.sub(SPACE, " ", html.unescape(b)).strip(" ") for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n".join(b for b in blocks if b)

    source = {r.page_id: r.html for r in pages.collect()}
    found = extract(pages).collect()
    assert len(found) == len(source) and all(r.text == want(source[r.page_id]) for r in found)


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(3)
    rows = [doc(i, "w " * int(rng.integers(1, 60)), [None, "b", "a", "B"][min(3, int(rng.integers(0, 9)))]) for i in range(600)]
    rows += [doc(900, None, "a"), doc(901, "", "b"), doc(None, "w w", "b"), doc(5, "w w w", "b"), doc(7, "w", "a"), doc(7, "w", "a")]
    frame = spark.createDataFrame(rows, DOCS)
    found = mix(frame).collect()
    assert len(found) == len(rows) and sorted(found, key=repr) == sorted(
        mix(frame.repartition(5)).collect(), key=repr)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    assert sum(r.taken for r in found) <= 1.5 * sum(r.size for r in found)
    by = collections.defaultdict(int)
    for r in found:
        by[(r.source_size, r.target)] += r.taken
    assert len(by) == 4 and all(abs(taken - target) <= 120 for (_, target), taken in by.items())
    assert mix(frame.limit(0)).count() == 0


def test_chat_round_trip(spark):
    odd = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>user\n\\s \\l \\n \\\\ [x]"
    rows = [(1, 0, "user", odd, "x"), (1, 1, "assistant", odd, "x"), (1, 2, "user", None, "x"), (2, 0, None, "q", "x"),
            (3, 0, "assistant", "", "x"), (3, 1, "assistant", "b", "x"), (3, 1, "assistant", "a", "x"), (3, 1, "assistant", "a", "x"),
            (None, 5, "ro\nle<|im_end|>", "t", "x"), (4, None, "assistant", "n", "x"), (4, 0, "assistant", "m" * 50_000, "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, example string")
    made = chat.examples(turns)
    assert made.filter("conv_id = 1").count() == 2 and made.filter("conv_id = 3").count() == 4
    for r in made.collect():
        assert "[INST]" not in r.text and r.text.count("<|im_start|>") == r.example + 1 and r.text[r.loss_end:] == "<|im_end|>\n"
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, 3, None, 4):
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r[2] or "", r[3] or "") for r in mine]
        assert "".join(back[conv].replies) == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    assert chat.examples(turns.limit(0)).count() == 0


def test_quality_separates_junk(spark):
    rng = np.random.default_rng(1)
    good = [doc(i, prose(i, int(rng.integers(1, 60)))) for i in range(300)]
    junk = [doc(1000 + i, "BUY!! NOW!! " * int(rng.integers(5, 20))) for i in range(60)]
    odd = [doc(2000, None), doc(2001, ""), doc(2002, prose(5, 20_000)), doc(None, prose(6, 30)), doc(3, prose(3, 20))]
    frame = spark.createDataFrame(good + junk + odd, DOCS)
    labels = spark.createDataFrame([(d[0], int(d[0] < 1000), 0) for d in good[::2] + junk[::2]] + [(None, 1, 0), (4, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    kept = select_quality(frame, labels)
    ids = [r.doc_id for r in kept.collect()]
    assert not [i for i in ids if i is not None and 1000 <= i < 2000]
    assert len([i for i in ids if i is not None and i < 1000]) >= 299
    assert select_quality(frame, labels, k=10).count() == 10
    assert select_quality(frame.limit(0), labels).count() == 0
    assert select_quality(frame, labels.limit(0)).count() == frame.count()


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(2).normal(0, 1, 30_000)] + [1.0] * 200
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 5000, 29_999, 40_000):
        assert kth_largest(frame, "x", k) == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_toxicity_generalises(spark):
    rng = np.random.default_rng(8)
    rows, marks = [], []
    for i in range(900):
        toxic = int(i % 3 == 0)
        text = prose(i, int(rng.integers(5, 60))).split()
        if toxic:
            text.insert(int(rng.integers(0, len(text))), rng.choice(["vile", "Nasty", f"grok{rng.integers(0, 400)}"]))
        rows.append(doc(i, " ".join(text)))
        marks.append((i, 1, toxic))
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    frame = spark.createDataFrame([*rows, doc(5000, None), doc(5001, ""), doc(None, "vile"), doc(5, rows[5][1])], DOCS)
    model = fit_toxicity(frame, labels)
    found = {r.doc_id: r.score for r in model.score(frame).collect()}
    assert all(0 <= s <= 1 for s in found.values())
    import zlib
    held = [(toxic, found[i] >= 0.5) for i, _, toxic in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(t == p for t, p in held) / len(held) >= 0.95
    assert fit_toxicity(frame, labels.limit(0)).score(frame.limit(3)).first().score == 0.5


def test_toxicity_attaches_labels_without_shuffling_texts(spark, no_broadcast):
    import zlib

    docs = spark.createDataFrame([doc(i, f"words {i}") for i in range(40)], DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0, 40, 2)] + [(4, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.labelled(docs, labels, "doc_id", "text", "true")
    text = plan(rows)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    known = {i for i in range(0, 40, 2) if zlib.crc32(str(i).encode()) % 5}
    assert {(r.i, r.text) for r in rows.collect()} == {(i, f"words {i}") for i in known} and rows.count() == len(known)


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 200)
    rng = np.random.default_rng(8)
    seen, step = [], toxicity.fit_on
    monkeypatch.setattr(toxicity, "fit_on", lambda rows, state, counts: seen.append((rows.count(), sum(counts.values()))) or step(rows, state, counts))
    rows = [doc(i, prose(i, int(rng.integers(5, 40))) + (" vile" if i % 3 == 0 else "")) for i in range(900)]
    marks = [(i, 1, int(i % 3 == 0)) for i in range(900)]
    frame, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    scores = {r.doc_id: r.score for r in fit_toxicity(frame, labels, sample=200).score(frame).collect()}
    import zlib
    fitted = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 > 1]
    assert seen == [(len(fitted), len(fitted))]  # 200 at most before
    assert sum((scores[i] >= 0.5) == (t == 1) for i, _, t in marks) >= 0.95 * 900


@pytest.mark.parametrize("size", [1.0, 1e7, 1e15])
def test_top_k_equals_brute_force(spark, size):
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(0, size, (300, 24)), 3)
    vectors[50:120] = vectors[50]
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)]
    rows += [(400, None, 1, "x"), (450, [1.0, float("nan")] + [0.0] * 22, 1, "x"), (None, vectors[0].tolist(), 1, "x"),
             (500, [2.0, 3.0], 1, "x"), (501, [1.0, 1.0], 1, "x"), (550, [], 1, "x"), (50, vectors[50].tolist(), 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, score string")
    exact = [[int(np.floor(256 * x)) for x in v] for v in vectors]
    want = {(500, 1, 501, 512 * 256 + 768 * 256)}
    for q in range(0, 300, 50):
        scores = sorted((-max(min(sum(a * b for a, b in zip(exact[q], exact[c], strict=True)), 2**63 - 1), -(2**63)), c)
                        for c in range(300) if c != q)
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:5])}
    assert {tuple(r) for r in top_k(frame).collect()} == want
    assert top_k(frame.limit(0)).count() == 0


def test_url_rules_equal_brute_force(spark):
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("b.a.com", "/en/", "allow"), ("a.com", "/en/x/", "block"),
             ("com", "/en/xyz/long/", "allow"), ("net", "", "block"), (None, "/", "block"), ("", "/", "block")]
    hosts = ["com", "A.com", "b.a.com", "c.b.a.com", "xa.com", "net", "x.net", "netx", "", "a.com:80"]
    paths = ["", "/", "/en/", "/en/x/1", "/en/xyz/long/p", "/EN/", "/en?u=/en/", "#/en/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "a.com/en/", "x://y://net/", "http://" + "s." * 3000 + "com/"]
    frame = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string, text string")
    found = {r.page_id: r for r in judge(frame, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = lower(host)
        fit = [(len(a + b), len(a), a + b, v) for a, b, v in rules if a and (host == a or host.endswith("." + a)) and path.startswith(b)]
        rule = max(fit)[2:] if fit else (None, "allow")
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, *rule), url


def test_kept_text_digest(spark):
    frame = spark.createDataFrame([doc(i, "same\nown " + str(i)) for i in range(12)], DOCS)
    slim = {r.doc_id: r.text for r in drop_frequent_lines(frame).collect()}
    assert hashlib.sha256(slim[3].encode()).hexdigest() == hashlib.sha256(b"own 3").hexdigest()
