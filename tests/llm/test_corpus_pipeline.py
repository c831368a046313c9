"""The pipeline's stages, one by one, against brute force on a small table."""

import collections
import re

from test_corpus_operators import expected_components, lower, weighted, words

import corpus_pipeline
from tillsight.llm.base import settle, table

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_does_its_work(spark):
    docs = table(spark, FOLDER, "documents")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(settle(stage(spark, frames[-1], FOLDER), "stage"))
        if len(frames) < 6:
            assert frames[-1].columns == list(corpus_pipeline.COLUMNS)
    raw, good, slim, single, clean, mixed = ({r.doc_id: r for r in f.collect()} for f in frames)
    quality = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    assert all(quality[d] for d in good if d in quality) or len(good) < len(raw)
    assert len([d for d in quality if quality[d] and d not in good]) <= 2

    holders = collections.defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\r\x0b\x0c"))
    for d, r in good.items():
        for line in (r.text or "").split("\n"):
            holders[key(line)].add(d)
    for d, r in good.items():
        kept = "\n".join(x for x in (r.text or "").split("\n") if not key(x) or len(holders[key(x)]) < 10)
        assert slim[d].text == kept and slim[d].n_chars == len(kept)

    groups = expected_components([(d, r.text) for d, r in sorted(slim.items())], 5, 8, 10)
    assert set(single) == {component if size else d for d, size, component in groups}

    items = [words(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    grams = lambda w: [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    known = {g for w in items for g in grams(w)}

    def leaks(text):
        own = grams(words(text))
        if known.isdisjoint(own):
            return False
        for item in map(grams, items):
            span = min(len(item), len(own))
            if item and span and not set(item).isdisjoint(own) and any(
                    10 * c >= 8 * u for c, u in (weighted(item, own[s:s + span]) for s in range(len(own) - span + 1))):
                return True
        return False

    assert set(clean) == {d for d, r in single.items() if not leaks(r.text)}

    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for d, r in clean.items()}
    assert set(mixed) <= set(clean)
    assert all(r.taken == r.copies * sizes[d] and r.copies in (1, 2) for d, r in mixed.items())
    total = sum(r.taken for r in mixed.values())
    assert 1.5 * sum(sizes.values()) - max(sizes.values()) <= total <= 1.5 * sum(sizes.values())
