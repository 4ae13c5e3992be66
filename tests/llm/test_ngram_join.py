import random
from itertools import combinations

import corpus
import numpy as np
import pytest

from haulmetric.llm import ngram_join
from haulmetric.llm.common import window_hashes, word_codes
from haulmetric.llm.components import components


def grams(text, size):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return set()
    return {tuple(tokens[k : k + size]) for k in range(max(len(tokens) - size + 1, 1))}


def brute(rows, size=4, percent=85):
    sets = [grams(text, size) for _, text, *_ in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a] | sets[b])):
            parent[find(a)] = find(b)
    found = []
    for k, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        own = row[0] if not sets[k] else min(ids, default=None)
        found.append((row[0], len(sets[k]), own))
    return found


def edited(rng, text, count):
    tokens = text.split(" ")
    for _ in range(count):
        tokens[rng.randrange(len(tokens))] = corpus.words(rng, 1)[0]
    return " ".join(tokens)


def key(row):
    return tuple((v is None, v or 0) for v in row)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_families_of_near_copies_equal_brute_force(spark, size, percent):
    rng = random.Random(size)
    shared = corpus.prose(rng, 40)
    rows = []
    for family in range(6):
        base = corpus.prose(rng, rng.choice([20, 60, 150]))
        for _ in range(25):
            rows.append((len(rows), edited(rng, base, rng.randint(0, 5)), "en", "a"))
    for _ in range(40):
        rows.append((len(rows), corpus.prose(rng, 30) + " " + shared, "en", "a"))
    rows += corpus.odd_rows()[:8]
    join = ngram_join.Join(size=size, percent=percent)
    got = ngram_join.ngram_classes(corpus.frame(spark, rows).repartition(4), join)
    found = [(r.id, r.n_shingles, r.component_id) for r in got.collect()]
    assert sorted(found, key=key) == sorted(brute(rows, size, percent), key=key)


def test_one_document_of_each_class_stays(spark):
    docs = corpus.odd(spark)
    kept = ngram_join.one_per_class(docs, ngram_join.Join(size=5, percent=80))
    assert kept.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(rows))
    ids = [i for i, _ in rows]
    # 1 stands for 2 and for a row without an id, 6 for 7; texts without words are alone.
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 8, 9]
    assert ids.count(None) == 1


def test_empty_table(spark):
    docs = corpus.odd(spark).limit(0)
    assert ngram_join.ngram_classes(docs).count() == 0
    assert ngram_join.one_per_class(docs).count() == 0


def test_words_without_blanks_and_long_words():
    long = "x" * 3_000_000
    codes = word_codes(f"a {long} b {long}")
    assert len(codes) == 4 and codes[1] == codes[3] != codes[0]
    assert (word_codes("Ab É") == word_codes("ab É")).all()
    assert len(window_hashes(codes, 5)) == 0


def test_prefixes_hold_the_asked_matches():
    rng = np.random.default_rng(1)
    join = ngram_join.Join(sketch_bits=10)
    for _ in range(200):
        n = int(rng.integers(5, 200))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop = int(len(x) * 0.07)
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, drop).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        sketch = rng.integers(0, 50, 1 << 10).astype(np.uint32)
        lx, px = ngram_join.prefix(x, sketch, 5.0, join)
        ly, py = ngram_join.prefix(y, sketch, 5.0, join)
        assert len(np.intersect1d(px, py)) >= min(lx, ly)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(201, 202), (202, 203), (203, 201), (300, 300)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert {got[k] for k in range(61)} == {0}
    assert {got[k] for k in range(100, 140)} == {100}
    assert {got[k] for k in (201, 202, 203)} == {201}


def test_copies_with_an_added_or_cut_paragraph_equal_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(30):
        base = corpus.words(rng, rng.choice([60, 103, 200]))
        at = rng.randrange(len(base))
        for share in (0.06, 0.1, 0.13, 0.2):
            more = corpus.words(rng, int(len(base) * share))
            rows.append((len(rows), " ".join(base[:at] + more + base[at:]), "en", "a"))
        rows.append((len(rows), " ".join(base), "en", "a"))
        rows.append((len(rows), " ".join(base[: int(len(base) * 0.9)]), "en", "a"))
    for _ in range(20):
        # Two nested texts, alone with their words.
        base = corpus.words(rng, 103)
        rows += [(len(rows), " ".join(base), "en", "a"), (len(rows) + 1, " ".join(base + corpus.words(rng, 11)), "en", "a")]
    got = ngram_join.ngram_classes(corpus.frame(spark, rows).repartition(4))
    found = [(r.id, r.n_shingles, r.component_id) for r in got.collect()]
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def test_unrelated_texts_without_an_id_or_under_one_id_all_stay(spark):
    rng = random.Random(12)
    texts = [corpus.prose(rng, 60) for _ in range(4)]
    near = texts[0] + " more"
    rows = [(None, texts[0]), (None, near), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3])]
    docs = corpus.frame(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3)
    kept = [(r.doc_id, r.text) for r in ngram_join.one_per_class(docs).collect()]
    assert len(kept) == 4
    assert sorted(t for i, t in kept if i == 7) == sorted(texts[2:])
    loose = {t for i, t in kept if i is None}
    assert texts[1] in loose and len(loose & {texts[0], near}) == 1
