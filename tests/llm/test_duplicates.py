"""Line and sentence-span deduplication against plain Python."""

import random
from collections import defaultdict

import corpus

from haulmetric.llm import line_dedup, sentence_spans


def documents(seed=3):
    rng = random.Random(seed)
    lines = [" ".join(corpus.words(rng, rng.choice([1, 5, 12, 20]))) for _ in range(30)]
    rows = []
    for k in range(40):
        chosen = []
        for line in rng.choices(lines, k=6):
            tokens = line.split()
            kind = rng.randrange(5)
            at = rng.randrange(len(tokens))
            if kind == 1:
                tokens[at] = "changed"
            elif kind == 2:
                del tokens[at]
            elif kind == 3:
                tokens.insert(at, "added")
            chosen.append(" ".join(tokens))
        rows.append((k, "\n".join(chosen), "en", "a"))
    return rows


def brute_lines(rows, near_words=8):
    places, gone = [], set()
    for doc, text, *_ in rows:
        for number, line in enumerate((text or "").split("\n")):
            tokens = line.encode().split()
            if tokens:
                places.append((doc, number, [t for t in tokens]))
    for k, (doc, number, tokens) in enumerate(places):
        earlier = places[:k]
        if any(other == tokens for _, _, other in earlier):
            gone.add((doc, number, 0))
        elif len(tokens) >= near_words and any(
            len(other) >= near_words and line_dedup.one_edit(other, tokens) for _, _, other in earlier
        ):
            gone.add((doc, number, 1))
    return gone


def test_lines_equal_brute_force(spark):
    rows = documents()
    found = line_dedup.line_duplicates(corpus.frame(spark, rows).repartition(4)).collect()
    assert {(r.ident, r.line, r.edits) for r in found} == brute_lines(rows)
    assert all((r.of.ident, r.of.line) < (r.ident, r.line) for r in found)


def test_one_edit_is_the_word_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i, *row[1:]] if False else _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        return new

    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randrange(3) for _ in range(rng.randint(0, 6))]
        b = [rng.randrange(3) for _ in range(rng.randint(0, 6))]
        assert line_dedup.one_edit(a, b) == (distance(a, b) <= 1)


def test_lines_of_odd_rows(spark, tmp_path):
    docs = corpus.odd(spark)
    cleaned = line_dedup.without_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    by_id = defaultdict(list)
    for row in cleaned.collect():
        by_id[row.doc_id].append(row.text)
    assert by_id[2] == [""] and by_id[7] == [""]
    assert by_id[1][0] == corpus.odd_rows()[0][1] and by_id[3] == [None]
    assert line_dedup.op3_line_dedup(spark, corpus.stored(docs.limit(0), tmp_path)).count() == 0


def brute_spans(rows, spans=sentence_spans.Spans()):
    first, gone = set(), defaultdict(set)
    for doc, text, *_ in rows:
        found = sentence_spans.sentences(text, spans)
        tokens = [t.lower() for t in (text or "").encode().split()]
        starts, sizes, _ = sentence_spans.runs(found, spans)
        for start, size in zip(starts, sizes):
            gram = tuple(tokens[found.bounds[start] : found.bounds[start + size]])
            if gram in first:
                gone[doc] |= set(range(start, start + size))
            first.add(gram)
    return {k: v for k, v in gone.items() if v}


def test_spans_equal_brute_force_and_long_passages_are_found(spark):
    rng = random.Random(8)
    passage = corpus.prose(rng, 55)
    rows = []
    for k in range(40):
        text = corpus.prose(rng, 120)
        if k % 4 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + " " + passage + " " + text[at:]
        rows.append((k, text, "en", "a"))
    found = sentence_spans.repeated_spans(corpus.frame(spark, rows).repartition(4)).collect()
    got = defaultdict(set)
    for r in found:
        got[r.ident] |= set(range(r.first, r.last + 1))
    assert got == brute_spans(rows)
    assert set(got) == set(range(4, 40, 4))
    assert {r.of.ident for r in found} == {0}


def test_spans_of_odd_rows(spark, tmp_path):
    docs = corpus.odd(spark)
    cleaned = sentence_spans.without_repeats(docs)
    assert cleaned.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in cleaned.collect()}
    plain = corpus.odd_rows()[0][1]
    assert (1, plain) in texts and (2, plain) not in texts and (None, plain) not in texts
    assert (8, corpus.odd_rows()[10][1]) in texts
    assert sentence_spans.op5_substring_dedup(spark, corpus.stored(docs.limit(0), tmp_path)).count() == 0


def test_text_without_a_range_keeps_the_rest():
    text = "One two. Three four.\nFive six! Seven."
    assert sentence_spans.cut_text(text, [(1, 1)]) == "One two. Five six! Seven."
    assert sentence_spans.cut_text(text, [(0, 3)]) == ""
    assert sentence_spans.cut_text(None, [(0, 0)]) is None


def brute_short_lines(rows, lines):
    def near(a, b):
        if not line_dedup.one_edit(a, b):
            return False
        if max(len(a), len(b)) >= lines.near_words:
            return True
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        odd = [(x, x[k]) for x in (a, b) if len(a) == len(b) or len(x) == max(len(a), len(b))]
        return all(100 * len(word) <= lines.short_share * sum(map(len, x)) for x, word in odd)

    places, gone = [], set()
    for doc, text, *_ in rows:
        for number, line in enumerate(text.split("\n")):
            tokens = line.encode().split()
            if any(other == tokens for other in places):
                gone.add((doc, number, 0))
            elif any(near(other, tokens) for other in places):
                gone.add((doc, number, 1))
            places.append(tokens)
    return gone


def test_short_lines_have_near_copies_too(spark, tmp_path):
    rng = random.Random(4)
    rows = [(0, "Anat with by of nteres atre are.\nabout our Company\nto\nno", "en", "a"),
            (1, "Tolyoued with by of nteres atre are.\nabout my Company\nelsewhere Company\nabout us", "en", "a")]
    pool = ["a", "of", "to", "page", "contact", "international", "documentation"]
    for k in range(2, 60):
        rows.append((k, "\n".join(" ".join(rng.choices(pool, k=rng.randint(1, 7))) for _ in range(4)), "en", "a"))
    sf = corpus.stored(corpus.frame(spark, rows).repartition(4), tmp_path)
    found = line_dedup.op3_line_dedup(spark, sf).collect()
    got = {(r.doc_id, r.line, r.edits) for r in found}
    assert got == brute_short_lines(rows, line_dedup.EVERY_LENGTH)
    assert (1, 0, 1) in got and (1, 1, 1) in got and not {(0, 3), (1, 2), (1, 3)} & {g[:2] for g in got}
