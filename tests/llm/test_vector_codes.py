import hashlib
import math
import random

import corpus
import numpy as np
import pytest

from haulmetric.llm import vector_codes
from haulmetric.llm.vector_codes import Book, Codes

SMALL = Codes(parts=4, entries=8, rounds=2)
SCHEMA = "vec_id long, embedding array<float>, label int, id long, code string, error int, vector string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, "v", 3) for r in rows], SCHEMA)


def plain(rows, codes):
    """The contract in plain Python; returns {(id, vector): (code, error)}, label errors and entries."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(codes.scale * x) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return {}, {}, []
    width = len(kept[0][1]) // codes.parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[: codes.entries]] for p in range(codes.parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(codes.rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for _, v, _ in kept:
                members[near(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(members, book)]
    found, labels = {}, {}
    for vec_id, v, label in kept:
        pairs = [near(cut(v, p), books[p]) for p in range(codes.parts)]
        code, error = "".join(f"{k:02x}" for _, k in pairs), sum(d for d, _ in pairs)
        found.setdefault((vec_id, label), []).append((code, error))
        labels[label] = labels.get(label, 0) + error
    return found, labels, books


def check(spark, rows, codes=SMALL):
    found, books = vector_codes.vector_codes(frame(spark, rows).repartition(3), codes)
    want, labels, entries = plain(rows, codes)
    got = {}
    for r in found.collect():
        got.setdefault((r.id, r.label), []).append((r.code.hex(), r.error))
        assert r.label_error == labels[r.label]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    text = ",".join(str(x) for b in entries for e in b for x in e)
    assert vector_codes.digest(books) == hashlib.sha256(text.encode()).hexdigest()


def vector(rng, count=12, spread=1.0):
    return [rng.gauss(0, spread) for _ in range(count)]


@pytest.mark.parametrize("seed", range(3))
def test_codes_equal_plain_python(spark, seed):
    rng = random.Random(seed)
    # Coarse values make many equal distances; one vector and one label hold a third of the rows.
    rows = [(k, [round(x * 4) / 256 for x in vector(rng)], k % 5) for k in range(200)]
    rows += [(200 + k, [0.5] * 12, 9) for k in range(100)]
    check(spark, rows)


def test_odd_rows(spark):
    rng = random.Random(4)
    nan, inf = float("nan"), float("inf")
    same = vector(rng)
    rows = [(k, vector(rng, spread=30), None if k % 3 else k) for k in range(5, 25)]
    rows += [(30, None, 1), (31, [], 1), (32, [nan, *same[1:]], 1), (33, [-inf, *same[1:]], 1), (34, [None, *same[1:]], 1)]
    rows += [(35, same[:8], 1), (None, same, None), (None, vector(rng), 2), (7, same, 1), (7, same, 1), (None, None, None)]
    rows += [(40, [3e5] * 12, 1), (41, [-3e5] * 12, 1)]
    check(spark, rows)


def test_huge_components_count_as_the_limit(spark):
    rows = [(k, [k * 1e30] * 12, 0) for k in range(4)]
    found, _ = vector_codes.vector_codes(frame(spark, rows), SMALL)
    assert found.count() == 4 and all(r.error >= 0 for r in found.collect())


def test_fewer_vectors_than_entries_and_none(spark):
    check(spark, [(1, [0.25] * 4, 1), (2, [0.5, 1.0, -1.0, 2.0], 1)])
    check(spark, [])
    check(spark, [(1, None, 1)])


def test_length_must_be_a_multiple_of_parts(spark):
    with pytest.raises(ValueError, match="cannot be cut"):
        vector_codes.vector_codes(frame(spark, [(1, [1.0] * 5, 1)]), SMALL)


@pytest.mark.parametrize("seed", range(20))
def test_equal_average_search_finds_the_first_nearest(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-6, 6, (rng.integers(1, 70), rng.integers(1, 7)))
    parts = rng.integers(-8, 8, (300, entries.shape[1]))
    index, best = Book(entries).nearest(parts)
    distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()


def test_codes_are_decoded_to_their_entries(spark):
    rng = random.Random(2)
    rows = [(k, vector(rng), 0) for k in range(60)]
    found, books = vector_codes.vector_codes(frame(spark, rows), SMALL)
    for r in vector_codes.decoded(found, books).collect():
        own = [math.floor(256 * x) for x in np.float32(rows[r.id][1]).astype(float)]
        assert sum((a - b) ** 2 for a, b in zip(own, r.vector)) == r.error


def test_query_over_a_stored_table(spark, tmp_path):
    rng = random.Random(6)
    rows = [(k, vector(rng, 64), k % 3) for k in range(150)]
    path = corpus.stored(frame(spark, rows), tmp_path, "embeddings")
    result = vector_codes.op11_vector_codes(spark, path)
    want, labels, _ = plain([(k, [float(np.float32(x)) for x in v], n) for k, v, n in rows], Codes())
    assert {r.vec_id: (r.code, r.error) for r in result.collect()} == {k: v[0] for (k, _), v in want.items()}
