import hashlib
import random
import zlib

import corpus
import numpy as np
import pytest

from haulmetric.llm import prefix_trie
from haulmetric.llm.prefix_trie import Minima, Trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, block int, conv int, steps string, base long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "s", 3) for r in rows], SCHEMA)


def tie(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    """The contract in plain Python: {(conv_id, depth, ...)}."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children, leaves, tokens = {}, {}, {}
    for node in nodes:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, members in nodes.items():
        saved = (len(members) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            tokens[node[:d]] = tokens.get(node[:d], 0) + saved
    found = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(node))
        found.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), children.get(node, 0),
            leaves[node], tokens[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def check(spark, rows, trie=Trie(), parts=3):
    paths = prefix_trie.rebuilt(frame(spark, rows).repartition(parts), trie)
    got = [tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.saved(paths, "paths"), trie).collect()]
    assert sorted(got, key=str) == plain(rows)


def talk(rng, conv, turns, vocabulary):
    return [(conv, k, rng.choice(["user", "assistant"]), rng.choice(vocabulary)) for k in range(turns)]


@pytest.mark.parametrize("seed, block_rows", [(0, 1), (1, 2), (2, 5), (3, 1000)])
def test_nodes_equal_plain_python(spark, seed, block_rows):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-250, 900), 220):
        rows += talk(rng, conv, rng.randint(0, 9), ["a", "bé", "日本", ""])
    check(spark, rows, Trie(block_rows=block_rows))


def test_a_third_share_everything(spark):
    """Copies of one conversation and one first turn lie over many blocks and partitions."""
    rng = random.Random(8)
    rows = []
    for conv in range(1, 400):
        if conv % 3 == 0:
            rows += [(conv, k, "user", "same") for k in range(7)]
        else:
            rows += [(conv, 0, "system", "hello"), *[(conv, k, "user", rng.choice("xy")) for k in range(1, rng.randint(1, 8))]]
    check(spark, rows, Trie(block_rows=7), parts=5)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (None, None, None, None), (1, None, None, None), (1, None, "", "x"), (1, 0, "user", "é"),
        (2, 1, "user", "tie"), (2, 1, "bot", "tie"), (2, 1, "bot", "tie"), (2, 1, "bot", "tie"), (3, -5, "u", ""),
        (100, 0, "user", "head"), (101, 3, "user", "only"), (-7, 0, "a", "b"), (-100, 0, "c", "d"), (-101, 9, "e", "f"),
        (2**62, 1, "user", "big"), (7, 2, "a:", "b"), (8, 2, "a", ":b"),
    ]
    check(spark, rows)
    check(spark, rows, Trie(block_rows=1))


def test_turnless_conversations_belong_to_the_root(spark):
    # No head is there and each has fewer turns than its head takes.
    lone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5][:4]
    rows = [(c, 0, "user", "x") for c in lone]
    assert len(plain(rows)) == 1
    check(spark, rows)
    check(spark, [*rows, (300, 0, "user", "y")], Trie(block_rows=2))


def test_long_conversation_and_text(spark):
    rows = [(200, k, "user", f"{k % 3}") for k in range(3000)] + [(201, k, "user", f"{k % 3}") for k in range(2500)]
    paths = prefix_trie.saved(prefix_trie.rebuilt(frame(spark, rows)), "paths")
    got = {(r.depth, r.n_convs) for r in prefix_trie.prefix_trie(paths, Trie(block_turns=100)).collect()}
    assert got == {(d, 2 if d <= 2500 else 1) for d in range(3001)}
    check(spark, [(5, 0, "user", "x" * 300_000), (6, 0, "user", "y" * 10)])


def test_no_conversations(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


def test_sparse_table(seed=5):
    rng = np.random.default_rng(seed)
    for size in (1, 2, 3, 8, 33):
        values = rng.integers(0, 6, size)
        values[0] = -1
        table = Minima(values)
        at, least = (g.ravel() for g in np.meshgrid(np.arange(size), np.arange(7)))
        for i, d, left, right in zip(at, least, table.leftmost(at, least), table.rightmost(at, least)):
            assert left == next(p for p in range(i, -1, -1) if values[p] < d)
            assert right == next((p - 1 for p in range(i + 1, size) if values[p] < d), size - 1)
        first, last = np.triu_indices(size)
        assert (table.between(first, last) == [values[i : j + 1].min() for i, j in zip(first, last)]).all()


def test_query_over_a_stored_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [t for c in range(150) for t in talk(rng, c, rng.randint(1, 8), ["a", "b"])]
    path = corpus.stored(frame(spark, rows), tmp_path, "conversations")
    assert sorted((tuple(r) for r in prefix_trie.op13_prefix_trie(spark, path).collect()), key=str) == plain(rows)
