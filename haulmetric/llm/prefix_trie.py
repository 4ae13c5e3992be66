"""Prefix trie of conversations by range minima over sorted common prefixes (operator 13).

Conversations are sorted by their turns. The members of a node, that is of a distinct sequence of
first turns, then stand next to each other, and with l[p] turns shared by the rows p - 1 and p, a
prefix of depth d of row p spans all rows around p between which l stays at d or more. A sparse
table holds the minima of l over every run of 2^k rows; each candidate prefix (row, depth) searches
its left and its right extent in it by halving steps, independent of all others and without a
stack. The prefix that finds itself at its left end stands for the node. Everything else about a
node is a range sum over its interval: members, leaves, and text shared with the row above. A
second sparse table gives the least conversation id.

The sorted rows are cut into blocks, each worked on in one task by arrays. Nodes that touch no end
of their block are complete. Those that do, one path at either end, are sent on as pieces; the
blocks' own minima form a sequence again, with a sparse table again, in which every piece searches
the block where its node starts. Pieces with one start are then added up. Nothing else crosses
blocks, so neither a first turn that all conversations share nor any number of copies of one
conversation comes together in one task: rows are dealt by (turns, id).

Sizes: a turn is 20 bytes from the first step on (MD5 of role and text, length of the text), and
the turns of one conversation are held by one task. There are at most about 2 * `BLOCKS` blocks,
whatever the number of conversations; three whole numbers of each come to the driver. Range
partitioning samples 100 rows a partition there. The conversations that end at one node are hashed
in order of their ids, in one pass with constant memory where they lie in several blocks.

Defined results: rows without a conversation id belong to none; null turns come first, equal turns
in order of the MD5 of (length of role, role, text); null roles and texts are empty; repeated rows
are repeated turns; a conversation whose turns are all replaced by an absent head is a member of the
root; without conversations there is no root; other columns of the input may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from haulmetric.llm.common import batched, quoted, read, rows_of, saved

#: Bytes of a turn: its MD5 and, big-endian, the code points of its text.
STEP = 20
#: Blocks are as large as needed to keep their number near this.
BLOCKS = 1 << 17


@dataclass(frozen=True)
class Trie:
    """Heads come from the first conversation of each `family` ids; block sizes are lower bounds."""

    family: int = 100
    heads: int = 6
    block_rows: int = 1 << 16
    block_turns: int = 1 << 20


# --- conversations as sequences of hashed turns ------------------------------------------


def step(role: Column, text: Column) -> Column:
    """A turn as 40 hex digits."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(whole.cast("binary")), F.lpad(F.hex(F.char_length(text)), 8, "0"))


def rebuilt(
    table: DataFrame, trie: Trie = Trie(), id_: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows (conv, path): every conversation with the head of its family's first one.

    One shuffle of hashed turns by family; the turns of a conversation are put in order there.
    """
    conv = quoted(id_).cast("long")
    turns = table.select(
        conv.alias("conv"), (conv - conv % trie.family).alias("base"),
        F.struct(quoted(turn).alias("turn"), step(quoted(role), quoted(text)).alias("step")).alias("at"),
    ).filter("conv IS NOT NULL")
    own = turns.repartition("base").groupBy("base", "conv").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    own = own.select("base", "conv", F.col("turns.step").alias("steps"))
    first = F.when(F.col("conv") == F.col("base"), F.slice("steps", 1, trie.heads - 1))
    family = W.partitionBy("base").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % trie.heads).cast("int")
    return (
        own.withColumn("head", F.first(first, ignorenulls=True).over(family))
        .withColumn("h", taken)
        .select(
            "conv",
            F.unhex(
                F.concat(
                    F.coalesce(F.array_join(F.slice("head", 1, F.col("h")), ""), F.lit("")),
                    F.array_join(F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps"), F.lit(1))), ""),
                )
            ).alias("path"),
        )
    )


# --- one block of sorted rows -------------------------------------------------------------


class Minima:
    """Sparse table: level k holds the minimum of every run of 2^k values."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.size:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def leftmost(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far left of `at` one gets while all values passed, that at `at` first, are >= least."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            low = at - (1 << k) + 1
            ok = (low >= 0) & (self.levels[k][np.maximum(low, 0)] >= least)
            at[ok] -= 1 << k
        return at

    def rightmost(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far right of `at` one gets while all values passed, that behind `at` first, are >= least."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            ok = at + (1 << k) < self.size
            ok &= level[np.minimum(at + 1, len(level) - 1)] >= least
            at[ok] += 1 << k
        return at

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each run first..last."""
        found = np.empty(len(first), self.levels[0].dtype)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in range(len(self.levels)):
            own = np.flatnonzero(level == k)
            if len(own):
                found[own] = np.minimum(self.levels[k][first[own]], self.levels[k][last[own] - (1 << k) + 1])
        return found


def ragged(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def steps_of(paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turn hashes (rows of two words) and text lengths of all paths in a row, and turns per path."""
    raw = np.frombuffer(b"".join(paths), np.uint8).reshape(-1, STEP)
    hashes = np.ascontiguousarray(raw[:, :16]).view(np.uint64)
    chars = np.ascontiguousarray(raw[:, 16:]).view(">u4")[:, 0].astype(np.int64)
    return hashes, chars, np.array([len(p) // STEP for p in paths], np.int64)


def shared_turns(hashes: np.ndarray, above: np.ndarray, below: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Number of first turns that sequences starting at above[k] and below[k] share, most[k] at most."""
    turn = ragged(most)
    left, right = np.repeat(above, most) + turn, np.repeat(below, most) + turn
    same = (hashes[left] == hashes[right]).all(axis=1)
    found = most.copy()
    some = np.flatnonzero(most)
    if len(some):
        first_other = np.where(same, np.repeat(most, most), turn)
        found[some] = np.minimum.reduceat(first_other, (np.cumsum(most) - most)[some])
    return found


#: kind: a complete node; a node whose parent is a piece; a piece; an id that ends at a piece's
#: node; the block itself. For a piece `saved` holds the shared text, `before` the text above its
#: last turn; for a block depth, n_children and n_leaves hold the least number of turns shared
#: inside it and the turns of its first and last row.
NODE, UNDER, PIECE, END, BLOCK = range(5)
_LONGS = ("block", "conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "before")
_FLAGS = ("at_left", "at_right", "up_left", "up_right")
_FOUND = pa.schema(
    [("kind", pa.int32()), *((n, pa.int64()) for n in _LONGS), *((n, pa.bool_()) for n in _FLAGS),
     ("digest", pa.string()), ("first", pa.binary()), ("last", pa.binary())]
)
_LAYOUT = (
    "kind int, " + ", ".join(f"{n} long" for n in _LONGS) + ", " + ", ".join(f"{n} boolean" for n in _FLAGS)
    + ", digest string, first binary, last binary"
)
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
FAR = 1 << 40


def _part(count: int, **columns: object) -> pa.RecordBatch:
    arrays = []
    for field in _FOUND:
        value = columns.get(field.name)
        if value is None:
            arrays.append(pa.nulls(count, field.type))
        elif isinstance(value, (int, bytes, bool)):
            arrays.append(pa.array([value] * count, field.type))
        else:
            arrays.append(pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_FOUND)


def block_nodes(block: int, convs: np.ndarray, paths: list[bytes]) -> Iterator[pa.RecordBatch]:
    """All nodes of a block of rows sorted by (path, conv)."""
    rows = len(convs)
    hashes, chars, size = steps_of(paths)
    start = np.cumsum(size) - size
    text = np.concatenate([[0], np.cumsum(chars)])
    shared = np.full(rows, -1)
    shared[1:] = shared_turns(hashes, start[:-1], start[1:], np.minimum(size[:-1], size[1:]))
    minima = Minima(shared)

    # Every prefix of every row is a candidate; the one at the left end of its extent is the node.
    row, depth = np.repeat(np.arange(rows), size + 1), ragged(size + 1)
    left = minima.leftmost(row, depth)
    own = np.flatnonzero(left == row)
    first_candidate = np.cumsum(size + 1) - size - 1
    place = np.zeros(len(row), np.int64)
    place[own] = np.arange(len(own))
    l, d = row[own], depth[own]
    # One turn less, at the left end of that prefix; own - 1 is the same row's candidate before.
    up = place[first_candidate[left[own - 1]] + np.maximum(d - 1, 0)]
    del row, depth, left, place
    r = minima.rightmost(l, d)

    conv = Minima(convs).between(l, r)
    before = text[start[l] + np.maximum(d - 1, 0)] - text[start[l]]
    known = np.maximum(shared, 0)
    overlap = np.concatenate([[0], np.cumsum(text[start + known] - text[start])])
    closed = np.zeros(rows, bool)
    closed[:-1] = shared[1:] < size[:-1]
    leaves = np.concatenate([[0], np.cumsum(closed)])
    # Rows that start a child below depth shared[p], by that depth.
    starts = np.sort((shared * rows + np.arange(rows))[1:][(size > shared)[1:]])
    children = np.searchsorted(starts, d * rows + r, "right") - np.searchsorted(starts, d * rows + l, "right")
    at_left, at_right = l == 0, r == rows - 1
    children += ~at_left & (size[l] > d)

    # Rows equal to the one above; a node's own ends are the run at its left end.
    same = np.zeros(rows, bool)
    same[1:] = (shared[1:] == size[1:]) & (size[1:] == size[:-1])
    runs = np.append(np.flatnonzero(~same), rows)
    stop = np.where(size[l] == d, runs[np.searchsorted(runs, l, "right")], l)

    piece = at_left | at_right
    under = ~piece & piece[up]
    for kind, chosen in ((NODE, ~piece & ~under), (UNDER, under), (PIECE, piece)):
        at = np.flatnonzero(chosen)
        for some in np.array_split(at, len(at) // 32_768 + 1):
            digest = None
            if kind != PIECE:
                digest = [
                    hashlib.sha256(",".join(map(str, convs[i:j].tolist())).encode()).hexdigest() if j > i else EMPTY_DIGEST
                    for i, j in zip(l[some].tolist(), stop[some].tolist())
                ]
            yield _part(
                len(some), kind=kind, block=block, conv=conv[some], depth=d[some], parent=conv[up[some]],
                n_convs=(r - l + 1)[some], n_children=children[some],
                n_leaves=(leaves[r + 1] - leaves[l])[some], saved=(overlap[r + 1] - overlap[l + 1])[some],
                before=before[some], at_left=at_left[some], at_right=at_right[some],
                up_left=at_left[up[some]], up_right=at_right[up[some]], digest=digest,
            )
    for k in np.flatnonzero(piece & (stop > l)):
        for first in range(l[k], stop[k], 32_768):
            ids = convs[first : min(first + 32_768, stop[k])]
            yield _part(
                len(ids), kind=END, block=block, conv=ids, depth=int(d[k]),
                at_left=bool(at_left[k]), at_right=bool(at_right[k]),
            )
    yield _part(
        1, kind=BLOCK, block=block, depth=int(shared[1:].min()) if rows > 1 else FAR,
        n_children=int(size[0]), n_leaves=int(size[-1]), first=paths[0], last=paths[-1],
    )


def blocks_of(paths: DataFrame, trie: Trie) -> DataFrame:
    """block_nodes() of the sorted rows; blocks are numbered by (partition, block in it)."""
    totals = paths.agg(F.count(F.lit(1)), F.sum(F.octet_length("path"))).first()
    most_rows = max(trie.block_rows, (totals[0] or 0) // BLOCKS)
    most_bytes = max(trie.block_turns * STEP, (totals[1] or 0) // BLOCKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        convs: list[int] = []
        held: list[bytes] = []
        weight = 0
        for conv, path in rows_of(batches, ("conv", "path")):
            if convs and (len(convs) >= most_rows or weight + len(path) > most_bytes):
                yield from block_nodes(block, np.array(convs, np.int64), held)
                block, convs, held, weight = block + 1, [], [], 0
            convs.append(conv)
            held.append(path)
            weight += len(path)
        if convs:
            yield from block_nodes(block, np.array(convs, np.int64), held)

    # Copies of one path are dealt by their ids.
    ordered = paths.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    return ordered.mapInArrow(work, _LAYOUT)


# --- nodes that reach over the end of a block ---------------------------------------------


@dataclass(frozen=True)
class Borders:
    """Per block, in order: turns and text its first row shares with the row before it, the least
    number of turns shared inside it, and the turns of its first and last row."""

    block: np.ndarray
    shared: np.ndarray
    text: np.ndarray
    inner: np.ndarray
    first: np.ndarray
    last: np.ndarray


def borders(found: DataFrame) -> Borders:
    """Five whole numbers a block; the first and last rows are compared where they lie."""
    blocks = found.filter(F.col("kind") == BLOCK)
    own = blocks.select("block", "depth", "n_children", "n_leaves").orderBy("block").toArrow()
    block, inner, first, last = (c.to_numpy() for c in own.columns)
    shared, text = np.full(len(block), -1), np.zeros(len(block), np.int64)
    if len(block) > 1:
        order = found.sparkSession.createDataFrame(
            pa.table({"block": pa.array(block), "k": pa.array(np.arange(len(block)))})
        )
        numbered = blocks.select("block", "first", "last").join(order, "block")
        pairs = numbered.select("k", "first").join(numbered.select((F.col("k") + 1).alias("k"), "last"), "k")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("k", pa.int64()), ("shared", pa.int64()), ("text", pa.int64())])

            def made() -> Iterator[tuple]:
                for k, below, above in rows_of(batches, ("k", "first", "last")):
                    hashes, chars, size = steps_of([above, below])
                    count = shared_turns(hashes, np.array([0]), size[:1], np.array([min(size)]))[0]
                    yield k, int(count), int(chars[:count].sum())

            yield from batched(made(), schema)

        met = pairs.mapInArrow(work, "k long, shared long, text long").toArrow()
        at = met["k"].to_numpy()
        shared[at], text[at] = met["shared"].to_numpy(), met["text"].to_numpy()
    return Borders(block, shared, text, inner, first, last)


_KEY = ("start", "depth", "right")
_PLACE = ("block", "depth", "at_left", "at_right")
_SUMS = ("n_convs", "n_children", "n_leaves", "saved")


def pieces(found: DataFrame, ends: Borders) -> DataFrame:
    """Pieces with the node they belong to: (start, right) is the block in which it starts, and
    whether it reaches that block's right end. up_block is set in the piece where the node starts."""
    names = ["start", "right", "up_block", *_PLACE, "conv", *_SUMS, "before", "up_left", "up_right"]
    flags = ("right", "at_left", "at_right", "up_left", "up_right")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = Minima(np.minimum(ends.shared, ends.inner))
        behind = np.append(ends.shared[1:], -1)
        for batch in batches:
            c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            k, depth, at_left = np.searchsorted(ends.block, c["block"]), c["depth"], c["at_left"]
            met = ends.shared[k]
            open_ = at_left & (met >= depth)
            start = np.where(open_, least.leftmost(k - 1, depth), k)
            children = c["n_children"] + (at_left & (met <= depth) & (ends.first[k] > depth))
            leaves = c["n_leaves"] + (c["at_right"] & (behind[k] < ends.last[k]))
            # The block's first row counts as a row below another one only if the node began before.
            saved_ = c["saved"] + np.where(open_, ends.text[k], 0)
            out = c | {"start": start, "right": open_ | c["at_right"], "n_children": children, "n_leaves": leaves, "saved": saved_}
            arrays = []
            for name in names:
                if name == "up_block":
                    arrays.append(pa.array(c["block"], pa.int64(), mask=open_ | (depth == 0)))
                else:
                    arrays.append(pa.array(out[name], pa.bool_() if name in flags else pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    layout = ", ".join(f"{n} {'boolean' if n in flags else 'long'}" for n in names)
    own = found.filter(F.col("kind") == PIECE)
    return own.select(*_PLACE, "conv", *_SUMS, "before", "up_left", "up_right").mapInArrow(work, layout)


def _digests(ends: DataFrame) -> DataFrame:
    """Rows (start, depth, right, digest) of ids, hashed in their order as they come by."""
    schema = pa.schema([("start", pa.int64()), ("depth", pa.int64()), ("right", pa.bool_()), ("digest", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            key = held = None
            for *own, conv in rows_of(batches, (*_KEY, "conv")):
                if own != key:
                    if key:
                        yield *key, held.hexdigest()
                    key, held = own, hashlib.sha256(str(conv).encode())
                else:
                    held.update(b",%d" % conv)
            if key:
                yield *key, held.hexdigest()

        yield from batched(made(), schema)

    ordered = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "conv")
    return ordered.mapInArrow(work, "start long, depth long, right boolean, digest string")


_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _output(nodes: DataFrame, parent: Column) -> DataFrame:
    # Rows below the first of a node share at least its turns with the row above.
    tokens = F.col("saved") - (F.col("n_convs") - 1) * F.col("before")
    values = ("conv", "depth", parent, "n_convs", "n_children", "n_leaves", tokens, "digest")
    return nodes.select(*((F.col(v) if isinstance(v, str) else v).alias(n) for v, n in zip(values, _OUT, strict=True)))


def prefix_trie(paths: DataFrame, trie: Trie = Trie()) -> DataFrame:
    """One row for each node of the trie of (conv, path); see the contract's names in `_OUT`."""
    found = saved(blocks_of(paths, trie), "blocks")
    parts = saved(pieces(found, borders(found)), "pieces")
    before = F.when(F.col("up_block").isNotNull(), F.struct("up_block", "up_left", "up_right"))
    joined = saved(
        parts.groupBy(*_KEY).agg(
            F.min("conv").alias("conv"), *(F.sum(n).alias(n) for n in _SUMS),
            F.max("before").alias("before"), F.max(before).alias("up"),
        ),
        "joined",
    )
    # The least id of the node that each piece belongs to.
    names = parts.select(*_PLACE, *(k for k in _KEY if k not in _PLACE)).join(
        joined.select(*_KEY, F.col("conv").alias("name")), list(_KEY)
    )
    above = names.select(
        F.col("block").alias("up_block"), (F.col("depth") + 1).alias("depth"),
        F.col("at_left").alias("up_left"), F.col("at_right").alias("up_right"), "name",
    )
    ends = found.filter(F.col("kind") == END).select(*_PLACE, "conv")
    digests = _digests(ends.join(names.select(*_PLACE, "start", "right"), list(_PLACE)).select(*_KEY, "conv"))
    wide = (
        joined.select("*", "up.*")
        .join(above, ["up_block", "depth", "up_left", "up_right"], "left")
        .join(digests, list(_KEY), "left")
        .withColumn("digest", F.coalesce("digest", F.lit(EMPTY_DIGEST)))
    )
    nodes = found.drop("first", "last").withColumn("up_block", F.col("block"))
    under = nodes.filter(F.col("kind") == UNDER).join(above, ["up_block", "depth", "up_left", "up_right"])
    return (
        _output(nodes.filter(F.col("kind") == NODE), F.col("parent"))
        .unionByName(_output(under, F.col("name")))
        .unionByName(_output(wide, F.col("name")))
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(saved(rebuilt(read(spark, sf_dir, "conversations")), "paths"))


def oracle_sql() -> str:
    """DuckDB SQL of op13, over whole prefixes."""
    trie = Trie()
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    crc = f"""xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda t: ascii(t)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {step})), 4294967295)"""
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}}
                       ORDER BY turn NULLS FIRST, md5(octet_length(encode(role)) || ':' || role || text)) AS turns
  FROM turns GROUP BY conv_id),
taken AS (SELECT conv_id, turns, {crc} % {trie.heads} AS h FROM own),
path AS (
  SELECT t.conv_id, list_concat(coalesce(b.turns[1:h], []), t.turns[h + 1:]) AS path
  FROM taken t LEFT JOIN own b ON b.conv_id = t.conv_id - t.conv_id % {trie.family}),
prefix AS (SELECT conv_id, len(path) AS size, d, path[1:d] AS node FROM path, range(0, 1000) depths(d) WHERE d <= len(path)),
node AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '') AS ends
  FROM prefix GROUP BY node, d),
child AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.d > 0 THEN (n_convs - 1) * length(n.node[n.d].text) ELSE 0 END AS saved
  FROM node n LEFT JOIN child USING (node)),
below AS (
  SELECT w.node[1:k] AS node, sum(CAST(n_children = 0 AS INT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM whole w, range(0, 1000) depths(k) WHERE k <= w.d GROUP BY 1)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
       w.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       sha256(w.ends) AS ends_sha256
FROM whole w JOIN below b USING (node) LEFT JOIN node p ON w.d > 0 AND p.d = w.d - 1 AND p.node = w.node[1:w.d - 1]"""
