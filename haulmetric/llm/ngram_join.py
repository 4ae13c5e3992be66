"""N-gram Jaccard join with adaptive multi-match prefixes (operator 10).

Two texts link when their sets of distinct word shingles have a Jaccard similarity of at least
`percent` / 100. The join returns classes, not pairs: every row gets the least id it reaches.

1. A count sketch over all shingles of all texts gives one global order, rare shingles first.
2. A text of n shingles must share `ceil(n * percent / 100)` of them with any partner, so of its
   first n - that + l shingles a partner's prefix holds at least l. Each text picks the l that
   costs least: a longer prefix means more postings, but partners must match l times.
3. Texts with equal sets collapse to one node. Each posting list is compared with its centre
   only, so a list of m nodes gives m - 1 candidates; lists that still touch several components
   get another centre in the next round. What is then left is compared pair by pair across
   components, by place in the prefix, match count and sizes, so that no link is lost.
4. Candidates are verified on the full shingle sets of the whole texts.

Defined results: texts that are null or without words have an empty set and are alone; fewer
words than a shingle make one shingle; rows with a null id take part, and a class of null ids
only has a null component; repeated rows are in one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmetric.llm.common import (
    batched,
    columns_of,
    fresh,
    quoted,
    read,
    rows_of,
    saved,
    window_hashes,
    word_codes,
)
from haulmetric.llm.components import components

CHUNKS = 64
#: Tasks that each fill an array of a fixed size; more than that read several splits each, so that
#: what they send stays bounded, too.
ARRAY_TASKS = 8192


@dataclass(frozen=True)
class Join:
    """size: words in a shingle; percent: least similarity; max_matches: largest l.

    sketch_bits and bloom_bits fix the sizes of what is broadcast (4 bytes << 20 and 1 << 26
    bits); verify_cost is the price of a candidate in postings; star_rounds bounds the rounds
    before the exact one.
    """

    size: int = 4
    percent: int = 85
    max_matches: int = 4
    verify_cost: int = 16
    sketch_bits: int = 20
    bloom_bits: int = 26
    star_rounds: int = 2
    members: int = 256


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z folded."""
    codes = word_codes(text)
    return np.unique(window_hashes(codes, min(size, len(codes)))) if len(codes) else codes


def merged(chunks: DataFrame, kind: type, combine: Callable) -> np.ndarray:
    """Combine per-task arrays that came as rows (chunk, data) into one array on the driver.

    Each chunk is folded as it streams by, so no task holds more than its own chunks; the
    array's size is fixed by a parameter, whatever the number of rows.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for chunk, data in rows_of(batches, ("chunk", "data")):
            part = np.frombuffer(data, kind)
            total[chunk] = combine(total[chunk], part) if chunk in total else part
        yield from batched(
            ((k, v.tobytes()) for k, v in total.items()),
            pa.schema([("chunk", pa.int32()), ("data", pa.binary())]),
        )

    found = {
        r.chunk: r.data
        for r in chunks.repartition(CHUNKS, "chunk").mapInArrow(fold, chunks.schema).collect()
    }
    return np.frombuffer(b"".join(bytes(found[k]) for k in sorted(found)), kind)


def chunked(array: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = np.split(array, CHUNKS)
    yield from batched(
        ((k, part.tobytes()) for k, part in enumerate(parts)),
        pa.schema([("chunk", pa.int32()), ("data", pa.binary())]),
    )


def count_sketch(docs: DataFrame, join: Join) -> np.ndarray:
    """How many shingles of all sets fall into each of 1 << sketch_bits counters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = np.zeros(1 << join.sketch_bits, np.uint32), np.uint64(64 - join.sketch_bits)
        for (text,) in rows_of(batches, ("text",)):
            np.add.at(total, (shingles(text, join.size) >> shift).astype(np.int64), np.uint32(1))
        yield from chunked(total)

    found = merged(docs.select("text").coalesce(ARRAY_TASKS).mapInArrow(count, "chunk int, data binary"), np.uint32, np.add)
    return found if len(found) else np.zeros(1 << join.sketch_bits, np.uint32)


def prefix(
    grams: np.ndarray, sketch: np.ndarray, noise: float, join: Join
) -> tuple[int, np.ndarray]:
    """The number of matches asked for, and the shingles to look up, rare ones first.

    `noise` is the sketch's mean counter, what a rare shingle finds there.
    """
    counts = sketch[(grams >> np.uint64(64 - join.sketch_bits)).astype(np.int64)].astype(np.int64)
    order = np.lexsort((grams, counts))
    least = len(grams) - (len(grams) * join.percent + 99) // 100 + 1
    longest = min(len(grams), least + join.max_matches - 1)
    others = np.maximum(counts[order[:longest]] - noise - 3 * noise**0.5 - 1, 0)
    reach = np.cumsum(others)[least - 1 :]
    matches = np.arange(1, len(reach) + 1)
    cost = least + matches - 1 + reach * (1 + join.verify_cost / matches)
    best = int(np.argmin(cost))
    return best + 1, grams[order[: least + best]]


def _prints(docs: DataFrame, join: Join) -> DataFrame:
    """One row per document: id, text key, set size, matches, set fingerprint, prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(count_sketch(docs, join))
    fields = pa.schema(
        [
            ("id", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("ell", pa.int32()),
            ("sid", pa.binary()), ("prefix", pa.list_(pa.int64())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        noise = float(sketch.mean())

        def made() -> Iterator[tuple]:
            for id_, key, text in rows_of(batches, ("id", "key", "text")):
                grams = shingles(text, join.size)
                if not len(grams):
                    yield id_, key, 0, 0, None, None
                    continue
                ell, first = prefix(grams, sketch, noise, join)
                yield id_, key, len(grams), ell, xxhash.xxh3_128_digest(grams.tobytes()), first.view(np.int64)

        yield from batched(made(), fields)

    return docs.select("id", F.xxhash64("text").alias("key"), "text").mapInArrow(
        work, "id long, key long, n int, ell int, sid binary, prefix array<long>"
    )


def bloom(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit set of 64-bit keys, two positions each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for at in _positions(batch.column("key").to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(found, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        yield from chunked(found)

    found = merged(
        keys.select("key").coalesce(ARRAY_TASKS).mapInArrow(work, "chunk int, data binary"), np.uint8, np.bitwise_or
    )
    return found if len(found) else np.zeros(1 << (bits - 3), np.uint8)


def in_bloom(keys: np.ndarray, found: np.ndarray, bits: int) -> np.ndarray:
    keep = np.ones(len(keys), bool)
    for at in _positions(keys, bits):
        keep &= (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return keep


def _positions(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.astype(np.int64).view(np.uint64)
    low = np.uint64((1 << bits) - 1)
    return (keys & low).astype(np.int64), ((keys >> np.uint64(64 - bits)) & low).astype(np.int64)


def _texts(docs: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """(node, text) for the nodes asked for; other texts mostly stay where they are read."""
    wanted = saved(nodes.select("node", F.col("id").alias("node_id"), "key"), "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted, join.bloom_bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(in_bloom(keys, found, join.bloom_bits)))

    likely = docs.select("id", F.xxhash64("text").alias("key"), "text").mapInArrow(
        work, "id long, key long, text string"
    )
    return (
        likely.join(wanted, "key")
        .filter(F.col("id").eqNullSafe(F.col("node_id")))
        .select("node", "text")
    )


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Partners of one `a` are dealt out in groups of about `members`, each with a copy of a's text.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / join.members).alias("groups"))
    of_a = groups.select(
        F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(1), "groups")).alias("deal"),
        F.lit(None).cast("long").alias("b"),
    )
    of_b = pairs.join(groups, "a").select(
        F.col("b").alias("node"), "a", (F.pmod(F.xxhash64("b"), F.col("groups")) + 1).alias("deal"), "b"
    )
    asked = saved(of_a.unionByName(of_b), "asked")
    ids = asked.select("node").distinct().join(nodes.select("node", "id", "key"), "node")
    filled = (
        asked.join(_texts(docs, ids, join), "node")
        .select("a", "deal", "b", "text")
        .repartition("a", "deal")
        .sortWithinPartitions("a", "deal", F.col("b").asc_nulls_first())
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            own = np.empty(0, np.uint64)
            for a, b, text in rows_of(batches, ("a", "b", "text")):
                grams = shingles(text, join.size)
                if b is None:
                    own = grams
                    continue
                both = len(np.intersect1d(own, grams, assume_unique=True))
                if 100 * both >= join.percent * (len(own) + len(grams) - both):
                    yield a, b

        yield from batched(made(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return filled.mapInArrow(work, "a long, b long")


def _may_match(x: str, y: str, percent: int) -> Column:
    """Whether a token at its places in two prefixes can be one of the first matches of a pair
    that is similar enough.

    Sizes n and m ask for `least` shared shingles. Before a token that is one of the first l
    matches lie less than l others, and not more than tokens that any other prefix holds too:
    what comes earlier in a prefix and in no other is not in the partner, whose prefix reaches
    up to the match. Tokens behind the match may be in the partner behind its prefix.
    """
    at = lambda side, name: F.col(f"{side}{name}")
    n, m = at(x, "n"), at(y, "n")
    least = F.ceil((n + m) * percent / F.lit(100 + percent))
    earlier = F.least(
        F.least(at(x, "ell"), at(y, "ell")) - 1, at(x, "earlier"), at(y, "earlier")
    )
    return earlier + F.least(n - at(x, "pos"), m - at(y, "pos")) >= least


def _active(nodes: DataFrame, join: Join) -> DataFrame:
    """Postings (token, node, pos, n, ell, earlier, own) of the tokens that two or more nodes hold.

    earlier: how many such tokens the node's prefix has before this one; own: how many tokens of
    its prefix no other prefix holds. Most tokens are one node's own; a Bloom filter of the others
    keeps their postings from being shuffled a second time, unless these are too many for it.
    """
    postings = nodes.select(
        "node", "n", "ell", F.size("prefix").alias("asked"), F.posexplode("prefix").alias("pos", "token")
    )
    shared = saved(
        postings.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select(F.col("token").alias("key")),
        "shared",
    )
    if shared.count() <= (1 << join.bloom_bits) // 4:
        postings = _likely(nodes, shared, join)
    held = postings.join(shared.withColumnRenamed("key", "token"), "token")
    # One node's tokens: bounded by the length of one text.
    node = Window.partitionBy("node")
    return saved(
        held.withColumn("earlier", F.row_number().over(node.orderBy("pos")) - 1)
        .withColumn("own", F.col("asked") - F.count(F.lit(1)).over(node).cast("int"))
        .drop("asked"),
        "active",
    )


def _likely(nodes: DataFrame, shared: DataFrame, join: Join) -> DataFrame:
    """The postings (node, n, ell, asked, pos, token) whose token a Bloom filter of `shared` knows."""
    known = nodes.sparkSession.sparkContext.broadcast(bloom(shared, join.bloom_bits))
    names = ["node", "n", "ell", "asked", "pos", "token"]
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column("prefix")
            sizes = np.diff(prefixes.offsets.to_numpy())
            tokens = prefixes.flatten().to_numpy()
            kept = np.flatnonzero(in_bloom(tokens, known.value, join.bloom_bits))
            row = np.repeat(np.arange(len(sizes)), sizes)[kept]
            place = kept - (np.cumsum(sizes) - sizes)[row]
            of_row = [batch.column(n).to_numpy()[row] for n in ("node", "n", "ell")]
            columns = [*of_row, sizes[row], place, tokens[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    layout = "node long, n int, ell int, asked int, pos int, token long"
    return nodes.select("node", "n", "ell", "prefix").mapInArrow(work, layout)


def _links(nodes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """Edges (a, b) that connect every class of similar nodes."""
    lists = _active(nodes, join).withColumn("component", F.col("node"))
    links = None
    tested = None
    for turn in range(join.star_rounds + 1):
        if turn:
            comp = components(links)
            lists = saved(
                lists.drop("component", "centre")
                .join(comp, "node", "left")
                .withColumn("component", F.coalesce("component", "node")),
                "labelled",
            )
        # The centre of a list is its least peculiar node, as the original is among its copies;
        # among equals another one each turn.
        rank = F.struct("own", F.xxhash64("node", F.lit(turn)).alias("r"))
        entry = F.struct("node", "pos", "n", "ell", "earlier", "component")
        open_ = lists.groupBy("token").agg(
            F.min(F.struct(rank.alias("rank"), entry.alias("entry")))["entry"].alias("centre"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).filter("low < high").select("token", "centre")
        lists = saved(lists.join(open_, "token"), "lists")
        exact = turn and (turn == join.star_rounds or _few(lists, nodes))
        if exact:
            # Every pair of a list may come once per match: two matches are asked for at most.
            lists = lists.withColumn("ell", F.least("ell", F.lit(2)))
            x, y = lists.alias("x"), lists.alias("y")
            found = x.join(
                y,
                F.expr("x.token = y.token AND x.node < y.node AND x.component <> y.component")
                & _may_match("x.", "y.", join.percent),
            ).select(
                F.col("x.node").alias("a"), F.col("y.node").alias("b"),
                F.least("x.ell", "y.ell").alias("ell"),
            )
        else:
            found = lists.filter("centre.node <> node AND centre.component <> component").filter(
                _may_match("", "centre.", join.percent)
            ).select(
                F.col("centre.node").alias("a"), F.col("node").alias("b"),
                F.least("ell", "centre.ell").alias("ell"),
            )
        pairs = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("ell").alias("ell"))
        pairs = pairs.filter("shared >= ell").select("a", "b")
        if tested is not None:
            flipped = tested.select(F.col("b").alias("a"), F.col("a").alias("b"))
            pairs = pairs.join(tested.unionByName(flipped), ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        new = saved(verified(pairs, nodes, docs, join), "links")
        links = new if links is None else links.unionByName(new)
        if exact:
            return links


def _few(lists: DataFrame, nodes: DataFrame) -> bool:
    """Whether comparing members of different components in the open lists is cheap by now."""
    cross = lists.groupBy("token", "component").agg(F.count(F.lit(1)).cast("double").alias("m"))
    cross = cross.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
    pairs = cross.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2)).first()[0]
    return (pairs or 0) <= 64 * nodes.count()


def ngram_classes(docs: DataFrame, join: Join = Join(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, key (a hash of the text), n_shingles, component_id."""
    return _classes(docs, join, id_, text).drop("component")


def _classes(docs: DataFrame, join: Join, id_: str, text: str) -> DataFrame:
    """ngram_classes() and the class itself, `component`: ids can be null or shared by classes.

    It is null where a text is alone because it has no words.
    """
    source = docs.select(
        quoted(id_).cast("long").alias("id"), quoted(text).cast("string").alias("text")
    )
    prints = saved(_prints(source, join), "prints")
    first = F.min_by(
        F.struct("id", "key", "n", "ell", "prefix"), F.struct(F.col("id").isNull(), "id", "key")
    )
    nodes = saved(
        prints.filter("n > 0").groupBy("sid").agg(first.alias("one"))
        .select("sid", "one.*").withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    classes = components(_links(nodes, source, join))
    member = nodes.select("node", "sid", "id").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = member.groupBy("component").agg(F.min("id").alias("component_id"))
    label = member.join(least, "component").select("sid", "component", "component_id")
    return prints.join(label, "sid", "left").select(
        "id", "key", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        "component",
    )


def one_per_class(docs: DataFrame, join: Join = Join(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the least id of each class, one row each, columns as they came.

    Of rows with that id, one whose text is in the class stays. A class of null ids keeps one.
    Texts without words are one class for each id and text.
    """
    classes = _classes(docs, join, id_, text)
    lone = F.col("component").isNull()
    picks = (
        classes.groupBy("component", F.when(lone, F.col("id")).alias("lone_id"), F.when(lone, F.col("key")).alias("lone_key"))
        .agg(F.min_by(F.struct("id", "key"), F.struct(F.col("id").isNull(), "id", "key")).alias("pick"))
        .select(F.col("pick.id").alias("pick_id"), F.col("pick.key").alias("pick_key"))
        .distinct()
    )
    key, row = fresh(docs, "text_key"), fresh(docs, "row")
    keyed = docs.withColumn(key, F.xxhash64(quoted(text).cast("string")))
    same = F.col("pick_id").eqNullSafe(quoted(id_).cast("long")) & (F.col("pick_key") == quoted(key))
    names = columns_of(docs)
    return (
        keyed.join(picks, same, "left_semi")
        .withColumn(row, F.struct(*names))
        .dropDuplicates([id_, key])
        .select(*names)
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


def oracle_sql() -> str:
    """DuckDB SQL of op10: all pairs that share a shingle, then the least id reachable."""
    blank = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{blank}') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 3], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
r AS (
  SELECT doc_id AS node, doc_id AS first FROM documents
  UNION SELECT e.b, r.first FROM r JOIN e ON e.a = r.node)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents LEFT JOIN n USING (doc_id)
JOIN (SELECT r.node AS doc_id, min(r.first) AS component_id FROM r GROUP BY r.node) c USING (doc_id)"""
