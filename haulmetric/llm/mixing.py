"""Mixing sources to target weights with a hypergeometric splitting tree (operator 6).

Every source is cut into blocks of about `block_words` words by a hash of its documents. The
target of a source says how many block slots it fills: whole passes over its blocks, then part
of another pass. The number of slots is exact, and a tree splits it among the output shards:
each node deals its slots to two children by a multivariate hypergeometric draw, so a shard's
mixture is that of a uniform shuffle while no two shards share a slot. A slot stands for one
block by a permutation of its pass, so the draws are disjoint without a global sort. Documents
then go to their shards and are shuffled there.

All draws come from keyed generators (seed, node), so a rerun or a retried task repeats them.

Defined results: a null text has size 0 and is never taken; null sources are one source, last in
order; repeated rows fall into one block and are taken alike; an empty table, or one without
words, takes nothing; columns of the input are carried through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from haulmetric.llm.common import (
    batched,
    columns_of,
    quoted,
    read,
    rows_of,
    saved,
    word_count,
)

#: Subtrees with at most so many shards are dealt out inside one task.
SUBTREE = 1024


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in order; amount and most are in percent of the words.

    block_words and shard_words set the sizes of blocks and output shards; a share `slack` of a
    target may stay open.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    amount: int = 150
    most: int = 200
    block_words: int = 50_000
    shard_words: int = 1_000_000
    slack: float = 0.0005
    seed: int = 20_240_601


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Add double `target` to (source, source_size), one row per source.

    What a capped source cannot take is shared by weight among the others until none is above
    its cap. Sorted by cap per weight, the capped sources are the first ones, so running sums
    give the level (target per weight) of the rest.
    """
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    cap = F.col("source_size") * (mix.most / 100)
    weighed = sizes.withColumn(
        "weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(mix.weights) + 1)
    ).withColumn("cap", cap)
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        W.unboundedPreceding, -1
    )
    goal = F.sum("source_size").over(everything) * (mix.amount / 100)
    level = (goal - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # The level of the first source whose cap holds it; none, and all are at their caps.
    fitting = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level")))
    return (
        weighed.withColumn("level", level)
        .withColumn("place", F.row_number().over(before.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("free", fitting.over(everything))
        .withColumn(
            "target",
            F.when(F.col("place") >= F.col("free.place"), F.col("free.level") * F.col("weight"))
            .otherwise(F.col("cap")),
        )
        .select("source", "source_size", "target")
    )


def _spread(docs: DataFrame, id_: str, text: str, mix: Mix) -> Column:
    """A document's place in the random order of its source, from its content and the seed."""
    return F.xxhash64(F.lit(mix.seed), quoted(id_).cast("string"), quoted(text).cast("string"))


def plan(sized: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """(sources, blocks) for rows (source, size, spread).

    sources: source, source_size, target, blocks (their number). blocks: source, block and
    takings, one for each time it is drawn: pass, shard and whether all of it is taken, or else
    the ranges of (size, spread) that are (cuts).

    A source's slots are its blocks in the order of their ranks, pass after pass, while they fit; of
    the last one those documents are taken that do. Where a long document leaves more than `slack`
    of the target open, another round goes on behind that slot with the documents short enough
    for what is left, until nothing fits or little is missing.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = saved(
        targets(sizes, mix).withColumn(
            "blocks", F.greatest(F.ceil(F.col("source_size") / mix.block_words), F.lit(1)).cast("long")
        ),
        "sources",
    )
    placed = with_block(sized, sources).filter("size > 0")
    passes = F.explode(F.sequence(F.lit(0), F.lit(-(-mix.most // 100) - 1)))
    open_ = sources.select(
        F.col("source").alias("s"), "target", F.col("target").alias("left"), F.lit(0).cast("long").alias("slots")
    ).filter("left > 0")
    rows, found, first = placed, [], True
    while True:
        # `left` is also the size of the longest document that can still be taken.
        if not first:
            rows = placed.join(open_, F.expr("source <=> s")).filter(
                (F.col("size") <= F.col("left")) & (F.struct(_rank(mix, F.col("pass")), "block") > F.struct("at.rank", "at.block"))
            )
        blocks = rows.groupBy("source", "block", *([] if first else ["pass"])).agg(F.sum("size").alias("words"))
        if first:
            blocks = saved(blocks, "blocks").withColumn("pass", passes)
        slots = saved(_slots(blocks.withColumn("rank", _rank(mix, F.col("pass"))), open_), "slots")
        cut = saved(_cuts(rows, slots.filter("room < words")), "cuts")
        here = slots.join(
            cut.select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("pass").alias("p"), "cuts", "filled"),
            F.expr("source <=> s AND block = b AND pass = p"), "left",
        )
        whole = F.col("room") >= F.col("words")
        short = F.array(F.struct(
            F.floor("left").alias("from_size"), F.lit(-(1 << 63)).alias("from_spread"),
            F.lit(0).cast("long").alias("to_size"), F.lit((1 << 63) - 1).alias("to_spread"),
        ))
        here = saved(
            here.select(
                "source", "block", "pass", "rank", "slot", whole.alias("all") if first else F.lit(False).alias("all"),
                (F.col("cuts") if first else F.when(whole, short).otherwise(F.col("cuts"))).alias("cuts"),
                F.when(whole, F.col("words")).otherwise(F.coalesce("filled", F.lit(0))).alias("words"),
            ),
            "round",
        )
        found.append(here.drop("rank"))
        done = here.groupBy(F.col("source").alias("s1")).agg(
            F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"),
            F.max(F.struct("pass", "rank", "block")).alias("last"),
        )
        # A round that took nothing found nothing short enough.
        open_ = saved(
            open_.join(done, F.expr("s <=> s1"))
            .select(
                "s", "target", (F.col("left") - F.col("words")).alias("left"), (F.col("slots") + F.col("n")).alias("slots"),
                F.col("last.pass").alias("pass"), F.col("last").alias("at"), "words",
            )
            .filter((F.col("left") > mix.slack * F.col("target")) & (F.col("left") >= 1) & (F.col("words") > 0)),
            "open",
        ).drop("words")
        first = False
        if open_.isEmpty():
            break
    slots = reduce(DataFrame.unionByName, found)
    quotas = slots.groupBy("source").agg(F.count(F.lit(1)).alias("slots"))
    shard_of = deal(quotas, slots.agg(F.sum("words")).first()[0] or 0, mix)
    dealt = slots.join(
        shard_of.select(F.col("source").alias("s"), F.col("slot").alias("k"), "shard"),
        F.expr("source <=> s AND slot = k"),
    )
    grouped = dealt.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "cuts", "all"))).alias("takings")
    )
    return sources, saved(grouped, "takings")


#: The high bits of a block's rank that number its bucket; ranks are spread evenly.
_BUCKET_BITS = 12


def _rank(mix: Mix, turn: Column) -> Column:
    """Place of a block in a pass, whose order is a permutation of its own."""
    return F.xxhash64(F.lit(mix.seed), "source", "block", turn.cast("int"))


def _slots(blocks: DataFrame, open_: DataFrame) -> DataFrame:
    """Rows (source, block, pass, rank, slot, words, room, left): the blocks that begin before a source's
    `left` words are full, in the order of (pass, rank).

    Running sums over a source go in two levels, within a bucket of ranks and over the buckets'
    totals, so that a source with very many blocks is dealt to as many tasks as it has buckets.
    """
    bucket = F.col("pass") * (1 << _BUCKET_BITS) + F.shiftright("rank", 64 - _BUCKET_BITS)
    ranked = blocks.withColumn("bucket", bucket)
    over = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = ranked.groupBy("source", "bucket").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("c"))
    before = totals.select(
        F.col("source").alias("s1"), F.col("bucket").alias("k"),
        F.coalesce(F.sum("w").over(over), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("c").over(over), F.lit(0)).alias("slots_before"),
    )
    within = W.partitionBy("source", "bucket").orderBy("rank", "block")
    start = F.col("words_before") + F.sum("words").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("words")
    placed = (
        ranked.join(before, F.expr("source <=> s1 AND bucket = k"))
        .withColumn("start", start)
        .withColumn("nth", F.row_number().over(within) - 1)
        .join(open_.select(F.col("s"), "left", "slots"), F.expr("source <=> s"))
    )
    return placed.filter(F.col("start") < F.col("left")).select(
        "source", "block", "pass", "rank", (F.col("slots") + F.col("slots_before") + F.col("nth")).alias("slot"), "words",
        # The words still allowed; less than all of them in the last slot only.
        (F.col("left") - F.col("start")).alias("room"), "left",
    )


def with_block(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Add `block`, the block of each row in its source."""
    side = sources.select(F.col("source").alias("_s"), F.col("blocks").alias("_blocks"))
    return (
        sized.join(side, F.expr("source <=> _s"))
        .withColumn("block", F.pmod(F.col("spread"), F.col("_blocks")))
        .drop("_s", "_blocks")
    )


_RANGE = pa.struct([(n, pa.int64()) for n in ("from_size", "from_spread", "to_size", "to_spread")])
_CUT = pa.schema(
    [("source", pa.string()), ("block", pa.int64()), ("pass", pa.int32()), ("cuts", pa.list_(_RANGE)), ("filled", pa.int64())]
)


def _cuts(rows: DataFrame, last: DataFrame) -> DataFrame:
    """Which documents of a source's last slot are taken, and their words (filled).

    Documents go by size, large ones first, then by spread; each is taken that still fits. What is
    taken is a list of ranges in that order. A document that does not fit is longer than what is
    left then, and one not longer than itself must be taken before the next such, so what is left
    halves from one to the next: there are no more ranges than binary digits in the slot's words.
    (Repeated rows, which are taken together or not at all, may add one each.) One block of each
    source passes here, about `block_words` words.
    """
    last = last.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.col("pass").alias("_p"), "room")
    found = (
        rows.select("source", "block", "size", "spread")
        .join(last, F.expr("source <=> _s AND block = _b"))
        .groupBy("source", "block", F.col("_p").alias("pass"), "room", "spread")
        .agg(F.max("size").alias("one"), F.sum("size").alias("size"))
        .repartition("source")
        .sortWithinPartitions("source", "block", "pass", F.col("one").desc(), "spread")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            key, ranges, fits = None, [], False
            for source, block, turn, room, spread, one, size in rows_of(
                batches, ("source", "block", "pass", "room", "spread", "one", "size")
            ):
                if key != (source, block, turn):
                    if key:
                        yield *key, ranges, filled
                    key, left, ranges, fits, filled = (source, block, turn), room, [], False, 0
                went_on, fits = fits, size <= left
                if fits:
                    left, filled = left - size, filled + size
                    if not went_on:
                        ranges.append({"from_size": one, "from_spread": spread})
                    ranges[-1] |= {"to_size": one, "to_spread": spread}
            if key:
                yield *key, ranges, filled

        yield from batched(made(), _CUT)

    layout = "from_size: bigint, from_spread: bigint, to_size: bigint, to_spread: bigint"
    return found.mapInArrow(work, f"source string, block long, pass int, cuts array<struct<{layout}>>, filled long")


def split(node: int, counts: np.ndarray, left: int, seed: int) -> np.ndarray:
    """How many of each source's slots go to the left child, which gets `left` slots in all."""
    draw = np.random.Generator(np.random.Philox(key=[seed, node]))
    taken = np.zeros_like(counts)
    total, rest = int(counts.sum()), left
    for k, count in enumerate(counts):
        # Source by source: the marginals of the multivariate draw, without its limit on totals.
        total -= int(count)
        taken[k] = draw.hypergeometric(int(count), total, rest) if rest and count else 0
        rest -= int(taken[k])
    return taken


def deal(quotas: DataFrame, words: int, mix: Mix) -> DataFrame:
    """Rows (source, slot, shard): each source's slots 0, 1, ... dealt to the shards.

    The upper tree is one small row of counts per node; below, each task deals one subtree.
    """
    tree = pa.schema(
        [("node", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("source", pa.string()),
         ("start", pa.int64()), ("count", pa.int64())]
    )
    layout = "node long, first long, last long, source string, start long, count long"
    shards = max(-(-words // mix.shard_words), 1)
    roots = quotas.select(
        F.lit(1).cast("long").alias("node"), F.lit(0).cast("long").alias("first"),
        F.lit(shards).cast("long").alias("last"), "source", F.lit(0).cast("long").alias("start"), F.col("slots").alias("count"),
    )

    def grow(depth: int | None):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes: dict[int, list[tuple]] = {}
            for node, *rest in rows_of(batches, tree.names):
                nodes.setdefault(node, []).append(rest)

            def made() -> Iterator[tuple]:
                stack = [(n, r) for n, r in nodes.items()]
                while stack:
                    node, rest = stack.pop()
                    first, last = rest[0][:2]
                    if last - first <= (SUBTREE if depth is None else 1):
                        yield from ((node, *r) for r in rest if r[4])
                        continue
                    rest.sort(key=lambda r: (r[2] is None, r[2] or ""))
                    counts = np.array([r[4] for r in rest], np.int64)
                    middle = (first + last) // 2
                    left = int(counts.sum()) * (middle - first) // (last - first)
                    taken = split(node, counts, left, mix.seed)
                    halves = list(zip(rest, map(int, taken), strict=True))
                    stack.append((2 * node, [(first, middle, r[2], r[3], t) for r, t in halves]))
                    stack.append(
                        (2 * node + 1, [(middle, last, r[2], r[3] + t, r[4] - t) for r, t in halves])
                    )

            yield from batched(made(), tree)

        return work

    upper = roots.coalesce(1).mapInArrow(grow(None), layout)
    leaves = upper.repartition("node").mapInArrow(grow(1), layout)
    return leaves.select(
        "source", F.col("first").alias("shard"),
        F.explode(F.sequence(F.col("start"), F.col("start") + F.col("count") - 1)).alias("slot"),
    )


def takings(sized: DataFrame, mix: Mix) -> DataFrame:
    """Add `source_size`, `target` and `shards` (array: the shard of each taking) to the rows."""
    sources, blocks = plan(saved(sized.select("source", "size", "spread"), "sized"), mix)
    here = [c for c in sized.columns]
    joined = with_block(sized, sources).join(
        blocks.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "takings"),
        F.expr("source <=> _s AND block = _b"), "left",
    )
    size, spread = F.col("size"), F.col("spread")

    def within(r: Column) -> Column:
        after = (size < r["from_size"]) | ((size == r["from_size"]) & (spread >= r["from_spread"]))
        return after & ((size > r["to_size"]) | ((size == r["to_size"]) & (spread <= r["to_spread"])))

    mine = F.filter("takings", lambda t: t["all"] | F.exists(t["cuts"], within))
    shards = F.when(F.col("size") > 0, F.transform(mine, lambda t: t["shard"]))
    out = joined.withColumn("shards", F.coalesce(shards, F.array().cast("array<long>")))
    side = sources.select(F.col("source").alias("_s2"), "source_size", "target")
    return out.join(side, F.expr("source <=> _s2")).select(
        *(quoted(c) for c in here), "source_size", "target", "shards"
    )


def _sized(docs: DataFrame, mix: Mix, id_: str, source: str, text: str) -> list[Column]:
    return [
        quoted(source).cast("string").alias("source"),
        word_count(quoted(text).cast("string")).alias("size"),
        _spread(docs, id_, text, mix).alias("spread"),
    ]


def mixed_documents(
    docs: DataFrame, mix: Mix = Mix(), id_: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """The mix: every taking of a document is a row, in its shard and shuffled there."""
    row = F.struct(*columns_of(docs)).alias("row")
    sized = docs.select(*_sized(docs, mix, id_, source, text), row)
    out = takings(sized, mix).select("row", "spread", F.posexplode("shards").alias("turn", "shard"))
    shuffled = out.repartition("shard").sortWithinPartitions(
        "shard", F.xxhash64(F.lit(mix.seed), "spread", "turn"), "spread", "turn"
    )
    return shuffled.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sized = saved(docs.select(*_sized(docs, Mix(), "doc_id", "source", "text"), "doc_id"), "docs")
    return takings(sized, Mix()).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("shards")).alias("taken"), "shards",
    )
