import random

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetric.llm import mixing


def plain_targets(sizes, mix=mixing.Mix()):
    """Share by weight; whoever is above the cap stays there, the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(names)}
    left, open_, found = sum(sizes.values()) * mix.amount / 100, set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > sizes[s] * mix.most / 100}
        if not above:
            return found | {s: left * weight[s] / total for s in open_}
        for s in above:
            found[s] = sizes[s] * mix.most / 100
        left -= sum(found[s] for s in above)
        open_ -= above
    return found


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice([0, 3, 50, 1000, 20_000]) for k in range(rng.randint(1, 12))} | {None: 70}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert all(abs(found[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def near(rows):
    """Taken words stay below the target, by a little or less than any document that was left out."""
    target, taken = rows[0].target, sum(r.taken for r in rows)
    passes = max(1, -(-target // max(rows[0].source_size, 1)))
    left_out = [r["size"] for r in rows if r["size"] and r.taken < passes * r["size"]]
    assert taken <= target + 1e-6 and (not left_out or target - taken <= max(min(left_out), 0.0005 * target))


def dealt(spark, rows, mix=mixing.Mix()):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    sized = mixing.saved(docs.select("doc_id", *mixing._sized(docs, mix, "doc_id", "source", "text")), "sized")
    size = F.col("size") * F.size("shards")
    return mixing.takings(sized, mix).withColumn("taken", size).collect()


@pytest.mark.parametrize("sources", [1, 3])
def test_one_very_long_text_among_tiny_ones(spark, sources):
    """The last block holds a text that does not fit and thousands that do."""
    rows = []
    for s in range(sources):
        count, long = (3000, 40_000) if sources == 1 else (1200, 30_000)
        rows.append((s * 10_000, f"s{s}", "w " * long))
        rows += [(s * 10_000 + 1 + k, f"s{s}", "w " * 20) for k in range(count)]
    found = dealt(spark, rows)
    for s in range(sources):
        near([r for r in found if r.source == f"s{s}"])


@pytest.mark.parametrize("seed", range(3))
def test_last_blocks_are_filled_from_any_sizes(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", "c", None]), "w " * int(rng.paretovariate(0.7))) for k in range(1500)]
    rows += rows[:300] * 2  # repeated rows are taken together
    found = dealt(spark, rows, mixing.Mix(block_words=rng.choice([100, 5000])))
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        near(own)
    again = dealt(spark, rows[::-1], mixing.Mix(block_words=5000))
    same = dealt(spark, rows, mixing.Mix(block_words=5000))
    assert sorted((r.doc_id, r.taken, tuple(r.shards)) for r in again) == sorted((r.doc_id, r.taken, tuple(r.shards)) for r in same)


def test_blocks_of_one_source_are_ranked_in_buckets(spark):
    """Two levels of running sums give the order that one window over the source would."""
    blocks = spark.range(5000).selectExpr("'a' AS source", "id AS block", "1 + id % 7 AS words", "explode(array(0, 1)) AS pass")
    total = blocks.agg(F.sum("words")).first()[0] / 2
    goal = spark.createDataFrame([("a", total * 1.5, 0)], "s string, left double, slots long")
    rows = mixing._slots(blocks.withColumn("rank", mixing._rank(mixing.Mix(), F.col("pass"))), goal).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert sorted(r.block for r in rows if r["pass"] == 0) == list(range(5000))
    done, at = 0, None
    for r in sorted(rows, key=lambda r: r.slot):
        assert r.room == total * 1.5 - done and (at is None or (r["pass"], r["rank"]) > at)
        done, at = done + r.words, (r["pass"], r["rank"])
    assert done >= total * 1.5 > done - 7


def test_takings_hit_the_targets_and_rerun_alike(spark, sf_dir):
    first = mixing.op6_mix_sources(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    rows = first.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(r.taken <= 2 * r["size"] for r in rows)
    sources = {r.source for r in rows}
    want = plain_targets({s: sum(r["size"] for r in rows if r.source == s) for s in sources})
    for source in sources:
        own = [r for r in rows if r.source == source]
        assert abs(own[0].target - want[source]) < 1e-6 * want[source]
        near(own)
    again = mixing.op6_mix_sources(spark, sf_dir)
    assert first.exceptAll(again).isEmpty()


def test_the_tree_deals_every_slot_once(spark):
    quotas = spark.createDataFrame([("a", 500), ("b", 130), (None, 41)], "source string, slots long")
    mix = mixing.Mix(shard_words=1)
    dealt = mixing.deal(quotas, 1500, mix).collect()
    assert len(dealt) == len({(r.source, r.slot) for r in dealt}) == 671
    assert {r.slot for r in dealt if r.source == "b"} == set(range(130))
    assert all(0 <= r.shard < 1500 for r in dealt)
    few = mixing.deal(quotas, 4, mix)
    counts = dict(few.groupBy("shard").count().collect())
    assert len(counts) == 4 and max(counts.values()) - min(counts.values()) <= 2
    # Each shard's mixture is near that of the whole.
    for row in few.groupBy("shard").agg(F.avg((F.col("source") == "a").cast("int")).alias("a")).collect():
        assert abs(row.a - 500 / 630) < 0.15


def test_splits_are_exact_and_follow_the_hypergeometric_mean():
    counts = np.array([1000, 10, 0, 300])
    draws = np.array([mixing.split(k, counts, 655, 1) for k in range(400)])
    assert (draws.sum(axis=1) == 655).all() and (draws <= counts).all()
    assert np.abs(draws.mean(axis=0) - counts / 2).max() < 2


def test_mixed_rows_keep_columns_and_repeat_at_most_twice(spark):
    rows = [(1000 + k, "w " * (k % 9 + 1), "en", f"s{k % 4}") for k in range(200)] + corpus.odd_rows()
    docs = corpus.frame(spark, rows).repartition(3)
    mixed = mixing.mixed_documents(docs, mixing.Mix(block_words=100, shard_words=300))
    assert mixed.schema == docs.schema
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert not {3, 4, 5} & set(counts)
    assert all(n <= 2 for k, n in counts.items() if k not in (None, 1))
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
