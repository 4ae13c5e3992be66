import random

import corpus
import pytest
from pyspark.sql import functions as F

from haulmetric.llm import quality


def brute_repeats(tokens, size=8):
    grams = [tuple(tokens[k : k + size]) for k in range(len(tokens) - size + 1)]
    covered = set()
    for k, gram in enumerate(grams):
        if grams.count(gram) > 1:
            covered |= set(range(k, k + size))
    return len(covered)


@pytest.mark.parametrize("seed", range(30))
def test_repeated_windows_equal_brute_force(seed):
    rng = random.Random(seed)
    tokens = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 60))]
    if seed % 3 == 0:
        tokens = tokens + corpus.words(rng, 20) + tokens
    assert quality.repeat_words(tokens) == brute_repeats(tokens)


def test_words_are_cut_at_ascii_blanks_only():
    assert quality.measures("a　b\x0bc d")[:2] == (2, 6)
    assert quality.measures(None) == quality.measures("") == (0,) * len(quality.MEASURES)


def test_sketches_of_parts_merge_to_the_sketch_of_all(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    measured = quality.measure(docs, "m").drop("text").cache()
    whole = quality.sketch(measured, "m")
    parts = [quality.sketch(measured.filter(F.pmod("doc_id", F.lit(3)) == k), "m") for k in range(3)]
    keys = ["lang", "source", "metric", "bucket"]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*keys).agg(F.sum("n").alias("n"))
    assert whole.exceptAll(merged.select(whole.columns)).isEmpty()
    assert whole.count() == merged.count()


def test_buckets_keep_leading_bits(spark):
    rows = spark.range(5000).select("id", quality.bucket(F.col("id")).alias("b")).collect()
    for row in rows:
        drop = max(row.id.bit_length() - quality.SKETCH_BITS, 0)
        assert row.b == row.id >> drop << drop


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    docs = corpus.odd(spark)
    kept = quality.quality_rules(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 8]
    sf = corpus.stored(docs, tmp_path)
    rows = quality.op1_quality_rules(spark, sf).collect()
    assert len(rows) == docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)


def test_empty_table(spark):
    assert quality.quality_rules(corpus.odd(spark).limit(0)).count() == 0


def test_outliers_of_a_group_go_and_its_usual_rows_stay(spark):
    rng = random.Random(2)
    rows = [(k, corpus.prose(rng, 100), "en", "a") for k in range(300)]
    rows += [(1000 + k, " ".join(w + "###" for w in corpus.words(rng, 100)), "en", "a") for k in range(5)]
    # In another source the same symbols are usual.
    rows += [(2000 + k, " ".join(w + "###" for w in corpus.words(rng, 100)), "en", "b") for k in range(300)]
    kept = {r.doc_id for r in quality.quality_rules(corpus.frame(spark, rows)).collect()}
    assert not kept & set(range(1000, 1005))
    assert len(kept) >= 0.98 * 600
