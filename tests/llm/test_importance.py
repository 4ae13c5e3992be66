import math
import random

import corpus
import numpy as np
from pyspark.sql import functions as F

from haulmetric.llm import importance
from haulmetric.llm.importance import Resampling

SMALL = Resampling(buckets=1 << 12)


def test_kth_largest_is_exact(spark):
    ranks = spark.range(3000).select((F.xxhash64("id") / 3).cast("long").alias("rank"))
    ranks = ranks.unionByName(spark.createDataFrame([(0,), (0,), (-1,), (2**62,), (-(2**62),)], "rank long"))
    want = sorted((r.rank for r in ranks.collect()), reverse=True)
    for k in (1, 2, 700, 1502, 1503, 3005):
        assert importance.kth_largest(ranks, k) == want[k - 1]
    assert importance.kth_largest(ranks, 3006) is None


def test_counts_and_scores_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, corpus.prose(rng, 30), "en", "a") for k in range(50)]
    docs = corpus.frame(spark, rows).select(F.col("doc_id").alias("id"), "text").repartition(3)
    good = np.arange(0, 50, 2)
    counts = importance.ngram_counts(docs, good, SMALL)
    want = np.zeros((2, SMALL.buckets * SMALL.order))
    for k, text, *_ in rows:
        for b in importance.buckets_of(text, SMALL):
            want[0, b] += 1
            want[1, b] += k % 2 == 0
    assert (counts == want).all()
    ratios = importance.log_ratios(counts, SMALL)
    scores = {r.id: r for r in importance.scored(docs, ratios, SMALL).collect()}
    for k, text, *_ in rows:
        assert math.isclose(scores[k].log_weight, ratios[importance.buckets_of(text, SMALL)].sum(), abs_tol=1e-4)


def test_noise_is_standard_gumbel():
    rng = random.Random(2)
    draws = [importance.gumbel(rng.getrandbits(64)) for _ in range(20_000)]
    assert abs(sum(draws) / len(draws) - 0.5772) < 0.03
    assert all(map(math.isfinite, (importance.gumbel(0), importance.gumbel(-1))))


def test_held_out_documents_are_told_apart(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(600):
        junk = k % 4 == 0
        tokens = corpus.words(rng, 60)
        rows.append((k, " ".join(t.upper() + "zz" if junk and i % 3 else t for i, t in enumerate(tokens)) + (" trash clown" * 5 if junk else ""), "en", "a"))
        if k < 300:
            labels.append((k, 0 if junk else 1, 0))
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = importance.resample(corpus.frame(spark, rows), frame, SMALL).collect()
    kept = {r.id for r in found if r.kept and r.id >= 300}
    clean = {k for k in range(300, 600) if k % 4}
    assert len(kept & clean) >= 0.95 * len(clean)
    assert len(kept - clean) <= 0.1 * 75
    assert sum(r.kept for r in found) == 450


def test_odd_rows_without_labels_are_all_kept(spark):
    docs = corpus.odd(spark)
    labels = spark.createDataFrame([(None, 1, 1), (77, None, None)], "doc_id long, quality int, toxic int")
    kept = importance.resampled_documents(docs, labels.limit(0), SMALL)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert importance.resample(docs, labels, SMALL).filter("kept").count() == 0
    assert importance.resample(docs.limit(0), labels, SMALL).count() == 0
