"""Quality by importance resampling (operator 8).

Two generative models over hashed word n-grams are counted: one of the target, which is the
labelled good documents, and one of all raw text. A document's log weight is the log ratio of
its probability under the two. Documents are then drawn without replacement in proportion to
their weights by the Gumbel top-k rule: add independent Gumbel noise to the log weights and keep
the k largest. The noise comes from a hash of the document, so reruns agree.

k is the estimated number of good documents: the share of good ones among the labelled, of all
documents. The k-th largest key is found by narrowing its bits with counts, without sorting.

Defined results: null or empty texts have weight 0 (no evidence) and are drawn last; documents
without a label only count as raw; an unlabelled or empty corpus keeps nothing to compare with
and draws by noise alone (all of it, as k is then everything); repeated rows get the same key,
and ties at the k-th key are all kept; labels may repeat or contradict each other, a document is
good if some label says so and none says toxic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import (
    MASK64,
    batched,
    columns_of,
    mixed,
    quoted,
    read,
    rows_of,
    saved,
    window_hashes,
    word_codes,
)
from haulmetric.llm.ngram_join import ARRAY_TASKS, chunked, merged

#: Steps of a rank per unit of log weight, and the rank of a text without words.
RANK_SCALE = 1 << 24
LAST = -(1 << 62)


@dataclass(frozen=True)
class Resampling:
    """buckets: hash buckets of each n-gram order, 1 to `order`; smoothing and sure: see log_ratios.

    label_rows bounds the labels that the target model is fitted on (by hash of the id, the same
    for every run); raw counts and scores always cover all documents.
    """

    buckets: int = 1 << 20
    order: int = 2
    smoothing: float = 5.0
    sure: float = 4.0
    label_rows: int = 1_000_000
    seed: int = 7


def buckets_of(text: str | None, how: Resampling) -> np.ndarray:
    """Bucket numbers of all n-grams of a text, order by order."""
    codes = word_codes(text)
    parts = []
    for n in range(1, how.order + 1):
        hashes = mixed(codes) if n == 1 else window_hashes(codes, n)
        parts.append((hashes % np.uint64(how.buckets)).astype(np.int64) + (n - 1) * how.buckets)
    return np.concatenate(parts)


def good_ids(labels: DataFrame, how: Resampling, id_: str = "doc_id") -> tuple[np.ndarray, float]:
    """Sorted ids of the good labelled documents, and their share of the labelled ones.

    Of more than `label_rows` labelled ids those with the least hashes are taken.
    """
    rows = (
        labels.filter(quoted(id_).isNotNull())
        .groupBy(quoted(id_).cast("long").alias("id"))
        .agg(
            (F.coalesce(F.max("quality"), F.lit(0)) > 0).alias("fine"),
            (F.coalesce(F.max("toxic"), F.lit(0)) > 0).alias("toxic"),
        )
        .orderBy(F.xxhash64(F.lit(how.seed), "id"), "id")
        .limit(how.label_rows)
        .select("id", (F.col("fine") & ~F.col("toxic")).alias("good"))
        .toArrow()
    )
    good = rows.column("good").to_numpy(zero_copy_only=False).astype(bool)
    return np.sort(rows.column("id").to_numpy()[good]), float(good.mean()) if len(good) else 1.0


def ngram_counts(docs: DataFrame, good: np.ndarray, how: Resampling) -> np.ndarray:
    """Counts (raw, target) by bucket over all documents (id, text). Their size is fixed."""
    size = how.buckets * how.order
    shared = docs.sparkSession.sparkContext.broadcast(good)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        total = np.zeros((2, size), np.uint64)
        for id_, text in rows_of(batches, ("id", "text")):
            if not text:
                continue
            found = buckets_of(text, how)
            np.add.at(total[0], found, np.uint64(1))
            at = np.searchsorted(ids, id_) if id_ is not None else len(ids)
            if at < len(ids) and ids[at] == id_:
                np.add.at(total[1], found, np.uint64(1))
        yield from chunked(total.ravel())

    rows = docs.select("id", "text").coalesce(ARRAY_TASKS).mapInArrow(work, "chunk int, data binary")
    found = merged(rows, np.uint64, np.add)
    return found.reshape(2, size) if len(found) else np.zeros((2, size), np.uint64)


def log_ratios(counts: np.ndarray, how: Resampling) -> np.ndarray:
    """log(target probability / raw probability) by bucket.

    A bucket whose target count is within `sure` standard deviations of what the raw model
    expects says nothing, and `smoothing` pulls the others towards 0; without a target all are 0.
    """
    ratios = []
    for k in range(how.order):
        raw, target = counts[:, k * how.buckets : (k + 1) * how.buckets].astype(np.float64)
        expected = raw * (target.sum() / max(raw.sum(), 1))
        ratio = np.log((target + how.smoothing) / (expected + how.smoothing))
        ratios.append(np.where(np.abs(target - expected) > how.sure * np.sqrt(expected + 1), ratio, 0.0))
    return np.concatenate(ratios).astype(np.float32)


def gumbel(spread: int) -> float:
    """Standard Gumbel noise from 64 random bits."""
    uniform = (((spread & MASK64) >> 12) + 0.5) / (1 << 52)
    return -math.log(-math.log(uniform))


def scored(docs: DataFrame, ratios: np.ndarray, how: Resampling) -> DataFrame:
    """(id, key, log_weight, rank) for rows (id, text); rank orders the draws, largest first."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = pa.schema(
        [("id", pa.int64()), ("key", pa.int64()), ("log_weight", pa.float64()), ("rank", pa.int64())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value

        def made() -> Iterator[tuple]:
            for id_, key, text, spread in rows_of(batches, ("id", "key", "text", "spread")):
                if not text:
                    yield id_, key, 0.0, LAST
                    continue
                weight = float(table[buckets_of(text, how)].sum(dtype=np.float64))
                yield id_, key, weight, round((weight + gumbel(spread)) * RANK_SCALE)

        yield from batched(made(), schema)

    key = F.xxhash64("text")
    return docs.select(
        "id", key.alias("key"), "text", F.xxhash64(F.lit(how.seed), "id", key).alias("spread")
    ).mapInArrow(work, "id long, key long, log_weight double, rank long")


def kth_largest(ranks: DataFrame, k: int) -> int | None:
    """The k-th largest of the longs in column `rank`, exactly: 16 bits at a time by counting."""
    low = None
    for shift in (48, 32, 16, 0):
        rows = ranks if low is None else ranks.filter(F.shiftright("rank", shift + 16) == low)
        found = (
            rows.groupBy(F.shiftright("rank", shift).alias("top")).agg(F.count(F.lit(1)).alias("n")).collect()
        )  # at most 65,536 rows
        low = None
        for row in sorted(found, key=lambda r: -r.top):
            if k <= row.n:
                low = row.top
                break
            k -= row.n
        if low is None:
            return None
    return low


def resample(
    docs: DataFrame, labels: DataFrame, how: Resampling = Resampling(), id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, key (a hash of the text), log_weight, rank and kept."""
    source = docs.select(quoted(id_).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    good, share = good_ids(labels, how)
    ranked = saved(scored(source, log_ratios(ngram_counts(source, good, how), how), how), "scores")
    k = round(share * ranked.count())
    cut = kth_largest(ranked.select("rank"), k) if k else None
    return ranked.withColumn("kept", F.lit(False) if cut is None else F.col("rank") >= cut)


def resampled_documents(
    docs: DataFrame, labels: DataFrame, how: Resampling = Resampling(), id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The drawn documents, columns as they came. Rows with equal id and text go together."""
    drawn = resample(docs, labels, how, id_, text).filter("kept").select("id", "key").distinct()
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("row"), quoted(id_).cast("long").alias("i"),
        F.xxhash64(quoted(text).cast("string")).alias("k"),
    )
    return rows.join(drawn, F.expr("i <=> id AND k = key"), "left_semi").select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns)
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "log_weight", "kept")
