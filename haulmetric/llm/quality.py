"""Quality rules with adaptive thresholds (operator 1).

Fixed rules reject the obvious. Everything else is judged against the documents of the same
language and source: each metric is summarised by a mergeable quantile sketch, and a document
goes when a metric lies beyond its group's fences (quartile +- `reach` interquartile ranges).

The sketch is a log-linear histogram: a value's bucket keeps its leading `SKETCH_BITS` bits, so
a quantile is exact in rank and at most 1/32 low in value. Merging two sketches adds counts, so
building one is a plain grouped count with map-side combine, and a group with too few documents
falls back on the merged sketch of its language, then of everything.

Defined results: a null text has no words and fails the fixed rules; null languages and sources
are groups of their own; repeated rows are judged alike; an empty table gives an empty result;
columns of the input are carried through whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from haulmetric.llm.common import columns_of, fresh, quoted, read, saved, words

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SKETCH_BITS = 6

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*BASE, "n_lines", "n_capitals", "n_shouts")
_STRUCT = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]+")


@dataclass(frozen=True)
class Metric:
    """A document metric in whole units; a spread under `least` counts as `least`."""

    name: str
    least: int
    lower: bool = False


METRICS = (
    Metric("symbol_share", 100),
    Metric("dup_line_share", 1500),
    Metric("repeat_share", 900),
    Metric("capital_share", 250),
    Metric("shout_share", 250),
    Metric("word_length", 60, lower=True),
)


@dataclass(frozen=True)
class Rules:
    """reach: interquartile ranges beyond a quartile; min_docs: smallest group judged alone."""

    reach: int = 3
    min_docs: int = 200


def repeat_words(tokens: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of `size` words that occur twice or more in the list."""
    if len(tokens) <= size:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(t, len(ids)) for t in tokens), np.int64, len(tokens))
    if len(ids) == len(tokens):
        return 0
    # Ranks instead of hashes: doubling the window keeps the comparison exact.
    span = 1
    while span < size:
        step = min(span, size - span)
        pairs = codes[: len(codes) - step] * np.int64(len(tokens) + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1]
        span += step
    often = np.bincount(codes)[codes] > 1
    edges = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(often), 1)
    np.add.at(edges, np.flatnonzero(often) + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES for one text."""
    if not text:
        return (0,) * len(MEASURES)
    tokens = words(text)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return (
        len(tokens),
        len(text) - blanks,
        sum(map(text.count, "#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeat_words(tokens),
        len(lines),
        len(text) - len(_CAPITALS.sub("", text)),
        text.count("!"),
    )


def _measured(texts: pa.Array) -> pa.Array:
    found = np.empty((len(texts), len(MEASURES)), np.int64)
    # A few texts at a time as Python objects.
    for start in range(0, len(texts), 256):
        for k, text in enumerate(texts.slice(start, 256).to_pylist(), start):
            found[k] = measures(text)
    return pa.StructArray.from_arrays([pa.array(column) for column in found.T], names=list(MEASURES))


def measure(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """Add the struct column `into` with the MEASURES of each text."""
    # Not deterministic in name only: the optimiser then never runs the function twice.
    measured = F.arrow_udf(_measured, _STRUCT).asNondeterministic()
    return docs.withColumn(into, measured(quoted(text).cast("string")))


def _share(part: Column, whole: Column, scale: int) -> Column:
    return F.when(whole > 0, F.expr("0L") + F.floor(part * scale / whole)).otherwise(0).cast("long")


def metric_values(m: str) -> dict[str, Column]:
    """Metrics per 10,000, and word length in hundredths, from the measures in column `m`."""
    at = lambda name: quoted(m)[name]
    return {
        "symbol_share": _share(at("n_symbols"), at("word_chars"), 10_000),
        "dup_line_share": _share(at("n_dup_lines"), at("n_lines"), 10_000),
        "repeat_share": _share(at("n_repeat_words"), at("n_words"), 10_000),
        "capital_share": _share(at("n_capitals"), at("word_chars"), 10_000),
        "shout_share": _share(at("n_shouts"), at("word_chars"), 10_000),
        "word_length": _share(at("word_chars"), at("n_words"), 100),
    }


def base_failed(m: str) -> Column:
    n, repeated = quoted(m)["n_words"], quoted(m)["n_repeat_words"]
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def bucket(value: Column) -> Column:
    """Smallest value with the same leading SKETCH_BITS bits."""
    extra = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, extra), extra)


def sketch(measured: DataFrame, m: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts by (lang, source, metric, bucket) of the documents that pass the fixed rules.

    Sketches of parts of the data merge by adding `n`.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), bucket(value).alias("bucket"))
            for name, value in metric_values(m).items()
        )
    )
    return (
        measured.filter(~base_failed(m))
        .select(
            quoted(lang).cast("string").alias("lang"),
            quoted(source).cast("string").alias("source"),
            F.inline(pairs),
        )
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper quartile and number of documents by keys and metric, pivoted wide."""
    over = W.partitionBy(*keys, "metric")
    ranked = counts.withColumn(
        "upto", F.sum("n").over(over.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    ).withColumn("total", F.sum("n").over(over))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    found = ranked.groupBy(*keys, "metric").agg(
        F.struct(at(1).alias("q1"), at(3).alias("q3")).alias("quartiles"),
        F.max("total").alias("docs"),
    )
    return found.groupBy(*keys).agg(
        F.max("docs").alias("docs"),
        *(F.max(F.when(F.col("metric") == m.name, F.col("quartiles"))).alias(m.name) for m in METRICS),
    )


def _pair(whole: Row, metric: Metric) -> dict[str, int | None]:
    found = whole[metric.name]
    return found.asDict() if found else {"q1": None, "q3": None}


def thresholds(sketched: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of fences per (lang, source), named <metric>_hi and <metric>_lo."""
    own = _quartiles(sketched, ["lang", "source"])
    by_lang = _quartiles(
        sketched.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n")), ["lang"]
    )
    # One row: the quartiles of everything.
    whole = _quartiles(sketched.groupBy("metric", "bucket").agg(F.sum("n").alias("n")), []).first()
    joined = own.alias("a").join(by_lang.alias("b"), F.expr("a.lang <=> b.lang"), "left")
    fences = []
    for m in METRICS:
        chosen = (
            F.when(F.col("a.docs") >= rules.min_docs, F.col(f"a.{m.name}"))
            .when(F.col("b.docs") >= rules.min_docs, F.col(f"b.{m.name}"))
            .otherwise(F.struct(*(F.lit(v).cast("long").alias(k) for k, v in _pair(whole, m).items())))
        )
        room = rules.reach * F.greatest(chosen["q3"] - chosen["q1"], F.lit(m.least))
        fences.append((chosen["q3"] + room).alias(f"{m.name}_hi"))
        if m.lower:
            fences.append((chosen["q1"] - room).alias(f"{m.name}_lo"))
    return joined.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), *fences)


def judge(
    measured: DataFrame,
    m: str,
    fences: DataFrame,
    into: str,
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Add boolean `into`: passes the fixed rules and lies within the fences of its group.

    The join leaves its strategy to Spark: fences that are small by measured size are
    broadcast, others are joined by shuffle, where adaptive execution splits a hot source.
    """
    row = fresh(measured, "fence")
    side = fences.select(
        F.col("lang").alias(f"{row}_lang"),
        F.col("source").alias(f"{row}_source"),
        F.struct(*(c for c in fences.columns if c not in ("lang", "source"))).alias(row),
    )
    matched = quoted(lang).cast("string").eqNullSafe(F.col(f"{row}_lang")) & quoted(source).cast(
        "string"
    ).eqNullSafe(F.col(f"{row}_source"))
    inside = ~base_failed(m)
    for metric, value in metric_values(m).items():
        kind = next(x for x in METRICS if x.name == metric)
        inside &= F.coalesce(value <= F.col(row)[f"{metric}_hi"], F.lit(True))
        if kind.lower:
            inside &= F.coalesce(value >= F.col(row)[f"{metric}_lo"], F.lit(True))
    return (
        measured.join(side, matched, "left")
        .withColumn(into, inside)
        .select(*columns_of(measured), quoted(into))
    )


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns as they came.

    Texts are measured twice, once for the sketch and once for the verdict: a scan costs less
    than writing all texts out with their measures.
    """
    m = fresh(docs, "measures")
    kept = fresh(docs, "kept")
    fences = saved(thresholds(sketch(measure(docs, m), m), rules), "fences")
    return judge(measure(docs, m), m, fences, kept).filter(quoted(kept)).select(*columns_of(docs))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    measured = saved(measure(docs, "m").select("doc_id", "lang", "source", "m"), "measures")
    fences = saved(thresholds(sketch(measured, "m")), "fences")
    return judge(measured, "m", fences, "kept").select(
        "doc_id",
        *(F.col("m")[name].alias(name) for name in BASE),
        base_failed("m").alias("base_failed"),
        "kept",
    )


def _quartile_sql(name: str, keys: str) -> str:
    over = f"PARTITION BY {keys}, metric"
    return f"""{name} AS (
  SELECT {keys}, metric, max(total) AS docs,
         min(bucket) FILTER (WHERE upto * 4 >= total) AS q1,
         min(bucket) FILTER (WHERE upto * 4 >= total * 3) AS q3
  FROM (SELECT *, sum(n) OVER ({over} ORDER BY bucket) AS upto, sum(n) OVER ({over}) AS total
        FROM (SELECT {keys}, metric, bucket, sum(n) AS n FROM sk GROUP BY ALL)) GROUP BY ALL)"""


def oracle_sql(documents: str = "documents", verdict: str | None = None) -> str:
    """DuckDB SQL of op1; `verdict` is the final SELECT over `judged`, if another is wanted."""
    rules = Rules()
    blank = r"[^\x20\x09-\x0D]+"
    size = WINDOW_WORDS
    least = " ".join(f"WHEN '{m.name}' THEN {m.least}" for m in METRICS)
    lower = ", ".join(f"'{m.name}'" for m in METRICS if m.lower)
    verdict = verdict or (
        "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        "kept FROM judged"
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '{blank}') AS w FROM {documents}),
wd AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
win AS (
  SELECT rid, pos, string_agg(word, ' ') OVER (
           PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS gram,
         count(*) OVER (PARTITION BY rid ORDER BY pos
           ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS width FROM wd),
often AS (
  SELECT rid, pos FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS times
                        FROM win WHERE width = {size}) WHERE times > 1),
rep AS (
  SELECT rid, count(DISTINCT pos + k) AS n_repeat_words
  FROM often, range({size}) r(k) GROUP BY rid),
ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT d.*, len(w)::BIGINT AS n_words,
         length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines,
         length(regexp_replace(body, '[^A-ZÀ-ÖØ-Þ]+', '', 'g'))::BIGINT AS n_capitals,
         length(regexp_replace(body, '[^!]+', '', 'g'))::BIGINT AS n_shouts
  FROM d LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
             AS base_failed FROM m),
v AS (
  SELECT rid, lang, source, base_failed, unnest([
    {{'metric': 'symbol_share', 'value': n_symbols * 10000 // greatest(word_chars, 1)}},
    {{'metric': 'dup_line_share', 'value': n_dup_lines * 10000 // greatest(n_lines, 1)}},
    {{'metric': 'repeat_share', 'value': n_repeat_words * 10000 // greatest(n_words, 1)}},
    {{'metric': 'capital_share', 'value': n_capitals * 10000 // greatest(word_chars, 1)}},
    {{'metric': 'shout_share', 'value': n_shouts * 10000 // greatest(word_chars, 1)}},
    {{'metric': 'word_length', 'value': word_chars * 100 // greatest(n_words, 1)}}],
    recursive := true) FROM b),
sk AS (
  SELECT lang, source, 1 AS one, metric, count(*) AS n,
         (value >> greatest(length(bin(value)) - {SKETCH_BITS}, 0))
           << greatest(length(bin(value)) - {SKETCH_BITS}, 0) AS bucket
  FROM v WHERE NOT base_failed GROUP BY ALL),
{_quartile_sql("qa", "lang, source")},
{_quartile_sql("qb", "lang")},
{_quartile_sql("qc", "one")},
q AS (
  SELECT a.lang, a.source, a.metric,
         CASE WHEN a.docs >= {rules.min_docs} THEN a.q1 WHEN b.docs >= {rules.min_docs} THEN b.q1
              ELSE c.q1 END AS q1,
         CASE WHEN a.docs >= {rules.min_docs} THEN a.q3 WHEN b.docs >= {rules.min_docs} THEN b.q3
              ELSE c.q3 END AS q3,
         CASE a.metric {least} END AS least
  FROM qa a JOIN qb b ON a.lang IS NOT DISTINCT FROM b.lang AND a.metric = b.metric
            JOIN qc c ON a.metric = c.metric),
bad AS (
  SELECT DISTINCT rid FROM v JOIN q ON v.lang IS NOT DISTINCT FROM q.lang
         AND v.source IS NOT DISTINCT FROM q.source AND v.metric = q.metric
  WHERE value > q3 + {rules.reach} * greatest(q3 - q1, least)
     OR v.metric IN ({lower}) AND value < q1 - {rules.reach} * greatest(q3 - q1, least)),
judged AS (
  SELECT b.*, NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM b)
{verdict}"""
