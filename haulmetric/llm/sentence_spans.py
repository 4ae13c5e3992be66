"""Substring deduplication by sliding sentence spans (operator 5).

A text is a sequence of sentences; long ones are cut further at words that their own hash
selects, so that the pieces of a passage are the same wherever it stands. From every sentence
a run goes on until it has `sentences` pieces and `words` words. All runs are hashed and grouped
over the whole corpus; the first place of a run stays, and at every other place the sentences
that the run covers are removed. "First" is by document id, then by place in the text.

Runs are compared by 64-bit hashes of their folded words.

Defined results: null or empty texts have no sentences; texts shorter than a run are never
removed; rows that share an id count as one document, so a repeated row is not its own copy;
rows with a null id are told apart by text and come last; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import (
    batched,
    columns_of,
    identity,
    named,
    quoted,
    range_hashes,
    read,
    rows_of,
    saved,
    span_codes,
    word_spans,
)


@dataclass(frozen=True)
class Spans:
    """A run has at least so many sentences and words; longer sentences than `long_words` are cut
    after words whose hash is 0 modulo `cut`."""

    sentences: int = 3
    words: int = 24
    long_words: int = 12
    cut: int = 4


_END = np.zeros(256, bool)
_END[list(b".!?")] = True


@dataclass
class Sentences:
    """Word codes of a text, the word at which each sentence starts (and the end), byte spans."""

    codes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sentences(text: str | None, spans: Spans) -> Sentences:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends = word_spans(raw)
    if not len(starts):
        return Sentences(np.empty(0, np.uint64), np.zeros(1, np.int64), starts, ends)
    codes = span_codes(raw, starts, ends)
    feeds = np.concatenate(([0], np.cumsum(raw == 10)))
    closes = _END[raw[ends - 1]]
    closes[:-1] |= feeds[starts[1:]] > feeds[starts[:-1]]
    closes[-1] = True
    last = np.flatnonzero(closes)
    length = np.diff(last, prepend=-1)
    long = np.repeat(length, length) > spans.long_words
    closes |= long & (codes % np.uint64(spans.cut) == 0)
    return Sentences(codes, np.concatenate(([0], np.flatnonzero(closes) + 1)), starts, ends)


def runs(found: Sentences, spans: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, number of sentences and hash of every run."""
    bounds = found.bounds
    count = len(bounds) - 1
    first = np.arange(count)
    stop = np.maximum(np.searchsorted(bounds, bounds[:-1] + spans.words), first + spans.sentences)
    first = first[stop <= count]
    stop = stop[stop <= count]
    return first, stop - first, range_hashes(found.codes, bounds[first], bounds[stop])


def _runs_of(docs: DataFrame, spans: Spans) -> DataFrame:
    """(nameless, ident, place, hash) of every run; place is sentence << 16 | sentences."""
    schema = pa.schema(
        [("nameless", pa.int32()), ("ident", pa.int64()), ("place", pa.int64()), ("hash", pa.int64())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for nameless, ident, text in rows_of([batch], ("nameless", "ident", "text")):
                first, size, hashes = runs(sentences(text, spans), spans)
                parts.append((nameless, ident, (first << 16) | size, hashes.view(np.int64)))
            counts = [len(p[2]) for p in parts]
            if not sum(counts):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([p[0] for p in parts], np.int32), counts)),
                    pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), counts)),
                    pa.array(np.concatenate([p[2] for p in parts])),
                    pa.array(np.concatenate([p[3] for p in parts])),
                ],
                schema=schema,
            )

    return docs.mapInArrow(work, "nameless int, ident long, place long, hash long")


def repeated_spans(docs: DataFrame, spans: Spans = Spans(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (nameless, ident, first, last, of): sentence ranges to remove and a first place.

    Ranges of one document do not touch each other. `of` is the document that keeps the text of
    the range's first run.
    """
    rows = _runs_of(identity(docs, id_, text), spans)
    at = F.struct("nameless", "ident", "place")
    # Most runs are met once: the minimum is combined map-side, and only keys met twice are left.
    kept = rows.groupBy("hash").agg(F.min(at).alias("kept"), F.max(at).alias("last"))
    kept = saved(kept.filter("kept <> last").select("hash", "kept"), "kept")
    later = rows.join(kept, "hash").filter(at > F.col("kept"))
    covered = (
        later.select(
            "nameless", "ident", F.shiftright("place", 16).alias("first"),
            (F.shiftright("place", 16) + F.col("place").bitwiseAND(0xFFFF) - 1).alias("last"), "kept",
        )
        .distinct()
        .repartition("nameless", "ident")
        .sortWithinPartitions("nameless", "ident", "first", "last", "kept")
    )
    schema = pa.schema(
        [("nameless", pa.int32()), ("ident", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
         ("of_nameless", pa.int32()), ("of_ident", pa.int64())]
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            held = None
            for nameless, ident, first, last, of in rows_of(
                batches, ("nameless", "ident", "first", "last", "kept")
            ):
                if held and held[:2] == (nameless, ident) and first <= held[3] + 1:
                    held = (*held[:3], max(held[3], last), *held[4:])
                    continue
                if held:
                    yield held
                held = (nameless, ident, first, last, of["nameless"], of["ident"])
            if held:
                yield held

        yield from batched(made(), schema)

    merged = covered.mapInArrow(
        merge, "nameless int, ident long, first long, last long, of_nameless int, of_ident long"
    )
    return merged.select(
        "nameless", "ident", "first", "last",
        F.struct(F.col("of_nameless").alias("nameless"), F.col("of_ident").alias("ident")).alias("of"),
    )


def cut_text(text: str | None, gone: list[tuple[int, int]], spans: Spans = Spans()) -> str | None:
    """The text without the sentence ranges, each with the blanks behind it."""
    if not text or not gone:
        return text
    data = text.encode()
    found = sentences(text, spans)
    edges = [*found.starts[found.bounds[:-1]].tolist(), len(data)]
    kept, at = [], 0
    for first, last in sorted(gone):
        kept.append(data[at : edges[first]])
        at = edges[last + 1]
    return b"".join([*kept, data[at:]]).decode()


def without_repeats(docs: DataFrame, spans: Spans = Spans(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated spans cut out of their texts, other columns as they came."""
    gone = saved(repeated_spans(docs, spans, id_, text), "spans").groupBy("nameless", "ident").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("gone")
    )
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("row"),
        quoted(id_).cast("long").isNull().cast("int").alias("nameless"),
        F.coalesce(quoted(id_).cast("long"), F.xxhash64(quoted(text).cast("string"))).alias("ident"),
    )
    cut = F.udf(lambda t, g: cut_text(t, [tuple(x) for x in g] if g else [], spans), "string")
    joined = rows.join(gone, ["nameless", "ident"], "left")
    body = F.col("row")[text].cast("string")
    new = F.when(F.col("gone").isNull(), body).otherwise(cut(body, "gone"))
    return joined.select(
        *(new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(read(spark, sf_dir, "documents"))
    return found.select(
        F.when(F.col("nameless") == 0, F.col("ident")).alias("doc_id"),
        F.col("first").alias("first_sentence"), F.col("last").alias("last_sentence"),
        named("of").alias("of_doc_id"),
    )
