"""Near-duplicate lines by a deletion-neighbourhood join (operator 3).

Two lines are near when one word inserted, deleted or replaced turns one into the other. Every
line emits the hash of itself and of each variant with one word deleted. Lines with equal
variants meet: lines that lost the word at one place differ in that word at most, and a line that
is itself a variant lacks that word. Of all lines that meet the earliest stays; its distance to
each of the others is verified on the words. No pair of lines but (line, earliest) is formed.

Only lines that share their first or second half with another line can be near to any, so the
others emit nothing; equal lines are one line. Lines of fewer than `near_words` words are near
only where each word that differs has at most `short_share` percent of its line's letters; they
emit just the variants without such a word, so all lines that meet are still near. Earliest is by
document id, then by line number.

Defined results: null texts and lines without words are left alone; rows that share an id count
as one document; rows with a null id are told apart by text and come last; an empty table gives
an empty result; columns of the input are carried through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import (
    batched,
    byte_codes,
    columns_of,
    deletion_hashes,
    identity,
    mixed,
    named,
    quoted,
    range_hashes,
    read,
    rows_of,
    saved,
    word_codes,
    word_spans,
)
from haulmetric.llm.ngram_join import bloom, in_bloom


@dataclass(frozen=True)
class Lines:
    """near_words: words of a line of which any one may differ; short_share: the letters that may
    differ in shorter lines, in percent of the line's (0: these are compared for equality only).
    """

    near_words: int = 8
    short_share: int = 0
    bloom_bits: int = 26

    def compared(self, sizes: np.ndarray) -> np.ndarray:
        """Which lines of so many words can be near to another."""
        return (sizes >= self.near_words) | (self.short_share > 0)


#: Lines of every length: of one to four words by letters, of five and more by words.
EVERY_LENGTH = Lines(near_words=5, short_share=25)


def halves(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys (four per line) of which near lines share one; a line is a range of codes.

    With m words in the shorter of two near lines, their first m // 2 words or the last
    m - m // 2 are equal; a line can be the shorter one or the longer. One word is its own first
    and last half.
    """
    keys = []
    for m in (last - first, np.maximum(last - first - 1, 1)):
        for side, start, stop in ((0, first, first + np.maximum(m // 2, 1)), (1, last - (m - m // 2), last)):
            salt = (2 * m + side).astype(np.uint64)
            keys.append(mixed(range_hashes(codes, start, stop) + salt))
    return np.stack(keys, axis=1).view(np.int64)


def variants(codes: np.ndarray) -> np.ndarray:
    """Hashes of the line without each one of its words, and of the whole line at the end."""
    whole = range_hashes(codes, np.array([0]), np.array([len(codes)]))
    return np.concatenate([deletion_hashes(codes), whole])


def one_edit(a: list[int], b: list[int]) -> bool:
    """Whether at most one word must be inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def lines_of(
    text: str | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word codes of a text, and of each line with a word: its number, first and last word; and
    the bytes of each word.
    """
    raw = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends = word_spans(raw)
    codes = word_codes(text, fold=False)
    feeds = np.concatenate(([0], np.cumsum(raw == 10)))
    of_word = feeds[starts]
    first = np.flatnonzero(np.diff(of_word, prepend=-1))
    return codes, of_word[first], first, np.append(first[1:], len(codes)).astype(np.int64), ends - starts


#: Bytes of text whose lines are worked on together, however many texts these are.
_GROUP = 2 << 20


def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with about `_GROUP` bytes of text, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    sums, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        done = sums[start - 1] if start else 0
        stop = max(int(np.searchsorted(sums, done + _GROUP, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


_ROWS = pa.schema(
    [("nameless", pa.int32()), ("ident", pa.int64()), ("line", pa.int32()), ("hash", pa.int64()),
     ("halves", pa.list_(pa.int64()))]
)


def line_rows(part: pa.RecordBatch, lines: Lines) -> Iterator[pa.RecordBatch]:
    """(nameless, ident, line, hash, halves) of the lines with a word, for all texts of a group at
    once: put one below the other, they are one text whose lines are counted from each start."""
    texts = [(t or "").encode() for t in part.column("text").to_pylist()]
    whole = b"\n".join(texts)
    raw = np.frombuffer(whole, np.uint8)
    starts, _ = word_spans(raw)
    codes = byte_codes(whole, fold=False)
    feeds = np.concatenate(([0], np.cumsum(raw == 10)))
    of_word = feeds[starts]
    first = np.flatnonzero(np.diff(of_word, prepend=-1))
    last = np.append(first[1:], len(codes)).astype(np.int64)
    if not len(first):
        return
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    doc = np.searchsorted(begins, starts[first], "right") - 1
    number = of_word[first] - feeds[begins[doc]]
    hashes = range_hashes(codes, first, last).view(np.int64)
    compared = lines.compared(last - first)
    keys = halves(codes, first[compared], last[compared]) if compared.any() else np.empty((0, 4), np.int64)
    # A null offset is a null list.
    offsets = np.append(4 * (np.cumsum(compared) - compared), 4 * compared.sum())
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.append(~compared, False)), pa.array(keys.ravel()))
    columns = [
        part.column("nameless").to_numpy()[doc], part.column("ident").to_numpy()[doc],
        number.astype(np.int32), hashes,
    ]
    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], schema=_ROWS)


def _spot(nameless: Column | str, ident: Column | str, line: Column | str) -> Column:
    """A 64-bit key of one place, for the Bloom filter."""
    return F.xxhash64(nameless, ident, line)


def chosen_texts(batches: Iterator[pa.RecordBatch], bits: np.ndarray, lines: Lines) -> Iterator[tuple]:
    """(nameless, ident, text, likely) of the texts with a line whose place the Bloom filter knows."""
    for batch in batches:
        for part in groups(batch):
            spots = part.column("spots")
            edges = spots.offsets.to_numpy() - spots.offsets[0].as_py()
            likely = in_bloom(spots.flatten().to_numpy(), bits, lines.bloom_bits)
            some = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(likely)))[edges]))
            rows = part.select(["nameless", "ident", "text"]).take(pa.array(some)).to_pylist()
            for k, row in zip(some.tolist(), rows, strict=True):
                yield *row.values(), likely[edges[k] : edges[k + 1]]


def line_duplicates(docs: DataFrame, lines: Lines = Lines(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (nameless, ident, line, of, edits) of the lines to drop.

    `of` is the place (nameless, ident, line, ...) of an earlier line that is the same (edits 0)
    or near (edits 1).
    """
    source = identity(docs, id_, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                yield from line_rows(part, lines)

    rows = saved(
        source.mapInArrow(work, "nameless int, ident long, line int, hash long, halves array<long>"),
        "lines",
    )
    at = F.struct("nameless", "ident", "line")
    distinct = saved(
        rows.groupBy("hash").agg(F.min(at).alias("at"), F.any_value("halves").alias("halves")), "distinct"
    )
    same = (
        rows.select("nameless", "ident", "line", "hash")
        .join(distinct.select("hash", "at"), "hash")
        .filter(at > F.col("at"))
        .select("nameless", "ident", "line", F.col("at").alias("of"), F.lit(0).alias("edits"))
    )
    return same.unionByName(_near(source, distinct, lines)).distinct()


def _near(source: DataFrame, distinct: DataFrame, lines: Lines) -> DataFrame:
    keys = distinct.select("hash", "at", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    suspects = (
        keys.join(shared.filter("low <> high").select("half"), "half")
        .select("hash", "at")
        .distinct()
        .select("hash", "at", _spot(F.col("at.nameless"), F.col("at.ident"), F.col("at.line")).alias("key"))
    )
    suspects = saved(suspects, "suspects")
    shared_bits = source.sparkSession.sparkContext.broadcast(bloom(suspects, lines.bloom_bits))
    schema = pa.schema(
        [("nameless", pa.int32()), ("ident", pa.int64()), ("line", pa.int32()), ("hash", pa.int64()),
         ("codes", pa.list_(pa.int64())), ("small", pa.list_(pa.int32()))]
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared_bits.value

        def made() -> Iterator[tuple]:
            for nameless, ident, body, likely in chosen_texts(batches, bits, lines):
                codes, numbers, first, last, sizes = lines_of(body)
                chosen = likely[numbers] & lines.compared(last - first)
                whole = range_hashes(codes, first, last).view(np.int64)
                for k in np.flatnonzero(chosen):
                    own = codes[first[k] : last[k]].view(np.int64)
                    small = None
                    if last[k] - first[k] < lines.near_words:
                        letters = sizes[first[k] : last[k]]
                        small = np.flatnonzero(100 * letters <= lines.short_share * letters.sum())
                    yield nameless, ident, int(numbers[k]), int(whole[k]), own, small

        yield from batched(made(), schema)

    numbers = F.sequence(F.lit(0), F.size(F.split("text", "\n", -1)) - 1)
    spots = F.transform(numbers, lambda k: _spot(F.col("nameless"), F.col("ident"), k))
    likely = source.filter("text IS NOT NULL").withColumn("spots", spots).mapInArrow(
        emit, "nameless int, ident long, line int, hash long, codes array<long>, small array<int>"
    )
    # The filter lets some other lines through; the join leaves the first place of each suspect.
    first = saved(
        likely.join(suspects.select("hash", "at"), "hash")
        .filter(F.struct("nameless", "ident", "line") == F.col("at"))
        .select("hash", "at", "codes", "small"),
        "first",
    )
    # `small`: which words of a short line may differ; null where any may.
    pair = pa.schema(
        [("hash", pa.int64()), ("small", pa.list_(pa.int32())), ("variants", pa.list_(pa.int64()))]
    )

    def vary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for hash_, codes, small in rows_of(batches, ("hash", "codes", "small")):
                found = variants(np.array(codes, np.int64).view(np.uint64)).view(np.int64)
                yield hash_, small, found if small is None else found[[*small, -1]]

        yield from batched(made(), pair)

    emitted = (
        first.select("hash", "codes", "small")
        .mapInArrow(vary, "hash long, small array<int>, variants array<long>")
        .select("hash", "small", F.posexplode("variants").alias("at", "variant"), F.size("variants").alias("size"))
        .select(
            "hash", "variant",
            F.when(F.col("at") < F.col("size") - 1, F.coalesce(F.get("small", "at"), "at")).otherwise(-1).alias("slot"),
        )
    )
    # The place goes along: (nameless, ident, line, hash) orders lines and names them.
    emitted = emitted.join(first.select("hash", "at"), "hash").select(
        "variant", "slot",
        F.struct(F.col("at.nameless"), F.col("at.ident"), F.col("at.line"), F.col("hash")).alias("place"),
    )
    met = emitted.groupBy("variant").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    emitted = saved(
        emitted.join(met.filter("low <> high").select("variant"), "variant"), "variants"
    )
    by_slot = emitted.groupBy("variant", "slot").agg(F.min("place").alias("earliest"))
    by_side = emitted.groupBy("variant", (F.col("slot") < 0).alias("whole")).agg(F.min("place").alias("other"))
    one_place = emitted.filter("slot >= 0").join(by_slot, ["variant", "slot"])
    across = emitted.withColumn("whole", F.col("slot") >= 0).join(by_side, ["variant", "whole"])
    claims = (
        one_place.select("place", F.col("earliest").alias("of"))
        .unionByName(across.select("place", F.col("other").alias("of")))
        .filter("of < place")
        .distinct()
    )
    words_of = first.select("hash", "codes")
    checked = (
        claims.join(words_of.toDF("h1", "a"), F.col("place.hash") == F.col("h1"))
        .join(words_of.toDF("h2", "b"), F.col("of.hash") == F.col("h2"))
        .select("place", "of", "a", "b")
    )
    verdict = F.arrow_udf(_verify, "boolean")
    return (
        checked.filter(verdict("a", "b"))
        .groupBy("place")
        .agg(F.min("of").alias("of"))
        .select(
            "place.nameless", "place.ident", "place.line",
            F.struct("of.nameless", "of.ident", "of.line").alias("of"), F.lit(1).alias("edits"),
        )
    )


def _verify(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([one_edit(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())


def without_lines(docs: DataFrame, lines: Lines = Lines(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their duplicate lines, other columns as they came."""
    gone = saved(line_duplicates(docs, lines, id_, text), "gone").groupBy("nameless", "ident").agg(
        F.collect_set("line").alias("gone")
    )
    body = quoted(text).cast("string")
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("row"),
        quoted(id_).cast("long").isNull().cast("int").alias("nameless"),
        F.coalesce(quoted(id_).cast("long"), F.xxhash64(body)).alias("ident"),
    )
    kept = F.array_join(
        F.filter(F.split(F.col("row")[text].cast("string"), "\n", -1), lambda _, k: ~F.array_contains("gone", k)),
        "\n",
    )
    new = F.when(F.col("gone").isNull(), F.col("row")[text].cast("string")).otherwise(kept)
    return rows.join(gone, ["nameless", "ident"], "left").select(
        *(new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_duplicates(read(spark, sf_dir, "documents"), EVERY_LENGTH)
    return found.select(
        F.when(F.col("nameless") == 0, F.col("ident")).alias("doc_id"), "line",
        named("of").alias("of_doc_id"), F.col("of")["line"].alias("of_line"), "edits",
    )


def oracle_sql() -> str:
    """DuckDB SQL of op3: every pair of lines with an equal variant. Ids are not null here."""
    lines = EVERY_LENGTH
    return rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, line, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM lines),
d AS (SELECT w, min({{'doc_id': doc_id, 'line': line}}) AS place FROM l WHERE len(w) > 0 GROUP BY w),
sized AS (SELECT *, list_transform(w, lambda x: octet_length(encode(x))) AS letters FROM d),
slots AS (
  SELECT w, place, slot FROM (SELECT *, unnest(range(len(w))) AS slot FROM sized)
  WHERE (len(w) >= {lines.near_words} OR 100 * letters[slot + 1] <= {lines.short_share} * list_sum(letters))
  UNION ALL SELECT w, place, -1 FROM sized),
v AS (
  SELECT place, slot, CASE WHEN slot < 0 THEN w ELSE list_concat(w[1:slot], w[slot + 2:]) END AS variant FROM slots),
near AS (
  SELECT a.place AS place, min(b.place) AS of_place
  FROM v a JOIN v b ON a.variant = b.variant AND b.place < a.place
    AND ((a.slot = b.slot AND a.slot >= 0) OR (a.slot < 0) <> (b.slot < 0))
  GROUP BY a.place)
SELECT doc_id, line::INT AS line, place.doc_id AS of_doc_id, place.line::INT AS of_line, 0 AS edits
FROM l JOIN d USING (w) WHERE {{'doc_id': doc_id, 'line': line}} > place
UNION ALL
SELECT place.doc_id, place.line::INT, of_place.doc_id, of_place.line::INT, 1 FROM near"""
