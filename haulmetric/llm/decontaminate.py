"""Benchmark decontamination by template windows (operator 7).

Every text becomes a template: numbers, units after a number, and names turn into typed
placeholders, other words into their folded letters. Windows of `window` template words are
joined by hash with those of the benchmark, so a question whose numbers or names were replaced
still matches. Aligned windows of one text and one item are then chained into runs; a run counts
when its slots are consistent (one benchmark value always stands for the same text value, and
the other way round) and it covers enough of the item.

A window with few plain words would match any list of numbers, so such a dense window matches
where its words, slot values included, are the same. Next to that, texts that match somewhere
give their dense windows with other values, which only lengthen runs on a diagonal that has a
match: between two such matches a question may be as dense as it likes.

An item that is dense itself, and got new values throughout, has no such match. It is found by an
anchor, its window with the most plain words, and must then stand there as a whole: all its template
words in order, with a one-to-one map of slot values. Its template must say something, by `telling`
different plain words. However many texts fill it with values of their own, all of them are found.

Defined results: null or empty texts and items match nothing; an item shorter than a window is
one window of its own length; of fewer than `shortest` words it must have the same values and
stand alone, as whole sentences or lines; repeated rows are judged alike; an empty benchmark or table finds nothing; columns of the input are carried through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import (
    BLANK,
    batched,
    columns_of,
    fresh,
    quoted,
    read,
    rows_of,
    saved,
    span_codes,
    window_hashes,
    word_spans,
)

NUMBER, UNIT, NAME = 1, 2, 3

# Words that count as units where they follow a number.
UNITS = frozenset(
    "mm cm dm m km in inch inches ft feet foot yd yard yards mi mile miles mg g kg t lb lbs oz "
    "pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min minute "
    "minutes h hour hours day days week weeks month months year years km/h mph m/s hz khz mhz ghz "
    "w kw j kj cal kcal v a pa kpa bar k c f % percent dollar dollars euro euros cent cents "
    "meter meters metre metres gram grams kilogram kilograms kilometer kilometers".split()
)

_NUMERIC = re.compile(rb"[-+$]*[0-9][0-9.,:/]*%?")
_NUMBER_UNIT = re.compile(rb"[-+$]*[0-9][0-9.,]*([A-Za-z/]+)")


def _is(marks: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(marks)] = True
    return found


_EDGE = _is(b"\"'()[]{}.,;:!?")
_END = _is(b".!?")
_DIGIT = _is(b"0123456789")
_UPPER = _is(bytes(range(65, 91)))
_LOWER = _is(bytes(range(97, 123))) | (np.arange(256) >= 0x80)


@dataclass(frozen=True)
class Leaks:
    """window: template words in a window; literal: with fewer plain words it is a dense one.

    A run of matching windows is a leak when it covers `share` percent of the item or `enough`
    words. Up to `broadcast_windows` benchmark windows (8 bytes each) go to every task as a
    sorted array; a larger benchmark is joined by shuffle instead. `common` is for callers who want
    forms left alone: whole templates that stand with more sets of values do not count then.
    """

    window: int = 8
    literal: int = 5
    shortest: int = 5
    share: int = 60
    enough: int = 13
    telling: int = 3
    common: int | None = None
    broadcast_windows: int = 4_000_000


@dataclass
class Template:
    """Codes of a text's words, 0 or the kind of slot they are, and where their letters lie; the
    codes of the words themselves, and which of them open a sentence or line.
    """

    data: bytes
    codes: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    opens: np.ndarray

    def slots(self, start: int, size: int) -> list[str | None]:
        """Slot values of a window, None where there is a plain word."""
        return [
            self.data[self.starts[k] : self.ends[k]].decode(errors="replace") if self.kinds[k] else None
            for k in range(start, start + size)
        ]


def template(text: str | None) -> Template:
    """The template of a text. All words are looked at together; only those with digits, and
    their followers, one by one.

    A capitalised word is a name unless it opens a sentence or line, where any word is.
    """
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(raw)
    if not len(starts):
        none = np.empty(0, np.int64)
        return Template(data, none.astype(np.uint64), none, none, none, none.astype(np.uint64), none.astype(bool))
    before = lambda mask: np.concatenate(([0], np.cumsum(mask[raw])))
    # Letters without the punctuation around them; words of punctuation stay whole.
    core = np.flatnonzero(~(_EDGE | BLANK)[raw])
    first = np.searchsorted(core, starts)
    last = np.searchsorted(core, ends)
    some = last > first
    low, high = starts.copy(), ends.copy()
    low[some], high[some] = core[first[some]], core[last[some] - 1] + 1
    codes = span_codes(raw, low, high)

    lines = before(_is(b"\n"))
    opens = np.ones(len(starts), bool)
    opens[1:] = _END[raw[ends[:-1] - 1]] | (lines[starts[1:]] > lines[starts[:-1]])
    upper = before(_UPPER)
    second = raw[np.minimum(low + 1, len(raw) - 1)]
    kinds = np.zeros(len(starts), np.int64)
    kinds[
        ~opens & _UPPER[raw[low]] & (high - low > 1) & _LOWER[second] & (upper[high] - upper[low] == 1)
    ] = NAME
    digits = before(_DIGIT)
    for k in np.flatnonzero(digits[high] > digits[low]):
        word = data[low[k] : high[k]]
        if _NUMERIC.fullmatch(word):
            kinds[k] = NUMBER
            if k + 1 < len(starts) and data[low[k + 1] : high[k + 1]].lower().decode(errors="replace") in UNITS:
                kinds[k + 1] = UNIT
        elif (found := _NUMBER_UNIT.fullmatch(word)) and found[1].lower().decode() in UNITS:
            kinds[k] = NUMBER
    slot, words = kinds > 0, codes.copy()
    codes[slot] = kinds[slot].astype(np.uint64)
    return Template(data, codes, kinds, low, high, words, opens)


def windows(made_of: Template, size: int, leaks: Leaks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of `size` words: the hash of its template and of its words, and whether it
    is a dense one.
    """
    plain = np.concatenate(([0], np.cumsum(made_of.kinds == 0)))
    dense = (plain[size:] - plain[:-size] < min(leaks.literal, size)) | (size < min(leaks.window, leaks.shortest))
    return window_hashes(made_of.codes, size), window_hashes(made_of.words, size, _SAME), dense


#: Seed of the hashes of words, and the ways in which windows match.
_SAME = 0xC2B2AE3D27D4EB4F
TEMPLATE, VALUES, FILL, ANCHOR = 0, 1, 2, 3

_ITEM = pa.schema(
    [
        ("way", pa.int32()), ("item", pa.int64()), ("hash", pa.int64()), ("item_pos", pa.int32()),
        ("size", pa.int32()), ("item_words", pa.int32()), ("item_slots", pa.list_(pa.string())),
        ("item_codes", pa.list_(pa.int64())),
    ]
)


def _item_windows(benchmark: DataFrame, leaks: Leaks) -> DataFrame:
    """One row per benchmark window and way to match it, with its slot values in place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for item, text in rows_of(batches, ("item", "text")):
                made_of = template(text)
                total = len(made_of.codes)
                size = min(leaks.window, total)
                if not total:
                    continue
                shapes, values, dense = windows(made_of, size, leaks)
                for at in range(len(dense)):
                    ways = ((VALUES, values), (FILL, shapes)) if dense[at] else ((TEMPLATE, shapes),)
                    for way, hashes in ways:
                        h = int(hashes[at].view(np.int64))
                        yield way, item, h, at, size, total, made_of.slots(at, size), None
                plain = made_of.kinds == 0
                if dense.any() and total >= leaks.window and len(np.unique(made_of.codes[plain])) >= leaks.telling:
                    counts = np.convolve(plain, np.ones(size, np.int64), "valid")
                    at = int(counts.argmax())
                    h = int(shapes[at].view(np.int64))
                    yield ANCHOR, item, h, at, size, total, made_of.slots(0, total), made_of.codes.view(np.int64)

        yield from batched(made(), _ITEM)

    return benchmark.mapInArrow(
        work,
        "way int, item long, hash long, item_pos int, size int, item_words int, item_slots array<string>, "
        "item_codes array<long>",
    )


_HIT = pa.schema(
    [("way", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("hash", pa.int64()),
     ("pos", pa.int32()), ("slots", pa.list_(pa.string()))]
)


def _text_windows(
    docs: DataFrame, sizes: list[int], wanted: list[np.ndarray] | None, leaks: Leaks, ways: tuple[int, ...]
) -> DataFrame:
    """Windows of the given sizes, only those whose hash is in `wanted`, by way, where that is
    given; FILL only for texts that have another match then.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def held(way: int, hashes: np.ndarray) -> np.ndarray:
            if known is None:
                return np.ones(len(hashes), bool)
            if not len(known[way]):
                return np.zeros(len(hashes), bool)
            at = np.minimum(np.searchsorted(known[way], hashes), len(known[way]) - 1)
            return known[way][at] == hashes

        def made() -> Iterator[tuple]:
            for row, id_, text in rows_of(batches, ("row", "id", "text")):
                if not sizes:
                    continue
                made_of = template(text)
                stops = np.append(made_of.opens, True)
                found, fill = [], []
                for size in sizes:
                    if size > len(made_of.codes):
                        continue
                    shapes, values, dense = windows(made_of, size, leaks)
                    same = held(VALUES, values)
                    if size < leaks.shortest:
                        same &= made_of.opens[: len(same)] & stops[size:]
                    found.append((TEMPLATE, size, shapes, ~dense & held(TEMPLATE, shapes)))
                    found.append((VALUES, size, values, same))
                    fill.append((FILL, size, shapes, dense))
                    if ANCHOR in ways and size == leaks.window:
                        for k in np.flatnonzero(held(ANCHOR, shapes)):
                            yield ANCHOR, row, id_, int(shapes[k].view(np.int64)), k, None
                if FILL in ways and (known is None or any(keep.any() for *_, keep in found)):
                    found += [(way, size, h, keep & held(FILL, h)) for way, size, h, keep in fill]
                for way, size, hashes, keep in found:
                    for k in np.flatnonzero(keep) if way in ways else ():
                        yield way, row, id_, int(hashes[k].view(np.int64)), k, made_of.slots(k, size)

        yield from batched(made(), _HIT)

    return docs.mapInArrow(
        work, "way int, row long, id long, hash long, pos int, slots array<string>"
    )


def consistent(pairs: list[tuple[str | None, str | None]]) -> bool:
    """Whether slot values map one to one."""
    ahead: dict[str, str] = {}
    back: dict[str, str] = {}
    for item, text in pairs:
        if item is None or text is None:
            if item is not text:
                return False
        elif ahead.setdefault(item, text) != text or back.setdefault(text, item) != item:
            return False
    return True


def _runs(rows: list[tuple]) -> Iterator[tuple[int, int, int, bool]]:
    """Runs of aligned windows (start, words, start in item, same values) of one diagonal.

    A window that breaks the one-to-one map of slot values starts a new run. Runs of nothing but
    dense windows with other values do not count.
    """
    start = end = item_start = 0
    matched = False
    held: list[tuple] = []
    ahead: dict[str, str] = {}
    back: dict[str, str] = {}
    for pos, item_pos, way, slots, item_slots in rows:
        fresh_run = not held or pos > end
        fits = not fresh_run and all(
            i is None or (ahead.get(i, s) == s and back.get(s, i) == i)
            for i, s in zip(item_slots, slots, strict=True)
        )
        if not fits:
            if held and matched:
                yield start, end - start, item_start, all(i == s for i, s in held)
            held, ahead, back, matched = [], {}, {}, False
            if not consistent(list(zip(item_slots, slots, strict=True))):
                continue
            start, item_start = pos, item_pos
        for i, s in zip(item_slots, slots, strict=True):
            if i is not None:
                ahead[i], back[s] = s, i
        held += zip(item_slots, slots, strict=True)
        end = pos + len(slots)
        matched |= way != FILL
    if held and matched:
        yield start, end - start, item_start, all(i == s for i, s in held)


_LEAK = pa.schema(
    [
        ("row", pa.int64()), ("id", pa.int64()), ("item", pa.int64()), ("start", pa.int32()),
        ("n_words", pa.int32()), ("item_start", pa.int32()), ("item_words", pa.int32()),
        ("same_values", pa.bool_()),
    ]
)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, leaks: Leaks, row: str, id_: str, text: str,
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per run: row, id, item, word positions, lengths and whether slot values agree.

    `row` names a column that tells texts apart; rows that share it count as one text.
    """
    items = saved(
        _item_windows(
            benchmark.select(
                quoted(item).cast("long").alias("item"), quoted(item_text).cast("string").alias("text")
            ),
            leaks,
        ),
        "items",
    )
    # At most `window` of them: items shorter than a window have windows of their own size.
    sizes = sorted(r.size for r in items.select("size").distinct().collect())
    distinct = items.select("way", "hash").distinct()
    few = distinct.limit(leaks.broadcast_windows + 1).count() <= leaks.broadcast_windows
    wanted = None
    if few:
        rows = distinct.collect()
        wanted = [
            np.sort(np.array([r.hash for r in rows if r.way == way], np.int64).view(np.uint64))
            for way in (TEMPLATE, VALUES, FILL, ANCHOR)
        ]
    source = docs.select(
        quoted(row).alias("row"), quoted(id_).cast("long").alias("id"),
        quoted(text).cast("string").alias("text"),
    )
    anchors = items.filter(F.col("way") == ANCHOR)
    anchored = not anchors.isEmpty()
    matching = _text_windows(source, sizes, wanted, leaks, (TEMPLATE, VALUES) + (ANCHOR,) * anchored)
    if anchored and few:
        matching = saved(matching, "matching")
    hits = matching.join(items.drop("item_codes"), ["way", "hash"]).filter(F.size("slots") == F.col("size"))
    # Equal values, though one side may open a sentence and so count as no name.
    hits = hits.withColumn("slots", F.when(F.col("way") == VALUES, F.col("item_slots")).otherwise(F.col("slots")))
    columns = ("row", "id", "item", "item_words", "diagonal", "pos", "item_pos", "way", "slots", "item_slots")
    hits = hits.withColumn("diagonal", F.col("pos") - F.col("item_pos")).select(*columns)
    if not items.filter(F.col("way") == FILL).isEmpty():
        # Dense windows only on diagonals with a match: at most one for each place of the item.
        hits = saved(hits, "hits")
        lines = hits.select("row", "item", "diagonal").distinct()
        dense = (
            _text_windows(source, sizes, wanted, leaks, (FILL,))
            .join(lines, "row")
            .withColumn("item_pos", F.col("pos") - F.col("diagonal"))
            .join(items, ["way", "item", "item_pos", "hash"])
            .filter(F.size("slots") == F.col("size"))
        )
        hits = hits.unionByName(dense.select(*columns))
    # One text, one item and one diagonal: bounded by the length of one text.
    diagonal = (
        hits.dropDuplicates(["row", "item", "pos", "item_pos", "way"])
        .repartition("row", "item")
        .sortWithinPartitions("row", "item", "diagonal", "pos", "way")
        .select(*columns)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = columns

        def made() -> Iterator[tuple]:
            key, held = None, []
            for *head, pos, item_pos, way, slots, item_slots in rows_of(batches, names):
                if head != key:
                    yield from told(key, held)
                    key, held = head, []
                held.append((pos, item_pos, way, slots, item_slots))
            yield from told(key, held)

        def told(key: list | None, held: list[tuple]) -> Iterator[tuple]:
            for start, size, item_start, same in _runs(held):
                row_, id__, item_, item_words, _ = key
                if size >= leaks.enough or 100 * size >= leaks.share * item_words:
                    yield row_, id__, item_, start, size, item_start, item_words, same

        yield from batched(made(), _LEAK)

    layout = (
        "row long, id long, item long, start int, n_words int, item_start int, item_words int, "
        "same_values boolean"
    )
    runs = diagonal.mapInArrow(work, layout)
    if not anchored:
        return runs
    dense = _whole_items(source, matching.filter(F.col("way") == ANCHOR), anchors, leaks, layout)
    # A run on the same place, as verbatim copies have, stands for the whole item.
    seen = saved(runs, "runs")
    return seen.unionByName(dense.join(seen.select("row", "item").distinct(), ["row", "item"], "left_anti"))


def _whole_items(source: DataFrame, hits: DataFrame, anchors: DataFrame, leaks: Leaks, layout: str) -> DataFrame:
    """Leaks of items that stand in a text as a whole, with other slot values."""
    asked = (
        hits.select("row", "hash", "pos")
        .join(anchors, "hash")
        .withColumn("start", F.col("pos") - F.col("item_pos"))
        .filter("start >= 0")
        .select("row", "item", "start", "item_words", "item_codes", "item_slots")
        .distinct()
    )
    schema = pa.schema([*_LEAK, ("values", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            last, made_of = None, template(None)
            names = ("row", "id", "text", "item", "start", "item_words", "item_codes", "item_slots")
            for row, id_, text, item, start, total, codes, item_slots in rows_of(batches, names):
                if row != last:
                    last, made_of = row, template(text)
                if not np.array_equal(made_of.codes[start : start + total].view(np.int64), codes):
                    continue
                slots = made_of.slots(start, total)
                pairs = [(i, s) for i, s in zip(item_slots, slots, strict=True) if i is not None]
                if consistent(pairs):
                    same = all(i == s for i, s in pairs)
                    yield row, id_, item, start, total, 0, total, same, "\x00".join(s for _, s in pairs)

        yield from batched(made(), schema)

    found = asked.join(source, "row").mapInArrow(work, f"{layout}, values string")
    if leaks.common is None:
        return found.drop("values")
    found = saved(found, "whole")
    rare = found.groupBy("item").agg(F.count_distinct("values").alias("n")).filter(F.col("n") <= leaks.common)
    return found.join(rare.select("item"), "item", "left_semi").drop("values")


def decontaminated(docs: DataFrame, benchmark: DataFrame, leaks: Leaks = Leaks(), text: str = "text") -> DataFrame:
    """The documents without a leak, columns as they came.

    A document is told by the hash pair of its text, so equal texts share one verdict.
    """
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(quoted(text).cast("string")))
    found = find_leaks(keyed.withColumn(id_ := fresh(keyed, "none"), F.lit(None).cast("long")),
                       benchmark, leaks, key, id_, text)
    bad = saved(found.select(F.col("row").alias(fresh(keyed, "leaking"))).distinct(), "leaks")
    return keyed.join(bad, quoted(key) == quoted(bad.columns[0]), "left_anti").select(*columns_of(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Texts are told apart by what they hold: the same in every scan, however rows are dealt.
    docs = read(spark, sf_dir, "documents").withColumn("row", F.xxhash64("doc_id", "text"))
    return find_leaks(docs, read(spark, sf_dir, "benchmark"), Leaks(), "row", "doc_id", "text").select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "n_words",
        "item_start", "item_words", "same_values",
    )
