"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.session import scratch_dir

MASK64 = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python workers a few megabytes at a time: texts are held several times over there."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back.

    It cuts the lineage: a lost executor costs a read, not the work above.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark, label)}/rows"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(frame: DataFrame) -> list[Column]:
    return [quoted(c) for c in frame.columns]


def words(text: str | None) -> list[bytes]:
    """Words between ASCII blanks (space and 0x09 to 0x0D), as UTF-8; none for a null text.

    bytes.split() knows exactly these blanks; str.split() would split on many more.
    """
    return text.encode().split() if text else []


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20
_powers: list[np.ndarray] = []


def powers_of(count: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < count:
        count = max(1 << 14, 1 << (count - 1).bit_length())
        steps = np.full((2, count), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = _BASE, pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = list(np.cumprod(steps, axis=1, dtype=np.uint64))
    return _powers


def word_codes(text: str | None, fold: bool = True) -> np.ndarray:
    """One 64-bit hash for each word between ASCII blanks; `fold` maps A-Z to a-z first.

    A word's hash is a difference of two running sums of byte times power, so that no word
    becomes a Python object. Long texts go through in blocks that end at a blank.
    """
    return byte_codes(text.encode(), fold) if text else np.empty(0, np.uint64)


def byte_codes(text: bytes, fold: bool = True) -> np.ndarray:
    """word_codes() of a text in UTF-8."""
    data = np.frombuffer(text, np.uint8)
    if fold:
        data = FOLD[data]
    found, start = [np.empty(0, np.uint64)], 0
    while start < len(data):
        stop = start + _BLOCK
        while stop < len(data) and not (gap := BLANK[data[stop : stop + _BLOCK]]).any():
            stop += _BLOCK
        stop = stop + int(gap.argmax()) if stop < len(data) else len(data)
        found.append(_block_codes(data[start:stop]))
        start = stop
    return np.concatenate(found)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    blank = np.ones(len(data) + 2, np.int8)
    blank[1:-1] = BLANK[data]
    edges = np.flatnonzero(np.diff(blank))
    return edges[::2], edges[1::2]


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each range of word codes, whatever stands around it."""
    return _span_hashes(codes, starts, ends) if len(starts) else np.empty(0, np.uint64)


def deletion_hashes(codes: np.ndarray) -> np.ndarray:
    """range_hashes() of the list without each one of its codes."""
    up, down = powers_of(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=sums[1:])
        return mixed(sums[:-1] + (sums[-1] - sums[1:]) * down[1])


def identity(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """Rows (nameless, ident, text): which document a row is.

    That is its id, or a hash of the text where the id is null; null ids come after all others.
    """
    known, body = quoted(id_).cast("long"), quoted(text).cast("string")
    return docs.select(
        known.isNull().cast("int").alias("nameless"),
        F.coalesce(known, F.xxhash64(body)).alias("ident"),
        body.alias("text"),
    )


def named(place: str) -> Column:
    """The id behind a struct with (nameless, ident)."""
    at = F.col(place)
    return F.when(at["nameless"] == 0, at["ident"])


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers_of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])


def _block_codes(data: np.ndarray) -> np.ndarray:
    return _span_hashes(data, *word_spans(data))


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans in order of place, A-Z folded, the same as word_codes() gives."""
    data = FOLD[data]
    found, done = [], 0
    while done < len(starts):
        base = starts[done]
        upto = max(int(np.searchsorted(ends, base + _BLOCK, "right")), done + 1)
        part = slice(done, upto)
        found.append(_span_hashes(data[base : ends[upto - 1]], starts[part] - base, ends[part] - base))
        done = upto
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def word_count(text: Column) -> Column:
    """Number of words between ASCII blanks, 0 for a null text."""
    starts = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++"))
    return F.coalesce(starts, F.lit(0)).cast("long")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection: the splitmix finaliser)."""
    values = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        values ^= values >> np.uint64(30)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(27)
        values *= np.uint64(0x94D049BB133111EB)
        values ^= values >> np.uint64(31)
    return values


def window_hashes(codes: np.ndarray, size: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """One 64-bit hash for each run of `size` codes."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    codes = codes.astype(np.uint64, copy=False)
    total = np.full(count, seed & MASK64, np.uint64)
    with np.errstate(over="ignore"):
        for shift in range(size):
            total = (total ^ codes[shift : shift + count]) * np.uint64(0x9FB21C651E98DF25)
            total ^= total >> np.uint64(29)
    return mixed(total)


def rows_of(batches: Iterable[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    """Python values of the named columns, row by row; only a part of a batch is held as such."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(part.column(name).to_pylist() for name in names), strict=True)


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and serve other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def batched(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, most_bytes: int = 16 << 20
) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows, closed early when their binaries are large.

    `rows` is a generator whose own arrays are gone at its end; then memory is given back.
    """
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (bytes, str, np.ndarray)))
        if len(held) >= size or weight >= most_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)
    del held
    give_back()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
