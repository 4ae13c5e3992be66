"""Vector code compression by product codebooks with equal-average search (operator 11).

Components become whole numbers, floor(scale * x). Vectors are cut into equal parts, and every
part position has a codebook of its own; a vector's code is the index of the nearest entry for
each of its parts. Codebooks start from the vectors of the least ids and are moved to the floored
means of their parts a fixed number of times. All arithmetic is in integers, so codebooks, codes
and errors do not depend on the order of rows or on how they are dealt to tasks.

The nearest entry is found by equal-average search. By Cauchy-Schwarz a part of d components
whose sum is s is at least (s - t)^2 / d away from an entry whose sum is t. Entries are sorted by
their sums; a part starts between its two neighbours by sum and looks outward on both sides, until
the bound on a side strictly exceeds the best distance. Only strictly, since an entry at the same
distance with a lower index must still win.

What is broadcast is the codebooks: `parts` x `entries` rows of whole numbers, whatever the table's
size. A task sends sums and counts of at most so many entries to the next round.

Defined results: vectors that are null, empty, or hold a null or non-finite component are dropped,
and so are those of another length than the kept vector of the least id, which sets the length; it
must be a multiple of `parts`. Components so large that a distance would not fit into a long (beyond 180
million in 64 components) count as that limit. Null ids come after all
others, rows with one id are ordered by their vectors, repeated rows get one row each. Fewer
vectors than entries give smaller codebooks; none give an empty result. A label's error that no
long holds is null. Columns of the input may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import quoted, read, saved

#: Vectors worked on at a time.
BLOCK = 8192


@dataclass(frozen=True)
class Codes:
    """At most 256 entries, so that an index is two hex digits."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def whole(vectors: Column, codes: Codes) -> Column:
    """Components as whole numbers; null where the vector is not to be kept."""
    count = F.size(vectors)
    # (2 * most * width)^2 and count * (2 * most)^2 stay below 2^63.
    most = F.lit(1.5e9) / F.greatest(F.sqrt(count), count / F.lit(codes.parts))

    def one(x: Column) -> Column:
        return F.floor(F.least(F.greatest(x.cast("double") * codes.scale, -most), most))

    def finite(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))

    return F.when((count > 0) & F.forall(vectors, finite), F.transform(vectors, one).cast("array<int>"))


class Book:
    """One part position's entries, sorted by component sum for the search."""

    def __init__(self, entries: np.ndarray) -> None:
        self.order = np.argsort(entries.sum(axis=1), kind="stable")
        self.entries = entries[self.order]
        self.sums = self.entries.sum(axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each row of `parts`."""
        size, (rows, width) = len(self.sums), parts.shape
        sums = parts.sum(axis=1)
        start = np.searchsorted(self.sums, sums)
        best = np.full(rows, np.iinfo(np.int64).max)
        index = np.full(rows, size)
        for step, first in ((-1, start - 1), (1, start)):
            # The first look on the other side already has a best distance to compare with.
            live, at = np.arange(rows), first
            while len(live):
                inside = (at >= 0) & (at < size)
                live, at = live[inside], at[inside]
                gap = sums[live] - self.sums[at]
                # gap^2 / width > best, in whole numbers that cannot overflow.
                near = -(-gap * gap // width) <= best[live]
                live, at = live[near], at[near]
                off = parts[live] - self.entries[at]
                distance = np.einsum("ij,ij->i", off, off)
                name = self.order[at]
                better = (distance < best[live]) | ((distance == best[live]) & (name < index[live]))
                won = live[better]
                best[won], index[won] = distance[better], name[better]
                at = at + step
        return index, best


def matrices(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list, np.ndarray]]:
    """The named columns and the vectors of a few thousand rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            vectors = part.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield [part.column(n) for n in names], flat.reshape(part.num_rows, -1)


def kept_vectors(table: DataFrame, codes: Codes, id_: str, vector: str, label: str) -> DataFrame:
    """Rows (id, label, vector) of the vectors to be coded, in whole numbers."""
    # Written once: every round reads these, and a filter on the spot would compute them twice.
    rows = saved(
        table.select(quoted(id_).alias("id"), quoted(label).alias("label"), whole(quoted(vector), codes).alias("vector")),
        "vectors",
    ).filter("vector IS NOT NULL")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector")).first()
    return rows.filter(F.size("vector") == (first[0] if first else 0))


def first_books(rows: DataFrame, codes: Codes) -> np.ndarray:
    """Entries by (part, entry, position): the parts of the vectors of the least ids."""
    least = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(codes.entries)
    vectors = np.array([r.vector for r in least.collect()], np.int64)
    if not len(vectors):
        return np.empty((codes.parts, 0, 1), np.int64)
    if vectors.shape[1] % codes.parts:
        raise ValueError(f"vectors of {vectors.shape[1]} components cannot be cut into {codes.parts} parts")
    return vectors.reshape(len(vectors), codes.parts, -1).swapaxes(0, 1)


def moved(rows: DataFrame, books: np.ndarray, codes: Codes) -> np.ndarray:
    """The codebooks after one round: each entry used is the floored mean of its parts."""
    parts, entries, width = books.shape
    names = ["part", "entry", "n", *(f"c{k}" for k in range(width))]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Book(b) for b in books]
        sums = np.zeros((parts * entries, width + 1), np.int64)
        for _, vectors in matrices(batches, []):
            for part, book in enumerate(search):
                own = vectors[:, part * width : (part + 1) * width]
                at = book.nearest(own)[0] + part * entries
                sums[:, 0] += np.bincount(at, minlength=len(sums))
                for k in range(width):
                    # A block's sums stay below 2^53, so doubles are exact.
                    sums[:, k + 1] += np.bincount(at, own[:, k], len(sums)).astype(np.int64)
        used = np.flatnonzero(sums[:, 0])
        columns = [used // entries, used % entries, *sums[used].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    sent = rows.select("vector").mapInArrow(work, ", ".join(f"{n} long" for n in names))
    total = [F.sum(n).alias(n) for n in names[2:]]
    after = books.copy()
    # At most `parts` x `entries` rows.
    for part, entry, n, *sums in sent.groupBy("part", "entry").agg(*total).collect():
        after[part, entry] = [s // n for s in sums]
    return after


def trained(rows: DataFrame, codes: Codes = Codes()) -> np.ndarray:
    books = first_books(rows, codes)
    for _ in range(codes.rounds if books.size else 0):
        books = moved(rows, books, codes)
    return books


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Rows (id, label, code, error); a code is a binary of one index per part."""
    width = books.shape[2]
    schema = pa.schema([("code", pa.binary()), ("error", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Book(b) for b in books]
        for carried, vectors in matrices(batches, ["id", "label"]):
            found = [b.nearest(vectors[:, k * width : (k + 1) * width]) for k, b in enumerate(search)]
            indices = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            code = pa.array([row.tobytes() for row in indices], pa.binary())
            error = pa.array(np.sum([e for _, e in found], axis=0), pa.int64())
            yield pa.RecordBatch.from_arrays([*carried, code, error], names=["id", "label", *schema.names])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(work, f"id {kinds['id']}, label {kinds['label']}, code binary, error long")


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """Add `vector`, the whole numbers that a code stands for."""
    table = F.array(*(F.array(*(F.array(*(F.lit(int(x)) for x in e)) for e in b)) for b in books))
    index = lambda k: F.conv(F.hex(F.substring("code", k + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("vector", F.flatten(F.array(*(table[k][index(k)] for k in range(len(books))))))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    table: DataFrame, codes: Codes = Codes(), id_: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, code, error, label_error) and the codebooks."""
    rows = kept_vectors(table, codes, id_, vector, label)
    books = trained(rows, codes)
    found = saved(coded(rows, books), "codes")
    totals = found.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    totals = totals.withColumnRenamed("label", "_label")
    return found.join(totals, F.expr("label <=> _label"), "left").drop("_label"), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes(read(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )


def oracle_sql() -> str:
    """DuckDB SQL of op11: every part against every entry, no search."""
    codes = Codes()
    ctes = [
        f"""k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.scale} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS (
  SELECT vec_id, label, part, v[part * len(v) // {codes.parts} + 1 : (part + 1) * len(v) // {codes.parts}] AS xs
  FROM k, range({codes.parts}) parts(part))""",
        f"""b0 AS (
  SELECT part, entry, xs AS ys
  FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k
               QUALIFY entry < {codes.entries}) USING (vec_id))""",
    ]
    for turn in range(codes.rounds + 1):
        ctes.append(f"""a{turn} AS (
  SELECT vec_id, label, part, xs,
         min(list_sum(list_transform(list_zip(xs, ys), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
             * 1000 + entry)::BIGINT AS won
  FROM p JOIN b{turn} USING (part) GROUP BY ALL)""")
        if turn < codes.rounds:
            ctes.append(f"""b{turn + 1} AS (
  SELECT part, entry, coalesce(m, ys) AS ys
  FROM b{turn} LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS m
    FROM (SELECT part, won % 1000 AS entry, place, CAST(floor(sum(xs[place]) / count(*)) AS BIGINT) AS mean
          FROM a{turn}, range(1, len(xs) + 1) places(place) GROUP BY ALL)
    GROUP BY ALL) USING (part, entry))""")
    last = codes.rounds
    return f"""WITH {", ".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes)},
e AS (SELECT vec_id, label, string_agg(printf('%02x', won % 1000), '' ORDER BY part) AS code,
             sum(won // 1000)::BIGINT AS error FROM a{last} GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(ys, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM e, h"""
