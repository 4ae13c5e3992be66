"""Token-ID files with directly addressable codes (operator 9).

Ids are cut into chunks from their low bits up. Level 0 holds the first chunk of every id,
level 1 the second chunk of the ids that have one, and so on. A bitmap per level says which ids
continue, and a directory of running counts turns a position in one level into a position in the
next, so any id is read from a few bytes per level without decoding its neighbours. The chunk
widths of a file are those that make it smallest.

A file is one shard of consecutive documents in ascending id order, written by Spark's own
writers and commit protocol. Layout, little-endian: `MAGIC`, header length, JSON header, then
the arrays it lists: document ids, null flags, document ends, and per level chunks, bitmap and
directory. Bytes after the last array are padding.

Defined results: a null text is an empty one and has the end id only; null ids come first; ties
are ordered by text; repeated rows are all written; an empty table writes no shard.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from haulmetric.llm.common import batched, quoted, read, rows_of, saved
from haulmetric.session import scratch_dir, session_conf

MAGIC = b"DACTOK1\n"
#: Ids between two entries of a directory.
RANK_STEP = 512
_BATCH = 1 << 20


@dataclass(frozen=True)
class Files:
    """end: id after each document; shard_tokens: ids in a file; cached: pieces remembered by a task."""

    tokenizer: str
    end: int = 2
    shard_tokens: int = 4_000_000
    cached: int = 300_000


def default_files() -> Files:
    import public_tokenizers

    return Files(public_tokenizers.path("byte_bpe_50k.json"))


# --- directly addressable codes ---------------------------------------------------------


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of the smallest code: dynamic programming over the histogram of bit lengths."""
    lengths = np.bincount(bit_lengths(ids), minlength=2)
    top = len(lengths) - 1
    longer = [int(lengths[k + 1 :].sum()) for k in range(top + 1)]  # ids of over k bits
    longer[0] = len(ids)
    cost: list[float] = [0.0] * (top + 1)
    step = [0] * (top + 1)
    for low in range(top - 1, -1, -1):
        # A level with bits low .. low + width: its chunks, and a bitmap unless it is the last.
        options = [
            (longer[low] * (width + (low + width < top)) + cost[low + width], width)
            for width in range(1, top - low + 1)
        ]
        cost[low], step[low] = min(options)
    widths, low = [], 0
    while low < top:
        widths.append(step[low])
        low += step[low]
    return widths or [1]


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    return np.frexp(ids.astype(np.float64))[1].clip(1)


def _eights(width: int) -> Iterator[tuple[int, int, int]]:
    """Of eight values of `width` bits in `width` bytes: (value, byte, shift of the value there)."""
    for k in range(8):
        for byte in range(k * width // 8, ((k + 1) * width + 7) // 8):
            yield k, byte, 8 * byte - k * width


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of `width` bits, one after the other, low bits first."""
    found = []
    for start in range(0, len(values), _BATCH):  # a multiple of 8 values, so whole bytes
        part = values[start : start + _BATCH].astype(np.uint32)
        rows = np.zeros((-(-len(part) // 8), 8), np.uint32)
        rows.ravel()[: len(part)] = part
        out = np.zeros((len(rows), width), np.uint8)
        for k, byte, shift in _eights(width):
            own = rows[:, k] >> np.uint32(shift) if shift > 0 else rows[:, k] << np.uint32(-shift)
            out[:, byte] |= own.astype(np.uint8)
        found.append(out.tobytes()[: -(-len(part) * width // 8)])
    return b"".join(found)


def unpack(data: memoryview, width: int, count: int) -> np.ndarray:
    found = np.empty(count, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, count, _BATCH):
        size = min(_BATCH, count - start)
        part = raw[start * width // 8 : -(-(start + size) * width // 8)]
        rows = np.zeros((-(-size // 8), width), np.uint8)
        rows.ravel()[: len(part)] = part
        columns = np.ascontiguousarray(rows.T).astype(np.uint32)
        out = np.zeros((len(rows), 8), np.uint32)
        for k, byte, shift in _eights(width):
            out[:, k] |= columns[byte] << np.uint32(shift) if shift > 0 else columns[byte] >> np.uint32(-shift)
        found[start : start + size] = out.ravel()[:size]
    found &= np.uint32((1 << width) - 1)
    return found


def encode(ids: np.ndarray) -> tuple[list[dict], list[bytes]]:
    """Level descriptions and their arrays: chunks, bitmap and directory of each level."""
    levels, arrays = [], []
    rest = ids.astype(np.uint32)
    for k, width in enumerate(widths := best_widths(ids)):
        last = k == len(widths) - 1
        more = rest >> np.uint32(width) > 0
        levels.append({"width": width, "count": len(rest), "last": last})
        arrays.append(pack(rest & np.uint32((1 << width) - 1), width))
        if not last:
            arrays.append(np.packbits(more, bitorder="little").tobytes())
            blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP), dtype=np.uint32)
            arrays.append(np.concatenate(([0], np.cumsum(blocks)[:-1])).astype("<u4").tobytes())
        rest = rest[more] >> np.uint32(width)
    return levels, arrays


class Shard:
    """A token file in memory or memory-mapped: whole decoding and access to single ids."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        if bytes(self.data[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token file")
        start = len(MAGIC) + 4
        size = int.from_bytes(self.data[len(MAGIC) : start], "little")
        self.header = json.loads(bytes(self.data[start : start + size]))
        start += size
        parts = []
        for length in self.header["arrays"]:
            parts.append(self.data[start : start + length])
            start += length
        if start > len(self.data):
            raise ValueError("token file is cut short")
        self.doc_ids = np.frombuffer(parts[0], "<i8")
        self.no_id = np.frombuffer(parts[1], np.uint8).astype(bool)
        self.ends = np.frombuffer(parts[2], "<i8")
        self.levels = []
        rest = iter(parts[3:])
        for level in self.header["levels"]:
            chunks = next(rest)
            self.levels.append((level, chunks, *((None, None) if level["last"] else (next(rest), next(rest)))))

    def __len__(self) -> int:
        return self.header["levels"][0]["count"] if self.header["levels"] else 0

    def __getitem__(self, at: int) -> int:
        """The id at a position, from at most a few bytes and one directory step per level."""
        if not 0 <= at < len(self):
            raise IndexError(at)
        value = shift = 0
        for level, chunks, bitmap, ranks in self.levels:
            width = level["width"]
            low, high = at * width // 8, -(-(at + 1) * width // 8)
            bits = int.from_bytes(chunks[low:high], "little") >> (at * width % 8)
            value |= (bits & ((1 << width) - 1)) << shift
            shift += width
            if level["last"] or not bitmap[at // 8] >> (at % 8) & 1:
                break
            at = self._rank(bitmap, ranks, at)
        return value

    @staticmethod
    def _rank(bitmap: memoryview, ranks: memoryview, at: int) -> int:
        """How many ids before `at` continue."""
        block = at // RANK_STEP
        before = int.from_bytes(ranks[4 * block : 4 * block + 4], "little")
        low = block * RANK_STEP // 8
        bits = int.from_bytes(bitmap[low : at // 8 + 1], "little")
        return before + (bits & ((1 << (at - low * 8)) - 1)).bit_count()

    def ids(self) -> np.ndarray:
        """All ids."""
        places, shift = None, 0
        found = np.zeros(len(self), np.uint32)
        for level, chunks, bitmap, _ in self.levels:
            values = unpack(chunks, level["width"], level["count"]) << np.uint32(shift)
            if places is None:
                places = np.arange(len(found))
            found[places] |= values
            shift += level["width"]
            if not level["last"]:
                more = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little", count=len(places))
                places = places[more.astype(bool)]
        return found


def shard_bytes(part: int, seq: int, doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs)
    levels, arrays = encode(ids)
    arrays = [
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.cumsum([len(d) for d in docs]).astype("<i8").tobytes(),
        *arrays,
    ]
    header = json.dumps(
        {"part": part, "seq": seq, "levels": levels, "arrays": [len(a) for a in arrays]}
    ).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *arrays])


# --- tokenizing -------------------------------------------------------------------------


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(size, array.dtype)])


#: Pieces encoded in one call: the library's records of a call are many times its text.
_LEARN = 8192
#: Bytes of text and number of documents worked on at a time.
_BLOCK_BYTES, _BLOCK_DOCS = 8 << 20, 8192
#: Bytes of ASCII letters and digits, and of the marks that end a word.
LETTERS, MARKS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")] = True
MARKS[list(b".,")] = True


#: Byte-level tokenizers write bytes as letters, those that are printable in Latin-1
#: as themselves and the others, in order, as the letters from U+0100 on.
_KEPT = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _KEPT]
_LETTER = {b: chr(b) for b in _KEPT} | {b: chr(0x100 + k) for k, b in enumerate(_OTHERS)}
#: Letters before this one are letters in every version of Unicode.
LATIN_END = "\u0250"
BYTE_LETTERS = {k: "".join(_LETTER[b] for b in chr(k).encode()) for k in range(ord(LATIN_END))}


class Pieces:
    """Ids of texts by way of the ids of their pieces.

    Byte-level pre-tokens never reach over the border before a single space or around a single
    line feed, so a text's ids are those of the pieces that start there. A block of texts is cut and
    its distinct pieces are found by Arrow, without an object for each word; only pieces that are
    not known yet are encoded. Of too many pieces, those unused for longest are forgotten. Texts
    with other blanks, runs of blanks or the text of an added token are encoded whole.
    """

    def __init__(self, files: Files):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(files.tokenizer)
        self.most = files.cached
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # A space before a word is the first letter of the word's first token.
        self.spaces = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaces[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.feeds = np.zeros(len(self.spaces), bool)
        self.feeds[vocabulary["\u010a"]] = True
        # Pieces by number, in the order in which they were learnt.
        self.numbers: dict[str, int] = {}
        self.weight = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.last_use = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.turn = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self._safe(t) for t in texts]
        found: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        known = [k for k, ok in enumerate(plain) if ok]
        if known:
            for k, ids in zip(known, self._plain(pa.array([texts[k] for k in known], pa.large_string())), strict=True):
                found[k] = ids
        whole = [k for k, ok in enumerate(plain) if not ok and texts[k]]
        for k, ids in zip(whole, self._batch([texts[k] for k in whole]), strict=True):
            found[k] = np.array(ids, np.uint32)
        return found

    def _plain(self, texts: pa.LargeStringArray) -> list[np.ndarray]:
        edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
        data = np.frombuffer(texts.buffers()[2], np.uint8, int(edges[-1]))
        opens = (data == 0x20) | (data == 0x0A)
        # A full stop or comma never joins the letter or digit before it.
        opens[1:] |= MARKS[data[1:]] & LETTERS[data[:-1]]
        opens[edges[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = pa.py_buffer(np.append(starts, len(data)))
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, ends, texts.buffers()[2]])
        coded = pieces.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.sizes[numbers]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[numbers] - stops + sizes, sizes) + np.arange(stops[-1])]
        return np.split(ids, stops[np.searchsorted(starts, edges[1:-1]) - 1])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct pieces, new ones included."""
        if len(self.numbers) > self.most or self.weight > 64 * self.most:
            self._forget()
        numbers = self.numbers
        fresh = [p for p in pieces if p not in numbers]
        if fresh:
            self._learn(fresh)
        found = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))
        self.turn += 1
        self.last_use[found] = self.turn
        return found

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces. One that is letters, behind a space or not, is one pre-token and goes
        to the model as it is; the others, at the start of a line or not, are encoded."""
        tokens = self.tokenizer.model.tokenize
        plain = [p[p[0] == " " :].isalpha() and max(p) < LATIN_END for p in pieces]
        coded = [
            [t.id for t in tokens(p.translate(BYTE_LETTERS))] if ok else None for p, ok in zip(pieces, plain, strict=True)
        ]
        for first, opens, skip in ((" ", self.spaces, 0), ("\n", self.feeds, 0), ("", self.feeds, 1)):
            # Pieces without a blank stand behind a line feed of their own.
            own = [k for k, ok in enumerate(plain) if not ok and (pieces[k][0] if pieces[k][0] in " \n" else "") == first]
            for start in range(0, len(own), _LEARN):
                part = own[start : start + _LEARN]
                text = "".join("\n" * skip + pieces[k] for k in part)
                ids = np.array(self._batch([text])[0])
                starts = np.flatnonzero(opens[ids])
                if len(starts) != len(part):
                    raise AssertionError("pieces and ids do not line up")
                ids, starts = ids.tolist(), [*starts.tolist(), len(ids)]
                for k, low, high in zip(part, starts, starts[1:]):
                    coded[k] = ids[low + skip : high]
        first = len(self.numbers)
        last = first + len(pieces)
        self.numbers.update(zip(pieces, range(first, last)))
        self.weight += sum(map(len, pieces))
        self.starts, self.sizes, self.last_use = (_grown(a, last) for a in (self.starts, self.sizes, self.last_use))
        sizes = self.sizes[first:last] = np.fromiter(map(len, coded), np.int64, len(coded))
        self.starts[first:last] = self.used + np.cumsum(sizes) - sizes
        total = self.used + int(sizes.sum())
        self.flat = _grown(self.flat, total)
        self.flat[self.used : total] = np.fromiter(chain.from_iterable(coded), np.uint32, total - self.used)
        self.used = total

    def _forget(self) -> None:
        """Keep the half of the pieces used last."""
        count = len(self.numbers)
        recent = self.last_use[:count] > np.median(self.last_use[:count])
        keep = np.flatnonzero(recent)
        pieces = list(self.numbers)
        pieces = [pieces[k] for k in keep]
        self.numbers = dict(zip(pieces, range(len(pieces))))
        self.weight = sum(map(len, pieces))
        starts, sizes = self.starts[keep], self.sizes[keep]
        stops = np.cumsum(sizes)
        self.used = int(stops[-1]) if len(stops) else 0
        self.flat = self.flat[np.repeat(starts - stops + sizes, sizes) + np.arange(self.used)]
        self.starts, self.sizes, self.last_use = stops - sizes, sizes, self.last_use[keep]

    def _safe(self, text: str) -> bool:
        """Whether all blanks are single spaces and line feeds between words."""
        even = " ".join(text.split()) == text.replace("\n", " ")
        return bool(text) and even and not any(a in text for a in self.added)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


# --- Spark jobs -------------------------------------------------------------------------

#: A task learns its pieces anew, so fewer and larger tasks learn fewer in all.
LARGE_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "192m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about `_BLOCK_BYTES` of text."""
    texts = batch.column("text")
    sums = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(sums[start - 1]) if start else 0
        stop = int(np.searchsorted(sums, done + _BLOCK_BYTES, "right"))
        stop = min(max(stop, start + 1), start + _BLOCK_DOCS, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def write_token_files(docs: DataFrame, path: str, files: Files, id_: str = "doc_id", text: str = "text") -> None:
    """Encode all documents in ascending id order into token files below `path`."""
    ordered = (
        docs.select(
            quoted(id_).cast("long").alias("id"),
            F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .withColumn("part", F.spark_partition_id())
    )
    fields = pa.schema([("data", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pieces = Pieces(files)
        end = np.array([files.end], np.uint32)

        def made() -> Iterator[tuple]:
            ids, docs_, total, seq, part = [], [], 0, 0, 0
            for batch in batches:
                for block in blocks(batch):
                    part = block.column("part")[0].as_py()
                    coded = pieces.encode(block.column("text").to_pylist())
                    for id__, own in zip(block.column("id").to_pylist(), coded, strict=True):
                        ids.append(id__)
                        docs_.append(np.concatenate([own, end]))
                        total += len(own) + 1
                        if total >= files.shard_tokens:
                            yield (shard_bytes(part, seq, ids, docs_),)
                            ids, docs_, total, seq = [], [], 0, seq + 1
            if ids:
                yield (shard_bytes(part, seq, ids, docs_),)

        yield from batched(made(), fields, size=1)

    # The text writer copies bytes as they are; one row per file, and a line end as padding.
    shards = ordered.mapInArrow(work, "data binary").select(F.col("data").cast("string").alias("value"))
    with session_conf(docs.sparkSession, LARGE_TASKS):
        shards.write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and its shard and place there."""
    fields = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()),
         ("shard_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (content,) in rows_of(batches, ("content",)):
                if not content:
                    continue
                shard = Shard(content)
                ids = shard.ids().astype("<u4")
                start = 0
                for place, end in enumerate(shard.ends.tolist()):
                    yield (
                        shard.header["part"], shard.header["seq"], place,
                        None if shard.no_id[place] else int(shard.doc_ids[place]),
                        start, end - start, zlib.crc32(ids[start:end].tobytes()),
                    )
                    start = end

        yield from batched(made(), fields)

    schema = "path string, modificationTime timestamp, length long, content binary"
    contents = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema(schema).load(path)
    rows = contents.select("content").mapInArrow(
        work,
        "part int, seq int, place long, doc_id long, shard_start long, n_tokens long, ids_crc32 long",
    )
    return rows


def with_starts(rows: DataFrame) -> DataFrame:
    """Replace shard_start by `start`, counted from the first document of all.

    Only one row per shard goes through the running sum.
    """
    shards = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("total"))
    order = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    before = shards.select(
        F.col("part").alias("p"), F.col("seq").alias("s"),
        F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"),
    )
    return rows.join(before, F.expr("part = p AND seq = s")).select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, files: Files | None = None, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files to the shared folder and report what is read back from them."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark, 'tokens')}/files"
    write_token_files(docs, path, files or default_files(), id_, text)
    return with_starts(saved(read_token_files(spark, path), "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"))
