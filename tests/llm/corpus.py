"""Small hand-made documents for the tests of the training-data operators."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns that clash with names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, kept boolean, "
    "measures string, id long, key string, size int, block long, shard int, gone string"
)
EXTRA = (7, True, "m", 9, "k", 1, 2, 3, "g")


def words(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(count)]


def prose(rng: random.Random, count: int) -> str:
    """Sentences of varying length over several lines."""
    out = []
    for word in words(rng, count):
        end = rng.random()
        out.append(word + (".\n" if end < 0.03 else ". " if end < 0.12 else " "))
    return "".join(out).strip()


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, ties and repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    plain = prose(rng, 120)
    return [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain, None, None), (None, plain, "en", "a"),
        (None, None, None, None), (3, None, "en", "b"), (4, "", "en", "b"), (5, " \n\t ", "en", "b"),
        (6, "one", "en", None), (7, "one", "de", "b"), (8, long, "en", "a"), (9, "é　ü 日本語 x", "fr", "c"),
    ]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    filled = [(i, t, g, s, len(t) if t else None, *EXTRA) for i, t, g, s in rows]
    return spark.createDataFrame(filled, SCHEMA)


def odd(spark: SparkSession) -> DataFrame:
    return frame(spark, odd_rows()).repartition(3)


def stored(frame: DataFrame, tmp_path, table: str = "documents") -> str:
    frame.write.parquet(f"{tmp_path}/{table}.parquet")
    return str(tmp_path)
