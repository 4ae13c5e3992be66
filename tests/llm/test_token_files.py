import random
import zlib

import corpus
import numpy as np
import pytest

from haulmetric.llm import token_files
from haulmetric.llm.token_files import Files, Pieces, Shard, default_files, shard_bytes


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_files().tokenizer)


@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 1 << 31])
def test_every_id_can_be_read_alone_and_together(top):
    rng = np.random.default_rng(top % 97)
    ids = np.minimum(rng.pareto(0.4, 3000) * 3, top - 1).astype(np.uint32)
    shard = Shard(shard_bytes(4, 2, [1, None, 9], [ids[:5], ids[5:5], ids[5:]]) + b"\n")
    assert (shard.ids() == ids).all()
    assert [shard[k] for k in range(0, 3000, 11)] == ids[::11].tolist()
    assert shard.ends.tolist() == [5, 5, 3000] and shard.no_id.tolist() == [False, True, False]
    for outside in (-1, 3000):
        with pytest.raises(IndexError):
            shard[outside]


def test_damaged_files_are_refused():
    data = shard_bytes(0, 0, [1], [np.arange(1000, dtype=np.uint32)])
    for bad in (data[:-50], b"x" + data):
        with pytest.raises(ValueError):
            Shard(bad)


def test_widths_are_the_cheapest():
    ids = np.array([1] * 900 + [60_000] * 100, np.uint32)
    assert token_files.best_widths(ids) == [1, 15]
    assert token_files.best_widths(np.zeros(5, np.uint32)) == [1]


def test_pieces_give_the_library_its_own_ids(library):
    rng = random.Random(1)
    alphabet = "ab 'sté1.,!|\n-_\"(#　"
    texts = ["", " ", "a  b\n\n c", "<|endoftext|> x", "don't 'll we're", "x' s", "日本語 テスト。", "a.\n\nb", "\t"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    texts += [corpus.prose(rng, 200) for _ in range(20)]
    pieces = Pieces(Files(default_files().tokenizer, cached=500))
    for start in range(0, len(texts), 700):
        part = texts[start : start + 700]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [x.tolist() for x in pieces.encode(part)] == want


def test_files_equal_plain_encoding(spark, sf_dir, library):
    got = {r.doc_id: r for r in token_files.op9_token_files(spark, sf_dir).collect()}
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    start = 0
    for doc_id, text in docs:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        row = got[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_rows_small_shards_and_empty_tables(spark):
    docs = corpus.odd(spark)
    files = Files(default_files().tokenizer, shard_tokens=50)
    rows = token_files.token_files(docs, files).orderBy("start").collect()
    assert len(rows) == docs.count()
    ids = [r.doc_id for r in rows]
    assert ids == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    ends = [r.start + r.n_tokens for r in rows]
    assert [0, *ends[:-1]] == [r.start for r in rows]
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {1}
    assert token_files.token_files(docs.limit(0), files).count() == 0
