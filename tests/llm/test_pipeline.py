import random

import corpus
import corpus_pipeline
import numpy as np
from test_ngram_join import brute

from haulmetric.llm import quality
from haulmetric.llm.token_files import default_files


def test_stages_are_named_and_keep_the_columns(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_join", "decontaminate", "mix_sources", "token_files",
    ]
    docs = corpus.odd(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.schema == corpus.odd(spark).schema


def test_run_equals_its_stages_in_plain_python(spark, tmp_path):
    """Stages 1, 2, 3 and 5 by brute force, stage 4 by the words that each source gives."""
    rng = random.Random(7)
    item = corpus.prose(rng, 30)
    rows = []
    for k in range(240):
        text = corpus.prose(rng, rng.choice([5, 60, 90]))
        if k % 11 == 0:
            text += "\n" + item
        if k % 7 == 0 and rows:
            text = rows[-1][1]
        rows.append((k, text, "en", f"s{k % 3}"))
    sf = corpus.stored(corpus.frame(spark, rows), tmp_path)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    benchmark.write.parquet(f"{sf}/benchmark.parquet")

    good = [r for r in rows if quality.measures(r[1])[0] >= quality.MIN_WORDS]
    kept = {r.doc_id for r in quality.op1_quality_rules(spark, sf).filter("kept").collect()}
    good = [r for r in good if r[0] in kept]
    classes = brute(good, 5, 80)
    alone = [r for r, (doc, _, least) in zip(good, classes) if doc == least]
    clean = [r for r in alone if item not in r[1]]

    result = corpus_pipeline.run(spark, sf).orderBy("start").collect()
    assert {r.doc_id for r in result} <= {r[0] for r in clean}
    taken = [r.doc_id for r in result]
    assert taken == sorted(taken)
    assert all(taken.count(k) <= 2 for k in set(taken))
    words = {r[0]: len(r[1].split()) for r in clean}
    total = sum(words.values())
    assert abs(sum(words[k] for k in taken) - 1.5 * total) <= 0.03 * total

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_files().tokenizer)
    texts = {r[0]: r[1] for r in clean}
    start = 0
    for r in result:
        ids = np.array(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)


def test_run_on_an_empty_table_and_on_odd_rows(spark, tmp_path):
    """Odd rows go through every stage, and their tokens are those of the texts that stayed."""
    benchmark = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "item_id long, text string")
    for name, docs in (("empty", corpus.odd(spark).limit(0)), ("odd", corpus.odd(spark))):
        sf = corpus.stored(docs, tmp_path / name)
        benchmark.write.parquet(f"{sf}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, sf).collect()
        texts = {i: t for i, t, _, _ in corpus.odd_rows()}
        assert (len(rows) == 0) == (name == "empty")
        assert {r.doc_id for r in rows} <= {k for k, t in texts.items() if t and len(t.split()) >= quality.MIN_WORDS}


def test_texts_that_fill_in_a_dense_question_are_dropped_however_many(spark, tmp_path):
    """250 texts hold the item with values of their own, and none of them gets through the stage."""
    rng = random.Random(9)
    form = "Add {} apples {} pears {} plums {} figs {} limes {} dates"
    fill = lambda: form.format(*rng.sample(range(2, 99_999), 6))
    rows = [(k, f"{corpus.prose(rng, 40)}.\n{fill()}.", "en", "a") for k in range(250)]
    rows += [(k, corpus.prose(rng, 60), "en", "a") for k in range(250, 280)]
    spark.createDataFrame([(1, fill())], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.drop_leaks(spark, corpus.frame(spark, rows).repartition(3), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(250, 280))


def test_rows_reach_python_workers_in_small_batches(spark, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:1]:
        stage(spark, corpus.odd(spark), sf_dir)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
