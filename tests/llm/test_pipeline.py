"""The pipeline's rows against plain versions of its stages."""

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_language_leaks import plain_tiles, words
from test_near_duplicates import brute

from playmart.llm import langid, minhash


def leaks(text, items):
    w = words(text)
    grams = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
    for item in items:
        i = words(item or "")
        if len(i) >= 4 and sum(tuple(i[k : k + 4]) in grams for k in range(len(i) - 3)) * 4 >= 0.5 * len(i):
            if sum(n for n, _, _ in plain_tiles(i, w, 4)) >= 0.5 * len(i):
                return True
    return False


def test_rows_of_the_pipeline(spark, tiny):
    from tokenizers import Tokenizer

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    sure = {r["doc_id"] for r in langid.identify(docs).where("lang_pred <> 'und' and score >= 0.4").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in sure}
    classes = brute(sorted(text.items()))
    items = [r["text"] for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    want = {i for i, c in classes.items() if i == c and not leaks(text[i], items)}
    rows = corpus_pipeline.run(spark, tiny).collect()
    assert {r["doc_id"] for r in rows} == want
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i in want:
        got = b"".join(r["ids"] for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]))
        assert np.frombuffer(got, "<u4").tolist() == [*plain.encode(text[i], add_special_tokens=False).ids, 2]


def test_stages_keep_columns_and_survive_odd_rows(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (1, "again and the same", "en", "s", 1), (None, "the or of", "en", None, 2)], docs.schema)
    got = docs.union(odd).withColumn("score", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, tiny)
        assert set(docs.columns) <= set(got.columns)
    # an id that repeats loses no text of its own, and no text stays twice
    mine = [r["text"] for r in got.where("doc_id = 1").collect()]
    assert "again and the same" in mine and len(mine) == len(set(mine))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, tiny)
        assert empty.count() == 0


def test_one_row_of_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.deduplicate(df).collect()) == [(1, "a b c"), (3, "d")]
