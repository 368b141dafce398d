"""Language ID by held-out accuracy, decontamination against a plain greedy string tiling."""

import math
import random
import re
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from playmart.llm import decontam, langid, shingles


def test_held_out_accuracy_and_calibration(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = langid.identify(docs).where("held_out and lang is not null").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 150
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert sum(right) / len(rows) > 0.97
    assert abs(sum(r["score"] for r in rows) / len(rows) - sum(right) / len(rows)) < 0.05


def plain_features(text, idf):
    """Hashed 1- to 3-grams of one text by plain integers, as values of length one."""
    c = [ord(x) if ord(x) > 127 or "a" <= x <= "z" else 32 for x in text]
    factors = (0x9E3779B1, 0xC2B2AE35, 0x27D4EB2F)
    grams = [list(zip(c[i : i + n], factors, strict=False)) for n in (1, 2, 3) for i in range(len(c) - n + 1)]
    tf = {}
    for gram in grams:
        chars = [x for x, _ in gram]
        if chars[0] == 32 and len(chars) == 1 or len(chars) == 2 and set(chars) == {32} or len(chars) == 3 and chars[1] == 32:
            continue
        h = 0
        for x, factor in gram:
            h = (h * 31 + x * factor) % 2**32
        b = ((h ^ h >> 15) * 0x85EBCA6B % 2**32 >> 9) % langid.BUCKETS
        tf[b] = tf.get(b, 0) + 1
    value = {b: (1 + math.log(n)) * idf[b] for b, n in tf.items()}
    norm = math.sqrt(sum(v * v for v in value.values()))
    return {b: v / norm for b, v in value.items()}


def plain_prediction(text, model):
    logit = list(model.weights[:, -1])
    for b, v in plain_features(text, model.idf).items():
        logit = [s + v * w for s, w in zip(logit, model.weights[:, b], strict=True)]
    e = [math.exp((s - max(logit)) / model.temperature) for s in logit]
    return model.labels[e.index(max(e))], max(e) / sum(e)


def test_features_and_predictions_are_those_of_a_plain_version(spark, tiny):
    rng = np.random.default_rng(3)
    model = langid.Model(["a", "b", "c"], rng.normal(size=(3, langid.BUCKETS + 1)), rng.uniform(0.5, 9, langid.BUCKETS), 1.7)
    own = ["x", "xy", "x y", " xyz ", "a1b22c", "Ünïcödé, naïve!", "漢字かな交じり文 and more", "aaaa aaaa", "ß\u0301\U0001F600z", "-- x --", "abc" * 40_000, "Ж"]
    texts = own + [r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(2)
    low = {r["doc_id"]: r["low"] for r in df.select("doc_id", F.lower("text").alias("low")).collect()}
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(df, model).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        if t is None or not any(unicodedata.category(x).startswith("L") for x in t):
            assert found[i] == ("und", 0.0)
        else:
            label, score = plain_prediction(low[i], model)
            assert found[i][0] == label and abs(found[i][1] - score) < 1e-9


def test_document_frequencies_are_those_of_a_plain_version(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("text is not null").select("text")
    ones = np.ones(langid.BUCKETS)
    want = np.zeros(langid.BUCKETS, "i8")
    low = [r[0] for r in docs.select(F.lower("text")).collect()]
    for t in low:
        if any(x > "\x7f" or x.isalpha() for x in t):
            want[list(plain_features(t, ones))] += 1
    got, n = langid.document_frequencies(docs)
    assert n == len(low) and (got == want).all()


def plain_ftrl(rows, labels, k, epochs, alpha, beta, l1, l2):
    """Per-coordinate FTRL-proximal in plain loops."""
    z, n = {}, {}

    def weight(c):
        v = z.get(c, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - (l1 if v > 0 else -l1)) / ((beta + n.get(c, 0.0) ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for (at, x), y in zip(rows, labels, strict=True):
            w = {(b, j): weight((b, j)) for b in at for j in range(k)}
            logit = [sum(v * w[b, j] for b, v in zip(at, x, strict=True)) for j in range(k)]
            e = [math.exp(v - max(logit)) for v in logit]
            for b, v in zip(at, x, strict=True):
                for j in range(k):
                    g = v * (e[j] / sum(e) - (j == y))
                    more = n.get((b, j), 0.0) + g * g
                    z[b, j] = z.get((b, j), 0.0) + g - (more**0.5 - n.get((b, j), 0.0) ** 0.5) / alpha * w[b, j]
                    n[b, j] = more
    return {c: weight(c) for c in z}


def test_weights_are_those_of_plain_ftrl():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(40, 6, replace=False)) for _ in range(50)]
    vals = [rng.random(6) for _ in rows]
    labels = [("a", "b", "c")[int(r[0]) % 3] for r in rows]
    sample = pd.DataFrame({"label": labels, "buckets": rows, "vals": vals})
    got, temperature = langid._train(sample, ["a", "b", "c"], 3, 0.5, 1.0, 0.1, 1e-4)
    used = [i for i in range(50) if i % 5 != 4]
    plain = [([*rows[i].tolist(), langid.BUCKETS], [*vals[i].tolist(), 1.0]) for i in used]
    want = plain_ftrl(plain, ["abc".index(labels[i]) for i in used], 3, 3, 0.5, 1.0, 0.1, 1e-4)
    for (bucket, j), w in want.items():
        assert abs(got[j, bucket] - w) < 1e-9
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values())
    assert 1e-5 < temperature < 1e5
    for margin, right in ((3.0, 50), (3.0, 40), (0.01, 50)):
        logits = np.where(np.arange(50)[:, None] < right, [[margin, 0.0]], [[0.0, margin]])
        loss = lambda t, s=logits: float((np.log(np.exp(s / t).sum(axis=1)) - s[:, 0] / t * 51 / 52 - s[:, 1] / t / 52).mean())
        t = langid._minimised(loss)
        assert all(loss(t) <= loss(t * f) + 1e-9 for f in (0.5, 0.9, 1.1, 2.0)) and math.exp(-13) < t < math.exp(13)


def test_most_weights_are_zero(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit(docs, langid.fold() != 0)
    used = model.weights[:, :-1][:, model.idf < model.idf.max()]
    assert (used == 0).mean() > 0.6
    assert 1e-4 < model.temperature < 1e3


def test_learns_from_its_folds_only(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(langid.fold() == 0, F.lit("zz")).otherwise(F.col("lang")))
    a, b = (sorted(tuple(r) for r in langid.identify(d).select("doc_id", "lang_pred", "score").collect()) for d in (docs, other))
    assert a == b


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "the word", None), (None, "le mot", "fr"), (6, "the " * 50_000, "en"), (6, "the", "en"), (8, "der mot", "de")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["lang_pred"] == "und") == (r["text"] is None or not re.search(r"[^\W\d_]", r["text"]))
        assert 0 <= r["score"] <= 1
    none = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def plain_tiles(item, doc, least):
    """Longest unmarked common runs, marked one after the other."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and not a[i + n] and not b[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n > best[0]:
                    best = n, i, d
        if best[0] < least:
            return out
        n, i, d = best
        a[i : i + n] = [True] * n
        b[d : d + n] = [True] * n
        out.append(best)


def words(text):
    """Runs of letters, marks and numbers; characters of scripts without spaces alone."""
    out, run = [], ""
    for c in text.lower():
        alone = any(low <= ord(c) <= high for low, high in shingles.UNSPACED)
        inside = unicodedata.category(c)[0] in "LMN"
        if run and (alone or not inside):
            out.append(run)
            run = ""
        if inside and alone:
            out.append(c)
        elif inside:
            run += c
    return [*out, run] if run else out


def test_words_of_any_script():
    import numpy as np
    import pyarrow as pa

    texts = ["hello\u2014world \u201cquoted\u201d a\u00a0b", "", "這是。一本書、x", "カタカナ abc漢字def", "naïve e\u0301té x\u00b2 \u00d7 ½", "ไทย ไทย", "😀a😀", "жук\u2026жук", "\u3000", "é", "a漢"]
    data, bounds = shingles.text_buffer(pa.array(texts))
    hashes, owner, _ = shingles.word_hashes(data, bounds)
    known = {}
    for k, text in enumerate(texts):
        mine = words(text)
        got = hashes[owner == k].tolist()
        assert len(got) == len(mine), text
        for w, h in zip(mine, got, strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    part, _, first = shingles.word_hashes(data, bounds[2:4])
    assert part.tolist() == hashes[owner == 2].tolist() and np.all(np.diff(first) > 0)


def test_tiles_cover_as_plain_tiling_does():
    import numpy as np

    random.seed(6)
    for _ in range(150):
        item = [random.randint(0, 6) for _ in range(random.randint(4, 40))]
        doc = [random.randint(0, 6) for _ in range(random.randint(0, 60))]
        if random.random() < 0.5:
            k = random.randint(0, len(item))
            doc[5:5] = item[k:] + [9] + item[:k]
        got = decontam.tiles(np.array(item, "u8"), np.array(doc, "u8"), 4)
        want = plain_tiles(item, doc, 4)
        assert got == want
        for n, i, d in got:
            assert item[i : i + n] == doc[d : d + n]
        for axis in (1, 2):
            taken = [x for t in got for x in range(t[axis], t[axis] + t[0])]
            assert len(taken) == len(set(taken))


def test_leaks(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    item = bench.where("item_id = 0").first()["text"].split()
    third = len(item) // 3
    moved = " ".join([*item[2 * third :], "between", *item[third : 2 * third], "other", *item[:third]])
    extra = [(9001, "Before. " + moved.upper() + " after"), (9002, " ".join(item[: third])), (9003, None), (9004, ""), (9005, "x " * 100_000)]
    both = docs.union(spark.createDataFrame(extra, docs.schema)).withColumn("leaks", F.lit("clash"))
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "x x x"), (903, " ".join(item))], bench.schema)
    items = bench.union(odd)
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontam.leaks(both, items).collect()}
    assert (9001, 0) in got and (9001, 903) in got
    assert not {d for d, _ in got} & {9002, 9003, 9004, 9005}
    want = set()
    texts = {r[0]: words(r[1] or "") for r in both.select("doc_id", "text").collect()}
    for r in items.collect():
        w = words(r["text"] or "")
        starts = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
        for d, t in texts.items():
            if sum(tuple(t[k : k + 4]) in starts for k in range(len(t) - 3)) and len(w) >= 4 and len(t) < 6000:
                if sum(n for n, _, _ in plain_tiles(w, t, 4)) >= 0.5 * len(w):
                    want.add((d, r["item_id"]))
    assert set(got) == want
    joined = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontam.leaks_by_join(both, items).collect()}
    assert joined == got
    assert decontam.leaks(both.limit(0), items).count() == 0 and decontam.leaks(both, items.limit(0)).count() == 0


def test_large_benchmarks_are_judged_alike(spark, monkeypatch):
    alone = [f"w{k}x" for k in range(160)]
    items = [(1, " ".join(["a b c d"] * 40 + alone)), (2, "one two three four five six"), (2, "red green blue white black pink"), (3, "one two three four five six"), (None, "sun moon star sky cloud rain"), (4, "a b c")]
    docs = [
        (1, "a b c d " * 40), (2, " ".join(alone)), (None, "so one two three FOUR five six"), (None, "clean words with no leak at all"), (7, "red green blue white black pink"),
        (7, "another clean row of the same id"), (7, "red green blue white black pink"), (8, "sun moon star sky cloud rain"), (9, None), (10, ""), (11, "a b c"),
    ]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lambda x: sorted((tuple(r) for r in x.collect()), key=str)
    want, stays = rows(decontam.leaks(df, bench)), rows(decontam.remove_leaks(df, bench))
    assert {(d, i) for d, i, *_ in want} == {(1, 1), (2, 1), (None, 2), (None, 3), (7, 2)}
    assert rows(decontam.leaks_by_join(df, bench)) == want
    clash = df.select("doc_id", "text", F.lit("x").alias("_lower"), F.lit(2).alias("leaks"), F.lit(3).alias("LOWER"))
    left = decontam.remove_leaks(clash, bench)
    assert left.columns == clash.columns and rows(left.select("doc_id", "text")) == stays
    monkeypatch.setattr(decontam, "MAX_BROADCAST_BYTES", 0)
    assert rows(decontam.remove_leaks(df, bench)) == stays
    clash = df.select("doc_id", "text", F.lit("x").alias("_lower"), F.lit(2).alias("leaks"), F.lit(3).alias("Digest"))
    assert rows(decontam.remove_leaks(clash, bench).select("doc_id", "text")) == stays
    assert rows(decontam.leaks(df, bench)) == want


def test_tiling_of_repetitive_texts_is_quick_and_plain():
    import time

    rng = np.random.default_rng(11)
    for item, doc in (([1] * 12, [1] * 40), ([1, 2, 3] * 6, [1, 2, 3] * 9 + [4] + [2, 3, 1] * 5), ([1] * 9 + [2] + [1] * 6, [1] * 30), ([*range(8), *range(8)], [*range(5), *range(8), *range(3, 8)])):
        item, doc = np.array(item, "u8"), np.array(doc, "u8")
        assert decontam.tiles(item, doc, 4) == plain_tiles(item.tolist(), doc.tolist(), 4)
    for _ in range(60):
        item, doc = rng.integers(0, 2, rng.integers(1, 25)), rng.integers(0, 2, rng.integers(1, 60))
        assert decontam.tiles(item.astype("u8"), doc.astype("u8"), 4) == plain_tiles(item.tolist(), doc.tolist(), 4)
    five = np.arange(50_000) % 5
    for item, doc in ((np.ones(400), np.ones(40_000)), (np.ones(50_000), np.ones(50_000)), (five, five[2:]), (five[:400], np.concatenate((five, np.ones(5), five)))):
        began = time.time()
        found = decontam.tiles(item.astype("u8"), doc.astype("u8"), 4)
        assert sum(t[0] for t in found) >= len(item) - 3 and time.time() - began < 4


def test_names_with_dots_and_marks_pass(spark):
    names = ["a.b", "c`d", "e f", "leaks", "lower"]
    df = spark.createDataFrame([(k, "plain words of a text that is said again", "en", 1, 2, 3, 4, 5) for k in range(20)], "doc_id long, text string, lang string, v int, w int, x int, y int, z int").toDF("doc_id", "text", "lang", *names)
    bench = spark.createDataFrame([(1, "another thing that nobody says here at all")], "item_id long, text string")
    for kept in (langid.keep_identified(df), decontam.remove_leaks(df, bench)):
        assert kept.columns == df.columns and kept.count() == 20 and tuple(kept.first())[3:] == (1, 2, 3, 4, 5)
