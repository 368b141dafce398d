"""BagMinHash near-duplicates against brute force, and its signatures against the exact similarity."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_language_leaks import words as word_list

from playmart.llm import common, minhash, shingles, simhash

SCHEMA = "doc_id long, text string, lang string"


def multiset(text, words=5):
    w = word_list(text)
    runs = [tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    return Counter(runs)


def jaccard(a, b):
    common = sum((a & b).values())
    return common / max(1, sum(a.values()) + sum(b.values()) - common)


def brute(rows):
    """Class of each doc_id by all pairs."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    bags = [(i, t, multiset(t)) for i, t in rows if t is not None]
    index = defaultdict(list)
    for k, (_, _, bag) in enumerate(bags):
        for s in bag:
            index[s].append(k)
    texts = defaultdict(list)
    for k, (i, t, bag) in enumerate(bags):
        texts[t].append(i)
        seen = Counter()
        for s in bag:
            for o in index[s]:
                if o < k:
                    seen[o] += 1
        for o, n in seen.items():
            # different shingles in common bound the similarity only for bags without repeats, so no pruning
            if jaccard(bag, bags[o][2]) >= 0.8:
                x, y = sorted((find(i), find(bags[o][0])))
                parent[y] = x
    for ids in texts.values():
        for i in ids[1:]:
            x, y = sorted((find(ids[0]), find(i)))
            parent[y] = x
    return {i: find(i) for i, _ in rows if i is not None}


def test_signature_agreement_estimates_weighted_jaccard():
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(300)]
    other = base[:200] + [random.choice(words) for _ in range(60)] + base[20:60]
    repeats = base[:40] * 6 + base[60:120]
    fewer = base[:40] * 3 + base[60:140]
    for a, b in ((base, other), (repeats, fewer)):
        texts = [" ".join(a), " ".join(b)]
        data, bounds = shingles.text_buffer(pa.array(texts))
        s, cuts = shingles.shingle_hashes(data, bounds, 5)
        sig = minhash.signatures(s, cuts, 4000)
        exact = jaccard(multiset(texts[0]), multiset(texts[1]))
        assert abs((sig[0] == sig[1]).mean() - exact) < 0.035
        x, y = (np.sort(s[cuts[i] : cuts[i + 1]]) for i in (0, 1))
        assert abs(minhash.similarity(x, y) - exact) < 1e-12


def test_classes_equal_brute_force(spark, tiny, small):
    for folder in (tiny, small):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
        rows = [tuple(r) for r in docs.collect()]
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
        assert got == brute(rows)


def test_links_hidden_behind_a_representative(spark):
    """Chains of neighbours, all in the same buckets, of which few resemble any one of them."""
    random.seed(5)
    words = [f"t{i}" for i in range(2000)]
    line = [random.choice(words) for _ in range(600)]
    rows = [(k, " ".join(line[k * 12 : k * 12 + 240])) for k in range(30)]
    rows += [(100 + k, " ".join(line[:100] + [random.choice(words) for _ in range(60)])) for k in range(60)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "a"), (2, None, "b"), (3, "", "a"), (4, "", None), (5, "one", "a"), (6, "One!", "a"), (7, "?!", "a"), (8, "?!", "a"), (9, "one two", "a"),
        (10, "x " * 30000, "a"), (11, "x " * 30001, "a"), (5, "one", "a"), (12, "alone here with some words of its own", "a"),
    ]
    got = sorted((r["doc_id"], r["class_id"], r["kept"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (5, 5, True), (5, 5, True), (6, 5, False), (7, 7, True), (8, 7, False), (9, 9, True),
        (10, 10, True), (11, 10, False), (12, 12, True),
    ]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_without_ids_link(spark):
    random.seed(8)
    words = [f"t{i}" for i in range(2000)]
    cut = lambda line, at: " ".join(line[at : at + 240])
    rows, want = [], []
    for g in range(6):
        line = [random.choice(words) for _ in range(300)]
        a, b = 10 * g + 1, 10 * g + 2
        rows += [(a, cut(line, 0)), (None, cut(line, 20)), (None, cut(line, 20)), (b, cut(line, 40))]
        want += [(a, a, True), (None, a, False), (None, a, False), (b, a, False)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_text_is_lost_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (None, c), (None, c), (7, c + " more"), (None, "lone"), (None, "lone"), (8, None), (8, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, Digest string")
    got = minhash.near_duplicates(df).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got if r["doc_id"]} == {(3, 3), (5, 3), (5, 5), (7, 7), (8, 8)}
    assert len({r["class_id"] for r in got if r["doc_id"] is None}) == 2
    left = minhash.deduplicate(df)
    assert left.columns == df.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(str, [(3, a), (5, b), (7, c + " more"), (None, "lone"), (8, None), (8, None)]))


def test_large_components_meet_only_the_rest(spark):
    """Buckets of one large component and a few others, over several blocks, give every link there is."""
    random.seed(12)
    line = [f"s{i}" for i in range(200)]
    rows = [(k, " ".join([*line, f"end{k}"])) for k in range(400)]
    rows += [(1000 + k, " ".join([*line[:110], *(f"u{k}x{i}" for i in range(60))])) for k in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: 0 if k < 1000 else k for k, _ in rows}


def test_tables_on_the_way_are_deleted(spark, tmp_path, monkeypatch):
    """Only the tables that the result reads are left, and tables of others are never deleted."""
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    w = [f"w{k}" for k in range(200)]
    texts = [" ".join(w[k // 3 : 150 + k // 3]) for k in range(12)] + [" ".join(w[::-1])]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], SCHEMA)
    found = minhash.near_duplicates(df)
    assert {f.split("-")[0] for f in os.listdir(tmp_path)} == {"sketches", "classes"}
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == {k: 0 for k in range(12)} | {12: 12}
    before = set(os.listdir(tmp_path))
    found = simhash.near_duplicates(df, part_rows=2)
    assert {f.rpartition("-")[0] for f in set(os.listdir(tmp_path)) - before} == {"simhash-prints", "simhash-different", "simhash-components"}
    assert found.count() == 13
    with pytest.raises(KeyError):
        common.discard(df)
