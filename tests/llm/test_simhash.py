"""SimHash components against brute force over all pairs of fingerprints."""

import re

import numpy as np
import pytest
import xxhash

from playmart.llm import simhash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(prints):
    """{number of the row: smallest number that it is linked with} of (id, fingerprint)."""
    values = np.array([p for _, p in prints], np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    members = {}
    for i, (doc, _) in enumerate(prints):
        members.setdefault(find(i), []).append((i, doc))
    out = [None] * len(prints)
    for group in members.values():
        name = min((d for _, d in group if d is not None), default=None)
        for i, _ in group:
            out[i] = name
    return out


def test_fingerprints_are_as_stated(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(table).collect()}
    texts = dict(map(tuple, table.limit(150).collect()))
    assert {d: got[d] for d in texts} == {d: f"{plain_print(t):016x}" for d, t in texts.items()}
    # the hash is the one that Spark's own function gives
    assert spark.range(1).selectExpr("xxhash64('a b c d')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_whole_table_equals_brute_force(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    rows = sorted(simhash.near_duplicates(table).collect())
    assert len(rows) == table.count()
    assert [r.component_id for r in rows] == brute([(r.doc_id, int(r.fingerprint, 16)) for r in rows])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one\x0btwo\x0cthree\rfour"), (7, "One two three  four"), (8, "one two three four five")]
    rows += [(None, "one two three four"), (None, "lonely words without any number at all"), (9, "é É a b"), (9, "é É a b"), (10, "x " * 300_000)]
    rows = [(i, t, 0) for i, t in rows]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, `print.a` int")).collect()
    assert len(got) == len(rows)
    prints = [(i, plain_print(t)) for i, t, _ in rows]
    want = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute(prints), strict=True)), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert [c for i, f, c in want if i in (1, 2, 3)] == [1, 1, 1] and want[0][1] == "0" * 16
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_vote_in_pieces():
    text = " ".join(f"w{i % 977}" for i in range(5000)).encode()
    for chunk in (1, 7, 100, 1 << 20):
        assert simhash.votes(text, chunk).tolist() == simhash.votes(text, 1 << 30).tolist()
    assert simhash.votes(b"abc" * 1000, 10)[64] == 1


def test_every_link_meets_at_an_anchor():
    rng = np.random.default_rng(5)
    for code in ((1, 10), (2, 6), (4, 4)):
        s = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        t = s.copy()
        for k in range(4):  # up to four bits differ
            t ^= np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)
        visits_s, visits_t = (list(simhash.anchors_of(x.view("i8"), code)) for x in (s, t))
        for (_, at_s, home_s), (_, at_t, home_t) in zip(visits_s, visits_t, strict=True):
            assert home_s in at_s and home_t in at_t
            assert home_s in at_t or home_t in at_s


@pytest.mark.parametrize("code, part_rows", [((1, 4), 40), ((2, 5), 64), (None, 1 << 16)])
def test_dense_groups_in_parts(spark, code, part_rows):
    """A group as a third of all rows, chains across it, and anchors with more rows than a part."""
    rng = np.random.default_rng(6)
    center = int(rng.integers(0, 1 << 63))
    prints = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    for _ in range(200):
        p = center
        for bit in rng.choice(64, int(rng.integers(1, 8)), replace=False):
            p ^= 1 << int(bit)
        prints.append(p)
    chain = center
    for bit in range(0, 60, 3):
        chain ^= 7 << bit
        prints.append(chain)
    prints = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    labels = {r.print: r.component for r in simhash.components(table, code, part_rows).collect()}
    want = brute([(p, p % (1 << 64)) for p in prints])
    assert [labels.get(p, p) for p in prints] == want
