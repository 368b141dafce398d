"""Token counts and packing against the tokenizers' own results on whole texts."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from playmart.llm import packing, queries, token_counts

ODD = [
    None, "", " ", "  a  b ", "a b", "▁a ▁ b", "tab\tand\nline\r\nends", "<s> x </s> <unk>", "naïve façade Ünï", "emoji 👩‍👩‍👧 ok", "a b　c", "\x1cx\x1dy\x85z",
    "<|endoftext|>abc<|startoftext|> d", "<|ENDOFTEXT|> THE the, The. THE., é. ÉT, a.b. .. , 5. J̌a, \u0130.", "x" * 3000, ("word " * 3000).strip(), "ÀÉÎ ΣΊΣΥΦΟΣ İstanbul é ́x", "it's we'll '' ' s 12345", " a b​c", "a" + " " * 40 + "b",
]


@pytest.fixture(scope="module")
def texts(tiny):
    import duckdb

    own = [r[0] for r in duckdb.sql(f"select text from '{tiny}/documents.parquet'").fetchall()]
    return ODD + own


def test_counts_equal_whole_encoding(spark, texts):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(df, model).collect()}
    for i, t in enumerate(texts):
        n = len(plain.encode(t or ""))
        assert got[i] == (len((t or "").encode()), n, n > 4096), repr(t)[:80]


def test_packing_holds_every_id_once(spark, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, None), (5, "x")], "doc_id long, text string")
    for shard_tokens, range_tokens in ((1 << 28, 1 << 28), (20_000, 50_000)):
        rows = packing.pack(df, path, shard_tokens=shard_tokens, range_tokens=range_tokens).collect()
        for i, t in enumerate(texts):
            if i in (0, 5):
                continue
            want = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
            pieces = sorted((r["start"], r["ids"], r["length"]) for r in rows if r["doc_id"] == i)
            assert [s for s, _, _ in pieces] == np.cumsum([0, *(n for _, _, n in pieces)])[:-1].tolist()
            assert np.frombuffer(b"".join(p for _, p, _ in pieces), "<u4").tolist() == want, repr(t)[:80]
        assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 2
        used = {}
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == used.get(r["sequence_id"], 0)
            used[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(used.values()) <= 4096
        shards = {s >> 32 for s in used}
        assert sum(n < 4096 for n in used.values()) <= len(shards)


def counts(ids):
    ids = [np.array(x, "<u2") for x in ids]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    owner, term, tf = packing.counted(np.concatenate(ids), bounds)
    cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
    statistics = packing.Statistics(len(ids), bounds[-1] / len(ids), np.bincount(term, minlength=packing.TERMS))
    return [(k, x, term[a:b], tf[a:b]) for k, (x, a, b) in enumerate(zip(ids, cuts, cuts[1:], strict=False))], statistics


def plain_bm25(docs, k1=1.2, b=0.75):
    """Score of every document for the different terms of every other, in plain loops."""
    n, average = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    out = []
    for q in docs:
        row = []
        for d in docs:
            tf, score = Counter(d), 0.0
            for t in set(q) & set(d):
                idf = max(0.0, math.log((n - df[t] + 0.5) / (df[t] + 0.5)))
                score += idf * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(d) / average))
            row.append(score)
        out.append(row)
    return np.array(out)


def test_neighbours_share_words():
    docs, statistics = counts([[10 + k % 3, 20 + k % 3, 30 + k % 3, 100 + k, 2] for k in range(12)])
    pieces = list(packing.fill(iter(docs), 20, statistics, 1000))
    for sequence in range(3):
        assert len({d[0] % 3 for d, _, _, number, _ in pieces if number == sequence}) == 1


def test_scores_are_those_of_plain_bm25():
    rng = np.random.default_rng(4)
    ids = [[*np.minimum(rng.zipf(1.3, rng.integers(1, 90)), 3000).tolist(), 2] for _ in range(240)]
    docs, statistics = counts(ids)
    want = plain_bm25(ids)
    index = packing.Index([d[2] for d in docs], [d[3] for d in docs], np.array([len(d[1]) for d in docs]), statistics)
    everyone = np.arange(len(docs))
    got = index.scores(everyone)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
    for row, exact in zip(got, want, strict=True):
        order = packing.best_first(row, 30)
        assert np.allclose(exact[order], np.sort(exact)[::-1][:30], rtol=1e-4, atol=1e-4)
        assert all(a < b or row[a] != row[b] for a, b in zip(order, order[1:], strict=False))
    left = np.sort(rng.permutation(240)[:70])
    index.keep(left)
    assert np.allclose(index.scores(everyone), want[:, left], rtol=1e-4, atol=1e-4)
    index.keep(left[::2])
    assert np.allclose(index.scores(everyone), want[:, left[::2]], rtol=1e-4, atol=1e-4)


def test_windows_take_the_best_unused_neighbours():
    rng = np.random.default_rng(9)
    ids = [[*rng.choice(60, rng.integers(3, 40)).tolist(), 2] for _ in range(200)]
    docs, statistics = counts(ids)
    want = plain_bm25(ids)
    left = np.array([len(x) for x in ids])
    windows = {}
    for d, start, n, sequence, _ in packing.fill(iter(docs), 150, statistics, 1 << 20):
        windows.setdefault(sequence, []).append((d[0], start, n))
    for pieces in windows.values():
        seed = pieces[0][0]
        left[seed] -= pieces[0][2]
        for d, _, n in pieces[1:]:
            unused = np.flatnonzero(left)
            assert want[seed, d] >= want[seed, unused[unused != seed]].max(initial=0) - 1e-3
            left[d] -= n
    assert not left.any()


def test_query_digests(spark, tiny):
    rows = queries.op2_lexical_packing(spark, tiny).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id").collect()}
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r[0]: r[1] for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    for r in rows[:60]:
        ids = [*plain.encode(text[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert token_counts.count_tokens(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_close_documents_meet_over_all_ranges(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(3)
    topics = [[f"{a}{b}" for a in rng.choice(list("bcdfghklmnprst"), 6) for b in ("ando", "ilu", "etra")] for _ in range(40)]
    rows = [(i, " ".join(rng.choice(topics[i % 40], 60))) for i in range(1600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = packing.pack(df, path, window=512, shard_tokens=30_000, range_tokens=40_000).collect()
    together = {}
    for r in pieces:
        together.setdefault(r["sequence_id"], []).append(r["doc_id"] % 40)
    assert len(together) > 100 and len({s >> 32 for s in together}) > 2
    same = sum(max(x.count(t) for t in x) for x in together.values()) / sum(map(len, together.values()))
    assert same > 0.8


def test_copies_are_dealt_to_many_ranges(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(6)
    hot = " ".join(f"w{i % 50}" for i in range(80))
    rows = [(i, hot if i % 3 == 0 else " ".join(f"v{j}" for j in rng.integers(0, 400, 80))) for i in range(900)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, window=512, shard_tokens=8000, range_tokens=16_000).collect()
    assert sorted({r["doc_id"] for r in pieces}) == list(range(900))
    assert len({r["sequence_id"] >> 32 for r in pieces if r["doc_id"] % 3 == 0}) > 2


def test_words_are_encoded_as_the_tokenizer_does():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    encoder = packing.WordEncoder(path, 50)
    assert encoder.splits
    batch = ["straße, STRASSE! (x) l'eau l'eau, d'd 's's", "İi ǅ ﬁn Å é é, ñ\u0303. ق‎ 你好，世界 a\u0301b c\u0338", "--- ... a.b,c;d _x_ x_ $5%%% le%%% w<|endoftext|>w <|endoftext|>, ²x x² Ⅷ٣"]
    long = ["été, ÉTÉ. The Of " * 40, "Ñandú %%% à la &&& " * 50] * 3
    for array in (pa.array(batch), pa.array(ODD), pa.array([*long, *batch, *ODD]).slice(2, 20), pa.array(batch[::-1])):
        ids, bounds = encoder.encode(array)
        for text, a, b in zip(array.to_pylist(), bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]
