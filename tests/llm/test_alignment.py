"""Aligned tokens against a plain byte-by-byte version."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
import tokenizers

from playmart.llm import alignment
from playmart.llm.common import vocabulary

ODD = [
    "", "  ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\n", "a\n \nb", "héllo 日本語 😀x 👩‍👩‍👧", "<|endoftext|></s> [INST] <0x0A>", "▁x", "x ▁y",
    "a\x00b", "tab\tx \t y", "é" * 50, "🏳️‍🌈🏳️‍🌈 𝔘𝔫 ﷽ ẛ̣", "ﬁ ½ ①", "x 　 y", "a  b \x1cq \x85z", "w" * 5000, "日本語テキスト" * 100,
    "don't can't 123 4567 ...!!!", None, "a \r\n b", "😀" * 30 + " 😀😀", "�﻿ x", "क्षत्रिय ไทยภาษา",
]


@pytest.fixture(scope="module")
def paths():
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def plain(rows, paths):
    a = tokenizers.Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    letters = alignment.byte_letters()

    def groups(text):
        if not text:
            return None
        ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        raw = [[bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if any(b"".join(r) != f" {text}".encode() for r in raw):
            return None
        ends = [[sum(map(len, r[: k + 1])) for k in range(len(r))] for r in raw]
        out, before = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            out.append([[i for i, e in zip(ids[s], ends[s], strict=True) if before < e <= cut] for s in (0, 1)])
            before = cut
        return out

    found = [(i, groups(t[:400] if t else t)) for i, t in rows]
    count, best = Counter(), {}
    for _, g in found:
        count.update({(p, q) for x, y in g or [] for p in x for q in y})
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for i, g in found:
        links = [(p, q) for x, y in g or [] for p in x for q in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        sums = sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)
        out.append((i, *sums, hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_pairs", [1_000_000, -1])
def test_odd_texts_sent_and_joined(spark, paths, max_pairs):
    rows = [(i, t[:400] if t else t) for i, t in enumerate(ODD)] + [(None, "a b"), (0, "a b"), (0, "a b")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, `n.a` int")
    assert sorted(map(tuple, alignment.align(df, *paths, max_pairs=max_pairs).collect()), key=str) == plain(rows, paths)
    assert alignment.align(spark.createDataFrame([], df.schema), *paths, max_pairs=max_pairs).collect() == []


def test_table_equals_plain_version(spark, paths, tiny):
    rows = [(r.doc_id, r.text[:400]) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(df, *paths).collect()), key=str) == plain(rows, paths)


def test_long_texts_are_whole(paths):
    """Segments aligned one by one give what the whole text gives."""
    a = alignment.Aligner(*paths)
    texts = [" ".join(f"wörd{k % 700} x{k}" for k in range(20_000)), "日本語" * 5000, "\n".join(f"line {k}" for k in range(9000))]
    counts, digests, *_ = a.align(texts)
    a.splits = False
    a.forget()
    whole, same, *_ = a.align(texts)
    assert counts.tolist() == whole.tolist() and digests == same


def test_forgetting_changes_nothing(paths, monkeypatch):
    texts = [t for t in ODD if t]
    one = alignment.Aligner(*paths)
    want = [[x.tolist() if hasattr(x, "tolist") else x for x in one.align([t])] for t in texts]
    monkeypatch.setattr(alignment, "KEPT", 3)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 10)
    other = alignment.Aligner(*paths)
    assert [[x.tolist() if hasattr(x, "tolist") else x for x in other.align([t])] for t in texts] == want
