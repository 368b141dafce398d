"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

Documents are dealt to the shards of the index by their words, not at random. A bounded number of pivot documents is
drawn; every document is scored by BM25 against each of them, and the ranking of its best pivots, then two
min-hashes of its terms, then a hash of its key make one order in which lexically close documents stand
together and no group of copies is bound to one place. The order is cut into ranges, a task each. The number of documents,
document frequencies and the average length are counted once, over all documents.

A task reads its range in order and holds one index shard of it at a time. A round draws seeds (rests of documents that were
cut come first); each, in turn, takes its unused neighbours in the shard, best BM25 first, until its window is full; the
last one is cut there and its rest stays unused. What is left when a quarter of the shard is unused goes on into the
next shard, so only the last window of a range can be short.

Neighbours are those of the seed's shard: the best of `shard_tokens` of text, chosen by the order, not of the whole table
(README has the share found). Work grows in proportion to the table.

Defined cases: a null text is empty and packs as its end id alone; repeated rows are packed each; a document longer
than a window fills several. Ties go by the order in the range. Extra columns are ignored. An empty table gives an empty
result. Tokenizers with ids beyond 16 bits are refused.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .shingles import mix, slices, text_buffer

WINDOW = 4096
K1, B = 1.2, 0.75
TERMS = 1 << 16
#: Documents against which all are ranked, and how many of the ranking's first places make the order.
PIVOTS, PLACES = 64, 4
#: Tokens of one index shard and of one range; seeds of a round; bytes of text encoded and tokens counted at once.
SHARD_TOKENS, RANGE_TOKENS, SEEDS, ENCODED_BYTES, COUNTED_TOKENS = 6 << 20, 12 << 20, 64, 8 << 20, 1 << 19
#: Numbers of the matrix by which documents are scored against the pivots at once.
SCORED_NUMBERS = 8 << 20
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Letters, then ASCII punctuation without an apostrophe: the tokenizer parts the two.
_TAILED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")


class WordEncoder:
    """Token ids of whole texts, by the different words of a batch; frequent ones stay in a bounded cache of the worker.

    Texts are split at ASCII white space where the vocabulary shows that no piece holds any and that it leaves no id;
    else they are encoded whole. Lower-case words take a shorter way through the same model where it is seen to agree.
    """

    _open: dict[str, WordEncoder] = {}

    def __init__(self, path: str, cache_entries: int) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        if size > TERMS:
            raise ValueError("ids beyond 16 bits")
        vocabulary = self.tokenizer.get_vocab()
        spaces = set("ĠĉĊċČ \t\n\v\f\r")  # as byte-level vocabularies write them, and as they are
        apart = all(spaces.isdisjoint(p) or spaces.issuperset(p.removesuffix("</w>")) for p in vocabulary)
        whole = self._each(["ab  cd\n\tef ", "ab", "cd", "ef", " \t\n\v\f\r"])
        self.splits = apart and whole[0] == b"".join(whole[1:4]) and not whole[4]
        #: Pieces that end a word, so that words encoded together can be told apart.
        self.ends = np.zeros(size, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.short = Tokenizer.from_file(path)
        self.short.normalizer = normalizers.Sequence([])
        self.short.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        pieces = sorted(p.removesuffix("</w>") for p in vocabulary if p.isascii())
        words = [a + b for a, b in zip(pieces, pieces[7:], strict=False) if (a + b).isalpha()] + ["été", "ñandú", "straße", "жук", "你好"]
        words = [w for w in words if _plain(w)]
        agrees = self._each(words) == [np.array(e.ids, "<u2").tobytes() for e in self.short.encode_batch_fast(words, add_special_tokens=False)]
        # lower-casing first must change nothing either
        lower = ["Ab CD,Ef. G'S", "ab cd ,ef . g's"]
        self.lowers = agrees and len(set(self._each(lower))) == 1
        if not agrees:
            self.short = self.tokenizer
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache_entries = cache_entries
        self._keep(np.zeros(0, bool))

    @classmethod
    def of(cls, path: str, cache_entries: int = 700_000) -> WordEncoder:
        if path not in cls._open:
            cls._open[path] = cls(path, cache_entries)
        return cls._open[path]

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> dict[str, bytes]:
        """Ids of lower-case words of letters only: encoded in one text and parted at the pieces that end a word."""
        groups = [words[k : k + 50] for k in range(0, len(words), 50)]
        out: dict[str, bytes] = {}
        for group, e in zip(groups, self.short.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u2")
            raw, cuts = ids.tobytes(), (2 * np.flatnonzero(self.ends[ids]) + 2).tolist()
            parted = [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)] if len(cuts) == len(group) else self._each(group)
            out.update(zip(group, parted, strict=True))
        return out

    def _keep(self, which: np.ndarray) -> None:
        """Forget all other words. The cache: words, their ids one after the other, first and number of ids, whether asked for since."""
        if not len(which):
            self.words, self.ids = pa.array([], pa.large_string()), np.zeros(0, "<u2")
            self.first, self.size, self.used = np.zeros(0, "i4"), np.zeros(0, "i4"), np.zeros(0, bool)
            return
        self.ids = self.ids[_ragged(self.size[which], self.first[which])]
        self.words, self.size = self.words.filter(pa.array(which)), self.size[which]
        self.first = np.cumsum(self.size, dtype="i4") - self.size
        self.used = np.zeros(len(self.size), bool)

    def _learn(self, words: pa.Array) -> None:
        names = words.to_pylist()
        out: dict[str, bytes] = {}
        plain, tailed, rest = [], {}, []
        for w in names:
            if len(w) > 64:
                rest.append(w)
            elif w.isalpha() and _plain(w):
                plain.append(w)
            elif (m := _TAILED.fullmatch(w)) and _plain(m[1]):
                tailed[w] = m.groups()
            else:
                rest.append(w)
        plain.extend({s for s, _ in tailed.values()}.difference(plain))
        for at in range(0, len(plain), 20_000):
            out.update(self._together(plain[at : at + 20_000]))
        for at in range(0, len(rest), 20_000):
            out.update(zip(rest[at : at + 20_000], self._each(rest[at : at + 20_000]), strict=True))
        tails = list({t for _, t in tailed.values()})
        tail = dict(zip(tails, self._each(tails), strict=True))
        out.update({w: out[s] + tail[t] for w, (s, t) in tailed.items()})
        parts = [out[w] for w in names]
        size = np.fromiter(map(len, parts), "i4", len(parts)) // 2
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(size, dtype="i4") - size))
        self.size, self.used = np.concatenate((self.size, size)), np.concatenate((self.used, np.zeros(len(size), bool)))
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(parts), "<u2")))
        self.words = pa.concat_arrays([self.words, words])

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """The texts in lower case, with a space between a letter and a full stop or comma, where this changes no id.

        Not where a special token might appear, or a mark compose with a small letter that it does not with a capital.
        """
        lower = pc.ascii_lower(texts)
        odd = [pc.match_substring(lower, s) for s in self.special]
        data, bounds = text_buffer(texts)
        if ((data[bounds[0] : bounds[-1]] & 0xFE) == 0xCC).any():
            odd.append(pc.match_substring_regex(texts, "[\u0300-\u036f]"))
        lower = pc.replace_substring_regex(lower, pattern="([a-z])([.,])", replacement=r"\1 \2")
        for mask in odd:
            if pc.any(mask).as_py():
                lower = pc.if_else(mask, texts, lower)
        return lower

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and n + 1 bounds into them."""
        # a copy that begins at its buffer's first byte: Arrow's kernels misread some slices
        data, starts = text_buffer(texts)
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(starts - starts[0]), pa.py_buffer(data[starts[0] : starts[-1]].tobytes()))
        if self.splits:
            split = pc.ascii_split_whitespace(self._lowered(texts) if self.lowers else texts)
            words, bounds = split.flatten(), np.asarray(split.offsets)
            bounds = bounds - bounds[0]
        else:
            words, bounds = texts, np.arange(len(texts) + 1)
        if not len(words):
            return np.zeros(0, "<u2"), np.zeros(len(texts) + 1, "i8")
        coded = words.dictionary_encode()
        at = np.array(pc.index_in(coded.dictionary, value_set=self.words).fill_null(-1))
        new = np.flatnonzero(at < 0)
        self.used[at[at >= 0]] = True
        if len(new):
            at[new] = len(self.words) + np.arange(len(new))
            self._learn(coded.dictionary.take(pa.array(new)))
        which = at[np.asarray(coded.indices)]
        many = self.size[which]
        ids = self.ids[_ragged(many, self.first[which])]
        if len(self.words) > self.cache_entries:
            # words asked for again, as far as they leave room for new ones; no long ones
            keep = self.used & (pc.binary_length(self.words).to_numpy() <= 64)
            self._keep(keep if keep.sum() <= self.cache_entries // 2 else keep & (np.cumsum(keep) <= self.cache_entries // 2))
        return ids, np.concatenate(([0], np.cumsum(many, dtype="i8")))[bounds]


def _plain(word: str) -> bool:
    """Letters in lower case, composed, as tokenizers make them first."""
    return word.islower() and word.isalpha() and (word.isascii() or word == word.lower() == unicodedata.normalize("NFC", word))


def _ragged(size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions first[i], ..., first[i] + size[i] - 1 of all i."""
    total = int(size.sum())
    kind = "i4" if total < 1 << 31 and len(first) and int(first.max()) < 1 << 31 else "i8"
    out = np.repeat((first - (np.cumsum(size, dtype="i8") - size)).astype(kind), size)
    out += np.arange(total, dtype=kind)
    return out


class Statistics:
    """Number, average length and document frequencies of all documents."""

    def __init__(self, n: int, average: float, df: np.ndarray) -> None:
        self.n, self.average = n, max(average, 1.0)
        # a term of more than half of the documents weighs nothing
        self.idf = np.maximum(0.0, np.log((n - df + 0.5) / (df + 0.5)))
        self.common = df >= n / 32

    def weights(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.average))


def counted(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, frequency) of every different term of every document, in this order."""
    keys = np.repeat(np.arange(len(bounds) - 1, dtype="i8") << 16, np.diff(bounds)) | ids.astype("i8")
    keys.sort()
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[new] >> 16, keys[new] & 0xFFFF, np.diff(new, append=len(keys))


class Index:
    """BM25 postings of some documents: common terms in a matrix, others as lists. Documents are given by terms and frequencies."""

    def __init__(self, terms: list[np.ndarray], tf: list[np.ndarray], length: np.ndarray, statistics: Statistics) -> None:
        self.terms, self.statistics = terms, statistics
        size = np.array([len(t) for t in terms])
        owner, term = np.repeat(np.arange(len(terms)), size), np.concatenate(terms).astype("i8")
        weight = statistics.weights(term, np.concatenate(tf).astype("f8"), length[owner].astype("f8"))
        often = statistics.common[term] & (statistics.idf[term] > 0)
        columns = np.unique(term[often])
        self.column = np.full(TERMS, -1)
        self.column[columns] = np.arange(len(columns))
        self.matrix = np.zeros((len(columns), len(terms)), "f4")
        self.matrix[self.column[term[often]], owner[often]] = weight[often]
        rare = np.flatnonzero(~statistics.common[term])
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.owner, self.weight = owner[rare].astype("i4"), weight[rare].astype("f4")
        self.many = np.bincount(term[rare], minlength=TERMS)
        self.first = np.cumsum(self.many) - self.many
        self.kept = np.arange(len(terms))

    def keep(self, positions: np.ndarray) -> None:
        """Score only these documents from now on."""
        place = np.full(len(self.terms), -1)
        place[positions] = np.arange(len(positions))
        now = place[self.kept[self.owner]]
        term = np.repeat(np.arange(TERMS), self.many)[now >= 0]
        self.matrix = np.ascontiguousarray(self.matrix[:, np.isin(self.kept, positions)])
        self.owner, self.weight = now[now >= 0].astype("i4"), self.weight[now >= 0]
        self.many = np.bincount(term, minlength=TERMS)
        self.first = np.cumsum(self.many) - self.many
        self.kept = positions

    def scores(self, documents: np.ndarray) -> np.ndarray:
        """BM25 of every kept document for the terms of each of these."""
        n = len(self.kept)
        size = np.array([len(self.terms[d]) for d in documents])
        seed, term = np.repeat(np.arange(len(documents)), size), np.concatenate([self.terms[d] for d in documents]).astype("i8")
        asked = np.zeros((len(documents), len(self.matrix)), "f4")
        hit = self.column[term] >= 0
        asked[seed[hit], self.column[term[hit]]] = 1
        out = asked @ self.matrix
        hit = self.many[term] > 0
        at = _ragged(self.many[term[hit]], self.first[term[hit]])
        if len(at):
            key = np.repeat(seed[hit], self.many[term[hit]]) * n + self.owner[at]
            out += np.bincount(key, self.weight[at], minlength=out.size).reshape(out.shape).astype("f4")
        return out


def best_first(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, best first, ties by position; scores below 0 are out."""
    if k < len(score):
        among = np.flatnonzero(score >= max(0.0, np.partition(score, len(score) - k)[len(score) - k]))
    else:
        among = np.flatnonzero(score >= 0)
    return among[np.lexsort((among, -score[among]))][:k]


class Shard:
    """Documents (id, ids, terms, frequencies) of one index shard, of each of which what follows `start` is unused."""

    def __init__(self, documents: list[tuple], start: list[int], window: int, statistics: Statistics) -> None:
        self.documents, self.window = documents, window
        self.start = np.array(start, "i8")
        self.length = np.array([len(d[1]) for d in documents], "i8")
        self.index = Index([d[2] for d in documents], [d[3] for d in documents], self.length, statistics)

    def windows(self, sequence: int, floor: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, start, length, sequence, offset) of every piece, as long as `floor` tokens or more are unused.

        With floor 0 all are used, and only then the last window may be short.
        """
        left = self.length - self.start
        offset = 0

        def place(d: int) -> tuple[int, int, int, int, int]:
            nonlocal sequence, offset
            n = int(min(left[d], self.window - offset))
            piece = d, int(self.start[d]), n, sequence, offset
            left[d] -= n
            self.start[d] += n
            offset += n
            if offset == self.window:
                sequence, offset = sequence + 1, 0
            return piece

        while left.sum() >= max(floor, 1):
            free = np.flatnonzero(left)
            if len(free) < 0.7 * len(self.index.kept):
                self.index.keep(free)
            cut, whole = free[self.start[free] > 0], free[self.start[free] == 0]
            seeds = np.concatenate((cut, whole[:: max(1, len(whole) // SEEDS)]))[:SEEDS]
            scores = self.index.scores(seeds)
            for seed, score in zip(seeds.tolist(), scores, strict=True):
                if left.sum() < max(floor, 1):
                    break
                if not left[seed]:
                    continue
                while left[seed] >= self.window:
                    yield place(seed)
                if not left[seed] or left.sum() < floor:
                    continue
                yield place(seed)
                score = np.where(left[self.index.kept] > 0, score, -1)
                k = 32
                while offset:
                    near = self.index.kept[best_first(score, k)]
                    for d in near.tolist():
                        if left[d]:
                            yield place(d)
                            if not offset:
                                break
                    if offset and k >= len(score):  # nothing is left
                        sequence, offset = sequence + 1, 0
                    k *= 8


def fill(documents: Iterator[tuple], window: int, statistics: Statistics, shard_tokens: int, sequence: int = 0) -> Iterator[tuple[tuple, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of the documents, which come in the order of a range."""
    held: list[tuple] = []
    start: list[int] = []
    more = True
    while more:
        tokens = sum(len(d[1]) for d in held) - sum(start)
        while more and tokens < shard_tokens:
            if (d := next(documents, None)) is None:
                more = False
            else:
                held.append(d)
                start.append(0)
                tokens += len(d[1])
        if not held:
            return
        shard = Shard(held, start, window, statistics)
        for d, at, n, number, offset in shard.windows(sequence, max(shard_tokens // 4, window) if more else 0):
            yield held[d], at, n, number, offset
            sequence = number + 1
        unused = np.flatnonzero(shard.start < shard.length).tolist()
        held, start = [held[d] for d in unused], shard.start[unused].tolist()


def encoded(df: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(key, doc_id, ids, length, terms, tf) of every row, the binaries of 16-bit values; keys are unique once written."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key = WordEncoder.of(tokenizer), TaskContext.get().partitionId() << 32
        for b in batches:
            _, sizes = text_buffer(b.column(1))
            for at, stop in slices(sizes, ENCODED_BYTES):
                inner, ends = encoder.encode(b.column(1).slice(at, stop - at))
                for low, high in slices(ends, COUNTED_TOKENS):
                    n, bounds = high - low, ends[low : high + 1] - ends[low]
                    bounds = bounds + np.arange(n + 1)  # each document ends with the end id
                    ids = np.full(bounds[-1], end_id, "<u2")
                    ids[np.delete(np.arange(len(ids)), bounds[1:] - 1)] = inner[ends[low] : ends[high]]
                    owner, term, tf = counted(ids, bounds)
                    cuts = np.searchsorted(owner, np.arange(n + 1))
                    # a frequency beyond 16 bits weighs as much as the largest within
                    columns = [_binaries(ids, bounds), pa.array(np.diff(bounds).astype("i4")), _binaries(term, cuts), _binaries(np.minimum(tf, 0xFFFF), cuts)]
                    yield pa.RecordBatch.from_arrays([pa.array(key + np.arange(n)), b.column(0).slice(at + low, n), *columns], names=["key", "doc_id", "ids", "length", "terms", "tf"])
                    key += n

    return rows.mapInArrow(encode, "key long, doc_id long, ids binary, length int, terms binary, tf binary")


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each document's 16-bit values as one binary."""
    offsets = (2 * bounds).astype("i4" if 2 * int(bounds[-1]) < 1 << 31 else "i8")
    kind = pa.binary() if offsets.dtype == "i4" else pa.large_binary()
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.astype("<u2"))]).cast(pa.binary())


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit values of all rows of a binary column, and n + 1 bounds into them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, "i8")[column.offset : column.offset + len(column) + 1] // 2
    return np.frombuffer(data, "<u2")[bounds[0] : bounds[-1]] if len(column) else np.zeros(0, "<u2"), bounds - bounds[0]


def collection(docs: DataFrame) -> tuple[Statistics, int]:
    """The statistics of all documents (at most 2^16 counts come to the driver), and their tokens."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(TERMS, "i8")
        for b in batches:
            df += np.bincount(_values(b.column(0))[0], minlength=TERMS)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    n, tokens = docs.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    rows = docs.select("terms").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(TERMS, "i8")
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return Statistics(n, tokens / max(n, 1), df), tokens


def ordered(docs: DataFrame, statistics: Statistics, pivots: int, seed: int) -> DataFrame:
    """All columns of `docs` and the order by words: `place`, `place2`, both long."""
    # of about so many documents by hash, so that a task sends few to the driver
    draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 40))
    drawn = docs.where(draw < min(1.0, 8 * pivots / max(statistics.n, 1)) * (1 << 40)).orderBy(draw, "key").limit(4 * pivots).select("terms", "tf", "length").collect()
    different = list({r["terms"]: r for r in drawn}.values())[:pivots]
    columns = np.full(TERMS, -1)
    terms = [np.frombuffer(r["terms"], "<u2") for r in different]
    used = np.unique(np.concatenate([t[statistics.idf[t] > 0] for t in terms])) if terms else np.zeros(0, "i8")
    columns[used] = np.arange(len(used))
    pivot = np.zeros((len(used), len(different)), "f4")
    for k, (r, t) in enumerate(zip(different, terms, strict=True)):
        hit = columns[t] >= 0
        pivot[columns[t[hit]], k] = statistics.weights(t, np.frombuffer(r["tf"], "<u2").astype("f8"), float(r["length"]))[hit]
    hashes = [np.where(statistics.idf > 0, mix(np.arange(TERMS, dtype="u8") * np.uint64(64) + np.uint64(k + 1)) >> np.uint64(1), np.uint64((1 << 63) - 1)) for k in range(2)]
    shared = docs.sparkSession.sparkContext.broadcast((columns, pivot, hashes))
    bits = max(1, (pivots - 1).bit_length())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, pivot, hashes = shared.value
        rows = min(2048, SCORED_NUMBERS // max(1, len(pivot)))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                term, bounds = _values(b.column("terms"))
                n = b.num_rows
                owner, column = np.repeat(np.arange(n), np.diff(bounds)), columns[term]
                has = np.zeros((n, len(pivot)), "f4")
                has[owner[column >= 0], column[column >= 0]] = 1
                score = has @ pivot
                best = np.argsort(-score, axis=1, kind="stable")[:, :PLACES]
                order = np.zeros(n, "i8")
                for k in range(best.shape[1]):
                    order = (order << bits) | best[:, k]
                # every document has a term: the end id
                low = [np.minimum.reduceat(h[term], bounds[:-1]).astype("i8") for h in hashes]
                free = 63 - bits * best.shape[1]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array((order << free) | (low[0] >> (63 - free))), pa.array(low[1])], names=[*b.schema.names, "place", "place2"])

    return docs.mapInArrow(place, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema) + ", place long, place2 long")


def pack(
    df: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, range_tokens: int = RANGE_TOKENS, pivots: int = PIVOTS, seed: int = 17
) -> DataFrame:
    """Pieces of every document, as PIECE_SCHEMA; `ids` holds unsigned little-endian 32-bit values.

    `tokenizer`: path of the tokenizer file on every machine. `shard_tokens`: of one index shard, which a task holds;
    `range_tokens`: of one task. `pivots`: documents drawn, by `seed`, to order all by; the driver holds these only.
    """
    docs = written(encoded(df, tokenizer, end_id), "encoded")
    statistics, tokens = collection(docs)
    shared = df.sparkSession.sparkContext.broadcast(statistics)
    keys = ["place", "place2", F.xxhash64("key"), "key"]
    ranges = max(1, math.ceil(tokens / range_tokens))
    dealt = ordered(docs, statistics, pivots, seed).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select("doc_id", "ids", "terms", "tf")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for doc_id, *binary in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True):
                    yield doc_id, *(np.frombuffer(x, "<u2") for x in binary)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def batch() -> pa.RecordBatch:
            d, start, length, sequence, offset = zip(*found, strict=True)
            ids = [x[1][a : a + n].astype("<u4").tobytes() for x, a, n in zip(d, start, length, strict=True)]
            columns = [[x[0] for x in d], start, length, ids, [len(x[1]) for x in d], sequence, offset]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if c is ids else pa.int64()) for c in columns], names=[f.split()[0] for f in PIECE_SCHEMA.split(", ")])

        for piece in fill(documents(batches), window, shared.value, shard_tokens, TaskContext.get().partitionId() << 32):
            found.append(piece)
            if len(found) == 1000:
                yield batch()
                found.clear()
        if found:
            yield batch()

    return dealt.mapInArrow(pieces, PIECE_SCHEMA)
