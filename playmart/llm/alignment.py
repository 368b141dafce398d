"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A text is encoded with a space in front of it by a byte-level tokenizer (A) and as it is by a sentencepiece model (B), which
adds that space itself. Wherever a token of A and one of B both end, the text is cut; tokens of a group are linked, all of
A's with all of B's. Counts of linked id pairs are numbers of documents.

The character spans that both libraries give are the coarse cuts. Tokens that end inside a character (byte-level halves of it,
byte-fallback tokens) have no end among characters: where both sides have such tokens between two coarse cuts, their decoded
bytes refine the group. Texts are split at spaces that no token of either side crosses, so a segment is encoded and aligned
once for a worker; its result is kept in a bounded store.

Pairs and how often a document links them are written once. Their document counts are one aggregation. A pair that one document
alone holds counts 1, so the table of the others is sent to all tasks where it is small (`max_pairs`); else pairs are joined.

Defined cases: texts that are null, empty, or that a tokenizer does not give back byte by byte have no tokens: zeros and an
empty string; special strings are plain text; repeated rows count as documents of their own; extra columns are left out. A text
without a safe boundary is aligned whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .shingles import slices, text_buffer

SPACE_MARK = "▁"
#: A space that begins a new word for both tokenizers: the only one in its place, before a character that is no white space.
BOUNDARY = re.compile(f"(?<=[^ {SPACE_MARK}]) (?=[^\\s{SPACE_MARK}])")
#: A space beside such a segment would be no boundary.
_ALONE = re.compile(f"{SPACE_MARK}|^\\s| $|^$")
_ODD = re.compile(f"{SPACE_MARK}| \\s|^ | $")
#: Segments and their characters that a worker keeps, bytes of text aligned at once, characters encoded at once, counted pairs
#: that a task may hold.
KEPT, KEPT_CHARS, SLICE_BYTES, TOGETHER, MAX_PAIRS = 300_000, 1 << 25, 1 << 20, 1024, 4_000_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _common(x: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the numbers from 0 to `size` in each array are in the other, too; numbers below 0 are in none."""
    marked = [np.zeros(size + 1, bool) for _ in range(2)]
    for into, keys in zip(marked, (x, y), strict=True):
        into[keys] = True  # -1 marks the last place, which is no key
    both = marked[0] & marked[1]
    both[size] = False
    return both[x], both[y]


def _runs(texts: list[str], alone: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts to encode together, of bounded size; each of the last `alone` texts by itself."""
    side_by_side = len(texts) - alone
    sizes = np.cumsum([0, *(len(t) + 1 for t in texts[:side_by_side])])
    yield from slices(sizes, TOGETHER)
    yield from ((k, k + 1) for k in range(side_by_side, len(texts)))


class Aligner:
    """Both tokenizers and the segments aligned so far."""

    _open: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = byte_letters()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [bytes(letters[c] for c in t) if (t := entries.get(i)) is not None and all(c in letters for c in t) else b"" for i in range(self.a.get_vocab_size())]
        n = self.b.vocab_size()
        self.is_byte = np.array([self.b.is_byte(i) for i in range(n)])
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace(SPACE_MARK, " ").encode() for p, byte in zip(pieces, self.is_byte, strict=True)]
        normal = (p for i, p in enumerate(pieces) if not (self.is_byte[i] or self.b.is_control(i) or self.b.is_unknown(i)))
        self.sizes = [np.fromiter(map(len, table), "i8", len(table)) for table in (self.a_bytes, self.b_bytes)]
        # an id after nothing, a new group, the other side, another token of its group
        self.marks = [f"{mark}{i}".encode() for i in range(max(len(self.a_bytes), n)) for mark in ("", ";", "|", ",")]
        self.mark_sizes = np.fromiter(map(len, self.marks), "i8", len(self.marks))
        self.splits = all(set(p) == {SPACE_MARK} or SPACE_MARK not in p[1:] for p in normal)
        self.forget()

    @classmethod
    def of(cls, a: str, b: str) -> Aligner:
        if (a, b) not in cls._open:
            cls._open[a, b] = cls(a, b)
        return cls._open[a, b]

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.strings: list[bytes] = []
        self.counts = np.zeros((0, 5), "i8")  # COUNTS, and 1 where the bytes are not given back
        self.pairs, self.bounds = np.zeros(0, "i8"), np.zeros(1, "i8")
        self.held_by = np.zeros(0, "i8")  # documents so far, since last forgotten

    def forget_rare(self) -> None:
        """Keeps the segments that most documents held, half of the store at most."""
        least = 2
        while len(keep := np.flatnonzero(self.held_by >= least)) > KEPT // 2:
            least *= 2
        words, at = list(self.known), keep.tolist()
        size = np.diff(self.bounds)[keep]
        begins = np.cumsum(size) - size
        self.pairs = self.pairs[np.repeat(self.bounds[keep] - begins, size) + np.arange(size.sum())]
        self.bounds = np.concatenate(([0], np.cumsum(size)))
        self.strings, self.counts = [self.strings[i] for i in at], self.counts[keep]
        self.known = {words[i]: k for k, i in enumerate(at)}
        self.chars = sum(map(len, self.known))
        self.held_by = np.zeros(len(at), "i8")

    def spans(self, texts: list[str]) -> list[dict]:
        """Ids and character spans of sentencepiece's tokens: an offset mapping, or the older library's immutable protos."""
        if hasattr(self.b, "EncodeAsOffsetMapping"):
            return self.b.EncodeAsOffsetMapping(texts, num_threads=1)
        protos = self.b.encode(texts, out_type="immutable_proto", num_threads=1)
        return [{"ids": [p.id for p in x.pieces], "offsets": [(p.begin, p.end) for p in x.pieces]} for x in protos]

    def segments(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        return BOUNDARY.split(text) if _ODD.search(text) else text.split(" ")

    def encoded(self, texts: list[str], alone: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Of both sides (text, id, first, last character) of every token of the texts, each with a space in front.

        Characters are counted from that space on. Texts are encoded together, but for the last `alone` ones.
        """
        found: tuple[list, list] = ([], [])
        for first, last in _runs(texts, alone):
            joined = " ".join(texts[first:last])
            starts = np.cumsum([0, *(len(t) + 1 for t in texts[first : last - 1])])
            e, (p,) = self.a.encode(f" {joined}", add_special_tokens=False), self.spans([joined])
            # spans of B leave out the space in front
            for side, ids, offsets, more in ((found[0], e.ids, e.offsets, 0), (found[1], p["ids"], p["offsets"], 1)):
                span = np.fromiter(chain.from_iterable(offsets), "i8", 2 * len(ids)).reshape(-1, 2) + more
                of = np.searchsorted(starts, span[:, 0], "right") - 1
                side.append((of + first, np.array(ids, "i8"), span[:, 0] - starts[of], span[:, 1] - starts[of]))
        return tuple(tuple(np.concatenate(x) for x in zip(*side, strict=True)) for side in found)

    def learn(self, new: list[str]) -> None:
        """Aligns segments, each with a space in front."""
        if alone := set(filter(_ALONE.search, new)):
            new = [*(w for w in new if w not in alone), *alone]
        sides = self.encoded(new, len(alone))
        ok = self._given_back(new, sides)
        (seg_a, a, begins_a, ends_a), (seg_b, b, begins_b, ends_b) = (tuple(x[ok[side[0]]] for x in side) for side in sides)
        len_a, len_b = (np.bincount(seg, minlength=len(new)) for seg in (seg_a, seg_b))
        follows = np.concatenate((seg_a[1:] == seg_a[:-1], [False]))[: len(a)]
        clean_a = ~(follows & (np.concatenate((begins_a[1:], [0]))[: len(a)] < ends_a))
        clean_b = ~(self.is_byte[b] & (begins_b == ends_b))
        base = 2 + int(max(ends_a.max(initial=0), ends_b.max(initial=0)))
        cut_a, cut_b = _common(np.where(clean_a, seg_a * base + ends_a, -1), np.where(clean_b, seg_b * base + ends_b, -1), len(new) * base)
        self._refine(a, b, cut_a, cut_b, clean_a, clean_b)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n = int(cut_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        seg_of = seg_a[cut_a]
        many = in_b[group_a]
        of = np.repeat(np.arange(len(a)), many)
        pairs = a[of] * len(self.b_bytes) + b[(np.cumsum(in_b) - in_b)[group_a[of]] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)]
        n_links = np.bincount(seg_of, weights=in_a * in_b, minlength=len(new)).astype("i8")
        counts = np.stack((len_a, len_b, np.bincount(seg_of, minlength=len(new)), n_links, ~ok), axis=1).astype("i8")
        self.known.update(zip(new, range(len(self.strings), len(self.strings) + len(new)), strict=True))
        self.strings += self._written_out(a, b, group_a, group_b, seg_a, seg_b, len(new))
        self.chars += sum(map(len, new))
        self.counts = np.concatenate((self.counts, counts))
        self.pairs = np.concatenate((self.pairs, pairs))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(n_links)))

    def _given_back(self, texts: list[str], sides: tuple[tuple[np.ndarray, ...], ...]) -> np.ndarray:
        """Whether both sides' decoded bytes are a text's."""
        whole = [f" {t}".encode() for t in texts]
        ok = np.ones(len(texts), bool)
        for (seg, ids, *_), table, sizes in zip(sides, (self.a_bytes, self.b_bytes), self.sizes, strict=True):
            decoded = list(map(table.__getitem__, ids.tolist()))
            if b"".join(decoded) == b"".join(whole):
                # all together are the texts; each is its own text where its tokens are as long
                ok &= np.bincount(seg, weights=sizes[ids], minlength=len(texts)) == np.fromiter(map(len, whole), "i8", len(whole))
            else:
                at = np.searchsorted(seg, np.arange(len(texts) + 1)).tolist()
                ok &= np.array([b"".join(decoded[i:j]) == t for i, j, t in zip(at, at[1:], whole, strict=False)], bool)
        return ok

    def _written_out(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, seg_a: np.ndarray, seg_b: np.ndarray, n: int) -> list[bytes]:
        """The groups of each segment as text: every token's id with the mark that stands before it."""
        kinds = []
        for group, seg, first in ((group_a, seg_a, 1), (group_b, seg_b, 2)):
            begins = np.concatenate((np.ones(min(1, len(group)), bool), group[1:] != group[:-1]))
            opens = np.concatenate((np.ones(min(1, len(seg)), bool), seg[1:] != seg[:-1]))
            kinds.append(np.where(begins, 0 if first == 1 else 2, 3))
            if first == 1:
                kinds[0] = np.where(begins & ~opens, 1, kinds[0])
        code = np.concatenate((a, b)) * 4 + np.concatenate(kinds)
        order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
        code, seg = code[order], np.concatenate((seg_a, seg_b))[order]
        ends = np.concatenate(([0], np.cumsum(self.mark_sizes[code])))
        at = ends[np.searchsorted(seg, np.arange(n + 1))].tolist()
        every = b"".join(map(self.marks.__getitem__, code.tolist()))
        return [every[i:j] for i, j in zip(at, at[1:], strict=False)]

    def _refine(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, clean_a: np.ndarray, clean_b: np.ndarray) -> None:
        """Adds the cuts inside characters: both sides' tokens between two coarse cuts, by their decoded bytes."""
        last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        broken = np.add.reduceat(~clean_a, np.concatenate(([0], last_a[:-1] + 1))) if len(a) else np.zeros(0)
        broken = broken * (np.add.reduceat(~clean_b, np.concatenate(([0], last_b[:-1] + 1))) if len(b) else np.zeros(0))
        for g in np.flatnonzero(broken):
            x = np.arange(last_a[g - 1] + 1 if g else 0, last_a[g] + 1)
            y = np.arange(last_b[g - 1] + 1 if g else 0, last_b[g] + 1)
            at_a = np.cumsum([len(self.a_bytes[i]) for i in a[x].tolist()])
            at_b = np.cumsum([len(self.b_bytes[i]) for i in b[y].tolist()])
            cut_a[x] = np.isin(at_a, at_b)
            cut_b[y] = np.isin(at_b, at_a)

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For texts: COUNTS, groups' digests, and the pairs of each text (its number, pair, how often)."""
        parts = [self.segments(t) if t else [] for t in texts]
        if len(self.known) > KEPT or self.chars > KEPT_CHARS:
            self.forget_rare()
            if self.chars > KEPT_CHARS // 2:
                self.forget()
        new = list(set().union(*parts).difference(self.known))
        for start, stop in slices(np.cumsum([0, *map(len, new)]), SLICE_BYTES):
            self.learn(new[start:stop])
        get = self.known.__getitem__
        ids = [list(map(get, p)) for p in parts]
        size = np.array(list(map(len, ids)), "i8")
        flat, doc = np.fromiter(chain.from_iterable(ids), "i8", int(size.sum())), np.repeat(np.arange(len(texts)), size)
        counts = np.zeros((len(texts), 5), "i8")
        some = np.flatnonzero(size)
        if len(some):
            counts[some] = np.add.reduceat(self.counts[flat], (np.cumsum(size) - size)[some], axis=0)
        lost = counts[:, 4] > 0
        counts[lost] = 0
        digests = [self._digest(x) if x and not gone else "" for x, gone in zip(ids, lost.tolist(), strict=True)]
        keys, times = np.unique((doc * len(self.strings) + flat)[~lost[doc]], return_counts=True)
        of, seg = np.divmod(keys, max(1, len(self.strings)))
        held_by = np.bincount(seg, minlength=len(self.strings))
        held_by[: len(self.held_by)] += self.held_by
        self.held_by = held_by
        many = self.bounds[seg + 1] - self.bounds[seg]
        at = np.repeat(self.bounds[seg], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        top = len(self.a_bytes) * len(self.b_bytes)
        both = np.repeat(of, many) * top + self.pairs[at]
        order = np.argsort(both, kind="stable")
        both, weight = both[order], np.repeat(times, many)[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(both)), bool), both[1:] != both[:-1])))
        of, pair = np.divmod(both[first], top)
        return counts[:, :4], digests, of, pair, np.add.reduceat(weight, first) if len(first) else np.zeros(0, "i8")

    def _digest(self, ids: list[int]) -> str:
        out = hashlib.sha256()
        get = self.strings.__getitem__
        for start in range(0, len(ids), 50_000):
            out.update((b";" if start else b"") + b";".join(map(get, ids[start : start + 50_000])))
        return out.hexdigest()


def aligned(df: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row; a pair is A's id times B's vocabulary plus B's id."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(a, b)
        for batch in batches:
            _, bounds = text_buffer(batch.column(1))
            for start, stop in slices(bounds, SLICE_BYTES):
                counts, digests, of, pair, times = aligner.align(batch.column(1).slice(start, stop - start).to_pylist())
                places = pa.array(np.searchsorted(of, np.arange(stop - start + 1)).astype("i4"))
                columns = [batch.column(0).slice(start, stop - start), *(pa.array(np.ascontiguousarray(c)) for c in counts.T), pa.array(digests, pa.string())]
                columns += [pa.ListArray.from_arrays(places, pa.array(pair)), pa.ListArray.from_arrays(places, pa.array(times.astype("i4")))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *COUNTS, "groups_sha256", "pairs", "times"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(made, f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, pairs array<long>, times array<int>")


def _looked_up(rows: DataFrame, repeated: DataFrame, best: DataFrame, b_size: int) -> DataFrame:
    """n_best and count_sum of rows, by tables that every task holds: counts beyond 1, and the largest count of each id of A."""
    table = repeated.toArrow()
    order = np.argsort(table.column("pair").to_numpy())
    top = best.toArrow()  # as many rows as A has ids at most
    most = np.zeros(int(max(top.column("a").to_numpy(), default=0)) + 1, "i8")
    most[top.column("a").to_numpy()] = top.column("most").to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast((table.column("pair").to_numpy()[order], table.column("n").to_numpy()[order], most))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, most = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                pairs, times = part.column("pairs"), part.column("times")
                size = pairs.value_lengths().to_numpy()
                pair, weight = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype("i8")
                at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
                count = np.where(keys[at] == pair, n[at], 1) if len(keys) else np.ones(len(pair), "i8")
                is_best = (count == most[pair // b_size]) * weight
                doc = np.repeat(np.arange(part.num_rows), size)
                sums = [np.zeros(part.num_rows, "i8") for _ in range(2)]
                np.add.at(sums[0], doc, is_best)
                np.add.at(sums[1], doc, count * weight)
                columns = [part.column(c) for c in ("id", *COUNTS, "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], names=["id", *COUNTS, "groups_sha256", "n_best", "count_sum"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(found, f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, n_best long, count_sum long")


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum of rows by joining each pair of a document with its count."""
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    judged = counts.withColumn("most", F.max("n").over(Window.partitionBy("a")))
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    weighed = each.join(judged, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    both = rows.join(weighed, "row", "left")
    return both.select("id", *COUNTS, "groups_sha256", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")))


def align(df: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    `a`: path of a byte-level tokenizer, `b`: of a sentencepiece model with byte fallback, on every machine. `max_pairs`: up to
    so many id pairs of more than one document are sent to all tasks (16 bytes each).
    """
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b).vocab_size()
    rows = written(aligned(df, a, b, id_col, text_col), "alignment")
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("a", F.floor(F.col("pair") / b_size).cast("int")), "alignment-pairs")
    repeated = counts.where(F.col("n") > 1)
    if repeated.count() <= max_pairs:
        out = _looked_up(rows, repeated.select("pair", "n"), counts.groupBy("a").agg(F.max("n").alias("most")), b_size)
    else:
        out = _joined(rows, counts)
    return out.select(F.col("id").alias(id_col), *COUNTS, "n_best", "count_sum", "groups_sha256")
