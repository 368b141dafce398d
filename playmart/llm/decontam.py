"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are candidates when the runs of `MIN_MATCH` words they share could cover
`COVERAGE` of the item. On candidates, running Karp-Rabin finds common runs of unmarked words; the longest
are marked as tiles again and again until none of MIN_MATCH words is left. Tiles do not overlap and need no
order, so reordered passages count. A document leaks an item when its tiles cover at least COVERAGE of the
item's words.

Defined cases: null and empty texts leak nothing; null or empty items, and items of fewer than MIN_MATCH words,
are leaked by nobody; items with equal texts are each reported; repeated rows, and rows without an id, are judged alike by
their text. Words are lower-cased runs of letters, marks and digits of any script, or single characters of scripts written
without spaces. Extra columns stay as they are, whatever their names. Empty tables give no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh
from .shingles import mix, shingle_hashes, slices, text_buffer, word_hashes

_U = np.uint64
MIN_MATCH = 4
COVERAGE = 0.5
#: Benchmarks up to this many bytes of text are broadcast; larger ones are joined (`leaks_by_join`).
MAX_BROADCAST_BYTES = 32 << 20
CHUNK_BYTES = 2 << 20
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
LEAK = "item_id long, coverage double, tiles int, longest int"


class _Words:
    """Word hashes with running sums, so that a window of any length has its rolling hash at once, and marks of what is used."""

    def __init__(self, words: np.ndarray, busy: np.ndarray) -> None:
        self.words, self.busy = words, busy
        self.up, self.down = (np.concatenate((np.ones(1, _U), np.multiply.accumulate(np.full(len(words), base, _U)))) for base in (_BASE, _BASE_INVERSE))
        self.sums = np.concatenate((np.zeros(1, _U), np.cumsum(words * self.up[:-1], dtype=_U)))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the unused windows of a length."""
        if len(self.words) < length:
            return np.zeros(0, "i8"), np.zeros(0, _U)
        used = np.concatenate(([0], np.cumsum(self.busy)))
        at = np.flatnonzero(used[length:] == used[:-length])
        return at, mix((self.sums[at + length] - self.sums[at]) * self.down[at])


def _shared(item: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document's words that lie in a window of `least` words of the item's, their places, and which of them are gaps."""
    sides = [_Words(x, np.zeros(len(x), bool)) for x in (item, doc)]
    hashes = [x.windows(least)[1] for x in sides]
    inside = np.zeros(len(doc) + 1, "i8")
    hit = np.flatnonzero(np.isin(hashes[1], hashes[0]))
    np.add.at(inside, hit, 1)
    np.add.at(inside, hit + least, -1)
    places = np.flatnonzero(np.cumsum(inside)[:-1])
    breaks = np.flatnonzero(np.diff(places) > 1) + 1
    words, at = np.insert(doc[places], breaks, _U(0)), np.insert(places, breaks, -1)
    return words, at, at < 0


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in item, start in document) of two arrays of word hashes: the longest first, of those the
    earliest in the item, then in the document.

    The longest length with a window that both have unused is found by halving, as a longer common window holds shorter ones.
    Its windows are then taken in order; a window that is used once stays used, so that each is looked at once, however
    often words repeat.
    """
    words, places, gaps = _shared(item, doc, least)
    a, b = _Words(item, np.zeros(len(item), bool)), _Words(words, gaps.copy())
    out: list[tuple[int, int, int]] = []

    def common(length: int) -> tuple[np.ndarray, ...] | None:
        (i_at, i_hash), (d_at, d_hash) = a.windows(length), b.windows(length)
        both = np.isin(d_hash, i_hash)
        return (i_at, i_hash, d_at[both], d_hash[both]) if both.any() else None

    longest = min(len(item), len(words))
    while longest >= least:
        low, high, best = least, longest, None
        while low <= high:
            middle = (low + high + 1) // 2
            if found := common(middle):
                best, low = (middle, found), middle + 1
            else:
                high = middle - 1
        if best is None:
            break
        length, (i_at, i_hash, d_at, d_hash) = best
        order = np.argsort(d_hash, kind="stable")
        d_at, d_hash = d_at[order], d_hash[order]
        first, last = (np.searchsorted(d_hash, i_hash, side).tolist() for side in ("left", "right"))
        starts = d_at.tolist()
        after: dict[int, int] = {}  # of each hash, its first window that may be unused
        taken = len(out)
        free_a = 0  # first place of the item behind the last tile
        for i, low, high in zip(i_at.tolist(), first, last, strict=True):
            if low == high or i < free_a:
                continue
            k = after.get(low, low)
            while k < high and b.busy[starts[k] : starts[k] + length].any():
                k += 1
            after[low] = k
            if k == high:
                continue
            d = starts[k]
            if not np.array_equal(item[i : i + length], words[d : d + length]):
                after[low] = k + 1  # equal hashes of different words
                continue
            a.busy[i : i + length] = b.busy[d : d + length] = True
            free_a = i + length
            out.append((length, i, int(places[d])))
        longest = length if len(out) > taken else length - 1
    return out


class Benchmark:
    """Items as word hashes, and their seeds in order of hash."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        data, bounds = text_buffer(pa.array(texts, pa.large_string()))
        words, owner, _ = word_hashes(data, bounds)
        self.ids = ids
        self.items = [words[owner == i] for i in range(len(ids))]
        seeds, cuts = shingle_hashes(data, bounds, MIN_MATCH)
        item = np.repeat(np.arange(len(ids)), np.diff(cuts))
        place = np.arange(len(seeds)) - cuts[item]
        enough = np.array([len(w) >= MIN_MATCH for w in self.items], bool)[item] if len(ids) else np.zeros(0, bool)
        order = np.argsort(seeds[enough], kind="stable")
        self.seeds, self.item, self.place = (x[enough][order] for x in (seeds, item, place))
        self.unique, self.first = np.unique(self.seeds, return_index=True)
        self.many = np.diff(np.append(self.first, len(self.seeds)))

    def candidates(self, doc: np.ndarray, seeds: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) whose shared seeds could cover enough of the item."""
        if not len(self.unique):
            return []
        at = np.minimum(np.searchsorted(self.unique, seeds), len(self.unique) - 1)
        hit = np.flatnonzero(self.unique[at] == seeds)
        if not hit.size:
            return []
        at, doc = at[hit], doc[hit]
        many = self.many[at]
        entry = np.repeat(self.first[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found = np.unique(np.stack([np.repeat(doc, many), self.item[entry], self.place[entry]], axis=1), axis=0)
        new = np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))
        step = np.minimum(np.append(found[1:, 2] - found[:-1, 2], MIN_MATCH), MIN_MATCH)
        step[np.append(new[1:], True)] = MIN_MATCH
        group = np.cumsum(new) - 1
        covered = np.bincount(group, step)
        pairs = found[new][:, :2]
        return [(int(d), int(i)) for (d, i), c in zip(pairs, covered, strict=True) if c >= COVERAGE * len(self.items[i])]

    def leak(self, item: int, words: np.ndarray) -> dict | None:
        found = tiles(self.items[item], words, MIN_MATCH)
        coverage = sum(t[0] for t in found) / len(self.items[item])
        if coverage < COVERAGE:
            return None
        return {"item_id": self.ids[item], "coverage": coverage, "tiles": len(found), "longest": max(t[0] for t in found)}


def _leaks_of(benchmark: Benchmark, data: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
    seeds, cuts = shingle_hashes(data, bounds, MIN_MATCH)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(cuts))
    for d, item in benchmark.candidates(doc, seeds):
        words, _, _ = word_hashes(data, bounds[d : d + 2])
        if found := benchmark.leak(item, words):
            out[d].append(found)
    return out


def _small(benchmark: DataFrame) -> bool:
    return (benchmark.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) <= MAX_BROADCAST_BYTES


def with_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", keep_text: bool = True, into: str = "leaks") -> DataFrame:
    """All columns of `df` and `into`: the benchmark items each row's text leaks. Needs a benchmark of bounded size."""
    if not _small(benchmark):
        raise ValueError("the benchmark is too large to broadcast; use leaks_by_join")
    rows = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", F.lower("text")).orderBy("item_id").collect()
    shared = df.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
    kept = [c for c in df.columns if c != into and (keep_text or c != text_col)]
    # columns go by number meanwhile, as their names may hold dots
    numbered = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    of = {c: f"c{k}" for k, c in enumerate(df.columns)}
    source = numbered.select(*(of[c] for c in kept), F.lower(of[text_col]).alias("lower"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("leaks", T.ArrayType(T.StructType.fromDDL(LEAK)))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32()), ("longest", pa.int32())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Benchmark(*shared.value)
        for b in batches:
            last = b.num_columns - 1
            data, bounds = text_buffer(b.column(last))
            leaks: list[list[dict]] = []
            for start, stop in slices(bounds, CHUNK_BYTES):
                leaks.extend(_leaks_of(items, data, bounds[start : stop + 1]))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(last)), pa.array(leaks, kind)], names=schema.names)

    return source.mapInArrow(found, schema).toDF(*kept, into)


def _digest() -> Column:
    return F.md5(F.lower("text").cast("binary"))


def _found_by_join(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(digest, item, coverage, tiles, longest) of every different text of `df` and of the items, named by their digests."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_buffer(b.column(1))
            for start, stop in slices(bounds, CHUNK_BYTES):
                found, cuts = shingle_hashes(data, bounds[start : stop + 1], MIN_MATCH)
                _, owner, _ = word_hashes(data, bounds[start : stop + 1])
                words = np.bincount(owner, minlength=stop - start)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, stop - start), pa.array(words), pa.ListArray.from_arrays(cuts.astype("i4"), found.view("i8"))], names=["digest", "words", "seeds"]
                )

    def seeded(table: DataFrame) -> DataFrame:
        rows = table.where(F.col("text").isNotNull()).select(_digest().alias("digest"), F.lower("text"))
        return rows.mapInArrow(seeds, "digest string, words long, seeds array<long>").where(F.col("words") >= MIN_MATCH)

    items = seeded(benchmark).dropDuplicates(["digest"]).select(F.col("digest").alias("item"), "words", F.posexplode("seeds").alias("place", "seed"))
    docs = seeded(df).select("digest", F.explode(F.array_distinct("seeds")).alias("seed")).distinct()
    # as Benchmark.candidates: how much of the item its places in common could cover
    after = F.lead("place").over(Window.partitionBy("digest", "item").orderBy("place")) - F.col("place")
    met = docs.join(items, "seed").select("digest", "item", "words", F.least(F.coalesce(after, F.lit(MIN_MATCH)), F.lit(MIN_MATCH)).alias("step"))
    pairs = met.groupBy("digest", "item").agg(F.sum("step").alias("covered"), F.max("words").alias("words")).where(F.col("covered") >= COVERAGE * F.col("words")).select("digest", "item")

    def texts(table: DataFrame, name: str, text: str) -> DataFrame:
        rows = table.select(_digest().alias(name), F.lower("text").alias(text))
        return rows.join(pairs.select(name).distinct(), name, "left_semi").dropDuplicates([name])

    full = pairs.join(texts(df, "digest", "text"), "digest").join(texts(benchmark, "item", "item_text"), "item")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for digest, item, text, item_text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data, bounds = text_buffer(pa.array([text], pa.large_string()))
                words, _, _ = word_hashes(data, bounds)
                if leak := Benchmark([0], [item_text]).leak(0, words):
                    out.append({"digest": digest, "item": item} | leak)
            kind = [("digest", pa.string()), ("item", pa.string()), ("coverage", pa.float64()), ("tiles", pa.int32()), ("longest", pa.int32())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(kind))

    return full.select("digest", "item", "text", "item_text").mapInArrow(judged, "digest string, item string, coverage double, tiles int, longest int")


def leaks_by_join(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, longest) for benchmarks of any size; each row is judged by its own text, as in `leaks`."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    found = _found_by_join(df, items)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"))
    named = items.select(F.col("item_id").cast("long").alias("item_id"), _digest().alias("item"))
    return rows.join(found, "digest").join(named, "item").select("doc_id", "item_id", "coverage", "tiles", "longest")


def leaks(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, longest) of every leak."""
    if not _small(benchmark):
        return leaks_by_join(df, benchmark)
    found = with_leaks(df.select("doc_id", "text"), benchmark, keep_text=False)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def remove_leaks(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `df` that leak no benchmark item."""
    if _small(benchmark):
        into = fresh(df, "leaks")
        return with_leaks(df, benchmark, into=into).where(F.size(into) == 0).drop(into)
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    name = fresh(df, "digest")
    gone = _found_by_join(df, items).select(F.col("digest").alias(name)).distinct()
    return df.withColumn(name, _digest()).join(gone, name, "left_anti").drop(name)
