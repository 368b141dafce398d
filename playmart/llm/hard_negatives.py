"""Hard negatives through an inverted multi-index: exact first rows of score windows, found cell by cell.

Component x counts as floor(x * scale). A codebook for each half of the vectors, fitted on a bounded sample, puts every row
into the cell of its two nearest code words. The half score of an anchor with all rows of a code word is bounded by its
product with the word plus its own length times the word's radius, so that a cell is bounded by the sum of its two halves.
A heap visits the pairs of code words by descending bound (multi-sequence); single cells are bounded once more by their own
radii. A first round reads the best cells of each anchor and so learns how good its first rows are at least; the second
visits what the first left, down to the last cell whose bound reaches that score: everything beyond is certified not to count.

First come the positives (the best rows of the anchor's label), then the windows that their scores open for rows of other
labels. Anchors are sent to the cells, rows stay in theirs; a cell with many rows is dealt into chunks.

Defined cases: rows with a null id or label, a null vector, or a component that is null, not finite, or beyond doubles once
scaled take no part; shorter vectors count as filled up with zeros; of repeated rows each takes part, and an anchor leaves
out its own row only; ties go to the smaller id. Scores beyond 64 bits count as the largest or smallest 64-bit value. Fewer
rows than asked for: all of them. Extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Code words for each half (cells: their square), rows on which the codebooks are fitted, and rounds of fitting.
CODE_WORDS, FIT_ROWS, FIT_ROUNDS = 16, 8192, 8
#: Bytes of a cell's vectors that a task holds (anchors are copied to each such chunk, so that large ones save shuffle), scores
#: computed at once, rows that an anchor's first round reads at least.
CHUNK_BYTES, SCORES, FIRST_ROWS = 1 << 25, 1 << 21, 1024
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
ASK = "row long, anchor_id long, label int, v binary, tags array<long>, lows array<long>, highs array<long>"


@dataclass
class Directory:
    """Codebooks of both halves, and of every cell its rows, chunks and the radii of its halves."""

    books: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    chunks: np.ndarray
    radii: tuple[np.ndarray, np.ndarray]

    def cells(self, q: np.ndarray, floor: float, ceiling: float) -> Iterator[int]:
        """Cells with rows that may score `floor` to `ceiling`, by descending bound of their code words."""
        half = self.books[0].shape[1]
        halves = (q[:half], q[half:])
        length = [math.sqrt(float(x @ x)) for x in halves]
        middle = [book @ x for book, x in zip(self.books, halves, strict=True)]
        own = [n * r for n, r in zip(length, self.radii, strict=True)]
        center = middle[0][:, None] + middle[1][None, :]
        reach = own[0] + own[1]
        # more than the roundings of all these products can come to
        slack = 1.0 + 1e-9 * (sum(length) * (sum(float(np.abs(b).max(initial=0.0)) for b in self.books) * half + sum(float(r.max(initial=0.0)) for r in self.radii)))
        with np.errstate(invalid="ignore", over="ignore"):
            upper, lower = (np.where(np.isfinite(center) & np.isfinite(reach), center + s * (reach + slack), s * np.inf) for s in (1, -1))
            wide = [np.nan_to_num(m + o.max(axis=1 - k), nan=np.inf, posinf=np.inf, neginf=np.inf) + slack for k, (m, o) in enumerate(zip(middle, own, strict=True))]
        order = [np.argsort(-w, kind="stable") for w in wide]
        sums = [w[o] for w, o in zip(wide, order, strict=True)]
        heap, seen = [(-(sums[0][0] + sums[1][0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < floor:
                return
            a, b = int(order[0][i]), int(order[1][j])
            if self.rows[a, b] and upper[a, b] >= floor and lower[a, b] <= ceiling:
                yield a * len(self.books[1]) + b
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(order[0]) and y < len(order[1]) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(sums[0][x] + sums[1][y]), x, y))


def fit_book(rows: np.ndarray, words: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Code words by Lloyd's rounds from rows spread over the sample."""
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    book = np.unique(rows[np.linspace(0, len(rows) - 1, min(words, len(rows))).astype(int)], axis=0)
    for _ in range(rounds):
        mine = nearest(rows, book)
        for w in range(len(book)):
            if (mine == w).any():
                book[w] = rows[mine == w].mean(axis=0)
    return book


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num((book * book).sum(axis=1)[None, :] - 2 * rows @ book.T, nan=np.inf).argmin(axis=1)


def _vectors(raw: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(-1, dim)


def participants(df: DataFrame, label: Column, scale: int, id_col: str, vector: str) -> DataFrame:
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), scaled.alias("x"), bad.alias("bad"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce("bad", F.lit(False))).drop("bad")


class Index:
    """Every row in its cell's chunk, written, and the directory."""

    def __init__(self, rows: DataFrame, code_words: int, fit_rows: int, chunk_rows: int | None) -> None:
        count, longest = rows.agg(F.count("*"), F.max(F.size("x"))).first()
        self.dim = dim = 2 * max(1, math.ceil((longest or 1) / 2))
        half = dim // 2
        chunk_rows = chunk_rows or max(1, CHUNK_BYTES // (8 * dim))

        def padded(x: pd.Series) -> np.ndarray:
            out = np.zeros((len(x), dim))
            for r, v in enumerate(x):
                out[r, : len(v)] = v
            return np.floor(out)

        # about twice the sample by hash, of which each task gives its part; then its first rows
        drawn = F.pmod(F.xxhash64("id", "x"), F.lit(1 << 30))
        few = rows.where(drawn < math.ceil(2 * fit_rows / max(count, 1) * (1 << 30)))
        sample = few.orderBy(drawn, "id").limit(fit_rows).select("x").toPandas()["x"]
        fitted = padded(sample)
        books = tuple(fit_book(part, code_words) for part in (fitted[:, :half], fitted[:, half:]))

        def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                v = padded(pdf["x"])
                parts = (v[:, :half], v[:, half:])
                words = [nearest(p, b) for p, b in zip(parts, books, strict=True)]
                with np.errstate(over="ignore", invalid="ignore"):
                    far = [np.sqrt(((p - b[w]) ** 2).sum(axis=1)) for p, b, w in zip(parts, books, words, strict=True)]
                raw = [x.tobytes() for x in v.astype("<f8")]
                yield pd.DataFrame({"cell": words[0] * len(books[1]) + words[1], "id": pdf["id"], "label": pdf["label"], "v": raw, "far_0": far[0], "far_1": far[1]})

        cells = rows.mapInPandas(placed, "cell int, id long, label int, v binary, far_0 double, far_1 double")
        cells = written(cells.withColumn("row", F.monotonically_increasing_id()), "cells")
        found = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_0").alias("far_0"), F.max("far_1").alias("far_1")).collect()  # one row for each cell
        shape = tuple(len(b) for b in books)
        n, far = np.zeros(shape, "i8"), (np.zeros(shape), np.zeros(shape))
        for r in found:
            at = divmod(r["cell"], shape[1])
            n[at], far[0][at], far[1][at] = r["n"], r["far_0"], r["far_1"]
        self.directory = Directory(books, n, -(-n // chunk_rows), far)
        many = [F.when(F.col("cell") == c, F.pmod(F.xxhash64("row"), F.lit(int(k)))) for c, k in enumerate(self.directory.chunks.ravel()) if k > 1]
        self.rows = cells.withColumn("chunk", F.coalesce(*many, F.lit(0)).cast("int"))

    def route(self, asks: DataFrame, first_rows: int) -> DataFrame:
        """Asks with the cells and chunks of their first round, or, once they have `floors`, of their second."""
        directory, dim = self.directory, self.dim
        second = "floors" in asks.columns

        def visited(q: np.ndarray, lows: list[int], highs: list[int], floors: list[int] | None) -> list[int]:
            windows = [w for w, low in enumerate(lows) if low <= highs[w]]
            if not windows:
                return []
            ceiling = float(max(highs[w] for w in windows))
            first, read = [], 0
            for c in directory.cells(q, float(min(lows[w] for w in windows)), ceiling):
                first.append(c)
                read += int(directory.rows.ravel()[c])
                if read >= first_rows:
                    break
            else:
                return [] if second else first
            if not second:
                return first
            done = set(first)
            return [c for c in directory.cells(q, float(min(floors[w] for w in windows)), ceiling) if c not in done]

        def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                v = _vectors(pdf["v"], dim)
                floors = [x.tolist() for x in pdf["floors"]] if second else [None] * len(pdf)
                cells = [visited(v[r], low.tolist(), high.tolist(), floors[r]) for r, (low, high) in enumerate(zip(pdf["lows"], pdf["highs"], strict=True))]
                if second:
                    pdf = pdf.assign(lows=pdf["floors"]).drop(columns="floors")
                flat = np.array([c for x in cells for c in x], "i8")
                chunks = directory.chunks.ravel()[flat]
                at = np.repeat(np.repeat(np.arange(len(pdf)), list(map(len, cells))), chunks)
                cell, chunk = np.repeat(flat, chunks), np.arange(len(at)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                for start in range(0, len(at), 10_000):
                    part = slice(start, start + 10_000)
                    yield pdf.iloc[at[part]].assign(cell=cell[part], chunk=chunk[part])

        return asks.mapInPandas(routed, f"{ASK}, cell int, chunk int")

    def search(self, asks: DataFrame, k: int, same: bool) -> DataFrame:
        """(row, place, found_id, score): of each ask and window the best k of each chunk that it is sent to, with or without its label."""
        dim = self.dim
        held = self.rows.select("cell", "chunk", F.lit(0).alias("kind"), "row", F.col("id").alias("anchor_id"), "label", "v", *(F.lit(None).cast("array<long>").alias(c) for c in ("tags", "lows", "highs")))
        both = held.unionByName(asks.select("cell", "chunk", F.lit(1).alias("kind"), "row", "anchor_id", "label", "v", "tags", "lows", "highs"))

        def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at, chunk, parts = None, None, []
            for pdf in batches:
                group = pdf[["cell", "chunk", "kind"]].to_numpy()
                cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
                for start, stop in zip(cuts, cuts[1:], strict=False):
                    part, place = pdf.iloc[start:stop], tuple(group[start][:2])
                    if place != at:
                        at, chunk, parts = place, None, []
                    if group[start][2] == 0:
                        parts.append(part)
                        continue
                    if parts:
                        chunk, parts = _Chunk(pd.concat(parts), dim), []
                    if chunk is not None:
                        at_once = max(1, SCORES // len(chunk.ids))
                        for first in range(0, len(part), at_once):
                            yield chunk.answer(part.iloc[first : first + at_once], k, same)

        placed = both.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")
        return placed.mapInPandas(answered, "row long, place int, found_id long, score long")


class _Chunk:
    def __init__(self, rows: pd.DataFrame, dim: int) -> None:
        rows = rows.sort_values("anchor_id", kind="stable")
        self.ids, self.row, self.label = (rows[c].to_numpy() for c in ("anchor_id", "row", "label"))
        self.dim, self.v = dim, _vectors(rows["v"], dim)
        self.most = float(np.abs(self.v).max(initial=0.0))
        self.small = self.v.T.astype("f4") if self.most < 1 << 24 else None

    def scores(self, q: np.ndarray) -> np.ndarray:
        """Inner products as 64-bit integers, exact up to their bounds."""
        with np.errstate(over="ignore"):
            most = float(np.abs(q).sum(axis=1).max(initial=0.0)) * self.most
        if most < 1 << 24 and self.small is not None:  # sums of integers are exact in single precision
            return (q.astype("f4") @ self.small).astype("i8")
        if most < 1 << 53:
            return (q @ self.v.T).astype("i8")
        whole = [[int(x) for x in v] for v in self.v]
        return np.array([[min(HIGHEST, max(LOWEST, sum(int(a) * b for a, b in zip(x, v, strict=True)))) for v in whole] for x in q], "i8").reshape(len(q), -1)

    def answer(self, asks: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
        s = self.scores(_vectors(asks["v"], self.dim))
        n = s.shape[1]
        may = (asks["label"].to_numpy()[:, None] == self.label[None, :]) == same
        may &= asks["row"].to_numpy()[:, None] != self.row[None, :]
        rank = n - 1 - np.arange(n)  # ties go to the smaller id
        near = bool(np.abs(s.astype("f8")).max(initial=0.0) < (1 << 62) // max(n, 1))
        out = []
        lows, highs = asks["lows"].tolist(), asks["highs"].tolist()
        for w in range(max(map(len, lows), default=0)):
            low, high = (np.array([b[w] if len(b) > w else none for b in bounds], "i8")[:, None] for bounds, none in ((lows, HIGHEST), (highs, LOWEST)))
            ok = may & (s >= low) & (s <= high)
            if near:
                key = np.where(ok, s * n + rank, LOWEST)
                top = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), s.shape)
            else:
                top = np.array([sorted(range(n), key=lambda j: (not ok[i, j], -int(s[i, j]), j))[:k] for i in range(len(s))])  # noqa: B023
            a, b = np.nonzero(np.take_along_axis(ok, top, axis=1))
            j = top[a, b]
            out.append(pd.DataFrame({"row": asks["row"].to_numpy()[a], "place": w, "found_id": self.ids[j], "score": s[a, j]}))
        return pd.concat(out) if out else pd.DataFrame({"row": [], "place": [], "found_id": [], "score": []}, dtype="int64")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _first_rows(index: Index, asks: DataFrame, k: int, same: bool, first_rows: int, what: str) -> DataFrame:
    """(row, place, found_id, score, rank): the first k rows of each window of each ask, in two rounds."""
    first = written(_best(index.search(index.route(asks, first_rows), k, same), k).drop("rank"), f"{what}-first")
    full = first.groupBy("row", "place").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    known = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("least"))
    raised = F.transform("lows", lambda low, w: F.greatest(low, F.try_element_at("least", w)))
    second = asks.join(known, "row", "left").withColumn("floors", F.coalesce(F.when(F.col("least").isNotNull(), raised), "lows")).drop("least")
    return _best(first.unionByName(index.search(index.route(second, first_rows), k, same)), k)


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    id_col: str = "vec_id",
    vector: str = "embedding",
    code_words: int = CODE_WORDS,
    fit_rows: int = FIT_ROWS,
    chunk_rows: int | None = None,
    first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor`: which rows are anchors, a condition on the column `id`; `window`: the least and largest percentage of the
    positive's score that a negative's may be. `fit_rows` bounds the sample that fits the codebooks; all rows are indexed.
    `chunk_rows`: by default as CHUNK_BYTES has it.
    """
    index = Index(participants(df, label, scale, id_col, vector), code_words, fit_rows, chunk_rows)
    whole = F.array(F.lit(0).cast("long")), F.array(F.lit(LOWEST)), F.array(F.lit(HIGHEST))
    asks = index.rows.where(anchor).select("row", F.col("id").alias("anchor_id"), "label", "v", *(c.alias(n) for c, n in zip(whole, ("tags", "lows", "highs"), strict=True)))
    asks = written(asks, "anchors")
    best = written(_first_rows(index, asks, positives, True, first_rows, "positives"), "positives")
    mine = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "found_id", "score"))).alias("p"))
    hundredths = [F.transform("p", lambda p: p["score"].cast("decimal(38,0)") * F.lit(share)) for share in window]  # noqa: B023
    bounded = asks.select("row", "anchor_id", "label", "v").join(mine, "row").select(
        "row", "anchor_id", "label", "v", F.transform("p", lambda p: p["found_id"]).alias("tags"),
        F.transform(hundredths[0], lambda x: F.greatest(F.lit(LOWEST), F.ceil(x / 100)).cast("long")).alias("lows"),
        F.transform(hundredths[1], lambda x: F.least(F.lit(HIGHEST), F.floor(x / 100)).cast("long")).alias("highs"),
    )
    bounded = written(bounded, "windows")
    found = _first_rows(index, bounded, negatives, False, first_rows, "negatives")
    pairs = best.select("row", (F.col("rank") - 1).alias("place"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = found.join(pairs, ["row", "place"]).join(asks.select("row", "anchor_id"), "row")
    return named.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
