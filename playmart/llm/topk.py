"""Exact top-k by inner product over an impact-ordered index, score at a time.

Component x counts as floor(x * scale). Vectors are packed into blocks of bounded size. The queries, not the vectors,
are sent about: groups of queries of bounded size meet every block (a stated query set against all rows, in blocks), whose
index is built once for a group. It holds, per
dimension and sign, the vectors' impacts (distance of the component from the block's least favourable one)
quantised into levels; its posting segments, all postings of one level, are processed by descending level.
After each level the scores so far and the largest impact that is left bound every candidate from both sides.
Processing stops only when the bounds prove which vectors can still be among the k best; those are scored again
exactly. The k best of each block are merged by query.

Defined cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no part;
shorter vectors count as filled up with zeros; a query excludes its own row only, so a repeated row finds its twin;
ties go to the smaller id. Fewer than k candidates: all of them. Empty table: empty result. Blocks and queries with
components beyond 2^20 in absolute value after scaling are bounded by sums of doubles and their rounding errors, and what
these leave is scored in Python's integers; a score beyond 64 bits is ranked as it is and shown as the largest or
smallest 64-bit value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEVELS = 8
BLOCK_BYTES = 1 << 19
#: Queries compared at once, and bytes of queries that one task holds.
QUERY_BLOCK, GROUP_BYTES = 256, 1 << 23
LARGEST = 1 << 20


def takes_part(vector: str) -> Column:
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


class Block:
    """The impact-ordered index of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors.astype("f8")
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        # for positive query components large values have impact, for negative ones small values
        impact = np.concatenate((self.vectors - self.low, self.high - self.vectors), axis=1)
        self.step = max(1.0, math.ceil((impact.max() + 1) / LEVELS))
        self.top = float(impact.max())
        level = (impact // self.step).astype("i1").T
        self.segments = {v: (level == v).astype("f4") for v in range(LEVELS)}

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, positions, exact scores) of all vectors that may be among a query's k best. own: position of its own row here, else -1."""
        q = queries.astype("f8")
        weight = np.concatenate((np.maximum(q, 0), np.maximum(-q, 0)), axis=1)
        # sums of integers below 2^24 are exact in single precision
        kind = "f4" if weight.sum(axis=1).max() * (self.top + 2 * self.step) < 1 << 24 else "f8"
        weight, kind_of = weight.astype(kind), np.dtype(kind).type
        # what is the same for all vectors of the block is left out of the bounds
        least = np.zeros((len(q), len(self.ids)), kind)  # of the active queries, as the next two
        seen = np.zeros_like(least)
        everything = weight.sum(axis=1)
        active = np.arange(len(q))
        done: dict[int, np.ndarray] = {}
        for level in range(LEVELS - 1, -1, -1):
            if level and not self.segments[level].any():
                continue
            in_segment = weight[active] @ self.segments[level].astype(kind, copy=False)
            seen += in_segment
            in_segment *= level * self.step
            least += in_segment
            # a processed posting may be worth step - 1 more; an open one at most what the next level down can hold
            rest = level * self.step - 1 if level else 0
            gap = seen * kind_of(self.step - 1 - rest) + (everything[active] * kind_of(rest))[:, None]
            keep = np.zeros(len(active), bool)
            if level:
                # as long as every candidate may still pass the best one, nothing can be proved
                top = least.max(axis=1)
                keep = gap.min(axis=1) > top - least.min(axis=1)
            for row in np.flatnonzero(~keep):
                i, low = active[row], least[row]
                if own[i] >= 0:
                    low = low.copy()
                    low[own[i]] = -np.inf
                need = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -np.inf
                may = np.flatnonzero(least[row] + gap[row] >= need)
                if level == 0 or len(may) <= 4 * k:
                    done[i] = may[may != own[i]]
                else:
                    keep[row] = True
            if not keep.all():
                active, least, seen = active[keep], least[keep], seen[keep]
            if not len(active):
                break
        # one product for the block is cheaper than many gathers once much is left
        whole = q @ self.vectors.T if sum(map(len, done.values())) * 8 > len(q) * len(self.ids) else None
        for i, may in done.items():
            yield i, may, (whole[i][may] if whole is not None else self.vectors[may] @ q[i]).astype("i8")


class WideBlock:
    """Vectors with components too large for sums of doubles to be exact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: int) -> None:
        self.ids, self.vectors, self.scale = ids, vectors, scale
        self.shrunk = _shrunk(vectors, scale)
        self.whole: dict[int, list[int]] = {}

    def search(self, queries: np.ndarray, scale: int, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        q = _shrunk(queries, scale)
        about = q @ self.shrunk.T
        error = np.abs(q) @ np.abs(self.shrunk).T * ((q.shape[1] + 4) * 2.0**-52) + 2.0**-900
        for i in range(len(q)):
            low = about[i] - error[i]
            if own[i] >= 0:
                low[own[i]] = -np.inf
            need = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -np.inf
            may = np.flatnonzero(about[i] + error[i] >= need)
            may = may[may != own[i]]
            mine = _integers(queries[i], scale)
            yield i, may, [sum(a * b for a, b in zip(mine, self._integers(v), strict=True)) for v in may.tolist()]

    def _integers(self, v: int) -> list[int]:
        if v not in self.whole:
            self.whole[v] = _integers(self.vectors[v], self.scale)
        return self.whole[v]


def _integers(row: np.ndarray, scale: int) -> list[int]:
    return [math.floor(y) if math.isfinite(y := x * scale) else int(x) * scale for x in row.tolist()]


def _shrunk(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(x * scale), all times one power of two, so that products stay finite."""
    power = max(0, math.frexp(np.abs(rows).max(initial=0.0))[1] - 400)
    small = np.abs(rows) < 2.0**53
    return np.where(small, np.ldexp(np.floor(np.where(small, rows, 0.0) * scale), -power), np.ldexp(rows, -power) * scale)


def _shown(score: int) -> tuple[int, bytes | None]:
    """As 64 bits, and what tells scores beyond them apart, in order."""
    if abs(score) < 1 << 63:
        return score, None
    raw = abs(score).to_bytes((score.bit_length() + 7) // 8, "big")
    raw = len(raw).to_bytes(4, "big") + raw
    return ((1 << 63) - 1, raw) if score > 0 else (-(1 << 63), bytes(255 - x for x in raw))


def pack_blocks(df: DataFrame, id_col: str, vector: str, scale: int, query: Column) -> DataFrame:
    """(block, ids, vectors, dim, wide, wanted): vectors of a block, 32-bit integers or, if wide, unscaled doubles; which of them are queries."""
    rows = df.where(takes_part(vector) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), F.coalesce(query, F.lit(False)).alias("wanted")
    )
    size = rows.agg(F.sum(F.size("v") * 4 + 16), F.max(F.size("v"))).first()
    total, dim = size[0] or 0, max(size[1] or 1, 1)
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        v = np.zeros((len(pdf), dim), "<f8")
        for r, x in enumerate(pdf["v"]):
            v[r, : len(x)] = x
        wide = bool((np.abs(v) > LARGEST / scale).any())
        raw = v.tobytes() if wide else np.floor(v * scale).astype("<i4").tobytes()
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "ids": [pdf["id"].to_numpy("<i8").tobytes()], "vectors": [raw], "dim": [dim], "wide": [wide], "wanted": [pdf["wanted"].to_numpy("u1").tobytes()]})

    return dealt.groupBy("block").applyInPandas(packed, "block int, ids binary, vectors binary, dim int, wide boolean, wanted binary")


def top_k(df: DataFrame, query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which `query` holds, against every row but their own."""
    blocks = written(pack_blocks(df, id_col, vector, scale, query), "vector-blocks")

    def unpacked(row: tuple) -> np.ndarray:
        return np.frombuffer(row.vectors, "<f8" if row.wide else "<i4").reshape(-1, row.dim)

    def questions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                at = np.flatnonzero(np.frombuffer(row.wanted, "u1"))
                v, i = unpacked(row), np.frombuffer(row.ids, "<i8")
                for part in np.array_split(at, math.ceil(len(at) / QUERY_BLOCK)) if len(at) else []:
                    yield pd.DataFrame({"block": [row.block], "ids": [i[part].tobytes()], "vectors": [v[part].tobytes()], "at": [part.astype("<i8").tobytes()], "dim": [row.dim], "wide": [row.wide]})

    asked = blocks.mapInPandas(questions, "block int, ids binary, vectors binary, at binary, dim int, wide boolean")
    asked = written(asked, "vector-queries")
    n, size = blocks.agg(F.max("block")).first()[0], asked.agg(F.sum(F.octet_length("vectors"))).first()[0]
    groups = max(1, math.ceil((size or 0) / GROUP_BYTES))

    def everywhere(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    dealt = asked.withColumn("q_group", F.pmod(F.xxhash64("block", "at"), F.lit(groups)).cast("int")).withColumnRenamed("block", "q_block")
    dealt = dealt.select("*", everywhere("block", (n if n is not None else 0) + 1))
    copies = blocks.select("block", "ids", "vectors", "dim", "wide", everywhere("q_group", groups))

    def answers(block: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        for here in block.itertuples(index=False):
            ids, v = np.frombuffer(here.ids, "<i8"), unpacked(here)
            narrow = None if here.wide else Block(ids, v)
            wide = None
            for part in parts.itertuples(index=False):
                q, q_ids, at = unpacked(part), np.frombuffer(part.ids, "<i8"), np.frombuffer(part.at, "<i8")
                own = at if part.q_block == here.block else np.full(len(q), -1)
                if here.wide or part.wide:
                    wide = wide or WideBlock(ids, v.astype("f8"), scale if here.wide else 1)
                    hits = wide.search(q.astype("f8"), scale if part.wide else 1, own, k)
                else:
                    hits = narrow.search(q, own, k)
                for i, may, score in hits:
                    if isinstance(score, list):
                        order = sorted(range(len(may)), key=lambda x: (-score[x], ids[may[x]]))[:k]  # noqa: B023
                        shown = [_shown(score[x]) for x in order]
                        score, beyond = np.array([x for x, _ in shown], "i8"), [x for _, x in shown]
                    else:
                        order = np.lexsort((ids[may], -score))[:k]
                        score, beyond = score[order], [None] * len(order)
                    m = len(order)
                    found.append((np.full(m, part.q_block), np.full(m, at[i]), np.full(m, q_ids[i]), ids[may[order]], score, beyond))
        columns = list(zip(*found, strict=True)) or [()] * 6
        out = {name: np.concatenate(c) if c else np.zeros(0, "i8") for name, c in zip(("q_block", "q_at", "query_id", "vec_id", "score"), columns, strict=False)}
        return pd.DataFrame(out | {"beyond": pd.Series([x for c in columns[5] for x in c], dtype=object)})

    schema = "q_block int, q_at long, query_id long, vec_id long, score long, beyond binary"
    partial = copies.groupBy("block", "q_group").cogroup(dealt.groupBy("block", "q_group")).applyInPandas(answers, schema)
    order = Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
