"""Near-duplicate documents by BagMinHash: weighted-Jaccard signatures, banding, exact multiset check.

A document is the multiset of its five-word shingles. Each shingle owns Poisson processes over its weight
axis, cut into the discretised levels (0,1], (1,2], (2,4], (4,8], ... . The points of a level come in order
of time; each falls on a signature component and on a place within the level, and counts for a document if
the place lies below the shingle's weight there. A component keeps its earliest point, so two documents agree in
it with a probability equal to their weighted Jaccard similarity. A process stops once its next point is
later than all components' earliest.

Signatures are banded. Equal texts are one node. In every band bucket the nodes are compared with one
representative (first round: one order over all buckets; then another order, across the components found so
far); what is still apart in a bucket is compared in blocks, by signature, without emitting pairs that cannot
be similar. Every link is confirmed on the multisets of shingles. Classes are connected components.

Defined cases: a null text is a class of its own; empty texts are equal texts; texts without a word have no
shingle and match equal texts only; rows are classed by their text, so rows that share a doc_id but no text need not
share a class; texts without any doc_id link as others do. Ties: the smallest doc_id names the class and is kept (with
several texts of that id, the one of the smallest digest). Extra columns are ignored, or kept by `deduplicate`. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, written
from .shingles import mix, shingle_hashes, slices, text_buffer

_U = np.uint64
WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
#: Components of the longer signatures by which blocks are compared, and the agreement below which two documents
#: are not compared exactly: four standard deviations under 0.8.
LONG = 800
LEAST_AGREEMENT = SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / LONG) ** 0.5
CHUNK_BYTES = 1 << 20
BLOCK = 256
_STEP = _U(0x9E3779B97F4A7C15)


def _weighted(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of every different shingle of every text."""
    docs, keys, weights = [], [], []
    for d in range(len(bounds) - 1):
        s = np.sort(shingles[bounds[d] : bounds[d + 1]])
        if not len(s):
            continue
        at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        keys.append(s[at])
        weights.append(np.diff(at, append=len(s)))
        docs.append(np.full(len(at), d))
    if not docs:
        return np.zeros(0, "i8"), np.zeros(0, _U), np.zeros(0, "i8")
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(weights)


def signatures(shingles: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Texts x size earliest times; infinite where a text has no shingle."""
    n = len(bounds) - 1
    doc, key, weight = _weighted(shingles, bounds)
    sig = np.full(n * size, np.inf)
    levels = [(doc, mix(key + _STEP), np.ones(len(doc)), np.zeros(len(doc)), weight.astype("f8"))]
    low = 1
    while (at := np.flatnonzero(weight > low)).size:
        levels.append((doc[at], mix(key[at] + np.full(1, low + 1, _U) * _STEP), np.full(len(at), float(low)), np.full(len(at), float(low)), weight[at].astype("f8")))
        low *= 2
    doc, state, width, base, weight = (np.concatenate(x) for x in zip(*levels, strict=True))
    time = np.zeros(len(doc))
    while len(doc):
        state = mix(state + _STEP)
        time = time - np.log(((state >> _U(11)).astype("f8") + 1.0) * 2.0**-53) / (size * width)
        place = mix(state ^ _U(0xA0761D6478BD642F))
        component = ((place >> _U(40)) % _U(size)).astype("i8")
        within = (place & _U(0xFFFFFFFFFF)).astype("f8") * 2.0**-40 * width + base < weight
        np.minimum.at(sig, doc[within] * size + component[within], time[within])
        latest = sig.reshape(n, size).max(axis=1)
        go = np.flatnonzero(time < latest[doc])
        doc, state, width, base, weight, time = doc[go], state[go], width[go], base[go], weight[go], time[go]
    return sig.reshape(n, size)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = BANDS * ROWS
    for b in batches:
        data, bounds = text_buffer(b.column(2))
        for start, stop in slices(bounds, CHUNK_BYTES):
            shingles, cuts = shingle_hashes(data, bounds[start : stop + 1], WORDS)
            sig = signatures(shingles, cuts, size)
            full = np.flatnonzero(np.diff(cuts) > 0)
            bits = sig[full].view(_U).reshape(len(full), BANDS, ROWS)
            keys = np.arange(BANDS, dtype=_U)[None, :] * _STEP
            for r in range(ROWS):
                keys = mix(keys * _U(0xD6E8FEB86659FD93) + bits[:, :, r])
            counts = np.zeros(stop - start, "i4")
            counts[full] = BANDS
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(start, stop - start),
                    b.column(1).slice(start, stop - start),
                    pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype("i4"), keys.view("i8").ravel()),
                ],
                names=["doc_id", "digest", "bands"],
            )


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, bounds = text_buffer(b.column(1))
        for start, stop in slices(bounds, CHUNK_BYTES // 4):
            sig = signatures(*shingle_hashes(data, bounds[start : stop + 1], WORDS), LONG)
            marks = (mix(sig.view(_U)) >> _U(56)).astype("u1")
            bands = np.asarray(b.column(2).slice(start, stop - start).flatten()).reshape(-1, BANDS)
            both = pa.array([x.tobytes() + m.tobytes() for x, m in zip(bands, marks, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), both], names=["node", "marks"])


def sketch(df: DataFrame) -> DataFrame:
    """(doc_id, digest, bands) of every row with a text."""
    rows = df.where(F.col("text").isNotNull()).select("doc_id", _digest().alias("digest"), F.lower("text").alias("text"))
    return rows.mapInArrow(_sketched, "doc_id long, digest string, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two sorted multisets."""

    def numbered(s: np.ndarray) -> np.ndarray:
        new = np.concatenate(([True], s[1:] != s[:-1]))
        if new.all():
            return s
        first = np.flatnonzero(new)
        nth = np.arange(len(s)) - first[np.cumsum(new) - 1]
        return np.sort(mix(s + nth.astype(_U) * _STEP) * (nth > 0) + s * (nth == 0))

    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate((numbered(a), numbered(b)))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sides = [text_buffer(b.column(2)), text_buffer(b.column(3))]
        both = (sides[0][1] + sides[1][1]) // 2
        for start, stop in slices(both, CHUNK_BYTES):
            cut = [shingle_hashes(data, bounds[start : stop + 1], WORDS) for data, bounds in sides]
            ok = np.zeros(stop - start, bool)
            for i in range(stop - start):
                x, y = (np.sort(s[c[i] : c[i + 1]]) for s, c in cut)
                ok[i] = similarity(x, y) >= SIMILARITY
            part = pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).slice(start, stop - start)
            yield part.filter(pa.array(ok))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar; texts: (node, text)."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    full = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")


def connected_components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it is linked with.

    Smallest labels spread along edges and through their own labels until none changes.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(edges.select("b", "a")).distinct()
    both = written(both, f"{what}-edges")
    labels = written(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("src"), F.min("dst")).alias("component")), what)
    total = None
    while True:
        near = both.join(labels.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node"), "component")
        spread = labels.union(near).groupBy("node").agg(F.min("component").alias("component"))
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = spread.join(roots, "component", "left").select("node", F.least("component", F.coalesce("root", "component")).alias("component"))
        before, labels = labels, written(jumped, what)
        discard(before)
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            discard(both)
            return labels
        total = now


def merge_components(labels: DataFrame, edges: DataFrame, what: str = "components") -> DataFrame:
    """The components after more edges: they link components, of which there are fewer than nodes."""
    named = edges
    for side in ("a", "b"):
        mine = labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
        named = named.join(mine, side, "left").withColumn(f"{side}_component", F.coalesce(f"{side}_component", side))
    named = written(named, f"{what}-links")
    between = named.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")).where("a <> b").distinct()
    larger = connected_components(between, what)
    joined = larger.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    new = named.select(F.col("a").alias("node"), F.col("a_component").alias("component")).union(named.select("b", "b_component"))
    merged = written(labels.union(new).distinct().join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component")), what)
    discard(named, larger)
    return merged


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) with agreeing signatures across components, from (key, node, component, marks, is_main, main_blocks, rest_blocks).

    `marks`: a node's band keys, then its long signature. Rows of a bucket's largest component are not compared with each
    other: they meet the blocks of the rest, which also meet each other. Blocks of the rest come first in number.
    """
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    block = F.when(F.col("is_main"), F.col("rest_blocks") + mine).otherwise(mine)
    # rows of the largest component meet the rest only, the rest meets all
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("is_main"), F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")) - 1))
    dealt = rows.select("key", "node", "component", "marks", block.alias("block"), others.alias("other")).select(
        "key", "node", "component", "marks", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )

    def pairs(key: int, left: pd.DataFrame, right: pd.DataFrame, same: bool) -> list[tuple[int, int]]:
        x, y = (np.frombuffer(b"".join(side["marks"]), "u1").reshape(len(side), -1) for side in (left, right))
        (x_bands, x), (y_bands, y) = ((np.ascontiguousarray(z[:, : 8 * BANDS]).view("i8"), z[:, 8 * BANDS :]) for z in (x, y))
        c, d = left["component"].to_numpy(), right["component"].to_numpy()
        a, b = left["node"].to_numpy(), right["node"].to_numpy()
        out = []
        for k in range(len(x)):
            at = np.flatnonzero(d != c[k])
            if same:
                at = at[at > k]
            # a pair is compared in the first of the buckets that it shares, all of which are dealt out
            at = at[x_bands[k][(y_bands[at] == x_bands[k]).argmax(axis=1)] == key]
            hit = at[(y[at] == x[k]).sum(axis=1) >= LEAST_AGREEMENT * LONG]
            out.extend(zip(np.minimum(a[k], b[hit]).tolist(), np.maximum(a[k], b[hit]).tolist(), strict=True))
        return out

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat((held, pdf), ignore_index=True)
            group = pdf[["key", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist()]
            held = pdf.iloc[cuts[-1] :]  # may go on in the next batch
            yield _pair_frame(p for start, stop in zip(cuts, cuts[1:], strict=False) for p in met(pdf.iloc[start:stop]))
        if held is not None:
            yield _pair_frame(met(held))

    def met(pdf: pd.DataFrame) -> list[tuple[int, int]]:
        if not len(pdf):
            return []
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        block = pdf["block"].to_numpy()
        return pairs(pdf["key"].iat[0], pdf[block == i], pdf[block == j], i == j)

    placed = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return placed.mapInPandas(compare, "a long, b long").distinct()


def _pair_frame(pairs: Iterable[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(list(set(pairs)), columns=["a", "b"], dtype="int64")


def _digest() -> Column:
    return F.md5(F.col("text").cast("binary"))


def _classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row with a text; (digest, id, class_id, head) of every different text.

    `id`: the smallest doc_id of the text; `head`: the text stands for its class.
    """
    sketches = written(sketch(df), "sketches")
    groups = sketches.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    groups = written(groups.withColumn("node", F.monotonically_increasing_id()), "texts")
    nodes = groups.where(F.size("bands") > 0).select("node", "bands")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    heads = keyed.groupBy("key").agg(F.min(F.struct(F.xxhash64("node"), "node"))["node"].alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(heads.select("key", "b"), "key"), "buckets")
    pairs = written(shared.where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "pairs")
    wanted = groups.select("digest", "node").join(shared.select("node").distinct(), "node", "left_semi")
    # copies of a text meet in one row before they are shuffled
    texts = df.where(F.col("text").isNotNull()).select(_digest().alias("digest"), "text").groupBy("digest").agg(F.first("text").alias("text"))
    texts = written(texts.join(wanted, "digest").select("node", F.lower("text").alias("text")), "candidates")
    edges = written(verify(pairs, texts), "links")
    labels = connected_components(edges)

    def apart(labels: DataFrame) -> DataFrame:
        """The bucket rows of buckets that hold more than one component, with the largest, its rows and the others."""
        rows = shared.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        counts = rows.groupBy("key", "component").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", "key"), "node"))["node"].alias("head"))
        largest = F.max(F.struct("n", "component", "head"))
        mixed = counts.groupBy("key").agg(largest.alias("main"), F.sum("n").alias("n"), F.count("*").alias("components")).where("components > 1")
        return rows.join(mixed.select("key", "main", (F.col("n") - F.col("main.n")).alias("others")), "key")

    again = apart(labels).where(F.col("component") != F.col("main.component")).select(F.col("node").alias("a"), F.col("main.head").alias("b")).distinct()
    again = written(again.join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = written(verify(again, texts), "links")
    interim = [groups, shared, pairs, texts, edges, again, links, labels]
    labels = merge_components(labels, links)
    blocks = {"main_blocks": F.ceil(F.col("main.n") / BLOCK).cast("int"), "rest_blocks": F.ceil(F.col("others") / BLOCK).cast("int")}
    left = apart(labels).withColumns(blocks).withColumn("is_main", F.col("component") == F.col("main.component"))
    left = written(left.select("key", "node", "component", "is_main", *blocks), "apart")
    mine = nodes.join(left.select("node").distinct(), "node", "left_semi")
    marks = texts.join(mine, "node").select("node", "text", "bands").mapInArrow(_marked, "node long, marks binary")
    rest = _in_blocks(left.join(marks, "node"))
    rest = written(rest.join(pairs.union(again), ["a", "b"], "left_anti"), "pairs")
    found = written(verify(rest, texts), "links")
    interim += [left, rest, found, labels]
    if not found.isEmpty():
        labels = merge_components(labels, found)
        interim.append(labels)

    classes = groups.join(labels, "node", "left").select("digest", "id", F.coalesce("component", "node").alias("component"))
    names = classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first"))
    # a class without any id is named by a number below 0
    named = classes.join(names, "component").select(
        "digest", "id", F.coalesce("first.id", -1 - F.col("component")).alias("class_id"), (F.col("digest") == F.col("first.digest")).alias("head")
    )
    named = written(named, "classes")
    discard(*interim)
    return sketches.select("doc_id", "digest"), named


def near_duplicates(df: DataFrame) -> DataFrame:
    """(doc_id, class_id, kept) of every row; `df` needs doc_id and text. `kept`: the row is of the class's first text and id."""
    rows, classes = _classes(df.select("doc_id", "text"))
    placed = rows.join(classes, "digest").select("doc_id", "class_id", (F.col("head") & F.col("doc_id").eqNullSafe(F.col("id"))).alias("kept"))
    return placed.union(df.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True)))


def deduplicate(df: DataFrame) -> DataFrame:
    """The rows of `df` that stay: one of each class, and every row without a text."""
    rows, classes = _classes(df.select("doc_id", "text"))
    row, text = fresh(df, "row_id"), fresh(df, "digest")
    judged = rows.join(classes, "digest").select(F.col("doc_id").alias(row), F.col("digest").alias(text), (F.col("head") & F.col("doc_id").eqNullSafe(F.col("id"))).alias("kept"))
    judged = written(judged, "judged")  # as it is, so that Spark may split the rows of a text that many share

    def of(table: DataFrame, other: DataFrame, how: str) -> DataFrame:
        return table.join(other, (table[text] == other[text]) & table["doc_id"].eqNullSafe(other[row]), how)

    left = of(df.withColumn(text, _digest()), judged.where(~F.col("kept")).select(row, text), "left_anti")
    repeated = judged.where("kept").groupBy(row, text).count().where("count > 1").select(row, text)
    if repeated.isEmpty():
        return left.drop(text)
    once = of(left, repeated, "left_semi").dropDuplicates([text])  # a text stands for one class
    return of(left, repeated, "left_anti").unionByName(once).drop(text)
