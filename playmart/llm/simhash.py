"""SimHash near-duplicates through anchor-point covering: every link of 64-bit fingerprints within a Hamming bound.

A text is lower-cased in A-Z and cut into words at ASCII white space; XXH64 (seed 42) of each run of four words votes
on the 64 bits of its fingerprint. Anchors are the words of a linear covering code. A fingerprint t lives at its nearest
anchor, at distance r(t), which is at most the code's covering radius, and is replicated to every anchor within r(t) plus
the threshold. Of two linked fingerprints the one that lives farther from its anchor so visits the home of the other, for
d(t, home(s)) <= d(t, s) + r(s) <= threshold + r(t): no link is lost whatever the code's radius is.

Fingerprints are compared per anchor, homes with visitors. What a group of rows links is given as a spanning forest, so that
dense groups make no pairs of all with all. Anchors with more rows than a task should hold are first dealt into parts; across
parts only rows outside the anchor's largest component are compared, with all others. Classes are connected components.

Defined cases: a null text counts as empty; a text without a word has fingerprint zero and links as any other; fewer than
four words are one shingle; repeated rows and ids are each given; a component is named by its smallest doc_id (null if none
of its rows has one). Extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .minhash import connected_components, merge_components
from .shingles import mix, slices, text_buffer

_U = np.uint64
WORDS, SEED, THRESHOLD = 4, 42, 4
#: Parts of a fingerprint with a code each, and the dimension of that code: 2^16 anchors; 2^24 for tables of very many texts.
CODE, LARGE_CODE, LARGE = (1, 16), (2, 12), 1 << 25
#: Rows of an anchor that are compared in one task.
PART_ROWS = 1 << 16
CHUNK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x09-\x0d\x20]")


def votes(text: bytes, chunk: int = CHUNK_BYTES) -> np.ndarray:
    """The shingles' hashes in pieces would be large: the number of set bits for each place, and of shingles last."""
    out = np.zeros(65, "i8")
    held: list[bytes] = []
    at = 0
    while at < len(text):
        stop = len(text)
        if at + chunk < stop:
            space = _SPACE.search(text, at + chunk)
            stop = space.start() if space else stop
        words = held + text[at:stop].lower().split()
        if len(words) >= WORDS:
            runs = zip(*(words[k:] for k in range(WORDS)), strict=False)
            _vote(out, list(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED))))
        held = words[1 - WORDS :] if len(words) >= WORDS else words
        at = stop
    if not out[64] and held:
        _vote(out, [xxhash.xxh64_intdigest(b" ".join(held), SEED)])
    return out


def _vote(out: np.ndarray, hashes: list[int]) -> None:
    raw = np.array(hashes, _U).view("u1").reshape(-1, 8)
    out[:64] += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    out[64] += len(raw)


def fingerprint(text: bytes) -> int:
    v = votes(text)
    return int(np.packbits(2 * v[:64] > v[64], bitorder="little").view(_U)[0])


def fingerprints(df: DataFrame) -> DataFrame:
    """(doc_id, print) of every row, the fingerprint as a signed number."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_buffer(b.column(1))
            for start, stop in slices(bounds, CHUNK_BYTES):
                prints = [fingerprint(data[bounds[i] : bounds[i + 1]].tobytes()) for i in range(start, stop)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), pa.array(np.array(prints, _U).view("i8"))], names=["doc_id", "print"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(made, "doc_id long, print long")


def code_words(length: int, dimension: int) -> np.ndarray:
    """A linear code whose generators a fixed hash draws; such codes cover nearly as well as spheres would."""
    seeds = mix(np.arange(1, dimension + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(length))
    words = np.zeros(1, _U)
    for g in seeds >> _U(64 - length):
        words = np.concatenate((words, words ^ g))
    return np.unique(words)


def anchors_of(prints: np.ndarray, code: tuple[int, int], threshold: int = THRESHOLD) -> Iterator[tuple[int, np.ndarray, int]]:
    """(place, anchors, home) of each fingerprint: anchors within its home distance plus the threshold, and which is its home."""
    parts, dimension = code
    length = 64 // parts
    words = code_words(length, dimension)
    mask = _U((1 << length) - 1)
    for i, p in enumerate(prints.view(_U)):
        found = np.zeros(1, "i8")
        excess = np.zeros(1, "i8")
        for k in range(parts):
            far = np.bitwise_count(words ^ (p >> _U(k * length) & mask))
            near = int(far.min())
            at = np.flatnonzero(far <= near + threshold)
            more = excess[:, None] + (far[at].astype("i8") - near)
            keep = more <= threshold
            found = ((found * len(words))[:, None] + at[None, :])[keep]
            excess = more[keep]
        yield i, found, int(found[excess.argmin()])


def visits(prints: DataFrame, code: tuple[int, int], threshold: int = THRESHOLD) -> DataFrame:
    """(anchor, print, home) for each anchor that a fingerprint of (print) lives at or visits."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.asarray(b.column(0)).copy()
            for start in range(0, len(values), 512):
                part = values[start : start + 512]
                anchors, owner, home = [], [], []
                for i, at, mine in anchors_of(part, code, threshold):
                    anchors.append(at)
                    owner.append(np.full(len(at), part[i]))
                    home.append(at == mine)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (anchors, owner, home)], names=["anchor", "print", "home"])

    return prints.select("print").mapInArrow(dealt, "anchor long, print long, home boolean")


def _forest(homes: np.ndarray, others: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between `homes` and `others` that connect all that is within the threshold; at most one for each row."""
    nodes = np.unique(np.concatenate((homes, others)))
    label = np.arange(len(nodes))
    at_home, at_other = np.searchsorted(nodes, homes), np.searchsorted(nodes, others)
    out = []
    step = max(1, (1 << 21) // max(1, len(others)))
    for start in range(0, len(homes), step):
        near = np.bitwise_count(homes[start : start + step, None].view(_U) ^ others[None, :].view(_U)) <= threshold
        for k in np.flatnonzero(near.any(axis=1)):
            me = at_home[start + k]
            hit = at_other[near[k]]
            roots, first = np.unique(label[hit], return_index=True)
            new = roots != label[me]
            if new.any():
                out.extend((int(nodes[me]), int(nodes[x])) for x in hit[first[new]])
                label[np.isin(label, roots)] = label[me]
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of rows with equal first `keys` columns, over the batches' borders."""
    held: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [np.asarray(c) if not pa.types.is_boolean(c.type) else c.to_numpy(zero_copy_only=False) for c in b.columns]
        columns = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
        new = np.zeros(len(columns[0]) - 1, bool)
        for c in columns[:keys]:
            new |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            yield [c[start:stop] for c in columns]
        held = [c[cuts[-1] :] for c in columns]
    if held is not None:
        yield held


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, "i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)], names=["a", "b"])


def _within_parts(rows: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) of rows (anchor, part, print, home) that share anchor and part."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for _, _, prints, home in _grouped(batches, 2):
            if home.any() and len(prints) > 1:
                found.extend(_forest(prints[home], prints, threshold))
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    placed = rows.select("anchor", "part", "print", "home").repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return placed.mapInArrow(compared, "a long, b long").distinct()


def _across_parts(rows: DataFrame, part_rows: int, threshold: int) -> DataFrame:
    """Links across the parts of large anchors, from (anchor, print, home, component).

    Rows of an anchor's largest component need no comparison with each other: the rest, dealt into its own parts, meets all.
    """
    counts = rows.groupBy("anchor", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("anchor").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"))
    main = main.where(F.col("all") > F.col("main.n")).select("anchor", F.col("main.component").alias("largest"), (F.col("all") - F.col("main.n")).alias("others"), F.col("main.n").alias("mains"))
    placed = rows.join(main, "anchor")
    is_main = F.col("component") == F.col("largest")
    rest_parts, main_parts = (F.ceil(F.col(c) / part_rows).cast("int") for c in ("others", "mains"))
    own = F.pmod(F.xxhash64("print"), F.when(is_main, main_parts).otherwise(rest_parts)).cast("int")
    block = F.when(is_main, rest_parts + own).otherwise(own)
    met = F.when(is_main, rest_parts).otherwise(rest_parts + main_parts)
    dealt = placed.select("anchor", "print", "home", "component", block.alias("block"), F.explode(F.sequence(F.lit(0), met - 1)).alias("other"))
    dealt = dealt.select("anchor", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "print", "home", "component", "block")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, i, j, prints, home, component, block in _grouped(batches, 3):
            left, right = block == i[0], block == j[0]
            found: list[tuple[int, int]] = []
            for x, y in ((left, right), (right, left)):
                if (home & x).any() and y.any():
                    found.extend(_forest(prints[home & x], prints[y], threshold))
            yield _pairs(found)

    placed = dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return placed.mapInArrow(compared, "a long, b long").distinct()


def components(prints: DataFrame, code: tuple[int, int] | None = None, part_rows: int = PART_ROWS, threshold: int = THRESHOLD) -> DataFrame:
    """(print, component) of the fingerprints of (print), all different, that link with another one."""
    code = code or (LARGE_CODE if prints.count() > LARGE else CODE)
    seen = written(visits(prints, code, threshold), "simhash-visits")
    large = seen.groupBy("anchor").agg(F.count("*").alias("rows")).where(F.col("rows") > part_rows)
    large = written(large, "simhash-large")
    some = not large.isEmpty()
    parts = F.ceil(F.coalesce("rows", F.lit(0)) / part_rows).cast("int")
    dealt = seen.join(large, "anchor", "left") if some else seen.withColumn("rows", F.lit(0))
    dealt = dealt.withColumn("part", F.when(parts > 1, F.pmod(F.xxhash64("print", "anchor"), parts)).otherwise(0).cast("int"))
    links = written(_within_parts(dealt, threshold), "simhash-links")
    labels = connected_components(links, "simhash-components")
    interim = [seen, large, links]
    if some:
        rows = seen.join(large.select("anchor"), "anchor", "left_semi").join(labels.withColumnRenamed("node", "print"), "print", "left")
        rows = written(rows.withColumn("component", F.coalesce("component", "print")), "simhash-apart")
        found = written(_across_parts(rows, part_rows, threshold), "simhash-links")
        interim += [rows, found]
        if not found.isEmpty():
            interim.append(labels)
            labels = merge_components(labels, found, "simhash-components")
    discard(*interim)
    return labels.withColumnRenamed("node", "print")


def hexadecimal(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_duplicates(df: DataFrame, code: tuple[int, int] | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `df`, which needs doc_id and text."""
    rows = written(fingerprints(df), "simhash-prints")
    prints = written(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-different")
    linked = components(prints, code, part_rows)
    named = prints.join(linked, "print", "left").withColumn("component", F.coalesce("component", "print"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(names, "component").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", hexadecimal("print").alias("fingerprint"), "component_id")
