"""URL filter: a sorted digest array, memory-mapped and probed by vectorised binary search.

A rule is (host, path, verdict). It fits its host and every subdomain when the url's path starts with
the rule's path; the longest rule string wins (on equal length the longer host, then block).

The index holds the rules sorted by the 64-bit xxhash of `host + path`, followed by the full strings.
A url probes one key per (host suffix, rule-path length); every hit is confirmed against the stored
string, so equal digests of different strings never decide a verdict.

Defined cases: null url, or one without `://`: host and path are empty and no rule fits. Repeated rows
are judged alike. Empty table: empty result. Only the named columns are read; others are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: An index travels to executors by broadcast; larger rule lists go through `judge_by_join`.
MAX_INDEX_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def build_index(rules: Iterable[Rule]) -> bytes:
    """Serialise rules: count, number of path lengths, keys, lengths, offsets, verdicts, strings."""
    unique: dict[str, Rule] = {}
    for r in rules:
        if r.key not in unique or r.verdict == "block":
            unique[r.key] = r
    keyed = sorted((xxhash.xxh64_intdigest(k), k, r) for k, r in unique.items())
    strings = [k.encode() for _, k, _ in keyed]
    lengths = sorted({len(r.path) for r in unique.values()})
    out = b"".join(
        (
            np.array([len(keyed), len(lengths)], "<u8").tobytes(),
            np.array([h for h, _, _ in keyed], "<u8").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            np.cumsum([0, *map(len, strings)]).astype("<u8").tobytes(),
            np.array([r.verdict == "block" for _, _, r in keyed], "u1").tobytes(),
            *strings,
        )
    )
    if len(out) > MAX_INDEX_BYTES:
        raise ValueError("too many rules for one index; use judge_by_join")
    return out


class DigestIndex:
    """A serialised index, memory-mapped from a file of the worker's own."""

    _open: dict[str, DigestIndex] = {}

    def __init__(self, file: str | BinaryIO) -> None:
        raw = np.memmap(file, dtype="u1", mode="r")
        n, m = (int(x) for x in raw[:16].view("<u8"))
        at = 16
        self.keys = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.path_lengths = [int(x) for x in raw[at : at + 8 * m].view("<u8")]
        at += 8 * m
        self.offsets = raw[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.block = raw[at : at + n]
        self.strings = raw[at + n :]

    @classmethod
    def of(cls, data: bytes) -> DigestIndex:
        name = hashlib.sha256(data).hexdigest()
        if name not in cls._open:
            # a file without a name: no other process finds or leaves one, and it goes with the mapping
            with tempfile.TemporaryFile() as f:
                f.write(data)
                f.flush()
                cls._open[name] = cls(f)
        return cls._open[name]

    def find(self, candidates: list[str]) -> np.ndarray:
        """Positions of the candidates' rules, -1 where none is stored."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, candidates), "<u8", len(candidates))
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(candidates), -1)
        n = len(self.keys)
        for i in np.flatnonzero((at < n) & (self.keys[np.minimum(at, n - 1)] == digests) if n else []):
            want, k = candidates[i].encode(), int(at[i])
            while k < n and self.keys[k] == digests[i]:
                if bytes(self.strings[self.offsets[k] : self.offsets[k + 1]]) == want:
                    found[i] = k
                    break
                k += 1
        return found

    def judge(self, hosts: list[str], paths: list[str], default: str) -> tuple[list[str | None], list[str]]:
        candidates: list[str] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            labels = host.split(".")
            suffixes = [".".join(labels[k:]) for k in range(len(labels))]
            for length in self.path_lengths:
                if length <= len(path):
                    head = path[:length]
                    candidates.extend(s + head for s in suffixes)
                    owner.extend([i] * len(suffixes))
        rules: list[str | None] = [None] * len(hosts)
        verdicts = [default] * len(hosts)
        found = self.find(candidates)
        for c in np.flatnonzero(found >= 0):
            i, rule = owner[c], candidates[c]
            # on equal length the first candidate stays, which is the shorter path and so the longer host
            if rules[i] is None or len(rule) > len(rules[i]):
                rules[i], verdicts[i] = rule, "block" if self.block[found[c]] else "allow"
        return rules, verdicts


def judge_urls(df: DataFrame, rules: Iterable[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row; `default` is the verdict where no rule fits."""
    index = df.sparkSession.sparkContext.broadcast(build_index(rules))

    @F.pandas_udf("rule string, verdict string")
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        rule, verdict = DigestIndex.of(index.value).judge(host.tolist(), path.tolist(), default)
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": verdict})

    parsed = df.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    found = fresh(parsed, "judged")
    return parsed.withColumn(found, judged("host", "path")).select(id_col, "host", "path", f"{found}.rule", f"{found}.verdict")


def judge_by_join(df: DataFrame, rules: DataFrame, path_lengths: list[int], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same for rule tables (host, path, verdict) of any size: candidate digests joined to rule digests.

    `path_lengths`: the distinct lengths of rule paths. A url is judged once by its host and path, whatever the ids of
    its rows are (null and repeated ids, too).
    """
    key = F.concat("host", "path")
    stored = rules.select(F.xxhash64(key).alias("digest"), key.alias("rule"), "verdict").groupBy("digest", "rule").agg(F.max("verdict").alias("verdict"))
    parsed = df.select(F.col(id_col).alias("_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.")
    probes = (
        parsed.where(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .select("*", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("_k"))
        .select("*", F.explode(F.array(*map(F.lit, path_lengths))).alias("_n"))
        .where(F.length("path") >= F.col("_n"))
        .select("host", "path", F.concat(F.array_join(F.slice(labels, F.col("_k"), F.size(labels)), "."), F.expr("substring(path, 1, _n)")).alias("candidate"))
    )
    hits = probes.join(stored, (F.xxhash64("candidate") == F.col("digest")) & (F.col("candidate") == F.col("rule")))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), F.length(F.substring_index("rule", "/", 1)), "rule", "verdict")).alias("b"))
    judged = parsed.join(best, ["host", "path"], "left")
    return judged.select(F.col("_id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
