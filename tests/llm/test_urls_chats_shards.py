"""URL rules, chat formatting and sharding against plain Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F

from playmart.llm import chat, queries, sharding, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.net/en/x?q", "https://a.b.example.net/EN/", "http://net", "http://net/", "http://x.net?/en/", "http://Örg/fr/", "http://sub.ORG/fr/a#b",
    "http://org/fr", "a://b://c.net/d", "http://badnet/", "http://example.com/de/", "http://notexample.com/de/", "http://user@x.net:80/", "x\n://y.net/\nz", "http://.net/", "http://a..net/",
]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.key), default=None)
    return host, path, rule and rule.key, rule.verdict if rule else "allow"


def test_urls(spark, small):
    own = [r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + own)], "page_id long, url string, host string")
    want = {(i, *judged(u)) for i, u in enumerate(URLS + own)}
    assert {tuple(r) for r in url_filter.judge_urls(df, queries.URL_RULES).collect()} == want
    rules = spark.createDataFrame([(r.host, r.path, r.verdict) for r in queries.URL_RULES], "host string, path string, verdict string")
    assert {tuple(r) for r in url_filter.judge_by_join(df, rules, [1, 4]).collect()} == want
    assert url_filter.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_rows_without_an_id_or_with_one_id_are_judged_by_their_url(spark):
    rows = [(None, "http://net/a"), (None, "http://org/de"), (1, "http://example.com/de/x"), (1, "http://org/fr/"), (1, None), (None, "http://net/a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, rule string")
    rules = spark.createDataFrame([(r.host, r.path, r.verdict) for r in queries.URL_RULES], "host string, path string, verdict string")
    want = sorted((str(i), *judged(u)) for i, u in rows)
    for found in (url_filter.judge_urls(df, queries.URL_RULES), url_filter.judge_by_join(df, rules, [1, 4])):
        assert sorted(((str(r[0]), *r[1:]) for r in found.collect()), key=str) == sorted(want, key=str)


def test_equal_digests_do_not_decide(monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    index = url_filter.DigestIndex.of(url_filter.build_index([url_filter.Rule("a.b", "/", "block"), url_filter.Rule("c.d", "/", "allow")]))
    assert index.judge(["a.b", "x.c.d", "e.f"], ["/", "/", "/"], "none") == (["a.b/", "c.d/", None], ["block", "allow", "none"])


def test_escapes():
    random.seed(2)
    for _ in range(3000):
        text = "".join(random.choice(["<", "|", "~", "n", "im", "end", ">", "\n", "<|im|>", "<|end|>\n"]) for _ in range(random.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)


def windows_of(spark, rows, budget, history):
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, window int")
    return chat.format_windows(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, budget, history)


def test_windows_and_digests(spark, tiny):
    random.seed(4)
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(1000, t, ["system", "user", "assistant"][0 if t == 0 else 1 + t % 2], " ".join(random.choices(["alpha", "<|end|>", "<~n", "é\n"], k=random.randint(0, 40)))) for t in range(60)]
    rows += [(1001, 0, "assistant", None), (1001, None, None, "x"), (1001, 0, "assistant", "y"), (1002, 3, "a\nb", "z"), (None, 0, "user", "w"), (1003, 0, "system", "word " * 900)]
    for budget, history in ((2048, 256), (120, 30), (1, 0)):
        windows = windows_of(spark, rows, budget, history).cache()
        got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
        each = defaultdict(list)
        for r in rows:
            each[r[0]].append(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or ""))
        assert set(got) == set(each)
        for conv, turns in each.items():
            turns.sort()
            loss = "".join(t for _, role, t in turns if role == "assistant")
            assert got[conv]["n_turns"] == len(turns)
            assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
            assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        for w in windows.collect():
            assert w["n_tokens"] <= budget or len(w["turns"]) - w["new_from"] == 1
            if w["conv_id"] == 1000 and w["window"] > 0 and budget > 100:
                assert w["turns"][0] == 0 and w["new_from"] >= 1
    assert windows_of(spark, [], 10, 1).count() == 0


def test_shards(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", F.lit(1).alias("size"))
    odd = spark.createDataFrame([(None, None, 1), (None, "", 1), (3, "twin", 1), (3, "twin", 1)], docs.schema)
    both = docs.union(odd)
    for bucket_bytes in (1 << 24, 20_000):
        rows = sharding.shuffle_into_shards(both, bucket_bytes=bucket_bytes).collect()
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in both.collect())
        slots, place = defaultdict(list), {}
        for r in rows:
            data = (r["text"] or "").encode()
            assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")
            slots[r["shard"]].append(r["slot"])
            assert place.setdefault(r["doc_id"], r["shard"]) == r["shard"]
            assert r["grown_shard"] in (r["shard"], 24)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        again = {r["doc_id"]: r["shard"] for r in sharding.shuffle_into_shards(both, shards=25).collect()}
        assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)
        in_order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])) if r["shard"] == 5]
        assert in_order != sorted(in_order, key=lambda x: (x is not None, x))
    assert sharding.shuffle_into_shards(both.limit(0)).count() == 0


def test_written_shards(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3, bucket_bytes=50_000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_buckets_are_not_dealt_again_to_be_numbered(spark, small):
    """Texts are shuffled twice, by equal rows and by bucket, whatever Spark knows of the tables' sizes before it runs."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sharding.shuffle_into_shards(docs, bucket_bytes=50_000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.select("doc_id", "shard", "slot", F.crc32(F.col("text").cast("binary")).alias("crc")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {tuple(r) for r in rows} == {tuple(r) for r in sharding.shuffle_into_shards(docs, bucket_bytes=50_000).select("doc_id", "shard", "slot", F.crc32(F.col("text").cast("binary"))).collect()}
    assert len(rows) == len({(r["shard"], r["slot"]) for r in rows}) == docs.count()


def test_slots_are_spread_evenly(spark):
    """Each quarter of the ids is found in each quarter of the slots about as often, whatever the number of partitions."""
    df = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = sharding.shuffle_into_shards(df, shards=2, bucket_bytes=1 << 16).collect()
    size = Counter(r["shard"] for r in rows)
    cells = Counter((r["shard"], 4 * r["doc_id"] // 12_000, 4 * r["slot"] // size[r["shard"]]) for r in rows)
    assert len(cells) == 32 and sum((n - 375) ** 2 / 375 for n in cells.values()) < 60  # chi-square, 18 degrees of freedom
    other = sharding.shuffle_into_shards(df.repartition(5), shards=2, bucket_bytes=1 << 16).collect()
    assert {(r["doc_id"], r["slot"]) for r in other} == {(r["doc_id"], r["slot"]) for r in rows}


def test_windows_keep_their_budget_as_written(spark):
    """Control strings inside texts are escaped, and the escaped text is what a window's tokens are counted on."""
    said = "<|im|>user <~ <|end|> " * 30
    rows = [("a.b", k % 2, k, "user" if k % 2 == 0 else "assistant", said[: 40 + 97 * k % 500] + f" {k}") for k in range(120)]
    df = spark.createDataFrame(rows, "`x.y` string, z int, turn int, role string, text string").withColumn("conv_id", F.lit(1))
    out = chat.format_windows(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, budget=600, history=200).collect()
    encode = chat._encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert len(out) > 3
    for r in out:
        n = len(encode([r["text"]])[0])
        assert n == r["n_tokens"] and (n <= 600 or len(r["turns"]) - r["new_from"] == 1)
    assert sum(len(r["turns"]) - r["new_from"] for r in out) == 120


def test_equal_rows_spread_over_buckets(spark):
    rows = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("one text for all of them").alias("text"), F.col("id").alias("a.b"))
    out = sharding.shuffle_into_shards(rows, bucket_bytes=1000)
    assert out.groupBy("bucket").count().agg(F.max("count")).first()[0] < 100
    assert sorted(r["slot"] for r in out.collect()) == list(range(4000)) and out.select("shard").distinct().count() == 1
