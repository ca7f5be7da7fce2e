"""Nulls, empty tables, repeated rows, ties, very long texts and clashing column names."""

from __future__ import annotations

import public_tokenizers
import pytest

from meterloom.llm import (
    bpe,
    chat_format,
    decontaminate,
    host_quality,
    line_align,
    secret_scan,
    simhash,
    token_store,
    unigram_count,
    url_filter,
)
from meterloom.sources.scratch import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Columns whose names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, source string, row string, key string, n_words long, fp long, "
    "host string, kept boolean, w string, ids string, hits string, root string, words string"
)
LONG = " ".join(f"w{i % 7919} Word{i}." for i in range(60_000))


def _frame(spark, rows):
    width = len(SCHEMA.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - 3)) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, repeated and very long texts; null and repeated ids."""
    rows = [
        (1, None, "a"), (2, "", None), (3, " \n\t \n", "b"), (4, "same text here", "a"),
        (4, "same text here", "a"), (5, "same text here", None), (None, "no id at all", "a"),
        (6, LONG, "b"), (7, LONG, "b"), (8, "x", "c"),
    ]
    return _frame(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return _frame(spark, [])


@pytest.fixture(scope="module")
def no_benchmark(spark):
    return spark.createDataFrame([], "item_id long, text string")


def _each(spark, docs, benchmark):
    folder = scratch_path(spark, "tokens")
    manifest = token_store.write_store(docs, folder, JSON)
    return {
        "tokens": token_store.read_documents(manifest, folder),
        "hosts": host_quality.judge(spark, docs),
        "good": host_quality.keep_good(spark, docs),
        "leaks": decontaminate.report(docs, benchmark),
        "clean": decontaminate.drop_documents(docs, benchmark),
        "spans": decontaminate.drop_spans(docs, benchmark),
        "near": simhash.near_duplicates(spark, docs),
        "first": simhash.keep_first(spark, docs),
        "lines": line_align.report(spark, docs),
        "cut": line_align.replace_texts(spark, docs),
        "pieces": unigram_count.count_tokens(docs, PIECES),
        "bpe": bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN),
        "ids": bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN),
        "secrets": secret_scan.scan(spark, docs, RANKS),
    }


def test_empty_tables(spark, nothing, no_benchmark):
    for name, df in _each(spark, nothing, no_benchmark).items():
        assert df.count() == 0, name


def test_odd_rows(spark, odd, no_benchmark):
    found = _each(spark, odd, no_benchmark)
    rows = {name: df.collect() for name, df in found.items()}
    for name in ("tokens", "hosts", "leaks", "clean", "spans", "near", "lines", "cut", "pieces", "bpe", "ids"):
        assert len(rows[name]) == 10, name
    for name in ("good", "clean", "spans", "first", "cut"):
        assert found[name].columns == odd.columns, name
    tokens = {r["doc_id"]: r["n_tokens"] for r in rows["tokens"]}
    assert tokens[1] == tokens[2] == 1 and tokens[6] == tokens[7] > 100_000
    starts = [r["start"] for r in sorted(rows["tokens"], key=lambda r: r["start"])]
    assert starts[0] == 0 and rows["tokens"][0] is not None
    assert min(rows["tokens"], key=lambda r: r["start"])["doc_id"] is None
    words = {r["doc_id"]: r["n_words"] for r in rows["hosts"]}
    assert words[1] == words[2] == words[3] == 0 and words[6] == 120_000
    # Most documents fail here, so the prior alone rejects every host.
    assert rows["good"] == [] and all(r["host_rejected"] for r in rows["hosts"])
    lenient = host_quality.HostRules(max_host_rate=1.0)
    assert {r["doc_id"] for r in host_quality.keep_good(spark, odd, lenient).collect()} == {6, 7}
    parts = {r["doc_id"]: r["component_id"] for r in rows["near"]}
    assert parts[1] == parts[2] == parts[3] == 1
    assert parts[4] == parts[5] == 4 and parts[6] == parts[7] == 6 and parts[8] == 8
    assert parts[None] is None
    # A row that is there twice stays once; the null id is first of its own group.
    assert sorted((r["doc_id"] for r in rows["first"]), key=str) == sorted([1, 4, None, 6, 8], key=str)
    lines = {r["doc_id"]: r for r in rows["lines"]}
    assert lines[7]["is_copy"] and lines[7]["kept_chars"] == 0
    assert lines[6]["kept_chars"] == len(LONG)
    assert not lines[5]["is_copy"]  # shorter than any block
    assert {r["doc_id"]: r["text"] for r in rows["cut"]}[1] is None
    assert all(not r["contaminated"] for r in rows["leaks"])
    assert rows["secrets"] == []
    assert {r["doc_id"]: r["n_tokens"] for r in rows["pieces"]}[1] == 0


def test_urls(spark):
    rules = spark.createDataFrame(
        [("net/", "block"), ("a.net/en/", "allow"), ("a.net/en/", "allow"), ("b.net/", "allow"),
         ("b.net/", "block"), (None, "block"), ("noslash", "block"), ("COM/x", "block"), ("é.org/ü", "block")],
        "rule string, verdict string",
    )
    pages = spark.createDataFrame(
        [(1, "http://x.a.net/en/1"), (2, "http://x.a.net/e"), (3, None), (4, "nothing"), (5, "http://b.net/"),
         (6, "HTTP://Q.Com/x?y#z"), (7, "http://net"), (8, "http://anet/en/"), (9, "x://é.org/üa"),
         (10, "http://a.net?/en/"), (10, "http://a.net?/en/"), (None, "http://é.org/u")],
        "page_id long, url string",
    )
    folder = scratch_path(spark, "rules")
    manifest = url_filter.build_index(rules, folder)
    rows = url_filter.judge_urls(pages, manifest, folder).collect()
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == 12
    assert found[1] == ("x.a.net", "/en/1", "a.net/en/", "allow")
    assert found[2] == ("x.a.net", "/e", "net/", "block")
    assert found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("b.net", "/", "b.net/", "block")
    assert found[6] == ("q.com", "/x", "com/x", "block")
    assert found[7] == ("net", "", None, "allow")
    assert found[8] == ("anet", "/en/", None, "allow")
    assert found[9] == ("é.org", "/üa", "é.org/ü", "block")
    assert found[10] == ("a.net", "", None, "allow")
    assert found[None] == ("é.org", "/u", None, "allow")
    assert url_filter.judge_urls(pages.limit(0), manifest, folder).count() == 0
    empty = scratch_path(spark, "rules")
    nothing = url_filter.build_index(rules.limit(0), empty)
    assert {r["verdict"] for r in url_filter.judge_urls(pages, nothing, empty).collect()} == {"allow"}


def test_key_collisions_are_confirmed(tmp_path):
    import numpy as np

    texts = [b"a/", b"b/", b"c/"]
    data = np.int64(3).tobytes() + np.array([5, 5, 9], "<i8").tobytes()
    data += np.array([0, 2, 4, 6], "<i8").tobytes() + bytes([1, 0, 1]) + b"".join(texts)
    (tmp_path / "shard").write_bytes(data)
    shard = url_filter.MappedShard(str(tmp_path), "shard")
    keys = np.array([5, 5, 5, 9, 7])
    assert shard.find(keys, [b"b/", b"a/", b"x/", b"c/", b"a/"]) == [1, 0, -1, 2, -1]


def test_chats(spark):
    rows = [
        (1, 1, "assistant", "b\\### <|x|> </turn>"), (1, 0, "user", None), (1, None, None, "first"),
        (None, 0, "assistant", "é" * 5), (2, 0, "assistant", "t"), (2, 0, "assistant", "t"), (2, 0, "assistant", "s"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F

    content = turns.withColumn("content", chat_format.text_part(F.col("text")))
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(content)).collect()}
    assert found[1]["n_turns"] == 3 and found[1]["loss_chars"] == len("b\\### <|x|> </turn>")
    assert found[None]["loss_chars"] == 5 and found[2]["n_turns"] == 3 and found[2]["loss_chars"] == 3
    import hashlib

    said = "\nfirst\n" + "user\n\n" + "assistant\nb\\### <|x|> </turn>\n"
    assert found[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert found[2]["loss_sha256"] == hashlib.sha256(b"stt").hexdigest()
    assert chat_format.read_back(chat_format.format_turns(content.limit(0))).count() == 0
