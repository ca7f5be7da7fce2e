"""The registered queries against their SQL statements, and against brute force where SQL ends."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from meterloom.llm import bpe
from meterloom.llm.oracles import llm_oracles
from meterloom.llm.queries import llm_queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = llm_queries()[name](spark, sf_dir)
    expected = con.execute(llm_oracles()[name])
    names = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert _rows(found.columns, found.collect()) == _rows(names, expected.fetchall())


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def test_token_store_query(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = {}, 0
    for doc_id in sorted(texts):
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        expected[doc_id] = (start, len(ids), crc)
        start += len(ids)
    rows = llm_queries()["op2_token_store"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected


def test_byte_bpe_query(spark, sf_dir, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = llm_queries()["op9_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = exact.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_every_operator_is_registered():
    names = [n for n in llm_queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in llm_queries()
