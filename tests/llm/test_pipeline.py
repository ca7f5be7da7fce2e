"""The stages on their own input: what goes had to go, what stays is clean."""

from __future__ import annotations

import public_tokenizers
import tiktoken

import corpus_pipeline
from meterloom.llm import bpe, decontaminate, simhash
from meterloom.llm.common import table
from meterloom.sources.scratch import scratch_path


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "byte_bpe":
            assert after.columns == columns
        seen[name] = ({r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in after.collect()})
        docs = after
    before, after = seen["quality_rules"]
    for i, r in before.items():
        words = r["text"].encode().split()
        assert i in after or len(words) < 50 or len(set(words)) < len(words)
    before, after = seen["line_dedup"]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"])
        assert set(r["text"].split("\n")) <= set(before[i]["text"].split("\n")) | {""}
    before, after = seen["near_dedup"]
    fps = {i: simhash.fingerprint(r["text"].encode()) for i, r in before.items()}
    root = {i: i for i in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (fps[i] ^ fps[j]).bit_count() <= 4 and top(i) != top(j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    assert set(after) == {top(i) for i in ids}
    before, after = seen["decontamination"]
    bench = table(spark, sf_dir, "benchmark")
    hit = {r["doc_id"] for r in decontaminate.report(spark.createDataFrame(list(before.values())), bench).filter("contaminated").collect()}
    assert set(after) == set(before) - hit
    before, after = seen["byte_bpe"]
    exact = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    assert {i: r["ids"] for i, r in after.items()} == {i: exact.encode_ordinary(r["text"]) for i, r in before.items()}
    result = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert result == {i: r["n_tokens"] for i, r in after.items()}
