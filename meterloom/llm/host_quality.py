"""Host-level quality rules.

Base rules look at one document. Their failures are summed by host, the failure rate of each host
is shrunk towards the corpus rate with a beta prior fitted to all hosts, and hosts whose shrunken
rate is too high are rejected with all their documents.

Defined results: a null text has no words (and fails the length rule); documents with a null host
form one host of their own; repeated rows count as often as they occur; an empty table gives no
rows and needs no prior. Only the named columns are read, so other columns may have any name."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import byte_texts
from meterloom.operators.sizing import is_small, maybe_broadcast
from meterloom.sources.scratch import scratch_path

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """Limits of the base rules, and the shrunken failure rate above which a host is rejected."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5
    # The weight of the prior, in documents, is kept within these bounds.
    min_strength: float = 1.0
    max_strength: float = 1e6


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice, first occurrences included."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(codes) + ids[1:], return_inverse=True)
    _, windows, times = np.unique(
        pairs[:-1] * len(codes) + ids[2:], return_inverse=True, return_counts=True
    )
    again = times[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five counts of COUNTS. Words end at ASCII white space, as bytes.split does."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(rules: HostRules) -> str:
    return (
        f"(n_words < {rules.min_words} OR "
        f"100 * n_repeat_words > {rules.max_repeat_percent} * n_words)"
    )


def document_counts(
    docs: DataFrame, rules: HostRules, doc_id: str, text: str, host: str
) -> DataFrame:
    """One row per document: doc_id, host, the counts and base_failed."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    kept = slim.select("doc_id", "host").schema
    fields = ", ".join(f"{c} long" for c in COUNTS)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [text_counts(t) for t in byte_texts(batch.column("text"))]
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] or [
                pa.array([], pa.int64()) for _ in COUNTS
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *columns],
                names=["doc_id", "host", *COUNTS],
            )

    counted = slim.mapInArrow(count, f"{types}, {fields}")
    return counted.withColumn("base_failed", F.expr(base_failed(rules)))


def fit_prior(hosts: DataFrame, rules: HostRules) -> tuple[float, float]:
    """Beta prior by the method of moments: the variance of the host rates beyond what sampling
    explains. Only sums over the hosts reach the driver."""
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
    ).first()
    if not sums["n"]:
        return 1.0, 1.0
    mean = sums["failed"] / sums["n"]
    spread = mean * (1 - mean)
    between = sums["squares"] / sums["n"] - mean * mean - spread * sums["hosts"] / sums["n"]
    strength = spread / between - 1 if between > 0 else rules.max_strength
    strength = min(max(strength, rules.min_strength), rules.max_strength)
    return mean * strength, (1 - mean) * strength


def host_verdicts(counted: DataFrame, rules: HostRules) -> DataFrame:
    """One row per host: documents, failures, shrunken rate, verdict. The sums are combined
    before the shuffle, so a host with a third of all documents ships one row per task."""
    hosts = counted.groupBy("host").agg(
        F.count("*").alias("n"), F.expr("count_if(base_failed)").alias("failed")
    )
    a, b = fit_prior(hosts, rules)
    rate = (F.col("failed") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn(
        "host_rejected", F.col("rate") > F.lit(rules.max_host_rate)
    )


def judge(
    spark: SparkSession,
    docs: DataFrame,
    rules: HostRules = HostRules(),
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """doc_id, host, counts, base_failed, host_rejected, kept. The counts are written once to the
    shared folder (numbers only), because the prior needs all of them before the first verdict."""
    path = scratch_path(spark, "host-counts")
    document_counts(docs, rules, doc_id, text, host).write.parquet(path)
    counted = spark.read.parquet(path)
    verdicts = host_verdicts(counted, rules).select(F.col("host").alias("of_host"), "host_rejected")
    same = F.col("host").eqNullSafe(F.col("of_host"))
    joined = counted.join(verdicts, same, "left").drop("of_host")
    return joined.withColumn("kept", ~(F.col("base_failed") | F.col("host_rejected")))


def keep_good(
    spark: SparkSession,
    docs: DataFrame,
    rules: HostRules = HostRules(),
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The documents that pass, with all their columns. Texts are counted again while they are
    filtered, which costs less than shuffling them to meet their verdicts."""
    path = scratch_path(spark, "host-counts")
    document_counts(docs, rules, host, text, host).write.parquet(path)
    rejected = host_verdicts(spark.read.parquet(path), rules).filter("host_rejected")
    path = scratch_path(spark, "rejected-hosts")
    rejected.select(F.col("host").alias("rejected_host")).write.parquet(path)
    rejected = spark.read.parquet(path)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = []
            for t in byte_texts(batch.column(text)):
                counts = text_counts(t)
                short = counts[0] < rules.min_words
                mask.append(not short and 100 * counts[4] <= rules.max_repeat_percent * counts[0])
            yield batch.filter(pa.array(mask, pa.bool_()))

    good = docs.mapInArrow(passing, docs.schema)
    same = good[host].eqNullSafe(rejected["rejected_host"])
    # Few hosts, which is counted, leave the texts where they are. Otherwise both sides start at
    # their own exchange, so the documents of a very large host can be split over tasks.
    return good.join(maybe_broadcast(rejected, is_small(rejected)), same, "left_anti")
