"""URL filter on a sorted digest array.

Rules are host and path prefixes with a verdict, written as one string (`example.net/en/`). Their
64-bit xxhash keys are sorted by Spark into shards of disjoint ranges; a shard file holds the keys,
then the verdicts and the rule strings. Tasks memory-map shards (those of a mounted folder are one
copy per machine) and probe them with a vectorised binary search. A key that is found is confirmed against
the stored string, and equal keys of different strings are all looked at.

A URL is looked up once per host suffix and per path length that rules have. Of several fitting
rules the longest string wins, then the longer host. Without one, the verdict is allow.

Defined results: a null URL, or one without `://`, has an empty host and path and no rule; a rule
that is null or has no slash is ignored; of repeated rules, block wins; repeated URLs each give a
row; without rules everything is allowed; an empty table gives no rows. Only the named columns are
read, so other columns may have any name."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import filesystem, qualified, str_texts

SEED = 42
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MANIFEST = "path string, low long, high long, n long, path_lengths array<long>"


def build_index(rules: DataFrame, folder: str, rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """Write the shards and their manifest. Spark's xxhash64 of a string is XXH64 with seed 42."""
    spark = rules.sparkSession
    folder = qualified(spark, folder)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    named = rules.select(F.col(rule).alias("rule"), F.col(verdict).alias("verdict"))
    named = named.filter("instr(rule, '/') > 0").withColumn(
        "rule", F.concat(F.translate(F.substring_index("rule", "/", 1), UPPER, UPPER.lower()), F.expr("substring(rule, instr(rule, '/'))"))
    )
    # Allow sorts before block.
    unique = named.groupBy("rule").agg((F.max("verdict") == "block").alias("block"))
    keyed = unique.select(F.xxhash64("rule").alias("key"), "rule", "block")
    ordered = keyed.repartitionByRange("key").sortWithinPartitions("key", "rule")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, blocks = [], [], []
        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            texts += [t.encode() for t in batch.column("rule").to_pylist()]
            blocks += batch.column("block").to_pylist()
        if not texts:
            return
        key = np.concatenate(keys)
        path = f"{root}/shard-{uuid.uuid4().hex}.idx"
        with fs.open_output_stream(path) as out:
            out.write(np.int64(len(key)).tobytes())
            out.write(key.astype("<i8").tobytes())
            out.write(np.cumsum([0, *map(len, texts)]).astype("<i8").tobytes())
            out.write(np.array(blocks, np.uint8).tobytes())
            out.write(b"".join(texts))
        lengths = sorted({len(t.decode()) - t.decode().index("/") for t in texts})
        row = [path.rpartition("/")[2], int(key[0]), int(key[-1]), len(key), lengths]
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "low", "high", "n", "path_lengths"), row))])

    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


class MappedShard:
    """One shard, mapped into memory. A file that is not on a mounted folder is first copied beside
    the worker, in blocks; the copy has no name any more once it is mapped, so it goes with its
    worker, however that ends. Each worker has its own copy of the shards that it probes."""

    def __init__(self, folder: str, name: str):
        fs, root = filesystem(folder)
        path = f"{root}/{name}"
        if fs.type_name == "local":
            data = np.memmap(path, np.uint8, "r")
        else:
            with fs.open_input_stream(path) as source, tempfile.TemporaryFile() as copy:
                shutil.copyfileobj(source, copy, 1 << 20)
                copy.flush()
                data = np.memmap(copy, np.uint8, "r")
        n = int(data[:8].view("<i8")[0])
        at = 8 + 8 * n
        self.keys = data[8:at].view("<i8")
        self.offsets = data[at : at + 8 * (n + 1)].view("<i8")
        self.blocks = data[at + 8 * (n + 1) :][:n]
        self.texts = data[at + 8 * (n + 1) + n :]

    def find(self, keys: np.ndarray, texts: list[bytes]) -> list[int]:
        """Position of each text in the shard, or -1."""
        at = np.searchsorted(self.keys, keys)
        found = []
        for position, key, text in zip(at.tolist(), keys.tolist(), texts):
            while position < len(self.keys) and self.keys[position] == key:
                if self.texts[self.offsets[position] : self.offsets[position + 1]].tobytes() == text:
                    break
                position += 1
            else:
                position = -1
            found.append(position)
        return found


class UrlRules:
    def __init__(self, folder: str, shards: tuple[tuple[str, int, int], ...], lengths: tuple[int, ...]):
        self.shards = shards
        self.lows = np.array([low for _, low, _ in shards], np.int64)
        self.lengths = lengths
        self.shard = lru_cache(maxsize=None)(lambda i: MappedShard(folder, shards[i][0]))

    def lookup(self, texts: list[str]) -> dict[str, bool]:
        """Whether each rule among the texts blocks."""
        data = [t.encode() for t in texts]
        keys = np.array([xxhash.xxh64_intdigest(t, SEED) for t in data], np.uint64).view(np.int64)
        known: dict[str, bool] = {}
        # Equal keys may lie on a border, so every shard that can hold a key is probed.
        for i, (_, low, high) in enumerate(self.shards):
            some = np.flatnonzero((keys >= low) & (keys <= high))
            if len(some):
                shard = self.shard(i)
                for k, position in zip(some.tolist(), shard.find(keys[some], [data[k] for k in some])):
                    if position >= 0:
                        known[texts[k]] = bool(shard.blocks[position])
        return known

    def candidates(self, host: str, path: str) -> list[str]:
        """Rules that would fit, the winner first."""
        labels = host.split(".")
        hosts = [".".join(labels[i:]) for i in range(len(labels))]
        fitting = [(h, path[:n]) for h in hosts for n in self.lengths if n <= len(path)]
        fitting.sort(key=lambda x: (len(x[0]) + len(x[1]), len(x[0])), reverse=True)
        return [h + p for h, p in fitting]


def host_and_path(url: str) -> tuple[str, str]:
    _, sign, rest = url.partition("://")
    if not sign:
        return "", ""
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.encode().lower().decode(), slash + path


@lru_cache(maxsize=2)
def _rules(folder: str, shards: tuple, lengths: tuple) -> UrlRules:
    return UrlRules(folder, shards, lengths)


def judge_urls(
    pages: DataFrame, manifest: DataFrame, folder: str, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """page_id, host, path, rule, verdict. The manifest has one row per shard."""
    folder = qualified(pages.sparkSession, folder)
    listed = manifest.orderBy("low").collect()
    shards = tuple((r["path"], r["low"], r["high"]) for r in listed)
    lengths = tuple(sorted({n for r in listed for n in r["path_lengths"]}))
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _rules(folder, shards, lengths)
        for batch in batches:
            parts = [host_and_path(u) for u in str_texts(batch.column("url"))]
            fitting = [rules.candidates(*p) for p in parts]
            known = rules.lookup(list({c for some in fitting for c in some}))
            chosen = [next((c for c in some if c in known), None) for some in fitting]
            verdicts = ["block" if c is not None and known[c] else "allow" for c in chosen]
            columns = [[h for h, _ in parts], [p for _, p in parts], chosen, verdicts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, pa.string()) for c in columns)],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    kind = slim.schema["page_id"].dataType.simpleString()
    return slim.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
