"""SimHash near-duplicates by anchor-point covering.

Every text has a 64-bit fingerprint. The anchors are the words of the perfect binary Golay code
(23 bits, covering radius 3) on two blocks of 23 fingerprint bits, so 2^24 pairs of code words
cover all fingerprints. Two fingerprints that differ in at most t bits have a point half way
between them, at most ceil(t/2) bits from each; that point lies within the covering radius of some
anchor in both blocks. So each fingerprint is replicated to every anchor within the covering radius
plus half the threshold (both sides move, so half is enough), and linked fingerprints always meet
at an anchor. There they are compared over all 64 bits. For t = 4 that makes 61 copies of 12 bytes
on average, whatever the corpus, and a chance meeting needs 24 equal bits.

Fingerprints are made distinct first, so copies of a text never meet each other; large anchors
give a spanning forest of their links, never all pairs; components are built on those links.

Defined results: a text without words (null, empty, blank) has fingerprint zero and is linked like
any other; repeated rows and ids share their component; null ids are passed through, and the
component of documents that all have null ids is null; an empty table gives no rows. Only the
named columns are read, so other columns may have any name."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import byte_texts, text_key
from meterloom.llm.components import connected
from meterloom.sources.scratch import scratch_path

SEED = 42
BLOCK = 23
RADIUS = 3
# Fixed value: generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0xC75
#: Anchors with more fingerprints are searched breadth first instead of by shifts.
SHIFTS = 64


def fingerprint(text: bytes, width: int = 4, block: int = 1 << 16) -> int:
    """A bit is set if more than half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - width + 1)
    starts, stops = [0, *ends], ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, block):
        pairs = zip(starts[at : min(at + block, n)], stops[at : at + block])
        hashes = b"".join([digest(joined[a : b - 1], SEED) for a, b in pairs])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str, text: str, with_key: bool = False) -> DataFrame:
    """doc_id, fp long, and on demand the key of the text."""
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        *([text_key(F.col(text)).alias("key")] if with_key else []),
    )
    kept = [c for c in slim.columns if c != "text"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in byte_texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(fps.view(np.int64))], names=[*kept, "fp"]
            )

    types = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in kept)
    return slim.mapInArrow(hashed, f"{types}, fp long")


class Golay:
    """Code words around a 23-bit point. A point plus any pattern with the same syndrome is a code
    word; patterns are listed by syndrome, and by how far they reach beyond the radius."""

    def __init__(self, extra: int):
        powers = []
        x = 1
        for _ in range(BLOCK):
            powers.append(x)
            x <<= 1
            if x >> 11:
                x ^= GENERATOR
        self.powers = np.array(powers, np.int64)
        by_reach: list[list[int]] = [[] for _ in range(extra + 1)]
        for weight in range(RADIUS + extra + 1):
            for bits in combinations(range(BLOCK), weight):
                by_reach[max(0, weight - RADIUS)].append(sum(1 << b for b in bits))
        self.reaches = []
        for patterns in by_reach:
            found = np.array(patterns, np.int64)
            syndromes = self.syndrome(found)
            order = np.argsort(syndromes, kind="stable")
            first = np.searchsorted(syndromes[order], np.arange(2049))
            self.reaches.append((found[order], first[:-1], np.diff(first)))

    def syndrome(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for bit, power in enumerate(self.powers):
            out ^= np.where(points >> bit & 1, power, 0)
        return out


@lru_cache(maxsize=4)
def golay(extra: int) -> Golay:
    return Golay(extra)


def anchors(fps: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, position in fps) for every anchor in reach, in a few arrays."""
    extra = (threshold + 1) // 2
    code = golay(extra)
    points = [(fps.view(np.uint64) >> np.uint64(s)).astype(np.int64) & (1 << BLOCK) - 1 for s in (0, BLOCK)]
    syndromes = [code.syndrome(p) for p in points]
    for i in range(extra + 1):
        for j in range(extra + 1 - i):
            (pa_, fa, na), (pb, fb, nb) = code.reaches[i], code.reaches[j]
            n_b = nb[syndromes[1]]
            total = na[syndromes[0]] * n_b
            row = np.repeat(np.arange(len(fps)), total)
            within = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
            a = points[0][row] ^ pa_[fa[syndromes[0]][row] + within // n_b[row]]
            b = points[1][row] ^ pb[fb[syndromes[1]][row] + within % n_b[row]]
            # The upper 12 bits tell the code words of one block apart.
            yield (a >> 11 << 12 | b >> 11).astype(np.int32), row


def _forest(fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Positions of links that span the components of one anchor's fingerprints, breadth first."""
    found, left = [], np.arange(len(fps))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            point = todo.pop()
            near = np.bitwise_count(fps[left] ^ fps[point]) <= threshold
            new = left[near].tolist()
            found += [(point, other) for other in new]
            todo += new
            left = left[~near]
    return found


def _spanning(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those links that join two components."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, b in links:
        if (x := top(a)) != (y := top(b)):
            root[x] = y
            kept.append((a, b))
    return kept


def links(keys: np.ndarray, fps: np.ndarray, threshold: int) -> np.ndarray:
    """Positions (n, 2) of linked fingerprints within equal keys (sorted). No anchor gives more
    links than it has fingerprints."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    sizes = np.diff(edges)
    found: list[tuple[int, int]] = []
    for g in np.flatnonzero(sizes > SHIFTS):
        start = int(edges[g])
        near = _forest(fps[start : edges[g + 1]], threshold)
        found += [(a + start, b + start) for a, b in near]
    group = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(sizes[group] <= SHIFTS)
    pairs = [np.array(found, np.int64).reshape(-1, 2)]
    for shift in range(1, SHIFTS):
        at = at[at + shift < len(keys)]
        at = at[keys[at] == keys[at + shift]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= threshold]
        pairs.append(np.stack([near, near + shift], axis=1))
    rows = np.concatenate(pairs)
    many = np.bincount(group[rows[:, 0]], minlength=len(sizes))[group[rows[:, 0]]] >= sizes[group[rows[:, 0]]]
    thinned = _spanning(list(map(tuple, rows[many].tolist())))
    return np.concatenate([rows[~many], np.array(thinned, np.int64).reshape(-1, 2)])


def near_pairs(fps: DataFrame, threshold: int) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (fp long)."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 2048):
                some = values[at : at + 2048]
                for anchor, row in anchors(some, threshold):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(some[row])], names=["anchor", "fp"]
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            rows = np.unique(fps.view(np.int64)[links(keys, fps, threshold)], axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"]
            )

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column("anchor").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)))
            last = held[-1][0][-1]
            if sum(len(k) for k, _ in held) >= 1 << 17 and held[0][0][0] != last:
                keys, fps = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(keys, last))  # the last anchor may go on
                yield found(keys[:cut], fps[:cut])
                held = [(keys[cut:], fps[cut:])]
        if held:
            yield found(*(np.concatenate(x) for x in zip(*held)))

    dealt = fps.mapInArrow(replicate, "anchor int, fp long").repartition(F.col("anchor"))
    return dealt.sortWithinPartitions("anchor", "fp").mapInArrow(compare, "a long, b long")


def rooted(
    spark: SparkSession, docs: DataFrame, threshold: int, doc_id: str, text: str, with_key: bool
) -> DataFrame:
    """doc_id, fp, root (one fingerprint that stands for the component), and on demand the key of
    the text. Fingerprints are written once; the links need them before the documents do."""
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, doc_id, text, with_key).write.parquet(path)
    hashed = spark.read.parquet(path)
    stars = connected(spark, near_pairs(hashed.select("fp").distinct(), threshold))
    roots = stars.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return hashed.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    threshold: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, fp, component_id: the smallest id that can be reached over links."""
    rows = rooted(spark, docs, threshold, doc_id, text, with_key=False)
    least = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # A key of its own: both sides of the join then start at their own exchange, and the documents
    # of a very large component can be split over tasks.
    least = least.select(F.bitwise_not("root").alias("flipped"), "component_id")
    joined = rows.join(least, F.bitwise_not(rows["root"]) == least["flipped"])
    return joined.select("doc_id", "fp", "component_id")


def keep_first(
    spark: SparkSession,
    docs: DataFrame,
    threshold: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id (null
    first), then the smallest text key; a row that is there several times stays once."""
    rows = rooted(spark, docs, threshold, doc_id, text, with_key=True)
    rows = rows.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "key", "n")).alias("first"))
    path = scratch_path(spark, "survivors")
    first.select(_name("first.doc_id", "first.key").alias("name"), "first.n").write.parquet(path)
    first = spark.read.schema("name string, n long").parquet(path)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    named = docs.select(row, _name(docs[doc_id], text_key(docs[text])).alias("name_of"))
    # Texts are dealt once, by a name that only the join uses: a hot one can be split over tasks. Rows
    # that are there several times are few kinds of rows and collapse before they are dealt again.
    once = named.join(first.filter("n = 1"), F.col("name_of") == F.col("name"))
    repeated = named.join(first.filter("n > 1"), F.col("name_of") == F.col("name"))
    repeated = repeated.groupBy("name").agg(F.first("row").alias("row"))
    return once.select("row").union(repeated.select("row")).select("row.*")


def _name(doc_id: Column | str, key: Column | str) -> Column:
    """Id and text key as one text; a null id leaves the key alone."""
    id_text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.concat_ws(" ", F.hex(key), id_text)
