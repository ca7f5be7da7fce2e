"""Hard negatives by rotated one-bit codes with deterministic intervals.

Every vector is rotated by one fixed random rotation and kept as its signs (one bit per component),
its norm and its alignment: the inner product of the rotated vector with its own unit sign vector.
An anchor's rotated vector is quantised to 8 bits, so popcounts over its bit planes give its
product with a sign vector. With the stored alignment that estimates the inner product; what lies
outside the sign direction is bounded by Cauchy-Schwarz on the two residuals, what quantising loses
by the sum of its errors. So the true score lies in the interval for certain, not just likely. Rows
whose interval cannot matter are passed over; the others are scored as integers, and the integers
decide.

Rows are dealt into blocks by row number, never by label or value, so a hot label or a large group
of copies fills no task. Anchors are streamed past each block, some at a time. A block returns at
most the first n_positives rows of an anchor and the first n_negatives of a (anchor, positive). The
search is done twice: positives first, then what lies between their bounds. Work is anchors times
rows, as a search of a query set against all rows is; memory is one block and one batch.

Defined results: rows without a label, a vector or with a null or non-finite component take no part;
a row without id is no anchor and comes last among ties; rows that repeat an id are separate rows
(other than each other); an anchor without another row of its label, or a positive without a row
between the bounds, gives no rows; an empty table gives none; vectors of different lengths raise an
error, as do scores beyond long. Only the named columns are read, so others may have any name."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.llm.vectors import integer_vector, largest, matrix, one_size, usable
from meterloom.sources.scratch import scratch_path

#: Rows of a block and anchors of a task at most (on average; rows are dealt by hash).
BLOCK_ROWS = 32768
TASK_ANCHORS = 65536
#: Anchor-row pairs that are looked at at once.
AT_ONCE = 1 << 19
PLANES = 8
#: Share of the norms that covers the rounding of doubles in estimates.
SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class MiningRules:
    """A negative's score s lies between two percentages of its positive's score p:
    least * p <= 100 * s <= most * p."""

    n_positives: int = 5
    n_negatives: int = 3
    least: int = 50
    most: int = 95


@lru_cache(maxsize=4)
def rotation(size: int, seed: int = 42) -> np.ndarray:
    """An orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, the last word filled up with zeros."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class Codes:
    """One-bit codes of integer vectors, with what the intervals need."""

    def __init__(self, x: np.ndarray):
        rotated = x.astype(float) @ rotation(x.shape[1])
        self.size = x.shape[1]
        self.words = _words(rotated > 0)
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.norm = np.linalg.norm(rotated, axis=1)
        self.aligned = np.where(rotated > 0, rotated, -rotated).sum(axis=1) / max(1, self.size) ** 0.5
        self.residual = np.sqrt(np.maximum(0, self.norm**2 - self.aligned**2))

    def intervals(self, anchors: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the inner products, one row per anchor."""
        rotated = anchors.astype(float) @ rotation(self.size)
        norm = np.linalg.norm(rotated, axis=1)
        low = rotated.min(axis=1)
        step = (rotated.max(axis=1) - low) / (2**PLANES - 1)
        step[step == 0] = 1.0
        units = np.rint((rotated - low[:, None]) / step[:, None]).astype(np.uint8)
        lost = np.abs(rotated - low[:, None] - step[:, None] * units).sum(axis=1)
        words, counts = self.words[rows], np.zeros((len(anchors), len(self.words[rows])))
        for plane in range(PLANES):
            bits = _words(units >> plane & 1)
            for w in range(words.shape[1]):
                counts += np.bitwise_count(words[None, :, w] & bits[:, None, w]) * float(1 << plane)
        root = self.size**0.5
        whole = low * self.size + step * units.sum(axis=1, dtype=np.int64)
        along = 2 * (low[:, None] * self.ones[rows] + step[:, None] * counts) - whole[:, None]
        along /= root
        lost = (lost / root + SLACK * norm)[:, None]
        off = np.sqrt(np.maximum(0, norm[:, None] ** 2 - np.maximum(0, np.abs(along) - lost) ** 2))
        aligned, size = self.aligned[rows], self.norm[rows]
        half = aligned * lost + self.residual[rows] * off + SLACK * norm[:, None] * size
        return aligned * along - half, aligned * along + half


def products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of rows i of a with rows j of b, some at a time."""
    if largest(a) * largest(b) * max(1, a.shape[1]) >= 1 << 63:
        return np.array([sum(int(u) * int(v) for u, v in zip(a[p], b[q])) for p, q in zip(i, j)], np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 15):
        some = slice(at, at + (1 << 15))
        out[some] = np.einsum("ij,ij->i", a[i[some]], b[j[some]])
    return out


def _largest_of(values: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th largest value, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def _first(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k of each group: higher scores, then smaller ties."""
    order = np.lexsort((tie, ~score, group))
    sorted_group = group[order]
    start = np.searchsorted(sorted_group, sorted_group)
    return order[np.arange(len(order)) - start < k]


class Block:
    """Rows of one block, sorted by label."""

    def __init__(self, uid: np.ndarray, ids: np.ndarray, label: np.ndarray, x: np.ndarray):
        order = np.argsort(label, kind="stable")
        self.uid, self.ids, self.label, self.x = uid[order], ids[order], label[order], x[order]
        self.codes = Codes(self.x) if x.shape[1] else None
        self.scored = 0

    def _bounds(self, anchors: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        if self.codes is None:
            shape = len(anchors), len(self.uid[rows])
            return np.full(shape, -np.inf), np.full(shape, np.inf)
        return self.codes.intervals(anchors, rows)

    def positives(self, uid: np.ndarray, label: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
        """(anchors, rows, scores): of each anchor's label its first k rows here, itself left out."""
        for value in np.unique(label):
            ends = (int(np.searchsorted(self.label, value, side)) for side in ("left", "right"))
            rows = slice(*ends)
            if rows.start == rows.stop:
                continue
            of = np.flatnonzero(label == value)
            step = max(1, AT_ONCE // (rows.stop - rows.start))
            for at in range(0, len(of), step):
                some = of[at : at + step]
                low, high = self._bounds(x[some], rows)
                own = uid[some][:, None] == self.uid[rows]
                low[own] = high[own] = -np.inf
                # Intervals whose upper end is below k lower ends cannot be among the first k.
                a, r = np.nonzero((high >= _largest_of(low, k)[:, None]) & ~own)
                r += rows.start
                score = products(x, self.x, some[a], r)
                self.scored += len(score)
                best = _first(a, score, self.ids[r], k)
                yield some[a[best]], r[best], score[best]

    def negatives(
        self, label: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
    ) -> Iterator[tuple]:
        """(anchors, positives, rows, scores): the first k rows of another label whose score lies
        within the bounds, which have one column per positive (none where low exceeds high)."""
        rows = slice(0, len(self.uid))
        step = max(1, AT_ONCE // len(self.uid))
        for at in range(0, len(x), step):
            some = slice(at, at + step)
            least, most = self._bounds(x[some], rows)
            other = label[some][:, None] != self.label
            wanted = np.zeros_like(other)
            for p in range(low.shape[1]):
                bottom, top = low[some, p, None], high[some, p, None]
                sure = np.where(other & (least >= bottom) & (most <= top), least, -np.inf)
                near = other & (most >= bottom) & (least <= top) & (bottom <= top)
                wanted |= near & (most >= _largest_of(sure, k)[:, None])
            a, r = np.nonzero(wanted)
            score = products(x[some], self.x, a, r)
            self.scored += len(score)
            for p in range(low.shape[1]):
                held = np.flatnonzero((score >= low[some][a, p]) & (score <= high[some][a, p]))
                best = held[_first(a[held], score[held], self.ids[r[held]], k)]
                yield a[best] + at, np.full(len(best), p), r[best], score[best]


def _streamed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """(block, batch of its anchors): rows sorted by block, those of the block before its anchors."""
    held: list[pa.RecordBatch] = []
    block, place = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("slot", "part", "kind")]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
            here = int(keys[0][start]), int(keys[1][start])
            if here != place:
                held, block, place = [], None, here
            some = batch.slice(start, stop - start)
            if not keys[2][start]:
                held.append(some)
                continue
            if block is None and held:
                columns = [np.concatenate([_numbers(b, c) for b in held]) for c in ("uid", "vec_id", "label")]
                block = Block(*columns, np.concatenate([matrix(b.column("x"), size) for b in held]))
                held = []
            if block is not None:
                yield block, some


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, mask=values == NO_ID)


class Search:
    """Usable rows in the shared folder, and how many blocks they fill."""

    def __init__(self, spark: SparkSession, rows: DataFrame, anchor: str):
        path = scratch_path(spark, "integer-vectors")
        numbered = rows.withColumn("uid", F.monotonically_increasing_id())
        numbered.withColumn("is_anchor", F.expr(anchor)).write.parquet(path)
        self.rows = spark.read.schema(
            "vec_id long, label long, x array<bigint>, uid long, is_anchor boolean"
        ).parquet(path)
        n = self.rows.count()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.n_slots = max(-(-n // BLOCK_ROWS), min(tasks, -(-n // 1024)), 1)
        self.anchors = self.rows.filter("is_anchor").drop("is_anchor")
        self.n_parts = max(1, -(-self.anchors.count() // TASK_ANCHORS))
        self.size = one_size(self.rows)

    def dealt(self, anchors: DataFrame) -> DataFrame:
        """Every block of rows, followed by the anchors (with their further columns); many anchors
        are parted, and the block is repeated for each part."""

        def numbers(n: int) -> F.Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        def place(n: int) -> F.Column:
            return F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")

        rows = self.rows.drop("is_anchor").withColumns({"kind": F.lit(0), "slot": place(self.n_slots)})
        rows = rows.withColumn("part", numbers(self.n_parts))
        asked = anchors.withColumns({"kind": F.lit(1), "part": place(self.n_parts)})
        asked = asked.withColumn("slot", numbers(self.n_slots))
        both = rows.unionByName(asked, allowMissingColumns=True)
        tasks = self.n_slots * self.n_parts
        return both.repartition(tasks, "slot", "part").sortWithinPartitions("slot", "part", "kind")


def _positives(search: Search, rules: MiningRules) -> DataFrame:
    """uid of an anchor, place (from 1), positive_id, positive_score."""
    size = search.size

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, some in _streamed(batches, size):
            uid, label, x = _numbers(some, "uid"), _numbers(some, "label"), matrix(some.column("x"), size)
            for a, r, score in block.positives(uid, label, x, rules.n_positives):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[a]), _ids(block.ids[r]), pa.array(score)],
                    names=["uid", "positive_id", "positive_score"],
                )

    found = search.dealt(search.anchors).mapInArrow(
        look, "uid long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("uid").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rules.n_positives)


def mine(
    spark: SparkSession,
    vectors: DataFrame,
    anchor: str = "vec_id % 50 = 0",
    rules: MiningRules = MiningRules(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | F.Column = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. anchor is a
    condition on vec_id."""
    value = F.col(label) if isinstance(label, str) else label
    rows = vectors.filter(usable(vector) & value.isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        value.cast("long").alias("label"),
        integer_vector(vector).alias("x"),
    )
    search = Search(spark, rows, anchor)
    result = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    if search.size is None:
        return spark.createDataFrame([], result).withColumn("rank", F.lit(0))
    path = scratch_path(spark, "positives")
    _positives(search, rules).write.parquet(path)
    one = F.struct("place", "positive_id", "positive_score")
    listed = (
        spark.read.schema("uid long, positive_id long, positive_score long, place int")
        .parquet(path)
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(one)).alias("positives"))
    )
    asked = search.anchors.join(listed, "uid")
    size, width = search.size, rules.n_positives

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, some in _streamed(batches, size):
            columns = [_numbers(some, c) for c in ("uid", "vec_id", "label")]
            uid, ids, labels = columns
            ids_p = np.full((len(uid), width), NO_ID)
            scores = np.full((len(uid), width), -1)  # no score lies between -0.5 and -0.95
            for a, listed in enumerate(some.column("positives").to_pylist()):
                for p, one in enumerate(listed):
                    ids_p[a, p] = NO_ID if one["positive_id"] is None else one["positive_id"]
                    scores[a, p] = one["positive_score"]
            # Rounded inwards, by parts, so that no product exceeds a long.
            tens, ones = scores // 100, scores % 100
            low = tens * rules.least - (-ones * rules.least // 100)
            high = tens * rules.most + ones * rules.most // 100
            x = matrix(some.column("x"), size)
            for a, p, r, score in block.negatives(labels, x, low, high, rules.n_negatives):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid[a]), pa.array(p.astype(np.int32)), pa.array(ids[a]), _ids(ids_p[a, p]),
                        pa.array(scores[a, p]), _ids(block.ids[r]), pa.array(score),
                    ],
                    names=["uid", "place", *(c.split()[0] for c in result.split(", "))],
                )

    found = search.dealt(asked).mapInArrow(look, f"uid long, place int, {result}")
    order = Window.partitionBy("uid", "place").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id")
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rules.n_negatives)
    return ranked.select(*(c.split()[0] for c in result.split(", ")), "rank")
