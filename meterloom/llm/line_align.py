"""Line de-duplication by pairwise alignment.

Documents are sequences of line hashes. Overlaps are found by what is rare in them: not single lines,
which very many documents may share, but the shortest runs of lines that hold enough characters, from
each line on and up to each line. Every run with enough characters is covered by such windows, and a
window leads each of its documents to the first document that has it, however many have it. So a
document meets at most two partners per line, and no group of documents is paired with itself.

Each pair is aligned by patience diff: common beginnings and ends, then the lines unique on both sides
in their longest increasing run, then the gaps between them; where no line of a gap is unique, its
rarest common line takes their place. Runs of aligned lines that hold enough characters are common
blocks, and the later document loses them; what is left is aligned again until no block is found, so
moved blocks go as well. An exact check follows: windows that the earlier document still has, which are
lines repeated in another order, go too. So no run of lines with enough characters stays that an
earlier document has.

Exact copies are handled before that: of documents with one text, the first keeps it and the others
lose it as one block. Documents are ordered by id (null first), then by text hash; texts that share an
id are told apart by their hash.

Defined results: a null text is empty and stays null if nothing is removed; lines without a word lead
nowhere, are removed only inside a block, and add nothing to its length; rows that repeat id and text
are one document repeated and share its result; an empty table gives no rows. Extra columns are
carried along and may have any name."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import byte_texts, text_key
from meterloom.sources.scratch import scratch_path

WIDTH = 16
BLANK = bytes(WIDTH)


@dataclass(frozen=True)
class LineRules:
    """A block is removed from min_chars on."""

    min_chars: int = 60


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """order_id, key (of the text), seq (16 bytes per line, zero for a blank line), sizes (code
    points per line as int32)."""
    slim = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("order_id"),
        F.col(text).alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, seqs, sizes = [], [], []
            for t in byte_texts(batch.column("text")):
                lines = t.split(b"\n")
                solid = [bool(x) and not x.isspace() for x in lines]
                digest = xxhash.xxh3_128_digest
                seqs.append(b"".join([digest(x) if s else BLANK for x, s in zip(lines, solid)]))
                counts = [len(x.decode()) if s else 0 for x, s in zip(lines, solid)]
                sizes.append(np.array(counts, np.int32).tobytes())
                keys.append(hashlib.md5(t).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("order_id"), *(pa.array(x, pa.binary()) for x in (keys, seqs, sizes))],
                names=["order_id", "key", "seq", "sizes"],
            )

    return slim.mapInArrow(cut, "order_id long, key binary, seq binary, sizes binary")


def _anchors(a: Sequence[bytes], b: Sequence[bytes], lo: tuple, hi: tuple) -> list[tuple[int, int]]:
    """Lines that occur once in both ranges, as far as they rise together."""
    once_a = {x for x, n in Counter(a[lo[0] : hi[0]]).items() if n == 1 and x != BLANK}
    once = {x for x, n in Counter(b[lo[1] : hi[1]]).items() if n == 1} & once_a
    at_b = {x: j for j, x in enumerate(b[lo[1] : hi[1]], lo[1]) if x in once}
    tops: list[int] = []
    ends: list[int] = []
    pairs, back = [(i, at_b[x]) for i, x in enumerate(a[lo[0] : hi[0]], lo[0]) if x in once], []
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(tops, j)
        back.append(ends[place - 1] if place else -1)
        tops[place : place + 1] = [j]
        ends[place : place + 1] = [k]
    run, k = [], ends[-1] if ends else -1
    while k >= 0:
        run.append(pairs[k])
        k = back[k]
    return run[::-1] or _rarest(a, b, lo, hi)


def _rarest(a: Sequence[bytes], b: Sequence[bytes], lo: tuple, hi: tuple) -> list[tuple[int, int]]:
    """One pair: the rarest line that both ranges have, where it comes first in each."""
    counts = Counter(a[lo[0] : hi[0]])
    shared = [x for x in dict.fromkeys(b[lo[1] : hi[1]]) if x != BLANK and counts[x]]
    if not shared:
        return []
    best = min(shared, key=counts.__getitem__)
    return [(a.index(best, lo[0], hi[0]), b.index(best, lo[1], hi[1]))]


def align(a: Sequence[bytes], b: Sequence[bytes]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences by patience diff."""
    found, todo = [], [((0, 0), (len(a), len(b)))]
    while todo:
        (i, j), (ie, je) = todo.pop()
        while i < ie and j < je and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < ie and j < je and a[ie - 1] == b[je - 1]:
            ie, je = ie - 1, je - 1
            found.append((ie, je))
        if i < ie and j < je and (anchors := _anchors(a, b, (i, j), (ie, je))):
            found += anchors
            starts = [(i, j), *((x + 1, y + 1) for x, y in anchors)]
            todo += zip(starts, [*anchors, (ie, je)])
    return sorted(found)


def windows(sizes: Sequence[int], min_chars: int) -> set[tuple[int, int]]:
    """(start, stop) of the shortest runs with enough characters from each line on and up to each
    line. They start and end with a word."""
    least, found = max(1, min_chars), set()
    stop = total = 0
    for start, size in enumerate(sizes):
        while stop < len(sizes) and total < least:
            total += sizes[stop]
            stop += 1
        if total < least:
            break
        if size:
            found.add((start, stop))
        total -= size
    start = total = 0
    for stop, size in enumerate(sizes, 1):
        total += size
        while total - sizes[start] >= least:
            total -= sizes[start]
            start += 1
        if size and total >= least:
            found.add((start, stop))
    return found


def _held(a: Sequence[bytes], b: Sequence[bytes], sizes_b: Sequence[int], min_chars: int) -> set[int]:
    """Lines of b in windows that a has anywhere."""
    digest = xxhash.xxh3_128_digest
    size_of, known, at = dict(zip(b, sizes_b)), set(), 0
    while at < len(a):
        end = at
        while end < len(a) and a[end] in size_of:
            end += 1
        sizes = [size_of[x] for x in a[at:end]]
        known |= {digest(b"\n".join(a[at + i : at + j])) for i, j in windows(sizes, min_chars)}
        at = end + 1
    if not known:
        return set()
    runs = [(i, j) for i, j in windows(sizes_b, min_chars) if digest(b"\n".join(b[i:j])) in known]
    return {k for i, j in runs for k in range(i, j)}


def _runs(pairs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(first line of b, lines) of aligned lines that follow each other on both sides."""
    start, last = 0, (-2, -2)
    for i, j in [*pairs, (-2, -2)]:
        if (i - 1, j - 1) != last:
            if last[1] >= 0:
                yield start, last[1] + 1 - start
            start = j
        last = i, j


def common_blocks(
    a: list[bytes], b: list[bytes], sizes_b: Sequence[int], min_chars: int
) -> tuple[set[int], set[int]]:
    """Lines of b in runs that a has and that hold enough characters: those that alignment finds, and
    those that only the check of all windows finds. The first pass aligns the whole documents, the
    next ones what the check still finds, until alignment adds nothing."""
    lost: set[int] = set()
    rest = list(b)
    while True:
        found = _runs(align(a, rest))
        new = {k for j, n in found if sum(sizes_b[j : j + n]) >= min_chars for k in range(j, j + n)} - lost
        lost |= new
        left = _held(a, b, sizes_b, min_chars) - lost
        if not new or not left:
            return lost, left
        rest = [x if k in left else b"-%d" % k for k, x in enumerate(b)]  # equal to no line


def _split(seq: bytes) -> list[bytes]:
    return [seq[i : i + WIDTH] for i in range(0, len(seq), WIDTH)]


def _window_rows(texts: DataFrame, min_chars: int) -> DataFrame:
    """place of a text and window, the hash of one of its windows."""
    digest = xxhash.xxh3_128_digest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            places, found = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(places, pa.binary()), pa.array(found, pa.binary())], names=["place", "window"]
            )

        rows: list[tuple] = []
        for batch in batches:
            for place, seq, sizes in zip(*(batch.column(c) for c in ("place", "seq", "sizes"))):
                place, seq = place.as_py(), seq.as_py()
                runs = windows(np.frombuffer(sizes.as_py(), np.int32).tolist(), min_chars)
                for x in {digest(seq[a * WIDTH : b * WIDTH]) for a, b in runs}:
                    rows.append((place, x))
                if len(rows) >= 1 << 15:
                    yield made(rows)
                    rows = []
        if rows:
            yield made(rows)

    return texts.select("place", "seq", "sizes").mapInArrow(cut, "place binary, window binary")


def _pairs(texts: DataFrame, rules: LineRules) -> DataFrame:
    """place of a text and first, the place of an earlier text that is the first with one of its
    windows. Windows are reduced to their first text before they are shuffled."""
    rows = _window_rows(texts, rules.min_chars)
    shared = rows.groupBy("window").agg(F.count("*").alias("df"), F.min("place").alias("first"))
    # The counts get a key of their own: both sides of the join then start at their own exchange,
    # and the rows of a very common window can be split over tasks.
    shared = shared.filter("df > 1").select(F.hex("window").alias("of_window"), "first")
    led = rows.join(shared, F.hex("window") == F.col("of_window")).filter("first < place")
    return led.select("place", "first").distinct()


def _removals(texts: DataFrame, rules: LineRules) -> DataFrame:
    """key, lines (positions that the text loses to earlier texts), n_aligned (how many of them
    alignment found)."""
    lined = texts.select("place", "key", "seq", "sizes")
    later = _pairs(texts, rules).join(lined, "place")
    first = texts.select(F.col("place").alias("p_place"), F.col("seq").alias("p_seq"))
    both = later.join(first, F.col("p_place") == F.col("first")).select("key", "seq", "sizes", "p_seq")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                keys, lines, found = [], [], []
                some = batch.slice(at, 64)
                for key, seq, sizes, p_seq in zip(*(some.column(c).to_pylist() for c in ("key", "seq", "sizes", "p_seq"))):
                    counts = np.frombuffer(sizes, np.int32).tolist()
                    for lost, by in zip(
                        common_blocks(_split(p_seq), _split(seq), counts, rules.min_chars), (True, False)
                    ):
                        keys += [key] * len(lost)
                        lines += lost
                        found += [by] * len(lost)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(lines, pa.int32()), pa.array(found, pa.bool_())],
                    names=["key", "line", "aligned"],
                )

    lost = both.mapInArrow(compare, "key binary, line int, aligned boolean")
    lost = lost.groupBy("key", "line").agg(F.max("aligned").alias("aligned"))
    return lost.groupBy("key").agg(
        F.collect_set("line").alias("lines"), F.expr("count_if(aligned)").alias("n_aligned")
    )


def _kept_text(text: Column, lines: Column) -> Column:
    """A text without the lines at some positions."""
    parts = F.transform(
        F.split(text, "\n", -1), lambda line, i: F.when(~F.array_contains(lines, i), line)
    )
    return F.array_join(F.filter(parts, lambda x: x.isNotNull()), "\n")


def dedup_lines(
    spark: SparkSession,
    docs: DataFrame,
    rules: LineRules = LineRules(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """row (all columns of docs), cleaned (the text that is left), n_removed (lines with a word
    that went), is_copy, n_aligned (lines that went by alignment, without those of copies). Line hashes are written once; texts are read again at the end, where they
    meet what they lose."""
    path = scratch_path(spark, "line-hashes")
    _lines(docs, doc_id, text).write.parquet(path)
    hashed = spark.read.parquet(path)
    path = scratch_path(spark, "texts")
    once = hashed.groupBy("key").agg(
        F.min("order_id").alias("order_id"), F.first("seq").alias("seq"), F.first("sizes").alias("sizes")
    )
    # The place in the order of documents: the id as an unsigned number, then the text hash.
    unsigned = F.lpad(F.hex(F.expr("order_id ^ -9223372036854775808")), 16, "0")
    once.withColumn("place", F.concat(F.unhex(unsigned), F.col("key"))).write.parquet(path)
    texts = spark.read.parquet(path)
    # One row per text, under a key of its own, so that the rows of a very frequent text can be
    # split over tasks.
    found = texts.select("key", "order_id").join(_removals(texts, rules), "key", "left")
    found = found.select(F.hex("key").alias("of_key"), "order_id", "lines", "n_aligned")

    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
        F.hex(text_key(docs[text])).alias("key"),
    )
    joined = keyed.join(found, F.col("key") == F.col("of_key"))
    value = F.col(f"row.{text}")
    solid = F.expr(r"filter(split(coalesce(row.`%s`, ''), '\n', -1), x -> x rlike '[^ \\t-\\r]')" % text)
    chars = F.aggregate(solid, F.lit(0), lambda n, x: n + F.length(x))
    is_copy = (F.col("id") > F.col("order_id")) & (chars >= rules.min_chars)
    cleaned = F.when(is_copy, F.lit("")).when(F.col("lines").isNull(), value)
    cleaned = cleaned.otherwise(_kept_text(value, F.col("lines")))
    left = F.expr(r"size(filter(split(coalesce(cleaned, ''), '\n', -1), x -> x rlike '[^ \\t-\\r]'))")
    return (
        joined.select(
            "row", is_copy.alias("is_copy"), F.size(solid).alias("n_lines"), cleaned.alias("cleaned"),
            F.when(is_copy, F.lit(0)).otherwise(F.coalesce("n_aligned", F.lit(0))).alias("n_aligned"),
        )
        .withColumn("n_removed", F.col("n_lines") - left)
    )


def replace_texts(
    spark: SparkSession, docs: DataFrame, rules: LineRules = LineRules(), text: str = "text"
) -> DataFrame:
    """The documents with the texts that are left; all rows and columns stay."""
    found = dedup_lines(spark, docs, rules, text=text)
    return found.select(*[F.col("cleaned").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in docs.columns])


def report(spark: SparkSession, docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """doc_id, n_lines, n_removed, n_aligned, is_copy, kept_chars, kept_sha256."""
    left = F.coalesce("cleaned", F.lit(""))
    return dedup_lines(spark, docs, rules).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.col("n_aligned").cast("long").alias("n_aligned"),
        "is_copy",
        F.length(left).cast("long").alias("kept_chars"),
        F.sha2(left, 256).alias("kept_sha256"),
    )
