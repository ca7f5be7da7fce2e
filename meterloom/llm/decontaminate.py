"""Benchmark decontamination with DataFrame functions only.

Benchmark items become windows of n normalised words (an item of fewer words is one window). The
windows are a broadcast hash set; every window of every document is looked up in it, and since the
key is the window itself, a hit is verified by the lookup. Hits give the words covered and the
items found, and documents, or the covered spans, are removed.

The set is broadcast only while its number of windows, which is counted, stays within a bound;
beyond it the same join is left to Catalyst, which shuffles both sides and splits hot windows.
Document words are handled in blocks, so that windows take a fixed multiple of a block's memory, and
a window is built only where its first two words may begin a known one.

Defined results: a null or empty text has no words and no hits; an item without words (or null)
matches nothing; a null item id is listed as an empty string; items that repeat an id count once;
repeated rows each give a row; an empty benchmark leaves every document clean, an empty document
table gives no rows. Only the named columns are read, so other columns may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import text_key
from meterloom.operators.sizing import is_small, maybe_broadcast
from meterloom.sources.scratch import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words, in a text without capitals.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word or what stands between words, in a text that still has its capitals.
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 1024
#: A window takes a few hundred bytes with its items, so this bounds a broadcast to some tens of MB.
BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null. In a text of ASCII alone, that is what
    lower does."""
    given = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(given) == F.char_length(given)
    lowered = F.when(ascii_only, F.lower(given)).otherwise(F.translate(given, UPPER, UPPER.lower()))
    return F.array_remove(F.split(lowered, GAP), "")


def _spans(items: Column, starts: Column, n: Column) -> Column:
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(items, i, n)))


def benchmark_windows(benchmark: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """gram, n_gram (words in it), items (sorted distinct ids as strings). A window's list of
    items is at most the benchmark."""
    listed = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        words(F.col(text)).alias("words"),
    ).filter("size(words) > 0")
    size = F.least(F.size("words"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("words") - size + 1)
    grams = listed.select("item", size.alias("n_gram"), F.explode(_spans(F.col("words"), starts, size)).alias("gram"))
    return grams.groupBy("gram", "n_gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _long(value: int) -> str:
    """A bigint literal; the least one has no positive counterpart to negate."""
    return f"{value}L" if value > -(1 << 63) else "shiftleft(1L, 63)"


def _may_begin(grams: DataFrame, lengths: list[int]) -> Callable[[Column, Column], Column]:
    """A test of a word and the next one (null at the end): whether a known window may begin there.
    It looks up a bit per hash of the first two words, or of the only one, of the known windows, so it
    never says no for one of them. There are sixteen bits per window and at most 2^20, which bounds
    what the driver gets."""
    bits = min(20, max(10, (16 * grams.count()).bit_length()))

    def spot(*first: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*first), 64 - bits).cast("int")

    parts = F.split("gram", " ")
    spots = F.when(F.col("n_gram") > 1, spot(parts[0], F.get(parts, F.lit(1)))).otherwise(spot(parts[0]))
    rows = grams.select(spots.alias("spot")).groupBy(F.shiftright("spot", 6).alias("place"))
    rows = rows.agg(F.expr("bit_or(shiftleft(1L, spot & 63))").alias("bits")).collect()
    found = {row["place"]: row["bits"] for row in rows}
    table = F.expr(f"array({', '.join(_long(found.get(w, 0)) for w in range(1 << bits - 6))})")

    def is_set(at: Column) -> Column:
        return F.bit_get(F.get(table, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1

    def test(first: Column, second: Column) -> Column:
        either = F.lit(False)
        if any(n > 1 for n in lengths):
            either = either | is_set(spot(first, second))
        if 1 in lengths:
            either = either | is_set(spot(first))
        return either

    return test


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: dict[str, Column],
    n: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_broadcast: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per document: the columns of keep, n_words, hits (array of pos, len), items.

    One pass over the documents. Each document gives a marker row and its windows; windows that
    miss leave before the only shuffle, which brings the hits of a document together."""
    spark = docs.sparkSession
    path = scratch_path(spark, "benchmark-windows")
    benchmark_windows(benchmark, n, item_id, item_text).write.parquet(path)
    grams = spark.read.parquet(path)
    # At most n lengths exist.
    lengths = sorted(r["n_gram"] for r in grams.select("n_gram").distinct().collect())
    known = grams.select("gram", "items")
    if known.limit(max_broadcast + 1).count() <= max_broadcast:
        known = F.broadcast(known)

    size = F.size("words")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(BLOCK)),
        lambda at: F.struct(at.alias("at"), F.slice("words", at + 1, F.lit(BLOCK + n - 1)).alias("words")),
    )
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[c.alias(name) for name, c in keep.items()]).alias("kept"),
        words(docs[text]).alias("words"),
    )
    cut = numbered.select("row", "kept", size.alias("n_words"), F.explode(blocks).alias("block"))
    # One row per position, and of these only the first of a document (its marker) and those where
    # a window may begin; a row is built only if it stays.
    at, part, i = F.col("block.at"), F.col("block.words"), F.col("i")
    spots = cut.select("row", "kept", "n_words", "block", F.posexplode_outer(part).alias("i", "first"))
    first_spot = (at == 0) & (F.coalesce(i, F.lit(0)) == 0)
    may_begin = _may_begin(grams, lengths)(F.col("first"), F.get(part, i + 1))
    spots = spots.filter(first_spot | ((i < BLOCK) & may_begin))

    def window(length: int) -> Column:
        gram = F.concat_ws(" ", F.slice(part, i + 1, F.lit(length)))
        found = F.struct((at + i).alias("pos"), F.lit(length).alias("len"), gram.alias("gram"))
        return F.when((i < BLOCK) & (i + length <= F.size(part)), found)

    marker = F.expr("named_struct('pos', -1, 'len', 0, 'gram', CAST(NULL AS STRING))")
    every = F.array(F.when(first_spot, marker), *map(window, lengths))
    looked = spots.select("row", "kept", "n_words", F.explode(F.array_compact(every)).alias("w")).select(
        "row", "kept", "n_words", "w.pos", "w.len", "w.gram"
    )
    hits = looked.join(known, "gram", "left").filter("items IS NOT NULL OR pos = -1")
    hit = F.when(F.col("pos") >= 0, F.struct("pos", "len"))
    return (
        hits.groupBy("row", "kept", "n_words")
        .agg(
            F.sort_array(F.collect_set(hit)).alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select("kept.*", "n_words", "hits", "items")
    )


def covered(hits: Column) -> Column:
    """Number of words inside any of the hits, which are sorted by position."""
    zero = F.expr("named_struct('n', 0L, 'upto', 0)")

    def add(acc: Column, hit: Column) -> Column:
        stop = hit["pos"] + hit["len"]
        more = F.greatest(F.lit(0), stop - F.greatest(hit["pos"], acc["upto"]))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["upto"], stop).alias("upto"))

    return F.aggregate(hits, zero, add, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs, benchmark, {"doc_id": F.col(doc_id)}, n)
    listed = F.array_join(F.sort_array("items"), ",")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def _hits_by_text(docs: DataFrame, benchmark: DataFrame, n: int, text: str) -> DataFrame:
    """Hits per distinct contaminated text."""
    found = scan(docs, benchmark, {"key": text_key(docs[text])}, n, text)
    return found.filter("size(hits) > 0").groupBy("key").agg(F.first("hits").alias("hits"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text") -> DataFrame:
    """The documents without any hit, with all their columns."""
    spark = docs.sparkSession
    path = scratch_path(spark, "contaminated")
    _hits_by_text(docs, benchmark, n, text).select("key").write.parquet(path)
    hits = spark.read.parquet(path)
    # Few keys, which is counted, leave the texts where they are.
    side = maybe_broadcast(hits, is_small(hits))
    return docs.join(side, text_key(docs[text]) == hits["key"], "left_anti")


def drop_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text") -> DataFrame:
    """All documents, without their covered words and what stands between covered words."""
    hits = _hits_by_text(docs, benchmark, n, text)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    joined = docs.select(row, text_key(docs[text]).alias("key")).join(hits, "key", "left")
    pieces = F.regexp_extract_all(F.col(f"row.{text}"), F.lit(PIECE), F.lit(0))
    # Pieces alternate, so the first one tells which positions are words.
    offset = F.when(F.col(f"row.{text}").rlike(rf"^(?:{PIECE.partition('|')[0]})"), 0).otherwise(1)
    numbered = F.transform(pieces, lambda p, i: F.struct(p.alias("p"), (i - offset).alias("i")))

    def inside(piece: Column) -> Column:
        word = F.floor(piece["i"] / 2)  # of a gap: the word before it
        is_gap = F.pmod(piece["i"], F.lit(2)) == 1
        return F.exists(
            "hits",
            lambda h: (word >= h["pos"]) & (word + F.when(is_gap, 1).otherwise(0) < h["pos"] + h["len"]),
        )

    left = F.filter(numbered, lambda p: ~inside(p))
    cleaned = F.when(F.col("hits").isNull(), F.col(f"row.{text}")).otherwise(
        F.array_join(F.transform(left, lambda p: p["p"]), "")
    )
    return joined.select(*[cleaned.alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in docs.columns])
