"""Token ids on disk: one compressed frame per document, a shared dictionary, an offset index.

A folder holds one dictionary file and shard files in ascending document order. A shard is

    header   magic, bytes per id (2 or 4), xxhash64 of the dictionary
    frames   one zstandard frame per document, made with the shared dictionary
    index    per document: id, whether the id is null, frame offset, number of ids
    trailer  offset of the index, number of documents, magic

so one short document is read with two small reads and one decompression. Shards have unique
names and count only once they are listed in the manifest, which Spark commits; a lost executor
leaves at most files that nothing refers to.

Defined results: a null text has no ids but the end id; null document ids come first and stay
null; rows that repeat an id keep it, next to each other; an empty table gives an empty manifest.
Only the named columns are read, so other columns may have any name. A task holds one Arrow batch,
two generations of a fixed number of words each and the index of the shard that it writes."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.llm.common import filesystem, qualified

MAGIC = b"IDFRAME1"
HEADER = struct.Struct("<8sIQ")
TRAILER = struct.Struct("<QQ8s")
INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u8")])
MANIFEST = "part long, shard long, path string, n_docs long, n_tokens long"
#: Remembered words; as many of those before them are kept as long as they are used.
CACHE_WORDS = 400_000
#: Words that go through the tokenizer together.
LEARN_WORDS = 1024
#: A word of one letter; what follows a letter is learned behind it.
STEM = "a"
#: An ASCII letter or digit and what ends a run of either, whatever follows.
BORDER = r"[0-9A-Za-z][\x00-&(-/:-@\[-`{-\x7F]"


@dataclass(frozen=True)
class StoreOptions:
    """end_id is appended to each document. The dictionary is trained on about sample_docs
    documents, chosen by a hash of id and text, of which at most sample_bytes are used; it changes
    the size of the files only. A shard is closed after shard_bytes."""

    end_id: int = 2
    dictionary_bytes: int = 65_536
    sample_docs: int = 1_000
    sample_bytes: int = 8 << 20
    level: int = 3
    shard_bytes: int = 128 << 20


def _blank(words: pa.Array, at: int) -> np.ndarray:
    """Whether words are empty or have white space at their start (0) or end (-1)."""
    side = pc.utf8_slice_codeunits(words, at, 1 if at == 0 else None)
    return pc.or_(pc.utf8_is_space(side), pc.equal(pc.binary_length(words), 0)).to_numpy(
        zero_copy_only=False
    )


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words up to their first border, and what comes after it."""
    words, n = words.cast(pa.large_string()), len(words)
    _, offsets, text = words.buffers()
    place = np.frombuffer(offsets, np.int64)[words.offset : words.offset + n + 1]
    found = pc.find_substring_regex(words, BORDER).to_numpy()
    both = np.empty(2 * n + 1, np.int64)
    both[::2] = place
    both[1::2] = np.where(found < 0, place[1:], place[:-1] + found + 1)
    parts = pa.LargeStringArray.from_buffers(2 * n, pa.py_buffer(both), text or pa.py_buffer(b""))
    heads, tails = pa.array(np.arange(0, 2 * n, 2)), pa.array(np.arange(1, 2 * n, 2))
    return parts.take(heads), parts.take(tails)


class TextEncoder:
    """Ids of texts by a tokenizer file, with the ids of words remembered.

    The split pattern of byte-level tokenizers never matches across a space that touches
    something else than white space on one side. Texts without other spaces are cut there, and the
    words once more behind the first ASCII letter or digit before an ASCII character that is neither
    nor an apostrophe: the pattern ends there, too, and punctuation makes no new words. New words
    go through the tokenizer together, and its ids are cut again where a token starts with a space.
    Other texts go through it as they are."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.opens = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.opens[i] = token.startswith("Ġ")  # how the vocabulary writes a space
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return self._each([text])[0]

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, self.kind) for encoding in made]

    def _learn(self, new: list[str]) -> None:
        plain, other = [], []
        for w in new:
            (other if not w or w[0].isspace() else plain).append(w)
        for start in range(0, len(plain), LEARN_WORDS):
            some = plain[start : start + LEARN_WORDS]
            ids = self.whole(" " + " ".join(some))
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(some):  # a word that holds a space of its own: one by one
                self.words.update((w, self.whole(" " + w).tobytes()) for w in some)
                continue
            data, ends = ids.tobytes(), [*(cuts[1:] * self.kind.itemsize).tolist(), ids.nbytes]
            begin = 0
            for word, end in zip(some, ends):
                self.words[word] = data[begin:end]
                begin = end
        self.words.update((w, self.whole(" " + w).tobytes()) for w in other)

    def _known(self, words: list[str]) -> list[bytes]:
        """Serialized ids of different words, each with a space before it."""
        if len(self.words) >= CACHE_WORDS:
            self.older, self.words = self.words, {}
        found = list(map(self.words.get, words))
        missing = [k for k, data in enumerate(found) if data is None]
        new = []
        for k in missing:
            data = self.older.get(words[k])
            if data is None:
                new.append(words[k])
            else:
                self.words[words[k]] = data
        self._learn(new)
        for k in missing:
            found[k] = self.words[words[k]]
        return found

    def _ids(self, words: pa.Array) -> pa.Array:
        """The same for a column of different words, put together from their two parts."""
        if not len(words):
            return pa.array([], pa.large_binary())
        heads, tails = (part.dictionary_encode() for part in _parts(words))
        some, rest = _strings(heads.dictionary), _strings(tails.dictionary)
        known = self._known([STEM, *some, *(STEM + w for w in rest)])
        stem, split = len(known[0]), 1 + len(some)
        head = pa.array(known[1:split], pa.large_binary()).take(heads.indices)
        tail = pa.array([x[stem:] for x in known[split:]], pa.large_binary()).take(tails.indices)
        return pc.binary_join_element_wise(head, tail, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        """Serialized ids of each text; a null text counts as empty. Words are cut, numbered and
        put together as columns, so that Python sees each different word of the texts once."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return
        texts = texts.fill_null("")
        lists = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        starts = np.cumsum(counts) - counts
        numbered = pc.list_flatten(lists).dictionary_encode()
        words, codes = numbered.dictionary, numbered.indices.to_numpy()
        first = _strings(words.take(pa.array(codes[starts])))

        # A space between white space and white space or the end is no place to cut.
        later = np.ones(len(codes), bool)
        later[starts] = False
        before = _blank(words, -1)[codes]
        before[starts] &= np.fromiter(map(bool, first), bool, len(first))
        after = _blank(words, 0)[codes]
        wide = np.flatnonzero(before[:-1] & after[1:] & later[1:])
        unsafe = np.zeros(len(texts), bool)
        unsafe[np.searchsorted(starts, wide, side="right") - 1] = True

        codes = codes[later & ~np.repeat(unsafe, counts)]
        used = np.zeros(len(words), bool)
        used[codes] = True
        place = np.cumsum(used) - 1
        data = self._ids(words.filter(pa.array(used))).take(pa.array(place[codes]))
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(pc.binary_length(data).to_numpy(), out=ends[1:])
        stops = ends[np.cumsum(np.where(unsafe, 0, counts - 1))].tolist()
        body, begin = memoryview(data.buffers()[2] or b""), 0

        heads = list({w for w, skip in zip(first, unsafe.tolist()) if w and not skip})
        head = {"": b""} | {w: ids.tobytes() for w, ids in zip(heads, self._each(heads))}
        for k, end in enumerate(stops):
            if unsafe[k]:
                yield self.whole(texts[k].as_py()).tobytes()
            else:
                yield head[first[k]] + body[begin:end]
            begin = end


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def _runs(texts: pa.Array, most: int = 2 << 20) -> Iterator[pa.Array]:
    """A column of texts in runs of a few million bytes."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        read = sizes[begin - 1] if begin else 0
        end = min(int(np.searchsorted(sizes, read + most)) + 1, len(texts))
        yield texts.slice(begin, end - begin)
        begin = end


def train_dictionary(
    docs: DataFrame, tokenizer: str, options: StoreOptions, doc_id: str, text: str
) -> bytes:
    """One task trains on the sampled documents' serialized ids. With too few of them for
    training, the samples themselves are the dictionary.

    The sample is documented and bounded before its exchange: about sample_docs rows, chosen by a hash
    of id and text (rows without id or of one id do not fall in together) and at most twice as many
    (copies of a chosen row do). The dictionary changes file sizes, not ids."""
    share = min(1.0, options.sample_docs / max(1, docs.count()))
    place = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)), F.lit(1 << 30))
    sample = docs.filter(place < F.lit(int(share * (1 << 30)))).select(F.col(text).alias("text"))
    sample = sample.limit(2 * options.sample_docs).repartition(1)
    kind = "dictionary binary"

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, size = [], 0
        for batch in batches:
            for run in _runs(batch.column("text")):
                for ids in encoder(tokenizer).encode(run):
                    # In blocks, so that one long document does not outweigh the others.
                    for start in range(0, len(ids), 8192):
                        if size < options.sample_bytes:
                            samples.append(ids[start : start + 8192])
                            size += len(samples[-1])
        try:
            made = zstandard.train_dictionary(options.dictionary_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            made = b"".join(samples)[: options.dictionary_bytes]
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["dictionary"])

    rows = sample.mapInArrow(train, kind).collect()  # one row of at most dictionary_bytes
    return bytes(rows[0]["dictionary"]) if rows else b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class _Shard:
    """A shard file while it is written."""

    def __init__(self, folder: str, number: int, width: int, dictionary: bytes):
        self.fs, root = filesystem(folder)
        self.number, self.rows, self.offset, self.tokens = number, [], HEADER.size, 0
        self.path = f"{root}/shard-{uuid.uuid4().hex}.ids"
        self.out = self.fs.open_output_stream(self.path)
        self.out.write(HEADER.pack(MAGIC, width, xxhash.xxh64_intdigest(dictionary)))

    def add(self, doc_id: int | None, frame: bytes, n: int) -> None:
        self.rows.append((doc_id or 0, doc_id is None, self.offset, n))
        self.out.write(frame)
        self.offset += len(frame)
        self.tokens += n

    def close(self, part: int) -> tuple:
        self.out.write(np.array(self.rows, INDEX).tobytes())
        self.out.write(TRAILER.pack(self.offset, len(self.rows), MAGIC))
        self.out.close()
        return part, self.number, self.path.rpartition("/")[2], len(self.rows), self.tokens


def write_store(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    options: StoreOptions = StoreOptions(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode, order by document id, write; returns the manifest, which is stored beside the
    shards. Ranges of ids are the only shuffle; text hashes break ties, so that a repeated id can
    be dealt to several tasks."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(slim, tokenizer, options, "doc_id", "text")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([options.end_id], encode.kind).tobytes()
        width = encode.kind.itemsize
        compress = zstandard.ZstdCompressor(
            level=options.level, dict_data=_dictionary(dictionary)
        ).compress
        part, shard, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for run in _runs(batch.column("text")):
                for data in encode.encode(run):
                    if shard is None:
                        shard = _Shard(folder, len(done), width, dictionary)
                    shard.add(next(ids), compress(data + end), len(data) // width + 1)
                    if shard.offset >= options.shard_bytes:
                        done.append(shard.close(part))
                        shard = None
        if shard is not None:
            done.append(shard.close(part))
        if done:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("part", "shard", "path", "n_docs", "n_tokens"), row)) for row in done]
            )

    ordered = (
        slim.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.asc("doc_id"), F.asc("tie"))
        .sortWithinPartitions(F.asc("doc_id"), F.asc("tie"))
        .select("doc_id", "text")
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


class ShardReader:
    """Documents of one shard by position."""

    def __init__(self, folder: str, name: str):
        fs, root = filesystem(folder)
        with fs.open_input_stream(f"{root}/dictionary") as data:
            dictionary = data.read()
        self.file = fs.open_input_file(f"{root}/{name}")
        magic, width, digest = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        size = self.file.size()
        self.end, count, tail = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"{name} is no complete shard")
        if digest != xxhash.xxh64_intdigest(dictionary):
            raise ValueError(f"{name} was written with another dictionary")
        self.kind = np.dtype(f"<u{width}")
        self.index = np.frombuffer(self.file.read_at(count * INDEX.itemsize, self.end), INDEX)
        self.decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

    def _cut(self, position: int) -> tuple[int, int]:
        stop = self.index["offset"][position + 1] if position + 1 < len(self.index) else self.end
        return int(self.index["offset"][position]), int(stop)

    def ids(self, position: int) -> np.ndarray:
        start, stop = self._cut(position)
        return np.frombuffer(self.decompress(self.file.read_at(stop - start, start)), self.kind)

    def all_ids(self, block: int = 8 << 20) -> Iterator[np.ndarray]:
        """All documents in order, read in blocks of a few megabytes."""
        at = 0
        while at < len(self.index):
            last = at
            begin, stop = self._cut(at)
            while last + 1 < len(self.index) and self._cut(last + 1)[1] - begin <= block:
                last += 1
                stop = self._cut(last)[1]
            data = memoryview(self.file.read_at(stop - begin, begin))
            for position in range(at, last + 1):
                a, b = self._cut(position)
                yield np.frombuffer(self.decompress(data[a - begin : b - begin]), self.kind)
            at = last + 1


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the shard files. The running
    start adds up shard totals (one small row each) and then counts within each shard."""
    folder = qualified(manifest.sparkSession, folder)
    order = Window.orderBy("part", "shard")
    before = F.sum("n_tokens").over(order) - F.col("n_tokens")
    shards = manifest.withColumn("before", before).select("path", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                reader = ShardReader(folder, name)
                crcs, sizes = [], []
                for ids in reader.all_ids():
                    sizes.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                n = np.array(sizes, np.int64)
                index = reader.index
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(index["id"].astype(np.int64), mask=index["null"].astype(bool)),
                        pa.array(at + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A task per shard; a number that is stated is not coalesced for the rows being few.
    spread = shards.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
