"""Secret scan with a random forest that removes false positives, DataFrame functions only.

Candidates are the values in words of a text that could hold a secret: long enough, with a digit or
a long run of capitals. A word may hold several (JSON, calls, lists, query strings). Each is described
by its length, the transitions between its characters, how much of it dictionary words cover,
whether it looks like a path, and the words around it, hashed, so that what they mean is learned. A
random forest (Spark ML) is trained on labelled findings and scores all candidates.

Findings come as labels of candidates of the documents themselves (doc_id, pos, label), or as a table
of labelled texts (doc_id, text, label); by default the generated one of `labelled_findings`, whose
shapes the forest is tested on by leaving some out. Training uses a bounded sample of labelled rows,
max_train_rows, chosen by a hash of their place; everything else covers all rows.

The dictionary is the letter tokens of a public vocabulary file, a fixed list whose size is
checked before it is broadcast.

Defined results: a null or empty text has no candidates, words without a value of eight visible ASCII
characters, or of fewer than twelve characters, or without digit and eight capitals in a row, give
none; repeated rows each give their candidates, and labels of a null id hold for documents without
id; without labels of both kinds every candidate is kept with a null score; an empty table gives no
rows. Texts of any length are one array of words. Only the named columns are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.labelled_findings import labelled_findings
from meterloom.sources.scratch import scratch_path

BLANKS = r"[ \t-\r]+"
#: At least 12 characters, with a digit or eight capitals in a row.
CANDIDATE = r"^(?=.{12})(?=.*(?:[0-9]|[A-Z]{8}))"
QUICK = r"[0-9]|[A-Z]{8}"
PARTS = r"""^["'(\[]*(?:([A-Za-z][A-Za-z0-9_.-]*?)["']?[=:]+["']?)?([^"',;()\[\]]*)"""
#: Every run of visible ASCII without quotes and brackets, with the key before it. A run ends where
#: the next field of a query string starts.
RUNS = (
    r"""(?:([A-Za-z][A-Za-z0-9_.-]*)["']?[=:]+["']?)?"""
    r"""((?:(?![&?][A-Za-z0-9_.-]+=)[!-~&&[^"',;()\[\]{}<>]]){8,})"""
)
#: Buckets of the hashed words around a candidate.
WORD_BUCKETS = 256
DICTIONARY_WORDS = 100_000
CLASSES = ("l", "u", "d", "s")
TRANSITIONS = tuple(a + b for a in CLASSES for b in CLASSES)
FEATURES = (
    "length", "n_distinct", "share_digits", "share_upper", "share_hex", "coverage",
    "is_path", "n_separators", "own_key", "before_quote",
    *(f"t_{t}" for t in TRANSITIONS),
)


@dataclass(frozen=True)
class ForestOptions:
    max_train_rows: int = 20_000
    trees: int = 60
    depth: int = 16
    seed: int = 7
    threshold: float = 0.5
    # Documents in one of ten hash buckets are held out of training.
    held_out_bucket: int = 9


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, pos (number of the word), nth (of the values in the word), word, value, key and the
    words around."""
    slim = docs.filter(docs[text].rlike(QUICK)).select(
        F.col(doc_id).alias("doc_id"), F.split(F.col(text), BLANKS).alias("w")
    )
    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).rlike(CANDIDATE))
    found = F.transform(
        places,
        lambda i: F.struct(
            i.alias("pos"),
            F.get("w", i).alias("word"),
            F.concat_ws(" ", F.get("w", i - 3), F.get("w", i - 2), F.get("w", i - 1)).alias("before"),
            F.get("w", i + 1).alias("after"),
        ),
    )
    rows = slim.select("doc_id", F.explode(found).alias("c")).select("doc_id", "c.*")
    whole = F.struct(
        F.regexp_extract("word", PARTS, 1).alias("key"), F.regexp_extract("word", PARTS, 2).alias("value")
    )
    runs = F.arrays_zip(
        F.regexp_extract_all("word", F.lit(RUNS), F.lit(1)).alias("key"),
        F.regexp_extract_all("word", F.lit(RUNS), F.lit(2)).alias("value"),
    )
    ascii_only = F.filter(F.array(whole), lambda x: x["value"].rlike("^[!-~]{8,}$"))
    parts = F.array_distinct(F.concat(ascii_only, runs))
    each = rows.select("*", F.posexplode(parts).alias("nth", "part"))
    return each.select("*", "part.key", "part.value").drop("part")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Letter tokens (four or more) of a rank file, lower-cased. The file is installed on every
    machine, like the library that it belongs to."""
    tokens = spark.read.text(f"file://{path}").select(
        F.trim(F.decode(F.unbase64(F.split("value", " ")[0]), "ISO-8859-1")).alias("entry")
    )
    return tokens.filter("entry rlike '^[A-Za-z]{4,}$'").select(F.lower("entry").alias("entry")).distinct()


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def features(found: DataFrame, entries: DataFrame) -> DataFrame:
    """The candidates with FEATURES. Letter runs of the values meet the dictionary in one join and
    come back as a number per candidate."""
    few = entries.limit(DICTIONARY_WORDS + 1).count() <= DICTIONARY_WORDS
    known = F.broadcast(entries) if few else entries
    runs = F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{4,}"), F.lit(0)))
    values = found.select("value").distinct()
    covered = (
        values.select("value", F.explode(runs).alias("entry"))
        .join(known, "entry")
        .groupBy("value")
        .agg(F.sum(F.length("entry")).alias("covered"))
    )
    joined = found.join(covered, "value", "left")
    kinds = F.expr(
        "regexp_replace(regexp_replace(regexp_replace(regexp_replace(value, "
        "'[^A-Za-z0-9]', '~'), '[a-z]', 'l'), '[A-Z]', 'u'), '[0-9]', 'd')"
    )
    classes = F.translate(kinds, "~", "s")
    rows = joined.withColumn("classes", classes)
    columns = {
        "length": F.length("value"),
        "n_distinct": F.size(F.array_distinct(F.split("value", ""))),
        "share_digits": _share("[0-9]"),
        "share_upper": _share("[A-Z]"),
        "share_hex": _share("[0-9a-f]"),
        "coverage": F.coalesce("covered", F.lit(0)) / F.length("value"),
        "is_path": F.expr("value rlike '[/\\\\\\\\@]|[a-z]\\\\.[a-z]'").cast("int"),
        "n_separators": F.regexp_count("value", F.lit("[^A-Za-z0-9]")),
        "own_key": (F.length("key") > 0).cast("int"),
        "before_quote": F.col("word").rlike("""^["']|[=:]["']""").cast("int"),
    }
    for t in TRANSITIONS:
        columns[f"t_{t}"] = F.regexp_count("classes", F.lit(f"{t[0]}(?={t[1]})")) / F.length("value")
    numbers = [c.cast("double").alias(name) for name, c in columns.items()]
    # The key and the two words before the value (a sign may be one of them), then all words around.
    last = F.slice(F.reverse(F.split("before", " ")), 1, 2)
    near = F.split(F.lower(F.concat_ws(" ", "key", last)), "[^a-z]+")
    around = F.split(F.lower(F.concat_ws(" ", "before", "key", "after")), "[^a-z]+")
    named = F.transform(F.filter(near, lambda w: F.length(w) > 1), lambda w: F.concat(F.lit("near "), w))
    words = F.concat(named, F.filter(around, lambda w: F.length(w) > 1))
    return rows.select(*found.columns, *numbers, words.alias("words"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(10))


def _model(labelled: DataFrame, options: ForestOptions) -> PipelineModel | None:
    """The forest of a bounded sample of described candidates with labels; None if one kind lacks."""
    share = min(1.0, options.max_train_rows / max(1, labelled.count()))
    place = F.pmod(F.xxhash64("doc_id", "pos", "value"), F.lit(1 << 30))
    sample = labelled.filter(place < F.lit(int(share * (1 << 30))))
    if sample.select("label").distinct().count() < 2:
        return None
    hashed = HashingTF(inputCol="words", outputCol="hashed", numFeatures=WORD_BUCKETS, binary=True)
    assembler = VectorAssembler(inputCols=[*FEATURES, "hashed"], outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=options.trees,
        maxDepth=options.depth, seed=options.seed,
    )
    return Pipeline(stages=[hashed, assembler, forest]).fit(sample)


def scan(
    spark: SparkSession,
    docs: DataFrame,
    dictionary_path: str,
    labels: DataFrame | None = None,
    options: ForestOptions = ForestOptions(),
    doc_id: str = "doc_id",
    text: str = "text",
    findings: DataFrame | None = None,
) -> DataFrame:
    """doc_id, pos, word, key, value, score, is_secret, label (null where there is none) and
    held_out. Candidates are few next to words and are written once; scoring reads them. With labels
    of candidates (doc_id, pos, label) the forest is trained on those of the documents, one tenth held
    out; else on labelled texts, findings, by default the generated ones."""
    known = dictionary(spark, dictionary_path)

    def described(texts: DataFrame, doc_id: str, text: str) -> DataFrame:
        path = scratch_path(spark, "candidates")
        candidates(texts, doc_id, text).write.parquet(path)
        return features(spark.read.parquet(path), known)

    held_out = _bucket() == options.held_out_bucket
    rows = described(docs, doc_id, text).withColumn("held_out", held_out)
    if labels is not None:
        marked = labels.groupBy("doc_id", "pos").agg(F.max("label").alias("label"))
        marked = marked.select(F.col("doc_id").alias("of_id"), F.col("pos").alias("at"), "label")
        same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("pos") == F.col("at"))
        rows = rows.join(marked, same, "left").drop("of_id", "at")
    else:
        rows = rows.withColumn("label", F.lit(None).cast("int"))
    path = scratch_path(spark, "described")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)

    if labels is not None:
        labelled = rows.filter("label IS NOT NULL AND NOT held_out")
    else:
        texts = labelled_findings(spark) if findings is None else findings
        label_of = texts.select(F.col("doc_id").alias("of_id"), "label")
        labelled = described(texts, "doc_id", "text")
        labelled = labelled.join(label_of, F.col("doc_id") == F.col("of_id"))
    model = _model(labelled, options)
    if model is None:
        scored = rows.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "pos", "word", "key", "value", "score",
        F.coalesce(F.col("score") >= options.threshold, F.lit(True)).alias("is_secret"),
        "label", "held_out",
    )


def report(found: DataFrame) -> DataFrame:
    """The findings without the secrets themselves."""
    return found.select(
        "doc_id", "pos", F.length("value").cast("long").alias("n_chars"),
        F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"),
        "is_secret", "label", "held_out",
    )
