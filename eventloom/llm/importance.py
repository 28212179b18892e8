"""Quality classifier by importance resampling with hashed n-gram models.

Two generative models over hashed n-grams, one of the good labelled text and one of all
labelled text (a sample of the raw text with known labels), give each document a log ratio.
Documents are then drawn without replacement by Gumbel top-k: the k largest of log weight
plus Gumbel noise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .common import documents, keep_table, ship
from .tokens import slices
from .words import hash_words, mix, words_of

PUNCTUATION = ".,;:!?\"'()|%&$*#@"
PREFIXES = (4, 5, 6, 7)
SLICE_BYTES = 1_500_000  # of text at a time
PARTS = 64  # of the count tables, when tasks' counts are added


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of texts: bucket and text of each, words per text.

    Per word: the word without punctuation, the punctuation around it, its first letters;
    per two words in a row: both.  ``buckets`` is a power of two.
    """
    words, which, counts = words_of(texts)
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    lower = pc.utf8_lower(words)
    bare = pc.utf8_trim(lower, characters=PUNCTUATION)
    around = pc.replace_substring_regex(lower, r"[\p{L}\p{N}]+", "a")
    kinds = [bare, around, *[pc.utf8_slice_codeunits(bare, 0, k) for k in PREFIXES]]
    hashed = [
        hash_words(kind.to_numpy(zero_copy_only=False)) + np.uint64(1_000_003 * i)
        for i, kind in enumerate(kinds)
    ]
    text = np.repeat(np.arange(len(counts)), counts)
    one = hashed[0][which]
    pairs = mix(one[:-1], one[1:])
    inside = text[:-1] == text[1:]
    low = np.uint64(buckets - 1)
    of_words = [(mix(h) & low).astype(np.int64)[which] for h in hashed]
    return (
        np.concatenate([*of_words, (pairs[inside] & low).astype(np.int64)]),
        np.concatenate([*[text] * len(hashed), text[:-1][inside]]),
        counts,
    )


def _count(buckets: int):
    """Counts of a task in good and in all labelled text, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                found, text, _ = features(part.column(0), buckets)
                good = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                totals[0] += np.bincount(found[good[text]], minlength=buckets)
                totals[1] += np.bincount(found, minlength=buckets)
        if totals[1].any():
            for i, piece in enumerate(np.split(totals, PARTS, axis=1)):
                data = zlib.compress(piece.astype("<i8").tobytes(), 1)
                yield pa.record_batch(
                    [pa.array([i], pa.int32()), pa.array([data], pa.binary())],
                    names=["part", "counts"],
                )

    return run


def _add(table: pa.Table) -> pa.Table:
    data = table.column("counts").to_pylist()
    total = sum(np.frombuffer(zlib.decompress(d), "<i8") for d in data)
    return pa.table(
        {
            "part": table.column("part")[:1].cast(pa.int32()),
            "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()),
        }
    )


def log_ratios(good: np.ndarray, raw: np.ndarray, prior: float, evidence: float) -> np.ndarray:
    """Log of the two models' ratio per bucket.

    The expected good count follows from the raw count, scaled so that the typical n-gram has
    a ratio of one.  A bucket whose counts differ by less than ``evidence`` standard
    deviations says nothing.
    """
    if not raw.sum() or not good.sum():
        return np.zeros(len(raw), np.float32)
    expected = raw * (good.sum() / raw.sum())
    ratio = good / np.maximum(expected, 1e-9)
    order = np.argsort(ratio)
    weight = np.cumsum(raw[order])
    expected = expected * ratio[order][np.searchsorted(weight, weight[-1] / 2)]
    found = np.log((good + prior) / (expected + prior))
    found[(good - expected) ** 2 <= evidence**2 * np.maximum(expected, 1)] = 0
    return found.astype(np.float32)


def _score(model, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = model.value
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                found, text, counts = features(part.column(0), buckets)
                total = np.bincount(text, ratios[found], minlength=len(counts))
                mean = pa.array(np.where(counts > 0, total / np.maximum(counts, 1), 0.0))
                yield pa.record_batch(
                    [*part.columns[1:], pa.array(counts, pa.int64()), mean],
                    names=[*part.schema.names[1:], "n_words", "mean_ratio"],
                )

    return run


def _column(name: str) -> Column:
    """The column of exactly this name, whatever marks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def least_of_top(keys: DataFrame, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of the double column ``key``; only counts of bins are collected."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return None
    while low < high:
        width = (high - low) / bins
        if not width or low + width == low:
            break
        at = F.least(F.lit(bins - 1), F.floor((F.col("key") - low) / width)).cast("int")
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        found = inside.groupBy(at.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in found.orderBy(F.desc("bin")).collect():
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        else:
            return low
        if k == row["n"]:
            return low
        if k == 1:
            return high
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    good: Column | None = None,
    most_labelled: int = 400_000,
    buckets: int = 1 << 20,
    prior: float = 1.0,
    evidence: float = 2.0,
    words: int = 256,
    lost: float = 0.01,
    seed: int = 1,
) -> DataFrame:
    """Rows of ``docs`` that importance resampling draws, with log_weight added.

    ``labels`` (doc_id, quality, toxic) teach the models; ``good`` says which are wanted,
    ``quality = 1 and toxic = 0`` unless given.  At most about ``most_labelled`` labels are
    used, chosen by hash: with their ids they are broadcast.  A log weight is the mean log
    ratio per word times ``words``, so length alone decides nothing.  The number k of draws is
    the number of documents whose weight reaches what all but a share ``lost`` of the good
    labelled ones reach.  The noise depends on id and text, so reruns agree.

    Null or empty text has no words and is never drawn.  Labels with a null are not used, an
    id with several labels takes the worst.  Without a good label, or with no label at all,
    nothing is known and every document with words stays.  A null id is drawn like others;
    repeated rows are drawn together.  An empty table gives no rows.  Columns of any name and
    type are carried; the weight is ``__log_weight``, with more ``_`` if that name is taken.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = good if good is not None else (F.col("quality") == 1) & (F.col("toxic") == 0)
    labels = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select(F.col("doc_id").alias("__id"), wanted.alias("__good"))
    )
    n = labels.count()
    if n > most_labelled:
        share = int(most_labelled / n * (1 << 32))
        labels = labels.where(F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1 << 32)) < share)
    labels = F.broadcast(labels)

    # the caller's columns go into one, so that no name of theirs meets one of ours
    row = F.struct(*[_column(c) for c in docs.columns]).alias("row")
    own = [_column(id_col).alias("id"), _column(text_col).alias("text")]
    taught = docs.select(*own).join(labels, F.col("id") == F.col("__id"))
    parts = (
        taught.select("text", "__good")
        .mapInArrow(_count(buckets), "part int, counts binary")
        .groupBy("part")
        .applyInArrow(_add, "part int, counts binary")
        .orderBy("part")
        .collect()  # PARTS rows, buckets counts in all
    )
    if parts:
        total = [
            np.frombuffer(zlib.decompress(p["counts"]), "<i8").reshape(2, -1) for p in parts
        ]
        raw_and_good = np.concatenate(total, axis=1).astype(float)
    else:
        raw_and_good = np.zeros((2, buckets))
    ratios = log_ratios(raw_and_good[0], raw_and_good[1], prior, evidence)
    model = spark.sparkContext.broadcast(ratios)

    keyed = docs.select(*own, row).join(labels, F.col("id") == F.col("__id"), "left").select(
        "text",
        "row",
        F.coalesce("__good", F.lit(False)).alias("good"),
        F.xxhash64(F.lit(seed), "id", F.xxhash64("text")).alias("luck"),
    )
    kinds = StructType(
        [
            keyed.schema["row"],
            StructField("good", BooleanType()),
            StructField("luck", LongType()),
            StructField("n_words", LongType()),
            StructField("mean_ratio", DoubleType()),
        ]
    )
    scored = keyed.mapInArrow(_score(model, buckets), kinds).where("n_words > 0")
    uniform = (F.pmod("luck", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    gumbel = -F.log(-F.log(uniform))
    scored = scored.select(
        "row", "good", (F.col("mean_ratio") * words).alias("log_weight"), gumbel.alias("gumbel")
    ).withColumn("key", F.col("log_weight") + F.col("gumbel"))
    scored = keep_table(scored, "resample-scores")

    reached = scored.where("good").agg(F.percentile_approx("log_weight", lost, 100_000)).first()[0]
    if reached is None:
        drawn = scored
    else:
        k = scored.where(F.col("log_weight") >= reached).count()
        drawn = scored.where(F.col("key") >= least_of_top(scored.select("key"), k))
    name = "__log_weight"
    while name in {c.lower() for c in docs.columns}:
        name = "_" + name
    return drawn.select("row.*", F.col("log_weight").alias(name))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    drawn = resample(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return drawn.select("doc_id", F.col("__log_weight").alias("log_weight"))


QUERIES = {"op5_importance_resampling": op5_importance_resampling}
SQL: dict[str, str] = {}
