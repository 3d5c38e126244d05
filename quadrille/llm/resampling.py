"""Quality by importance resampling.

Two generative models of hashed n-grams, one of target texts and one of all texts, give
each text a log weight: the mean log ratio of its words and word pairs, times a fixed
number of n-grams so that the length of a text does not matter.  A sample without
replacement, with probabilities in proportion to the weights, is the texts with the
largest sums of log weight and a Gumbel-distributed number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, named, shuffle_width, slices, stored, text_id
from .words import joined, word_hashes

#: Buckets of the n-grams.
BUCKETS = 1 << 17
#: Parts in which vectors of counts travel.
PARTS = 64
#: Labelled target texts that the target model is fitted on, at most.
TARGET_SAMPLE = 20_000
#: N-grams that a text counts for, whatever its length.
LENGTH = 256
#: Bytes of text hashed at once.
STEP_BYTES = 4 << 20


def _ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of all texts, and the text of each."""
    words, bounds = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs = joined(words[:-1], words[1:])
    same = text[1:] == text[:-1]
    grams = np.concatenate([words, pairs[same]]) % np.uint64(BUCKETS)
    return grams.astype(np.int64), np.concatenate([text, text[1:][same]])


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all n-grams and of those of target texts.

    Every task counts its partition in two vectors; they are added up in two steps, a few
    parts of the vectors at a time, so that no task reads the vectors of all others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for whole in batches:
            for batch in slices(whole, 0, STEP_BYTES):
                grams, text = _ngrams(batch.column(0))
                target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                counts[0] += np.bincount(grams, minlength=BUCKETS)
                counts[1] += np.bincount(grams[target[text]], minlength=BUCKETS)
        salt = TaskContext.get().partitionId()
        if counts.any():
            parts = np.split(counts, PARTS, axis=1)
            yield _vectors(range(PARTS), [salt] * PARTS, parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, vector in zip(
                batch.column(0).to_pylist(), batch.column(2).to_pylist()
            ):
                values = np.frombuffer(vector, np.int64).reshape(2, -1)
                sums[part] = sums[part] + values if part in sums else values
        salt = TaskContext.get().partitionId()
        if sums:
            yield _vectors(sums, [salt] * len(sums), sums.values())

    fields = "part int, salt int, counts binary"
    partitions = shuffle_width(rows.sparkSession)
    vectors = map_arrow(rows, count, fields)
    some = vectors.withColumn("salt", F.col("salt") % F.lit(max(1, partitions // 8)))
    some = map_arrow(some.repartition(partitions, "part", "salt"), add, fields)
    total = map_arrow(some.repartition(min(PARTS, partitions), "part"), add, fields)
    out = np.zeros((2, PARTS, BUCKETS // PARTS), np.int64)
    for row in total.collect():  # PARTS rows
        out[:, row["part"]] += np.frombuffer(row["counts"], np.int64).reshape(2, -1)
    return out[0].ravel(), out[1].ravel()


def _vectors(parts, salts, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(parts), pa.int32()),
            pa.array(salts, pa.int32()),
            pa.array([c.tobytes() for c in counts], pa.binary()),
        ],
        ["part", "salt", "counts"],
    )


#: Added to every count.  Most buckets are empty in a small target model; much more than
#: this in each of them would outweigh what the model has counted.
SMOOTHING = 0.1


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the ratio of both models, with ``SMOOTHING`` added to every count."""
    if not target.any():
        return np.zeros(len(raw))
    return (
        np.log(target + SMOOTHING)
        - np.log(target.sum() + SMOOTHING * len(target))
        - np.log(raw + SMOOTHING)
        + np.log(raw.sum() + SMOOTHING * len(raw))
    )


def resample(
    documents: DataFrame,
    labels: DataFrame,
    target: Column,
    share: float | None = None,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Weights of all texts, and a sample of them that resembles the target texts.

    ``labels`` has the id column, and ``target`` is a condition over ``labels`` that tells the texts to resemble; the model
    of them is fitted on at most ``TARGET_SAMPLE`` of these, chosen by a hash of the id.
    The model of all texts counts every text.  ``share`` is the part of the texts to keep.

    One row per input row: the id, ``log_weight``, ``key`` (with the Gumbel number, the
    same for the same id and seed) and ``kept``.  Texts without words, null ones included,
    have no weight and are never kept; rows that tie with the last one kept are kept too,
    so repeated rows share their fate.  A null id gets its number from the text.  Without
    target texts all weights are equal.  An empty table gives no rows.  Other columns are
    not read.
    """
    spark = documents.sparkSession
    wanted = labels.where(target).select(F.col(id_column).cast("bigint").alias("id"))
    wanted = wanted.where("id IS NOT NULL").distinct()
    # bounded by TARGET_SAMPLE, so it can be broadcast
    sample = wanted.orderBy(F.xxhash64("id"), "id").limit(TARGET_SAMPLE)
    rows = documents.select(
        text_id(id_column, text_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    marked = rows.join(
        F.broadcast(sample.withColumn("target", F.lit(True))), "id", "left"
    ).select("text", F.coalesce("target", F.lit(False)).alias("target"))
    ratios = log_ratios(*_counts(marked))
    shared = spark.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                grams, text = _ngrams(batch.column(1))
                n = np.bincount(text, minlength=batch.num_rows)
                total = np.bincount(text, shared.value[grams], batch.num_rows)
                weight = pa.array(total * LENGTH / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), weight], ["id", "log_weight"]
                )

    weighed = map_arrow(rows, weigh, "id bigint, log_weight double")
    uniform = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(
        float(1 << 52)
    )
    gumbel = -F.log(-F.log(uniform))
    keyed = stored(weighed.withColumn("key", F.col("log_weight") + gumbel), "weights")
    usable = keyed.where("key IS NOT NULL")
    last = _nth_largest(usable, "key", round(share_of(labels, target, share) * usable.count()))
    kept = F.coalesce(F.col("key") >= F.lit(last), F.lit(False))
    return keyed.select(
        named("id").alias(id_column), "log_weight", "key", kept.alias("kept")
    )


def share_of(labels: DataFrame, target: Column, share: float | None) -> float:
    """The share asked for, or that of the target among the labels; 1 without labels."""
    if share is not None:
        return share
    found = labels.agg(F.avg(F.when(target, 1.0).otherwise(0.0))).first()[0]
    return 1.0 if found is None else found


def _nth_largest(rows: DataFrame, column: str, n: int) -> float:
    """The n-th largest value, by histograms of narrower and narrower ranges."""
    if n <= 0:
        return float("inf")
    low, high, count = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not count or n >= count:
        return float("-inf")
    while low < high:
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        at = F.least(
            F.floor((F.col(column) - low) / F.lit(high - low) * 1000), F.lit(999)
        )
        bins = (
            inside.groupBy(at.alias("at"))
            .agg(
                F.count("*").alias("count"),
                F.min(column).alias("low"),
                F.max(column).alias("high"),
            )
            .collect()
        )
        for b in sorted(bins, key=lambda b: -b["at"]):
            if n <= b["count"]:
                low, high = b["low"], b["high"]
                break
            n -= b["count"]
    return low
