"""Importance resampling toward the distribution of a target set of texts.

Texts are turned into hashed n-grams batch by batch with Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``. The dictionary indices
of neighbouring words, shifted against each other, name the longer n-grams, so a CRC is
taken once per distinct n-gram of a batch. A bucket's gain compares its share in the
target with its share in the corpus; a text's weight is the sum of the gains of its
features, taken by bucket and reduced by segments. Seeded Gumbel noise on the weights
makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from minuteflow.llm.common import arrow_schema, running_sums

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# Texts are worked on in runs of at most so many bytes (or one text).
RUN_BYTES = 4 << 20
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_runs(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``RUN_BYTES``; null is empty. One slice holds one text at least."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and the row of each. A-Z is lower-cased."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), _GAP)
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), rows.filter(full).to_numpy().astype(np.int64)


def features(texts: pa.Array, max_n: int, buckets: int) -> tuple[np.ndarray, list]:
    """Words per text, and for every length 1 to ``max_n`` (buckets, rows) of the n-grams in order."""
    words, rows = split_words(texts)
    coded = words.dictionary_encode()
    spelled = coded.dictionary.cast(pa.binary()).to_pylist()
    index = coded.indices.to_numpy().astype(np.int64)
    grams, starts = index, np.arange(len(index))
    crcs = np.fromiter(map(zlib.crc32, spelled), np.int64, len(spelled))
    found = [(crcs[grams] % buckets, rows)]
    for n in range(2, max_n + 1):
        # A gram goes on with the word after it, if that is in the same text.
        fits = starts + (n - 1) < len(index)
        fits[fits] = rows[starts[fits] + n - 1] == rows[starts[fits]]
        starts, before = starts[fits], grams[fits]
        longer = before * max(len(spelled), 1) + index[starts + n - 1]
        distinct, grams = np.unique(longer, return_inverse=True)
        heads, tails = np.divmod(distinct, max(len(spelled), 1))
        crcs = np.fromiter(
            (zlib.crc32(b" " + spelled[t], int(crcs[h])) for h, t in zip(heads, tails, strict=True)),
            np.int64,
            len(distinct),
        )
        found.append((crcs[grams] % buckets, rows[starts]))
    return np.bincount(rows, minlength=len(texts)), found


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over every whole ``text``. A task gives at most one row per bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for run in text_runs(batch.column(0)):
                for own, _ in features(run, max_n, buckets)[1]:
                    total += np.bincount(own, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"]
        )

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    buckets = len(raw)
    all_target, all_raw = float(target.sum() + buckets), float(raw.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target)))
            for t, s in zip(target.tolist(), raw.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Seeded Gumbel noise in thousandths; a null id is an empty string."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(
            T.StructField(name, T.LongType(), False)
            for name in ("n_words", "n_features", "weight", "score", "unfit", "below", "no_id", "spread")
        ),
    ]
)


def scored(
    docs: DataFrame, gains: np.ndarray, max_n: int = MAX_N, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """Per row its counts, weight and score, and the columns by which rows are ranked."""
    schema = arrow_schema(_SCORED)
    buckets = len(gains)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            parts = []
            for run in text_runs(batch.column(1)):
                n_words, found = features(run, max_n, buckets)
                n_features, weight = np.zeros_like(n_words), np.zeros(len(run), np.int64)
                for own, rows in found:
                    # Rows ascend, so a text's gains are one segment of those taken.
                    sums = np.concatenate([[0], np.cumsum(gains.take(own))])
                    cuts = np.searchsorted(rows, np.arange(len(run) + 1))
                    weight += np.diff(sums[cuts])
                    n_features += np.diff(cuts)
                parts.append((n_words, n_features, weight))
            if not parts:
                continue
            n_words, n_features, weight = (np.concatenate(p) for p in zip(*parts, strict=True))
            ids = batch.column(0).to_pylist()
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            columns = (
                n_words, n_features, weight, score, n_words < min_words, -score,
                np.array([i is None for i in ids]), seen + np.arange(len(ids)),
            )
            seen += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c.astype(np.int64)) for c in columns)], schema=schema
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weighed, _SCORED)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the rows with at least ``min_words`` words the ``percent`` in a hundred (rounded down) with
    the highest scores are drawn; ``rank`` counts them from 1 and is null for all others. Ties go to
    the smaller ``doc_id``, null last; equal rows follow each other.

    A null or empty text has no features, weight 0 and no rank. A null id draws its noise from the
    empty string. Very long texts are taken whole, one at a time; further columns of ``docs`` and
    ``target``, whatever their names, are ignored. An empty table gives no rows, an empty target
    flat shares. The driver holds ``buckets`` counts and one row per task, whatever the input.
    """
    gains = bucket_gains(bucket_counts(target, max_n, buckets), bucket_counts(docs, max_n, buckets))
    rows = scored(docs, gains, max_n, min_words, seed).withColumn("one", F.lit(1).cast("long"))
    placed = running_sums(rows, ["unfit", "below", "no_id", "doc_id", "spread"], ["one"], "scores")
    quota = percent * placed.where("unfit = 0").count() // 100
    place = F.col("one_before") + 1
    drawn = (F.col("unfit") == 0) & (place <= quota)
    return placed.select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, place).alias("rank")
    )
