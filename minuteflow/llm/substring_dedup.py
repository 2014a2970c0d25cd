"""Substring dedup: repeated passages found by level-wise doubling.

A passage of ``length`` words can only repeat if its parts repeat. The first
level looks at windows of a few words, and of these only at anchors: of every
passage of about twice that length the window with the smallest hash, so that
equal passages have an anchor at the same place. Windows repeated at one level
alone are extended to the next, of twice the length (one more where it is odd),
until none is left or ``length`` is reached, where every window counts.

Windows are compared as 64-bit hashes. Among n candidate windows about
n^2 / 2^65 pairs of different ones share a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from minuteflow.llm.common import arrow_schema, kept, text_bytes, window_hashes, word_hashes

LENGTH = 13
LEAST = 5


def anchors(h: np.ndarray, short: int, long: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the short windows, and for every long window which of these is its smallest."""
    hashes = window_hashes(h, short)
    if len(h) < long:
        return hashes, np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, long - short + 1)
    return hashes, views.argmin(1) + np.arange(len(views))


def _pairs(docs: DataFrame, hashes_of: Callable, *columns: str) -> DataFrame:
    """(``doc``, ``h``): what ``hashes_of`` gives for every row's text and further columns."""
    kind = T.StructType([T.StructField("doc", T.LongType()), T.StructField("h", T.LongType())])
    schema = arrow_schema(kind)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            further = [batch.column(k) for k in range(2, batch.num_columns)]
            found = [
                hashes_of(text, *(f[i] for f in further))
                for i, text in enumerate(text_bytes(batch.column(1)))
            ]
            h = np.concatenate(found) if found else np.zeros(0, np.uint64)
            doc = np.repeat(ids, [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(h.view(np.int64))], schema=schema
            )

    return docs.select("doc", "text", *columns).mapInArrow(pairs, kind)


def level_lengths(length: int, least: int = LEAST) -> list[int]:
    """Window lengths from the shortest to ``length``, each about twice the one before."""
    lengths = [length]
    while lengths[0] // 2 >= least:
        lengths.insert(0, lengths[0] // 2)
    return lengths


def _windows(lengths: list[int], level: int) -> Callable:
    """The windows of a level that may repeat, given those that did at the level before.

    Below the last level only anchors: of every window of the next length, the
    window of this level with the smallest hash.
    """

    def hashes_of(text: bytes, survivors: pa.Scalar | None = None) -> np.ndarray:
        h = word_hashes(text.split())
        own = window_hashes(h, lengths[level])
        may = np.ones(len(own), bool)
        if level:
            shorter, places = anchors(h, lengths[level - 1], lengths[level])
            may = np.isin(shorter[places], survivors.values.to_numpy().view(np.uint64))
        if level + 1 < len(lengths):
            chosen = np.zeros(len(own), bool)
            chosen[anchors(h, lengths[level], lengths[level + 1])[1]] = True
            may &= chosen
        return np.unique(own[may])

    return hashes_of


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(``doc``, ``h``, ``first``): windows found in several documents, and the first of these.

    Per level: windows that may repeat, counted; those found twice go back to
    their documents, where the next level extends them.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("doc"), "text")
    lengths = level_lengths(length)
    survivors = None
    for level in range(len(lengths)):
        own = _windows(lengths, level)
        if survivors is None:
            found = _pairs(texts, own)
        else:
            found = _pairs(texts.join(survivors, "doc"), own, "survivors")
        found = kept(found, f"windows-{lengths[level]}")
        if level + 1 == len(lengths):
            break
        twice = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
        back = found.join(twice, "h").groupBy("doc").agg(F.collect_list("h").alias("survivors"))
        survivors = kept(back, f"survivors-{lengths[level]}")
        if survivors.isEmpty():
            return found.limit(0).withColumn("first", F.col("doc"))
    first = (
        found.groupBy("h")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last")
        .select("h", "first")
    )
    return found.join(first, "h")


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the words that a smaller ``doc_id`` has in the same passage.

    A word goes if a window of ``length`` words that covers it starts, word for
    word, in a document with a smaller id too; windows are judged on the input.
    ``text`` becomes the words left, joined by a space; ``n_words`` and
    ``n_removed`` are added (columns of these names are replaced), further columns stay. Null and empty texts
    have no words. Rows without an id neither lose words nor take any away. Rows
    that share an id take none from each other.
    """
    repeated = repeated_windows(docs, length).where("first < doc")
    marks = repeated.groupBy("doc").agg(F.collect_list("h").alias("gone"))
    marks = kept(marks, "gone")
    inner = docs.drop("n_words", "n_removed")
    others = F.struct(*(c for c in inner.columns if c != "text"))
    packed = inner.select(F.col("doc_id").alias("doc"), "text", others.alias("rest"))
    schema = T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("rest", packed.schema["rest"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    names = [f.name for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for i, text in enumerate(text_bytes(batch.column(1))):
                words = text.split()
                n_words.append(len(words))
                gone = batch.column(3)[i]
                if gone.is_valid:
                    own = window_hashes(word_hashes(words), length)
                    starts = np.flatnonzero(np.isin(own, gone.values.to_numpy().view(np.uint64)))
                    covered = np.zeros(len(words) + 1, np.int64)
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + length, -1)
                    stay = np.cumsum(covered)[:-1] == 0
                    words = [w for w, s in zip(words, stay, strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    batch.column(2),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                ],
                names=names,
            )

    cleaned = packed.join(marks, "doc", "left").mapInArrow(cut, schema)
    return cleaned.select(
        *("text" if c == "text" else F.col("rest")[c].alias(c) for c in inner.columns),
        "n_words",
        "n_removed",
    )
