"""Line dedup: lines that stand in many documents, found with levelled sorted runs.

An index of line hashes is kept as sorted runs in levels, like the files of a
log-structured store. A run has one row per line key: its 128-bit hash and the
number of documents it was found in. Each batch of documents is merge-anti-joined
with the runs, so that keys already known to be frequent are not written again,
and adds what is left as a run of level 0. When a level has ``fanout`` runs,
they are compacted into one of the next level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from minuteflow.llm.common import SPACES, arrow_schema, few_tasks, kept, slices, text_bytes
MIN_CHARS = 1
MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
_STRIP = SPACES.encode()


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line: white space stripped at both ends, A-Z lower-cased."""
    return [line.strip(_STRIP) for line in text.lower().split(b"\n")]


def _n_chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


@dataclass
class LineIndex:
    """Levelled runs of (``line``, ``n_docs``), each sorted by ``line`` in its files."""

    spark: SparkSession
    min_docs: int = MIN_DOCS
    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, counts: DataFrame) -> None:
        """Take in a batch's (``line``, ``n_docs``), one row per line and task or fewer."""
        new = counts.groupBy("line").agg(F.sum("n_docs").alias("n_docs"))
        for run in self.runs():
            known = run.where(F.col("n_docs") >= self.min_docs).select("line")
            new = new.hint("merge").join(known.hint("merge"), "line", "left_anti")
        self._put(0, new)

    def _put(self, level: int, counts: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        run = kept(few_tasks(counts).sortWithinPartitions("line"), f"lines-{level}")
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            parts, self.levels[level] = self.levels[level], []
            self._put(level + 1, _summed(parts))

    def frequent(self) -> DataFrame:
        """Lines found in at least ``min_docs`` documents."""
        return _summed(self.runs()).where(F.col("n_docs") >= self.min_docs).select("line")


def _summed(runs: list[DataFrame]) -> DataFrame:
    every = runs[0]
    for run in runs[1:]:
        every = every.unionByName(run)
    return every.groupBy("line").agg(F.sum("n_docs").alias("n_docs"))


_LINES = T.StructType(
    [
        T.StructField("row_key", T.LongType(), False),
        T.StructField("line", T.BinaryType(), False),
    ]
)


def document_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(``row_key``, ``line``): the hashes of the different lines of every row.

    ``row_key`` is a hash of id and text; equal rows give their lines once each.
    """
    schema = arrow_schema(_LINES)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, lines, counts = batch.column(0), [], []
            for text in text_bytes(batch.column(1)):
                own = {k for k in line_keys(text) if k and _n_chars(k) >= min_chars}
                lines.extend(xxhash.xxh3_128_digest(k) for k in own)
                counts.append(len(own))
            rows = pa.array(np.repeat(np.arange(len(keys)), counts))
            yield pa.RecordBatch.from_arrays(
                [keys.take(rows), pa.array(lines, pa.binary())], schema=schema
            )

    return docs.select(_row_key(), "text").mapInArrow(hashes, _LINES)


def _row_key():
    return F.xxhash64("doc_id", "text").alias("row_key")


def frequent_lines(
    lines: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """Feed ``document_lines`` to an index in ``batches`` slices and ask it for frequent lines."""
    index = LineIndex(lines.sparkSession, min_docs, fanout)
    for batch in range(batches):
        slice_ = lines.where(F.pmod("row_key", F.lit(batches)) == batch)
        index.add(slice_.select("line", F.lit(1).cast("long").alias("n_docs")))
    return index.frequent()


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with the lines left in ``text``, and ``n_lines`` and ``n_dropped``.

    A document is a row. A line whose key has at least ``min_chars`` code points
    and is found in at least ``min_docs`` rows is dropped from every row; the
    other lines stay as they were, joined by newlines. A null or empty text is
    one empty line, and its ``text`` becomes empty. Null and repeated ids and
    further columns do no harm, except that columns called ``n_lines`` and
    ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    lines = kept(document_lines(docs, min_chars), "lines")
    frequent = frequent_lines(lines, min_docs, batches, fanout)
    # Per row the frequent lines it has. A line of many rows meets in one task of this join.
    marks = lines.join(frequent, "line").groupBy("row_key").agg(F.collect_set("line").alias("drop"))
    inner = docs.drop("n_lines", "n_dropped")
    packed = inner.select(
        _row_key(), F.col("text"), F.struct(*(c for c in inner.columns if c != "text")).alias("rest")
    )
    schema = T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("rest", packed.schema["rest"].dataType),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )
    names = [f.name for f in schema.fields]

    def cut(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches_):
            texts, n_lines, n_dropped = [], [], []
            drops = batch.column(3).to_pylist()
            for text, drop in zip(text_bytes(batch.column(1)), drops, strict=True):
                own = text.split(b"\n")
                n_lines.append(len(own))
                if drop:
                    gone = set(drop)
                    keys = line_keys(text)
                    own = [
                        line
                        for line, key in zip(own, keys, strict=True)
                        if not key or xxhash.xxh3_128_digest(key) not in gone
                    ]
                n_dropped.append(n_lines[-1] - len(own))
                texts.append(b"\n".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    batch.column(2),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                ],
                names=names,
            )

    done = packed.join(marks, "row_key", "left").mapInArrow(cut, schema)
    return done.select(
        *("text" if c == "text" else F.col("rest")[c].alias(c) for c in inner.columns),
        "n_lines",
        "n_dropped",
    )
