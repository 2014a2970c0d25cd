"""Order MinHash fingerprints: signatures that follow the edit distance of texts.

The k-mers of a text are runs of ``k`` words, numbered by occurrence, so that a
k-mer's second copy is another element. For each of ``size`` hash functions the
``chosen`` k-mers with the smallest hashes are selected and put back in text
order, and the tuple of their plain k-mers is hashed. The share of equal
components estimates how alike two texts are in content and order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from minuteflow.llm.common import arrow_schema, kept

K = 2
CHOSEN = 2
SIZE = 64
_CELLS = 1 << 22


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def kmers(text: str, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers in text order, plain and numbered by occurrence.

    A text of fewer than ``k`` words is one k-mer of all its words.
    """
    words = text.encode().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(k, n)
    plain = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        plain = _mixed(plain + h[j : n - k + 1 + j])
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = nth.astype(np.uint64)
    return plain, _mixed(plain + _mixed(occurrence + np.uint64(1)))


def signature(text: str, k: int = K, chosen: int = CHOSEN, size: int = SIZE) -> np.ndarray:
    """``size`` components of 32 bits; a text without words has zeros."""
    plain, numbered = kmers(text, k)
    if not len(plain):
        return np.zeros(size, np.uint32)
    seeds = _mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    chosen = min(chosen, len(plain))
    out = np.empty(size, np.uint32)
    step = max(1, _CELLS // len(plain))  # long texts take fewer hash functions at once
    for a in range(0, size, step):
        rows = seeds[a : a + step, None]
        hashes = (numbered[None, :] ^ rows) * (rows | np.uint64(1))
        hashes ^= hashes >> np.uint64(29)
        places = []
        lines = np.arange(len(hashes))
        for _ in range(chosen):
            least = hashes.argmin(1)
            places.append(least)
            hashes[lines, least] = np.uint64(0xFFFFFFFFFFFFFFFF)
        order = np.sort(np.stack(places, 1), 1)
        tuples = np.zeros(len(hashes), np.uint64)
        for j in range(chosen):
            tuples = _mixed(tuples + plain[order[:, j]])
        out[a : a + step] = (tuples >> np.uint64(32)).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the first characters of the next document."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprint_column(text: Column, k: int = K, chosen: int = CHOSEN, size: int = SIZE) -> Column:
    """The fingerprint of every text as hex digits, eight per component; null is empty."""

    @F.pandas_udf("string")
    def fingerprints(texts):
        return texts.fillna("").map(lambda t: hexed(signature(t, k, chosen, size)))

    return fingerprints(text)


def hexed(sig: np.ndarray) -> str:
    return packed(sig).hex()


def packed(sig: np.ndarray) -> bytes:
    return sig.astype(">u4").tobytes()


_RESULT = [
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.BinaryType()),
    T.StructField("fingerprint", T.BinaryType()),
    T.StructField("edited_fingerprint", T.BinaryType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]
# What a task cannot finish alone: its last document waits for the first of the next task.
_EDGES = [
    T.StructField("pid", T.LongType()),
    T.StructField("edge", T.StringType()),
    T.StructField("text", T.StringType()),
]


def compare_with_next(
    docs: DataFrame, k: int = K, chosen: int = CHOSEN, size: int = SIZE
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Documents follow one another by descending ``doc_id`` (null last; equal ids
    by a hash of the text), and the last is followed by the first. Texts are dealt once, by
    ranges of the id; every task walks along its sorted rows. The rows at the
    edges of tasks, two per task, are matched afterwards. A null text is empty.
    A table of one row is followed by itself; further columns are ignored.
    """
    fields = _RESULT + _EDGES
    kind = T.StructType(fields)
    schema = arrow_schema(kind)

    def row(doc_id, text, sig, following, next_sig):
        changed = edited(text, following)
        other = signature(changed, k, chosen, size)
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode()).digest(),
            packed(sig),
            packed(other),
            likeness(sig, other),
            likeness(sig, next_sig),
        )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                text = text or ""
                sig = signature(text, k, chosen, size)
                if last is None:
                    rows.append((doc_id, *[None] * 6, pid, "first", text))
                else:
                    rows.append((*row(*last, text, sig), None, None, None))
                last = (doc_id, text, sig)
            yield batch_of(rows)
        if last is not None:
            yield batch_of([(last[0], *[None] * 6, pid, "last", last[1])])

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc()]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    walked = kept(ranged.mapInArrow(walk, kind), "fingerprints")
    edges = walked.where("edge is not null")
    # Two rows per task, numbered along the tasks: first, last, first, last, ...
    tasks = [r.pid for r in edges.where("edge = 'first'").select("pid").orderBy("pid").collect()]
    done = walked.where("edge is null").select(*(f.name for f in _RESULT))
    if not tasks:
        return _in_hex(done)
    after = list(zip(tasks, tasks[1:] + tasks[:1], strict=True))
    follows = docs.sparkSession.createDataFrame(after, "pid long, next_pid long")
    ends = edges.where("edge = 'last'").select("pid", "doc_id", "text")
    begins = edges.where("edge = 'first'").select(
        F.col("pid").alias("next_pid"), F.col("text").alias("following")
    )
    pairs = ends.join(follows, "pid").join(begins, "next_pid").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in _RESULT]
        own = pa.schema([schema.field(n) for n in names])
        for batch in batches:
            rows = []
            for doc_id, text, following in zip(
                *(batch.column(c).to_pylist() for c in range(3)), strict=True
            ):
                sigs = (signature(t, k, chosen, size) for t in (text, following))
                sig, next_sig = sigs
                rows.append(row(doc_id, text, sig, following, next_sig))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, own, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=own)

    return _in_hex(done.unionByName(pairs.mapInArrow(finish, T.StructType(_RESULT))))


def _in_hex(rows: DataFrame) -> DataFrame:
    """Bytes as lowercase hex digits; the table between holds them as bytes, half as large."""
    hexes = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return rows.withColumns({c: F.lower(F.hex(c)) for c in hexes})
