"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from minuteflow.llm import resampling

from .conftest import HARD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, max_n, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets
        for n in range(1, max_n + 1)
        for i in range(len(words) - n + 1)
    ]


def brute_force(docs, target, max_n, buckets, min_words, percent, seed):
    made = [(d, *grams(t, max_n, buckets)) for d, t in docs]
    s = Counter(b for _, _, bs in made for b in bs)
    t = Counter(b for text in target for b in grams(text, max_n, buckets)[1])
    gain = lambda b: math.floor(
        1000
        * math.log(
            (t[b] + 1.0) * float(s.total() + buckets) / ((s[b] + 1.0) * float(t.total() + buckets))
        )
    )
    rows = []
    for d, n, bs in made:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bs))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, n, len(bs), weight, score))
    fit = sorted(
        (r for r in rows if r[1] >= min_words),
        key=lambda r: (-r[4], r[0] is None, r[0] or 0),
    )
    drawn = fit[: percent * len(fit) // 100]
    ranks = {(r[0], r[4]): [] for r in drawn}
    for place, r in enumerate(drawn, 1):
        ranks[r[0], r[4]].append(place)
    out = []
    for r in rows:
        left = ranks.get((r[0], r[4]))
        fits = r[1] >= min_words and left
        out.append((*r, left.pop() if fits else None))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_against_brute_force(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    wanted = [r.text for r in target.collect()]
    for options in ((1, 10_000, 20, 10, 2024), (3, 512, 5, 33, 7)):
        got = resampling.resampled(docs.repartition(5), target, *options).collect()
        assert sorted(map(tuple, got), key=key) == sorted(
            brute_force(texts, wanted, *options), key=key
        )


def test_hard_rows(spark, hard, empty):
    target = spark.createDataFrame([(None,), ("",), ("one two q",)], "text string")
    got = resampling.resampled(hard, target, max_n=2, buckets=64, min_words=1, percent=50)
    want = brute_force([(d, t) for d, t, _ in HARD], [None, "", "one two q"], 2, 64, 1, 50, 2024)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert got.where("n_features = 0").select("weight", "rank").distinct().collect() == [(0, None)]
    assert resampling.resampled(empty, target).count() == 0
    flat = resampling.resampled(hard, target.limit(0))
    assert flat.count() == len(HARD)


def test_runs_and_shifted_indices():
    texts = pa.array(["A b! b", None, "", "ÄB9-c " * 4, "x" * 100])
    runs = list(resampling.text_runs(texts))
    assert sum(len(r) for r in runs) == 5 and runs[0].to_pylist()[1] == ""
    n_words, found = resampling.features(runs[0], 4, 1 << 31)
    assert n_words.tolist() == [3, 0, 0, 8, 1]
    for n, (own, rows) in enumerate(found, 1):
        want = []
        for i, text in enumerate(runs[0].to_pylist()):
            words = WORD.findall(text.translate(LOWER))
            want += [
                (zlib.crc32(" ".join(words[k : k + n]).encode()) % (1 << 31), i)
                for k in range(len(words) - n + 1)
            ]
        assert list(zip(own.tolist(), rows.tolist())) == want
    assert [len(r) for r in resampling.text_runs(pa.array(["x" * resampling.RUN_BYTES] * 3))] == [1, 1, 1]


def test_draws_follow_the_target(spark):
    rows = [(i, " ".join(("sea ship sail" if i % 4 else "law court judge").split() * 10)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("the law of the court",)], "text string")
    drawn = resampling.resampled(docs, target, buckets=1 << 16).where("rank is not null").collect()
    assert sorted(r["rank"] for r in drawn) == list(range(1, 41))
    assert all(r.doc_id % 4 == 0 for r in drawn)
    assert np.all(np.diff([r.score for r in sorted(drawn, key=lambda r: r["rank"])]) <= 0)
