"""What op1 takes from the corpus: the number of buckets and the threshold."""

import math
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from minuteflow.llm import quality
from minuteflow.llm.common import let, table, words

from .test_llm_queries import WORD, buckets, spark_hash


def test_buckets_follow_the_corpus(spark, documents):
    # 600,000 words and as many pairs, none twice.
    frame = spark.range(600).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 1000), i -> concat('w', id, '-', i)), ' ') AS text"
    )
    assert quality.bucket_count(documents) == quality.BUCKETS
    assert quality.bucket_count(frame) == 2 * quality.BUCKETS
    assert quality.bucket_count(frame.union(frame).repartition(7)) == 2 * quality.BUCKETS
    few = frame.where("doc_id < 9")
    trusted = few.select("doc_id").where("doc_id < 4")
    scores = lambda **n: [r[0] for r in quality.judged(few, trusted, **n).select("verdict.score").collect()]
    assert scores(threshold=0.0) == scores(buckets=quality.BUCKETS)
    assert scores(threshold=0.0) != scores(buckets=2 * quality.BUCKETS)


def test_buckets_are_told_by_all_n_grams(spark):
    # Texts of one word, each twice: as many n-grams as words.
    for n in (64, 256, 4096, 65_536):
        for more in (0, 1):
            frame = spark.range(2 * (n + more)).selectExpr(
                "id AS doc_id", f"concat('w', id % {n + more}) AS text"
            )
            assert quality.bucket_count(frame, least=1) == n // quality.LOAD * (1 + more)
    assert quality.bucket_count(frame.limit(0), least=1) == 1


def test_no_bound_reaches_the_pipeline(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [
        (d, " ".join(f"w{x}" for x in rng.integers(40 if d % 9 else 4000, size=60))) for d in range(90)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    asked = []
    ids = quality._ids
    monkeypatch.setattr(quality, "_ids", lambda trusted, most=None: asked.append(most) or ids(trusted, most))
    kept = lambda: sorted(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect())
    want = kept()
    first, lost, _ = quality.held_out_threshold.__defaults__
    monkeypatch.setattr(quality.held_out_threshold, "__defaults__", (first, lost, 5))
    assert kept() == want and want
    assert asked == [None] * 6


def test_threshold_is_held_out(spark, sf_dir, documents, texts):
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    chosen = {r.doc_id for r in trusted.collect()}
    grams = {d: Counter(buckets(WORD.findall(t))) for d, t in texts}
    raw = sum(grams.values(), Counter())
    target = sum((grams[d] for d in chosen), Counter())
    share = lambda n, total: (n + 1.0) / (total + quality.BUCKETS)
    want = []
    failed = quality.judged(documents, trusted).where("verdict.base_failed").select("doc_id").collect()
    for d in chosen - {r.doc_id for r in failed}:
        size, others = grams[d].total(), target - grams[d]
        score = sum(
            n * math.log(share(others[b], others.total()) / share(raw[b], raw.total()))
            for b, n in grams[d].items()
        )
        want.append(score / size)
    weights = quality.bucket_weights(documents, trusted)
    got = quality.held_out_threshold(documents, trusted, weights, quality.BUCKETS, lost=0.05)
    margin = lambda s: quality.QUANTILE_ERROR * np.std(s) / math.sqrt(len(s))
    assert math.isclose(got, np.quantile(want, 0.05) - margin(want), abs_tol=1e-9)
    # One rule for few documents; none leave the base rules alone.
    none = trusted.limit(0)
    assert quality.held_out_threshold(documents, none, weights, quality.BUCKETS) == -math.inf
    one = documents.where("doc_id = -1")
    assert quality.held_out_threshold(one, trusted, weights, quality.BUCKETS) == -math.inf
    bounded = [
        quality.held_out_threshold(documents, trusted, weights, quality.BUCKETS, max_calibrated=n)
        for n in (9, len(chosen), quality.MAX_CALIBRATED)
    ]
    assert bounded[0] != bounded[1] == bounded[2]


def test_clean_documents_stay(spark):
    sf_dir = "/root/testdata/sf0.01"
    if not Path(sf_dir).exists():
        pytest.skip("no test tables")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # A fifth of the good documents is not told to be good.
    trusted = quality.trusted_ids(labels)
    verdicts = quality.judged(docs, trusted.where("doc_id % 5 > 0")).select("doc_id", "verdict.*")
    kept = {r.doc_id: r.kept for r in verdicts.where("NOT base_failed").collect()}
    hidden = [kept[r.doc_id] for r in trusted.where("doc_id % 5 = 0").collect() if r.doc_id in kept]
    junk = [kept[r.doc_id] for r in labels.where("quality = 0").collect() if r.doc_id in kept]
    assert len(hidden) > 40 and sum(hidden) >= 0.95 * len(hidden)
    assert len(junk) > 20 and sum(junk) <= 0.1 * len(junk)
    assert all(kept[d] for d in (20, 23, 33))  # plain German and French, without labels


def test_all_trusted_documents_count(spark):
    n = 100_200
    frame = spark.range(n).selectExpr("id AS doc_id", "'a' AS text")
    row = quality.bucket_weights(frame, frame).select("all_target").first()
    assert row.all_target == n


def test_all_trusted_documents_set_the_threshold(spark, monkeypatch):
    # More trusted documents than any bound there was, of 7 texts of 60 words.
    n, kinds = 20_400, 7
    frame = spark.range(n).selectExpr(
        "id AS doc_id",
        f"array_join(transform(sequence(1, 60), i -> concat('w', i * (1 + id % {kinds}))), ' ') AS text",
    )
    own = [Counter(buckets([f"w{i * (1 + k)}" for i in range(1, 61)])) for k in range(kinds)]
    times = [len(range(k, n, kinds)) for k in range(kinds)]
    raw = Counter()
    for grams, m in zip(own, times):
        raw.update({b: m * c for b, c in grams.items()})
    share = lambda c, total: (c + 1.0) / (total + quality.BUCKETS)
    scores = []
    for grams in own:
        rest = raw.total() - grams.total()
        score = sum(
            c * math.log(share(raw[b] - c, rest) / share(raw[b], raw.total())) for b, c in grams.items()
        )
        scores.append(score / grams.total())
    held = np.repeat(scores, times)
    want = np.quantile(held, 0.01) - quality.QUANTILE_ERROR * np.std(held) / math.sqrt(n)
    weights = quality.bucket_weights(frame, frame)
    threshold = lambda: quality.held_out_threshold(frame, frame, weights, quality.BUCKETS)
    assert math.isclose(threshold(), want, rel_tol=1e-9)
    monkeypatch.setattr(quality, "BROADCAST_IDS", 3)  # the ids are joined by a shuffle
    assert math.isclose(threshold(), want, rel_tol=1e-9)


def test_quantile_is_exact(spark):
    for n, part in ((1, 0.01), (2, 0.5), (150_000, 0.01)):
        values = np.floor(np.random.default_rng(n).normal(size=n) * 1000) / 1000
        scores = spark.createDataFrame([(float(v),) for v in values], "score double")
        assert math.isclose(quality._quantile(scores, n, part), np.quantile(values, part), rel_tol=1e-9)


def test_repeated_words_by_parts_of_hashes(spark, monkeypatch):
    texts = ["a b c d a b c", "a a a a", "x y z " * 9, " ".join(f"w{i % 23}" for i in range(60)), "a b"]
    want = []
    for w in map(str.split, texts):
        found = Counter(zip(w, w[1:], w[2:]))
        want.append(
            len({i + k for i in range(len(w) - 2) if found[tuple(w[i : i + 3])] > 1 for k in range(3)})
        )
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits in (2, 5, quality.POSITION_BITS):
        monkeypatch.setattr(quality, "POSITION_BITS", bits)
        n_repeat = let(words(F.col("text")), lambda w: quality._repeat_words(w)).alias("n")
        rows = frame.select("doc_id", n_repeat).collect()
        assert [r.n for r in sorted(rows)] == want


def test_rows_of_n_grams_need_no_lambda(spark):
    texts = [None, "", " \n ", "a", "a b a", "\na  b\tc d\n\n", "x\x0by\x0cz\rw", "é 漢字  b c"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality._gram_rows(frame, "doc_id")
    want = Counter()
    for doc_id, text in enumerate(texts):
        own = WORD.findall(text or "")
        want.update((doc_id, spark_hash(*g)) for g in [*zip(own), *zip(own, own[1:])])
    assert Counter((r.doc_id, r.h) for r in rows.collect()) == want
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    # Each text is split once: by its one form or the other.
    assert plan.count("split(") == 2
