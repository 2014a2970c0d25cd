"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Native: everything on the path is DataFrame expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from minuteflow.llm.common import kept, let, words
from minuteflow.session import broadcast_if_small

# The fewest buckets; more n-grams of trusted documents than LOAD for each of them get more buckets.
BUCKETS = 1 << 14
LOAD = 64
# Standard error of the sketch that counts n-grams, as a part of their number.
SKETCH_ERROR = 0.02
CHUNK = 1 << 12
SMOOTHING = 1.0
# Up to so many trusted ids are broadcast, about 64 MB; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
# So many trusted documents set the threshold; None: all.
MAX_CALIBRATED = None
HELD_OUT_LOST = 0.01
# Standard error of the 1 % quantile of n normal scores, in standard deviations over sqrt(n).
QUANTILE_ERROR = 3.73
# Windows are numbered in so many bits of a long, the others hold a part of their hash.
POSITION_BITS = 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Each task that counts sends nearly every bucket, so there are this many tasks a core at most.
COUNTING_TASKS = 4


def base_counts(text: Column, w: Column) -> Column:
    """A struct of counts over the whole text with the words ``w``; null counts as an empty text.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters
    of ``#*$%&|<>``; ``n_dup_lines``, lines with a word that equal an earlier
    line; ``n_repeat_words``, words in 3-word windows found twice or more.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]+", "")))
        .cast("long")
        .alias("n_symbols"),
        let(
            F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))),
            lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        ).alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
    )


def _repeat_words(w: Column, few: Column | int = 0) -> Column:
    """Words covered by 3-word windows that occur twice or more in ``w``; 0 where no more than ``few``
    can be, by the number of distinct windows.

    Windows are compared as 64-bit hashes within one text. Texts whose hashes all differ need no
    sort; in the others only windows that share the low bits of a hash are sorted by all of it.
    """
    hashes = F.slice(
        F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
        1,
        F.greatest(F.size(w) - 2, F.lit(0)),
    )

    def twins(h: Column) -> Column:
        """Positions of hashes whose low bits are found twice or more; in huge texts all positions."""
        high = lambda x: F.shiftright(x, POSITION_BITS)
        packed = F.sort_array(
            F.transform(
                h, lambda x, i: F.shiftleft(x, POSITION_BITS).bitwiseOR(i.cast("long"))
            )
        )
        found = lambda s: F.transform(
            F.filter(
                s,
                lambda x, k: F.coalesce(high(F.get(s, k - 1)) == high(x), F.lit(False))
                | F.coalesce(high(F.get(s, k + 1)) == high(x), F.lit(False)),
            ),
            lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int"),
        )
        return F.when(F.size(h) <= 1 << POSITION_BITS, let(packed, found)).otherwise(
            F.transform(h, lambda x, i: i)
        )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(
            F.transform(twins(h), lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i")))
        )
        starts = let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        # A window covers three words, or as many as lie before the next one.
        length = lambda p: F.aggregate(
            F.transform(
                p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))
            ),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )
        return let(starts, length)

    return let(
        hashes,
        # Each window that repeats an earlier one makes two at most repeated, of three words each.
        lambda h: F.when(
            6 * (F.size(h) - F.size(F.array_distinct(h))) <= few, F.lit(0).cast("long")
        ).otherwise(covered(h)),
    )


def base_failed(counts: Column, min_words: int = MIN_WORDS) -> Column:
    return (counts["n_words"] < min_words) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )


def _buckets(w: Column, buckets: int) -> Column:
    """The buckets of the words and of the pairs of neighbouring words."""
    of = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    return F.concat(
        F.transform(w, lambda x: of(F.xxhash64(x))),
        F.slice(
            F.transform(w, lambda x, i: of(F.xxhash64(x, F.get(w, i + 1)))),
            1,
            F.greatest(F.size(w) - 1, F.lit(0)),
        ),
    )


def _gram_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """A row for each word and each pair of neighbouring words: ``columns`` and its hash ``h``.

    Words become rows before they are hashed, so no lambda is interpreted. A text without words gives
    a row of null, dropped behind: else Spark splits every text once more to tell whether it has words.
    """
    split = docs.select(*columns, words(F.col("text")).alias("words"))
    each = split.select("*", F.posexplode_outer("words").alias("i", "word")).where("word is not null")
    word, pair = F.xxhash64("word"), F.xxhash64("word", F.get("words", F.col("i") + 1))
    hashes = F.when(F.col("i") < F.size("words") - 1, F.array(word, pair)).otherwise(F.array(word))
    return each.select(*columns, F.explode(hashes).alias("h"))


def bucket_count(docs: DataFrame, least: int = BUCKETS) -> int:
    """The least power of two, ``least`` or more, with at most ``LOAD`` distinct n-grams for each bucket.

    All n-grams are counted, by their 64-bit hashes. A sketch over all of them tells the power of two
    where it is four standard errors or more away from the next; else they are counted one by one.
    """
    grams = _gram_rows(docs)
    fitting = lambda n: max(least, 1 << max(0, math.ceil(n / LOAD) - 1).bit_length())
    about = grams.agg(F.approx_count_distinct("h", SKETCH_ERROR)).first()[0]
    low, high = (fitting(about * (1 + m * SKETCH_ERROR)) for m in (-4, 4))
    if low == high:
        return low
    return fitting(kept(grams.distinct().agg(F.count("*").alias("n")), "grams").first()[0])


def _ids(trusted: DataFrame, most: int | None = None) -> DataFrame:
    """All trusted ids once, or the first ``most`` by a hash, as ``trusted_id``; broadcast if few."""
    ids = trusted.where("doc_id is not null").select(F.col("doc_id").alias("trusted_id")).distinct()
    if most is not None:
        ids = ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most)
    return broadcast_if_small(ids, BROADCAST_IDS)


def bucket_weights(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """One row: ``weights``, per bucket the log of its share in trusted documents over its share
    in all; ``alone``, the same with one n-gram fewer in trusted documents; ``target``, per bucket
    its count in trusted documents; ``all_target``, their sum.

    ``trusted`` has the ``doc_id`` of trusted documents; all of them are counted, and every document
    counts for the raw corpus. The shuffled counts are bounded by cores and buckets, whatever the
    corpus; beyond ``BROADCAST_IDS`` trusted documents the texts are shuffled as well, to tell which
    are trusted. The arrays are put together from runs of ``CHUNK`` buckets; with them one task
    holds 24 bytes a bucket.
    """
    tasks = COUNTING_TASKS * docs.sparkSession.sparkContext.defaultParallelism
    marked = docs.select("doc_id", "text").coalesce(tasks).join(
        _ids(trusted), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    bucket = F.pmod("h", F.lit(buckets)).cast("int").alias("bucket")
    counts = (
        _gram_rows(marked, "trusted_id")
        .groupBy(bucket)
        .agg(F.count("*").alias("raw"), F.count("trusted_id").alias("target"))
    )
    # From here on there are at most as many rows as buckets.
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    chunks = rows.groupBy(F.floor(F.col("bucket") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("rows"),
        F.sum("raw").alias("raw"),
        F.sum("target").alias("target"),
    )
    chunks = kept(
        chunks.select(
            "chunk",
            "raw",
            "target",
            F.col("rows.raw").alias("raws"),
            F.col("rows.target").alias("targets"),
        ),
        "buckets",
    )
    totals = chunks.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    share = lambda n, total: (n + F.lit(smoothing)) / F.lit(total + smoothing * buckets)
    weights = F.transform(
        F.arrays_zip("raws", "targets"),
        lambda r: F.log(share(r["targets"], totals.target))
        - F.log(share(r["raws"], totals.raw)),
    )
    alone = F.transform(
        F.arrays_zip("weights", "targets"),
        lambda r: r["weights"]
        + F.log(r["targets"] + F.lit(smoothing - 1))
        - F.log(r["targets"] + F.lit(smoothing)),
    )
    return (
        chunks.select("chunk", weights.alias("weights"), "targets")
        .select("chunk", "weights", alone.alias("alone"), "targets")
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "weights", "alone", "targets"))).alias("rows"))
        .select(
            F.flatten("rows.weights").alias("weights"),
            F.flatten("rows.alone").alias("alone"),
            F.flatten("rows.targets").alias("target"),
            F.lit(totals.target).alias("all_target"),
        )
    )


def score(w: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """Mean weight of the n-grams of the words ``w``; null where there is no word."""
    mean = let(
        _buckets(w, buckets),
        lambda b: let(
            weights, lambda t: F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(t, x)) / F.size(b)
        ),
    )
    return F.when(F.size(w) > 0, mean)


def _held_out_score(b: Column, alone: Column, target: Column, total: float, smoothing: float) -> Column:
    """``score`` of the buckets ``b``, ascending, with their own counts taken out of ``target``."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(b) - 1), lambda i: (i == 0) | (F.get(b, i - 1) != F.get(b, i))
    )

    def summed(p: Column, t: Column, counts: Column) -> Column:
        def own(x: Column, n: Column) -> Column:
            # ``alone`` has one of the document's n-grams taken out; most buckets have no more.
            return F.when(n == 1, F.get(t, x)).otherwise(
                let(
                    F.get(counts, x) + F.lit(smoothing),
                    lambda count: n * (F.get(t, x) + F.log(count - n) - F.log(count - 1)),
                )
            )

        each = F.transform(
            p, lambda i, k: own(F.get(b, i), F.coalesce(F.get(p, k + 1), F.size(b)) - i)
        )
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x)

    total_ = let(
        starts, lambda p: let(alone, lambda t: let(target, lambda counts: summed(p, t, counts)))
    )
    return total_ / F.size(b) - F.log(1 - F.size(b) / F.lit(total))


def _quantile(scores: DataFrame, n: int, part: float) -> float:
    """The exact ``part`` quantile of the ``n`` rows of ``scores``, between two of them by proportion.

    A sketch gives two scores around it; those outside are counted and only those between are ranked,
    a few in a thousand. Should the sketch have missed it, the two are taken further apart.
    """
    place, margin = part * (n - 1), max(0.001, 100 / n)
    while True:
        around = F.array(*(F.lit(float(min(1, max(0, part + m)))) for m in (-margin, margin)))
        low, high = scores.agg(F.percentile_approx("score", around)).first()[0]
        below, upto = scores.agg(
            F.count_if(F.col("score") < low), F.count_if(F.col("score") <= high)
        ).first()
        if below <= place <= upto - 1 or margin >= 1:
            break
        margin *= 4
    inner = F.lit((place - below) / max(1, upto - below - 1))
    return scores.where(F.col("score").between(low, high)).agg(F.percentile("score", inner)).first()[0]


def held_out_threshold(
    docs: DataFrame,
    trusted: DataFrame,
    table: DataFrame,
    buckets: int,
    smoothing: float = SMOOTHING,
    lost: float = HELD_OUT_LOST,
    max_calibrated: int | None = MAX_CALIBRATED,
) -> float:
    """The score that ``lost`` of the trusted documents miss when they are not counted as trusted.

    All trusted documents that pass the base rules are scored with their own counts taken out of
    ``table``, which :func:`bucket_weights` gave; only a caller that sets ``max_calibrated`` gets no
    more than so many, by a hash of their ids. The threshold is the ``lost`` quantile of these scores
    less its standard error, so few of them make it lower. Without any the base rules alone decide:
    minus infinity. The scores are written once to the shared folder and ranked by Spark.
    """
    own = docs.select("doc_id", "text").join(
        _ids(trusted, max_calibrated), F.col("doc_id") == F.col("trusted_id")
    )
    # Each array is named once below, so Spark puts it in there and copies it into no row.
    own = own.withColumns(
        {"alone": table.select("alone").scalar(), "target": table.select("target").scalar()}
    )
    total = table.select("all_target").first()[0] + smoothing * buckets
    # The exact number of repeated words matters only where they might be too many.
    brief = lambda w: F.struct(
        F.size(w).alias("n_words"),
        _repeat_words(w, MAX_REPEAT_PERCENT * F.size(w) / 100).alias("n_repeat_words"),
    )
    scored = let(
        words(F.col("text")),
        lambda w: F.when(
            ~base_failed(brief(w)),
            let(
                F.sort_array(_buckets(w, buckets)),
                lambda b: _held_out_score(b, F.col("alone"), F.col("target"), total, smoothing),
            ),
        ),
    )
    scores = kept(own.select(scored.alias("score")), "held-out").where("score is not null")
    row = scores.agg(F.count("score").alias("n"), F.stddev_pop("score").alias("spread")).first()
    if not row.n:
        return float("-inf")
    return _quantile(scores, row.n, lost) - QUANTILE_ERROR * row.spread / row.n**0.5


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Every column of ``docs``, and a column ``verdict``.

    ``verdict`` is a struct of the base counts, ``base_failed``, ``score`` (the
    log-likelihood ratio per n-gram of the trusted and the raw multinomial) and
    ``kept``: the base rules hold and the score is at least ``threshold``, by default
    :func:`held_out_threshold`; ``buckets`` follow all trusted documents (:func:`bucket_count`),
    and with them what a task holds. A
    null or empty text has no score and is not kept; very long texts are judged whole. Rows are
    judged one by one, so null or repeated ids and further columns do no harm; a column of
    ``docs`` already called ``verdict`` is replaced. Without trusted documents
    every bucket's share is compared with a flat one and the base rules alone decide. An empty
    table gives no rows. The verdict depends on nothing but the text and the counts, so reruns agree.
    """
    if buckets is None:
        own = docs.join(_ids(trusted), F.col("doc_id") == F.col("trusted_id"), "left_semi")
        buckets = bucket_count(own)
    table = kept(bucket_weights(docs, trusted, buckets), "weights")
    if threshold is None:
        threshold = held_out_threshold(docs, trusted, table, buckets, max_calibrated=None)
    weights = "weights of all buckets"
    text = F.col("text")

    def verdict(both: Column) -> Column:
        counts, mean = both["counts"], both["score"]
        failed = base_failed(counts)
        return F.struct(
            *(
                counts[c].alias(c)
                for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            ),
            failed.alias("base_failed"),
            mean.alias("score"),
            (~failed & F.coalesce(mean >= threshold, F.lit(False))).alias("kept"),
        )

    both = let(
        words(text),
        lambda w: F.struct(
            base_counts(text, w).alias("counts"), score(w, F.col(weights), buckets).alias("score")
        ),
    )
    weighed = docs.withColumn(weights, table.select("weights").scalar())
    return weighed.withColumn("verdict", let(both, verdict)).drop(weights)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic."""
    return labels.where("quality = 1 and toxic = 0").select("doc_id")
