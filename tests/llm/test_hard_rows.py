"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from minuteflow.llm import (
    chat,
    line_dedup,
    mixing,
    near_dup,
    order_minhash,
    packing,
    quality,
    sharding,
    substring_dedup,
)

from .conftest import HARD


def test_quality(spark, hard, empty):
    trusted = spark.createDataFrame([(1,), (None,), (1,)], "doc_id long")
    rows = quality.judged(hard, trusted).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        assert r.verdict.kept is False or r.verdict.n_words >= 50
        if not (r.text or "").strip():
            assert (r.verdict.n_words, r.verdict.score, r.verdict.base_failed) == (0, None, True)
    assert [r.verdict.n_repeat_words for r in rows if r.doc_id == 7] == [30_000]
    assert quality.judged(empty, trusted).count() == 0
    assert quality.judged(hard, trusted.limit(0)).count() == len(HARD)


def test_substring(hard, empty):
    rows = substring_dedup.dedup_substrings(hard).collect()
    assert len(rows) == len(HARD)
    removed = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in rows)
    # Both copies of row 2 lose what row 1 has; the row without an id loses nothing.
    assert removed.count((2, 17, 16)) == 2 and (1, 16, 0) in removed and (0, 16, 0) in removed
    assert {r.text for r in rows if r.doc_id in (3, 4, 5)} == {""}
    assert substring_dedup.dedup_substrings(empty).count() == 0
    assert substring_dedup.dedup_substrings(hard, 104).where("n_removed > 0").count() == 0


def test_substring_longer_levels(spark):
    passage = " ".join(f"w{i}" for i in range(120))
    frame = spark.createDataFrame(
        [(1, f"a {passage} b"), (2, f"{passage} c"), (3, " ".join(passage.split()[:100]))],
        "doc_id long, text string",
    )
    rows = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(frame, 104).collect()}
    assert rows == {1: 0, 2: 120, 3: 0}


def test_order_minhash(hard, empty):
    rows = order_minhash.compare_with_next(hard).collect()
    assert len(rows) == len(HARD)
    by_text = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert len(by_text[16 * 2 - 1]) == 1
    assert order_minhash.compare_with_next(empty).count() == 0
    one = order_minhash.compare_with_next(hard.where("doc_id = 9")).collect()
    assert [(r.near_next, r.near_edited) for r in one] == [(1.0, one[0].near_edited)]


def test_sharding(hard, empty):
    rows = sharding.sharded(hard).collect()
    assert len(rows) == len(HARD)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r["size"] == 1}) == 1  # null and empty texts
    assert sharding.sharded(empty).count() == 0


def test_lines(hard, empty):
    rows = line_dedup.dedup_lines(hard, min_docs=2).collect()
    assert len(rows) == len(HARD)
    kept = {r.doc_id: r for r in rows}
    # Its three equal lines are in one document only.
    assert (kept[6].n_lines, kept[6].n_dropped) == (5, 0)
    assert (kept[2].n_lines, kept[2].n_dropped, kept[2].text) == (1, 1, "")
    assert (kept[3].n_lines, kept[3].n_dropped, kept[3].text) == (1, 0, "")
    assert (kept[5].n_lines, kept[5].n_dropped) == (3, 0)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_batches_agree(hard):
    counts = lambda b, f: sorted(
        (r.text, r.n_dropped)
        for r in line_dedup.dedup_lines(hard, min_docs=2, batches=b, fanout=f).collect()
    )
    assert counts(1, 2) == counts(5, 2) == counts(7, 3)


def test_mixing(hard, empty):
    rows = mixing.mixed(hard).collect()
    assert len(rows) == len(HARD)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mixed(empty).count() == 0


def test_packing(hard, empty):
    rows = packing.packed(hard, capacity=512).collect()
    assert max(r.length for r in rows) == 512
    assert sum(r.piece == 0 for r in rows) == len(HARD)
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        ends = [0]
        for offset, length in sorted(places):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 512
    assert packing.packed(empty).count() == 0


def test_near_dup(hard, empty):
    rows = near_dup.near_duplicates(hard, length=4).collect()
    assert len(rows) == len(HARD)
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows)
    assert found.count((2, 1, False)) == 2 and (1, 1, True) in found
    assert (0, 1, False) in found  # the row without an id belongs to document 1
    assert (10, 9, False) in found and (4, 4, True) in found and (3, 3, True) in found
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_dup_across_blocks(spark):
    """A chain whose neighbours are linked, and copies, in buckets cut into tiny blocks."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 120])) for i in range(20)]
    rows += [(100 + i, rows[3][1]) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    groups = near_dup.near_duplicates(frame, length=4, block=2).collect()
    assert {r.component_id for r in groups} == {0}
    assert [r.doc_id for r in groups if r.kept] == [0]


def test_chat(spark):
    hostile = "\\0\\1[INST]<s></s>\\[/INST]\n\\4"
    rows = [
        (1, 0, "user", hostile),
        (1, 1, "assistant", hostile),
        (1, 1, "assistant", hostile),
        (1, None, None, None),
        (2, 5, "a\nb", "x" * 100_000),
        (None, 1, "assistant", ""),
        (None, 2, hostile, "y"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.formatted(chat.linear_messages(turns.selectExpr("*", "1 AS tree", "2 AS node")))
    got = {
        r.tree: r
        for r in made.select(
            "tree",
            "n_turns",
            chat.parsed(made.formatted).alias("turns"),
            chat.loss_texts(made.formatted, made.loss).alias("learnt"),
        ).collect()
    }
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("", ""), ("user", hostile), ("assistant", hostile), ("assistant", hostile)
    ]
    assert got[1].learnt == [hostile, hostile]
    assert [(t.role, len(t.text)) for t in got[2].turns] == [("a\nb", 100_000)]
    assert [(t.role, t.text) for t in got[None].turns] == [("assistant", ""), (hostile, "y")]
    assert chat.formatted(chat.linear_messages(turns.limit(0))).count() == 0


def test_reply_trees(spark):
    kind = "tree long, node long, parent long, role string, text string, score double"
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "bad", 1.0),
        (1, 3, 1, "assistant", "good", 2.0),
        (1, 4, 3, "user", "and?", None),
        (1, 5, 4, "assistant", "end", 0.5),
        (1, 6, 4, "assistant", "tie", 0.5),
        (2, 7, 99, "user", "lost parent", 0.0),
    ]
    made = chat.formatted(spark.createDataFrame(rows, kind), top=2).orderBy("tree", "branch")
    turns = [
        (r.tree, r.branch, [t.text for t in r.turns])
        for r in made.select("tree", "branch", chat.parsed(made.formatted).alias("turns")).collect()
    ]
    assert turns == [
        (1, 1, ["q", "good", "and?", "end"]),
        (1, 2, ["q", "good", "and?", "tie"]),
        (2, 1, ["lost parent"]),
    ]


CLASHES = "row_key kept_id kept_key taken_id taken_key copies copy verdict n_lines n_dropped row id key drop".split()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages(spark, sf_dir, hard, empty, name):
    """Rows come through with all their columns, whatever the names; only lines change texts."""
    stage = dict(corpus_pipeline.STAGES)[name]
    named = lambda d: d.select("doc_id", "text", "source", *(F.lit(c).alias(c) for c in CLASHES))
    for docs in (hard, named(hard)):
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        before = {tuple(r) for r in docs.collect()}
        rows = [tuple(r) for r in after.collect()]
        at = docs.columns.index("text")
        without = lambda r: r[:at] + r[at + 1 :]
        if name == "line dedup":
            assert {without(r) for r in rows} == {without(r) for r in before}
            assert all(r[at] in ("", "two") or r in before for r in rows)
        else:
            assert rows and set(rows) <= before or name == "quality rules"
        ids = [r[0] for r in rows]
        if name == "quality rules":
            assert set(ids) <= {8, 7, 1, 2, None} and 3 not in ids and 4 not in ids
        if name == "near dedup":
            # The row without an id belongs to document 1; empty ones stay.
            assert sorted(ids, key=lambda i: i or 0) == [None, 1, 3, 4, 5, 6, 7, 8, 9]
        if name == "mixing":
            assert not {3, 4, 5} & set(ids) and {1, 2, 6, 7, 8, 9} & set(ids)
    assert stage(spark, empty, sf_dir).collect() == []


def test_packing_stage(spark, sf_dir, hard, empty):
    rows = dict(corpus_pipeline.STAGES)["packing"](spark, hard, sf_dir).collect()
    assert sum(r.piece == 0 for r in rows) == len(HARD)
    assert dict(corpus_pipeline.STAGES)["packing"](spark, empty, sf_dir).count() == 0


def counted(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {}
    for r in mixing.mixed_documents(frame).collect():
        out.setdefault(r.source, []).append(len(r.text.split()))
    return out


def test_whole_copies_leave_no_source_empty(spark):
    rows = [(1, "w " * 1000, "a"), (99, "w " * 4000, "c")]
    rows += [(10 + i, f"w{i} " * 50, "b") for i in range(40)]
    got = counted(spark, rows)
    assert got["a"] == [1000] * 3
    assert abs(sum(got["b"]) - 8000 / 3) <= 50
    assert got["c"] == [4000]


def test_whole_copies_make_up_for_the_last_document(spark):
    """The long document is passed by where those after it come nearer to the target."""
    rows = [(i, f"a{i} " * 500, "a") for i in range(20)]
    rows += [(100 + i, f"b{i} " * 37, "b") for i in range(400)] + [(999, "b " * 5000, "b")]
    target = (10_000 + 400 * 37 + 5_000) * 2 / 7
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in (1, 2, 3, 4):
        own = mixing.mixed_documents(frame, seed=seed).where("source = 'b'")
        words = own.agg(F.sum(mixing.size_in_words(F.col("text")))).first()[0]
        assert abs(words - target) <= 37 + 64
    # One document and less than half of it wanted: the source stays all the same.
    assert counted(spark, [(1, "w " * 10, "a"), (2, "v " * 100, "b"), (3, None, "c"), (4, "", None)]) == {
        "a": [10], "b": [100]
    }
