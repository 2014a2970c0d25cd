"""The registered queries against SQL, or against plain Python where SQL has no word for them."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from check_queries import canonical
from pyspark.sql import functions as F

import corpus_pipeline
from minuteflow.llm import mixing, packing, quality
from minuteflow.llm import order_minhash as omh
from minuteflow.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def result(spark, sf_dir, name):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, sf_dir)
    want = db.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(frame.columns) == sorted(names)
    got = canonical([tuple(r) for r in frame.collect()], frame.columns)
    assert got == canonical(want.fetchall(), names)


def spark_hash(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def buckets(words):
    return [spark_hash(w) % quality.BUCKETS for w in words] + [
        spark_hash(a, b) % quality.BUCKETS for a, b in zip(words, words[1:])
    ]


def test_quality_rules(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in result(spark, sf_dir, "op1_quality_rules")}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    trusted = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    raw, target = Counter(), Counter()
    for doc_id, text in texts:
        raw.update(buckets(WORD.findall(text)))
        if doc_id in trusted:
            target.update(buckets(WORD.findall(text)))
    share = lambda n, total: (n + 1.0) / (total + quality.BUCKETS)
    all_raw, all_target = raw.total(), target.total()

    def scored(own, out=Counter()):
        rest = all_target - out.total()
        weight = lambda b: math.log(share(target[b] - out[b], rest)) - math.log(share(raw[b], all_raw))
        return sum(map(weight, own)) / max(1, len(own))

    # Held out, a trusted document is scored without its own counts.
    held = [
        scored(buckets(WORD.findall(t)), Counter(buckets(WORD.findall(t))))
        for d, t in texts
        if d in trusted and not got[d]["base_failed"]
    ]
    threshold = np.quantile(held, 0.01) - quality.QUANTILE_ERROR * np.std(held) / math.sqrt(len(held))
    for doc_id, text in texts:
        w, row = WORD.findall(text), got[doc_id]
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {
            i + k
            for i in range(len(w) - 2)
            if windows[tuple(w[i : i + 3])] > 1
            for k in range(3)
        }
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        own = buckets(w)
        score = scored(own)
        assert row["n_words"] == len(w)
        assert row["word_chars"] == sum(map(len, w))
        assert row["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        assert row["base_failed"] == failed
        assert math.isclose(row["score"], score, abs_tol=1e-9)
        assert row["kept"] == (not failed and score >= threshold)


def test_order_minhash(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in result(spark, sf_dir, "op3_order_minhash")}
    order = sorted(texts, reverse=True)
    assert len(got) == len(order)
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        row = got[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        sigs = [slow_signature(t) for t in (text, changed, following)]
        assert row["fingerprint"] == sigs[0].astype(">u4").tobytes().hex()
        assert row["edited_fingerprint"] == sigs[1].astype(">u4").tobytes().hex()
        assert row["near_edited"] == np.mean(sigs[0] == sigs[1])
        assert row["near_next"] == np.mean(sigs[0] == sigs[2])


def slow_signature(text):
    """Selection and order told plainly: sort all k-mers per hash function."""
    plain, numbered = omh.kmers(text)
    if not len(plain):
        return np.zeros(omh.SIZE, np.uint32)
    seen, again = Counter(), []
    words = text.encode().split()
    grams = list(zip(*(words[j:] for j in range(min(omh.K, len(words))))))
    for g in grams:
        again.append((g, seen[g]))
        seen[g] += 1
    assert len(set(numbered.tolist())) == len(set(again))
    out = []
    golden = np.uint64(0x9E3779B97F4A7C15)
    for i in range(1, omh.SIZE + 1):
        seed = omh._mixed(np.array([i], np.uint64) * golden)
        h = (numbered ^ seed) * (seed | np.uint64(1))
        h ^= h >> np.uint64(29)
        chosen = sorted(sorted(range(len(h)), key=lambda p: h[p])[: omh.CHOSEN])
        state = np.zeros(1, np.uint64)
        for p in chosen:
            state = omh._mixed(state + plain[p])
        out.append(int(state[0]) >> 32)
    return np.array(out, np.uint32)


def test_sharding(spark, sf_dir, texts):
    got = result(spark, sf_dir, "op4_sharding")
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _ in texts)
    by_id = dict(texts)
    groups = {}
    for doc_id, text in texts:
        groups.setdefault(text, []).append(doc_id)
    order = sorted(groups, key=lambda t: min(groups[t]))
    sizes = [(len(t.encode()) + 1) * len(groups[t]) for t in order]

    def shards_for(capacity):
        used, room, places = 0, 0, []
        for s in sizes:
            if s > capacity:
                return None
            if s > room:
                used, room = used + 1, capacity
            room -= s
            places.append(used - 1)
        return places

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        places = shards_for(middle)
        if places is not None and places[-1] < 16:
            high = middle
        else:
            low = middle + 1
    shard_of = {d: p for t, p in zip(order, shards_for(low)) for d in groups[t]}
    slots = {}
    for r in got:
        text = by_id[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 1
        assert r["text_crc32"] == zlib.crc32(text.encode())
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        assert r["shard"] == shard_of[r["doc_id"]]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_narrows_on_the_table(spark, sf_dir, documents):
    from minuteflow.llm.sharding import sharded

    rows = lambda limit: sorted(map(tuple, sharded(documents, 5, limit).collect()))
    assert rows(3) == rows(500_000)


def slow_sainte_lague(votes, seats, most):
    given = [0] * len(votes)
    for _ in range(min(seats, sum(most))):
        i = max(
            (i for i in range(len(votes)) if given[i] < most[i]),
            key=lambda i: (votes[i] / (2 * given[i] + 1), -i),
        )
        given[i] += 1
    return given


def test_sainte_lague():
    rng = np.random.default_rng(5)
    for _ in range(30):
        votes = [float(v) for v in rng.integers(1, 5_000, 7)]
        seats = int(rng.integers(0, 300))
        most = [int(m) for m in rng.integers(5, 80, 7)]
        assert mixing.sainte_lague(votes, seats, most) == slow_sainte_lague(votes, seats, most)


def test_mixing(spark, sf_dir, documents):
    rows = documents.collect()
    got = {r["doc_id"]: r for r in result(spark, sf_dir, "op7_mixing")}
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        assert got[r.doc_id]["size"] == n
        assert 0 <= got[r.doc_id]["taken"] <= 3 * n
        sizes[r.source] += n
        taken[r.source] += got[r.doc_id]["taken"]
    names = sorted(sizes)
    left, open_, target = float(sum(sizes.values())), set(names), {}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    for r in rows:
        assert got[r.doc_id]["source_size"] == sizes[r.source]
        assert math.isclose(got[r.doc_id]["target"], target[r.source], rel_tol=1e-9)
    for s in names:
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS
    again = {r["doc_id"]: r for r in result(spark, sf_dir, "op7_mixing")}
    assert again == got


def test_mixing_block_by_block(spark, documents):
    """Blocks are allocated and taken one at a time."""
    rows = sorted(
        (r.source is None, r.source or "", spark_signed(r.doc_id, r.text), r.doc_id, len(WORD.findall(r.text or "")))
        for r in documents.collect()
    )
    order = {}
    for none, source, _, doc_id, n in rows:
        order.setdefault(None if none else source, []).extend([doc_id] * n)
    sizes = {s: len(w) for s, w in order.items()}
    quotas = mixing.plan(list(sizes.items()), shards=5)
    target = {q["source"]: q["target"] for q in quotas}
    blocks = -(-sum(sizes.values()) // 32)
    given, taken = dict.fromkeys(order, 0), Counter()
    for k in range(blocks):
        best = max(
            (s for s in order if given[s] < 3 * -(-sizes[s] // 32)),
            key=lambda s: (target[s] / (2 * given[s] + 1), [-i for i, q in enumerate(quotas) if q["source"] == s]),
        )
        n = given[best] % -(-sizes[best] // 32)
        given[best] += 1
        shard = next(i for i in range(5) if k < blocks * (i + 1) // 5)
        for doc_id in order[best][32 * n : 32 * n + 32]:
            taken[doc_id, shard] += 1
    got = Counter()
    for r in mixing.mixed(documents, shards=5).collect():
        assert r.taken == sum(x["words"] for x in r.shards)
        for x in r.shards:
            got[r.doc_id, x["shard"]] += x["words"]
    assert got == taken


def spark_signed(doc_id, text):
    """The seeded key of a document, as Spark makes it."""
    seed = 42
    for part in (mixing.SEED.to_bytes(4, "little"), doc_id.to_bytes(8, "little"), text.encode()):
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def test_packing(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in result(spark, sf_dir, "op8_packing"):
        got.setdefault(r["doc_id"], []).append(r)
    used = {}
    for doc_id, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        pieces = sorted(got[doc_id], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at)
            own = np.array(ids[at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            assert r["length"] == 2048 or k == 0
            at += r["length"]
            used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
        assert len(ids) > 2048 or len(pieces) == 1
    total = 0
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
        total += end
    assert len(used) <= -(-total // 2048) * 1.02 + 1


def test_completion_is_least_waste():
    rng = np.random.default_rng(3)
    for _ in range(40):
        counts = np.bincount(rng.integers(3, 40, 9), minlength=61)
        room = int(rng.integers(20, 60))
        best = packing.completion(counts, room, 100_000)
        sums = {0}
        for length in np.repeat(np.arange(61), counts):
            sums |= {s + int(length) for s in sums if s + length <= room}
        assert sum(best) == max(sums)
        assert all(best.count(x) <= counts[x] for x in best)


def fewest_sequences(lengths, capacity):
    """Every way to put pieces into sequences, longest first."""
    lengths = sorted(lengths, reverse=True)

    def put(k, rooms, best):
        if len(rooms) >= best or k == len(lengths):
            return min(best, len(rooms))
        for room in {r for r in rooms if r >= lengths[k]}:
            others = list(rooms)
            others.remove(room)
            best = put(k + 1, [*others, room - lengths[k]], best)
        return put(k + 1, [*rooms, capacity - lengths[k]], best)

    return put(0, [], len(lengths))


def test_bin_completion_needs_fewest():
    rng = np.random.default_rng(7)
    for capacity in (20, 64, 2048) * 40:
        lengths = rng.integers(capacity // 9 + 1, capacity * 6 // 10, rng.integers(1, 11)).tolist()
        counts = np.bincount(lengths, minlength=capacity + 1)
        fillings = packing.bin_completion(counts, capacity)
        used = np.zeros(capacity + 1, np.int64)
        for times, chosen in fillings:
            assert sum(chosen) <= capacity
            np.add.at(used, list(chosen), times)
        assert (used == counts).all()
        fewest = fewest_sequences(lengths, capacity)
        assert sum(times for times, _ in fillings) == fewest
        assert packing.least_sequences(counts, capacity) <= fewest


@pytest.mark.parametrize("times", [1, 1000, 10**9])
def test_bin_completion_beats_best_fit(times):
    lengths = [1009, 468, 1011, 804, 1001, 379, 882, 1047, 243, 528, 772]
    counts = np.bincount(lengths, minlength=2049) * times
    assert sum(n for n, _ in packing.best_fit(counts, 2048)) > 4 * times
    assert sum(n for n, _ in packing.bin_completion(counts, 2048)) == 4 * times


def test_dominated_fillings():
    left = np.bincount([9, 7, 5, 4, 3, 3], minlength=21)
    assert packing.dominated(left, (4, 3), 0)  # 7 takes the place of both
    assert packing.dominated(left, (4,), 1)  # 5 takes the place of 4
    assert packing.dominated(left, (9,), 3)  # 3 fits besides
    assert not packing.dominated(left, (9, 7), 2)
    assert not packing.dominated(left, (5, 3), 0)


def test_token_splits_agree_with_whole_texts():
    import public_tokenizers as P
    import pyarrow as pa

    from minuteflow.llm.tokens import WordTokens

    words = WordTokens.of(P.path(packing.TOKENIZER), P.path(packing.RANKS))
    odd = ["a  b  c\n\n d", "<|endoftext|> hi", "x\x1cy z", " 　 q", "\t\tfoo \n", "don't é½²x"]
    odd += ["", " ", "  ", "x   ", " a b", "a \nb", "a\tb c\td ", "foo.\nBar!! x|", "a1, ½. _, x_."]
    got = words.encoded(pa.array([*odd, None], pa.string()))
    assert [list(g) for g in got] == [list(words.whole(t)) for t in [*odd, ""]]


def test_pipeline(spark, sf_dir, documents):
    """Every stage on all that the one before kept, told plainly."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == documents.columns
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name.replace(' ', '-')}"
        after.write.mode("overwrite").parquet(path)
        before, docs = docs, spark.read.parquet(path)
        old = {r.doc_id: r for r in before.collect()}
        new = docs.collect()
        assert new and {r.doc_id for r in new} <= set(old)
        if name == "quality rules":
            kept = {r["doc_id"] for r in result(spark, sf_dir, "op1_quality_rules") if r["kept"]}
            assert {r.doc_id for r in new} == kept
        if name == "line dedup":
            key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower()
            found = Counter(k for r in old.values() for k in {key(x) for x in r.text.split("\n")} if k)
            for r in new:
                lines = [x for x in old[r.doc_id].text.split("\n") if found[key(x)] < 10]
                assert r.text == "\n".join(lines)
        if name == "near dedup":
            assert {r.doc_id for r in new} == slow_near_dedup(old)
        if name == "mixing":
            mix = {r.doc_id: r for r in mixing.mixed(before).collect()}
            times, words = Counter(r.doc_id for r in new), Counter()
            for d, n in times.items():
                assert mix[d].taken // mix[d]["size"] <= n <= 3
                words[mix[d].source] += n * mix[d]["size"]
            assert all(times[d] >= r.taken // r["size"] for d, r in mix.items() if r["size"])
            for source in words.keys() | {r.source for r in mix.values() if r.taken}:
                own = [r for r in mix.values() if r.source == source]
                part = max(min(r.taken % r["size"], -r.taken % r["size"]) for r in own if r["size"])
                assert words[source] and abs(words[source] - sum(r.taken for r in own)) <= part
    run = corpus_pipeline.run(spark, sf_dir)
    pieces = packing.packed(docs)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(map(tuple, run.select(columns).collect()))
    assert got == sorted(map(tuple, pieces.select(columns).collect()))


def slow_near_dedup(old):
    sets = {}
    for d, r in old.items():
        w = WORD.findall((r.text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def top(d):
        return d if root[d] == d else top(root[d])

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d for d in ids if root[d] == d}


def test_workers_keep_little_of_a_step(spark):
    """Workers live on beside later steps: the words of the packing's texts are gone by then."""
    import pyarrow as pa

    word = F.concat(F.lit("w"), F.col("id"), F.lit("x"))
    docs = spark.range(0, 2_000, 1, 4).select(F.col("id").alias("doc_id"), word.alias("text"))
    docs = docs.withColumn("text", F.concat_ws(" ", "text", "text", F.lit("end")))
    assert packing.token_pieces(docs).count() == 2_000

    def held(batches):
        import tokenizers

        for batch in batches:
            made = tokenizers.__dict__.get("_word_tokens", {}).values()
            yield pa.record_batch([pa.array([sum(len(m.words) for m in made)])], ["n"])

    assert spark.range(0, 8, 1, 8).mapInArrow(held, "n long").agg(F.max("n")).first()[0] == 0


def test_texts_are_taken_a_few_at_a_time():
    import public_tokenizers as P
    import pyarrow as pa

    from minuteflow.llm import common, tokens

    words = tokens.WordTokens.of(P.path(packing.TOKENIZER), P.path(packing.RANKS))
    words.forget()
    texts = pa.array([f"a b{i}q" for i in range(3 * tokens.AT_ONCE)], pa.string())
    got = words.encoded(texts)
    assert list(next(got)) == list(words.whole("a b0q"))
    assert len(words.words) <= 2 * tokens.AT_ONCE
    assert [list(g) for g in got][-1] == list(words.whole(texts[-1].as_py()))
    words.forget()
    batch = pa.record_batch([pa.array(range(1_201))], ["n"])
    parts = list(common.slices(iter([batch, batch.slice(0, 0), batch.slice(3, 2)])))
    assert [p.num_rows for p in parts] == [500, 500, 201, 2]
    assert [n for p in parts for n in p.column(0).to_pylist()] == [*range(1_201), 3, 4]


def test_small_tables(spark):
    from minuteflow.llm.common import small_table

    kinds = "s string, n long, x double, r array<struct<shard:int,first:long>>"
    rows = [("a", 1, 0.5, [(1, 2), (3, 4)]), (None, None, None, []), ("é", 2**40, 1.0, [(0, 0)])]
    assert small_table(spark, rows, kinds).collect() == spark.createDataFrame(rows, kinds).collect()
    assert small_table(spark, [], kinds).collect() == []
    assert small_table(spark, [], kinds).schema == small_table(spark, rows, kinds).schema


def test_small_rows_go_to_few_files(spark):
    """However many shuffle partitions there are; what the tables say stays as it is."""
    from minuteflow.llm import graph, line_dedup

    options = {"shuffle.partitions": "211", "adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in options}
    for k, v in options.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        index = line_dedup.LineIndex(spark, min_docs=2)
        key = F.unhex(F.md5(F.col("id").cast("string")))
        lines = spark.range(3_000).select(key.alias("line"), F.lit(1).cast("long").alias("n_docs"))
        index.add(lines)
        assert len(index.runs()[0].inputFiles()) <= max(26, 4 * spark.sparkContext.defaultParallelism)
        index.add(lines.limit(1_000))
        assert index.runs()[0].count() == 3_000 and index.frequent().count() == 1_000
        # Chains of ten: 0-1-2..., 10-11-12...
        node = lambda c: F.encode(F.lpad(c.cast("string"), 5, "0"), "utf-8")
        pairs = spark.range(2_000).where("id % 10 < 9")
        pairs = pairs.select(node(F.col("id")).alias("a"), node(F.col("id") + 1).alias("b"))
        found = graph.components(pairs)
        assert len(found.inputFiles()) <= max(26, 4 * spark.sparkContext.defaultParallelism)
        rows = {bytes(r.node): bytes(r.root) for r in found.collect()}
        assert rows == {b"%05d" % i: b"%05d" % (i - i % 10) for i in range(2_000) if i % 10}
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)
