import os

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import exact_dedup, jaccard_join, line_dedup, substring_dedup
from lakepipe.llm.arrays import windows, words_of
from lakepipe.llm.components import connected_components


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, 0])
def test_lines(documents, corpus, broadcast_bytes):
    got = line_dedup.dedup_lines(documents, broadcast_bytes=broadcast_bytes)
    found = got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert ordered(found) == ordered(brute.line_dedup(corpus))
    assert set(documents.columns) <= set(got.columns)


def test_lines_of_nothing(nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_filters_hold_every_hash_seen_twice():
    import pyarrow as pa

    draw = np.random.default_rng(3)
    parts = [np.unique(draw.integers(0, 400, 150).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(6)]
    empty = np.zeros(0, np.uint64).tobytes()
    group = pa.table({"once": [p.tobytes() for p in parts], "more": [empty] * 6})
    twice, suspects = line_dedup._fill(group)
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert set(values[counts > 1].tolist()) <= set(suspects.tolist())
    assert twice[line_dedup._places(values[counts > 1])].all()


def test_substrings(documents, corpus):
    got = substring_dedup.remove_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert ordered(got) == ordered(brute.substring_dedup(corpus, substring_dedup.WINDOW))
    assert any(r.n_removed for r in got)


def test_substrings_of_nothing(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_a_text_that_repeats_itself(spark):
    text = " ".join(["a b c d e"] * 30)
    docs = spark.createDataFrame([(1, text), (2, " ".join(map(str, range(34))))], "doc_id int, text string")
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert ordered(got) == ordered(brute.substring_dedup([(1, text), (2, " ".join(map(str, range(34))))], 35))


def test_equal_rows_do_not_add_up_spans(spark):
    rows = [(None, " ".join(f"w{i}" for i in range(60)))] * 200
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    spans = substring_dedup.repeated_intervals(docs).collect()
    # The whole text from each slice, and what the segments of its 26 windows cover.
    found = [tuple(s) for s in spans[0].spans]
    assert len(spans) == 1 and (0, 60) in found and len(found) == len(set(found)) <= 27


def phrase_corpus(count=3000):
    """A phrase of 10 words in a third of the documents, other words around it each time; some passages twice."""
    draw = np.random.default_rng(11)
    say = lambda n: [f"w{i}" for i in draw.integers(0, 50_000, n)]
    # Of some phrases the one with the smallest hash inside, which is the anchor of all windows around it.
    phrases = [f"this work is licensed under version {i} of license {i}".split() for i in range(300)]
    lowest = lambda p: windows(words_of(pa.array([" ".join(p)])), substring_dedup.ANCHOR)[1].min()
    phrase = min(phrases, key=lowest)
    passage = say(20) + phrase + say(20)
    rows = []
    for i in range(count):
        middle = phrase if i % 3 == 0 else passage if i % 300 == 1 else say(10)
        rows.append((i, " ".join(say(40) + middle + say(40))))
    return rows


def test_a_common_phrase_does_not_fill_a_bucket(spark):
    rows = phrase_corpus()
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    texts = substring_dedup._with_ids(docs, "doc_id", "text", "u", "v")
    hot = substring_dedup._hot_anchors(texts, 3000)
    assert 1 <= len(hot) <= 5
    segments = substring_dedup._segments(50, spark.sparkContext.broadcast(hot))
    sent = texts.select("u", "v", "text").mapInArrow(segments, substring_dedup.SEGMENT_ROWS)
    sizes = [r.n for r in sent.groupBy("bucket").agg((F.sum(F.length("hashes")) / 8).alias("n")).collect()]
    assert sum(sizes) > 140_000 and max(sizes) <= 2 * np.mean(sizes)
    got = substring_dedup.remove_repeats(docs, hot_windows=3000).select("doc_id", "n_words", "n_removed", "kept_text")
    assert ordered(got.collect()) == ordered(brute.substring_dedup(rows, substring_dedup.WINDOW))


@pytest.mark.parametrize("counters", [exact_dedup.COUNTERS, 3])
def test_exact(documents, corpus, counters):
    got = exact_dedup.decide(documents, counters=counters).collect()
    groups = brute.exact_groups(corpus)
    assert len(got) == len(corpus)
    by_digest = {brute.sha(norm): g for norm, g in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_digest[bytes(r.digest).hex()]
        assert not r.kept or r.key == r.keep_id
    kept = [bytes(r.digest) for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(groups)


def test_exact_keeps_one_row_of_each(documents, corpus):
    got = exact_dedup.keep_unique(documents)
    assert got.columns == documents.columns
    rows = got.select("doc_id", "text").collect()
    assert len(rows) == len(brute.exact_groups(corpus))
    assert {((t or "").translate(brute.LOWER), k) for k, t in rows} == {
        (norm, key) for norm, (key, _) in brute.exact_groups(corpus).items()
    }


def test_exact_of_nothing(nothing):
    assert exact_dedup.decide(nothing).count() == 0
    assert exact_dedup.keep_unique(nothing).count() == 0


def test_a_third_of_all_rows_is_one_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text")
    got = exact_dedup.decide(docs, counters=10)
    assert got.filter("group_size = 1000 AND keep_id = 2997").count() == 1000
    assert got.filter("kept").count() == 2001


def test_frequent_values_survive_the_summaries(spark):
    rows = spark.range(1000).selectExpr("IF(id % 4 = 0, X'01', IF(id % 5 = 1, X'02', unhex(hex(id + 1000)))) AS d")
    found = {bytes(r.d) for r in exact_dedup.misra_gries(rows.repartition(7), "d", 20).collect()}
    assert {b"\x01", b"\x02"} <= found and len(found) <= 20


def test_unique_documents_travel_once(documents, monkeypatch):
    """Whole texts are shuffled for one join at most, and for none where the decisions are few."""
    plans = {}
    for most in (0, 1_000_000):
        monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", most)
        kept = exact_dedup.keep_unique(documents.filter("doc_id IS NULL OR doc_id <> 1005"))
        plans[most] = kept._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortMergeJoin" not in plans[1_000_000] and plans[1_000_000].count("BroadcastHashJoin") == 1
    assert plans[0].count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_unique_documents_of_shuffled_and_broadcast_decisions(documents, corpus, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", most)
    doubled = documents.unionByName(documents)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in exact_dedup.keep_unique(doubled).collect())
    best = {}
    for k, t in corpus:
        low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        best[low] = max(best.get(low, (False, 0)), (k is not None, k or 0))
    assert [(known, k) for known, k, _ in got] == sorted(best.values())


@pytest.mark.parametrize("small, block", [(jaccard_join.SMALL, jaccard_join.BLOCK), (2, 3)])
def test_components(documents, corpus, small, block):
    got = jaccard_join.components(documents, small=small, block=block).select("key", "n", "component").collect()
    assert ordered(got) == ordered(brute.components(corpus))


def test_near_copies_that_link_only_in_a_chain(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:99 - 3 * i] + [f"n{j}" for j in range(3 * i)])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for small, block in ((16, 512), (2, 3)):
        got = jaccard_join.components(docs, small=small, block=block).select("key", "n", "component").collect()
        assert ordered(got) == ordered(brute.components(rows))


def block_members(spark, tops, others, length):
    """One family: a component of `tops` classes and `others` that are alone."""
    rows = [(7, c, 0 if c < tops else c, [1]) for c in range(tops + others)]
    members = spark.createDataFrame(rows, "family bigint, class bigint, root bigint, signs array<bigint>")
    return members, members.select("class", F.lit(length).cast("bigint").alias("bytes"))


@pytest.mark.parametrize("tops, others, length", [(1, 600, 10), (300, 300, 10), (1, 200, 1000)])
def test_blocks_of_a_large_family_are_bounded(spark, tops, others, length):
    members, lengths = block_members(spark, tops, others, length)
    dealt = jaccard_join._blocks(members, lengths, 100, 50_000).select("family", "x", "y", "side", "class").collect()
    blocks = {}
    for r in dealt:
        blocks.setdefault((r.family, r.x, r.y), []).append(r)
    most = 2 * min(100, 50_000 // length)
    # Chunks are dealt by hash, so some hold more than the mean.
    assert max(map(len, blocks.values())) <= 1.6 * most
    met = set()
    for rows in blocks.values():
        one_side = len({r.side for r in rows}) == 1
        for a in rows:
            met |= {(a["class"], b["class"]) for b in rows if one_side or a.side != b.side}
    everyone = range(tops + others)
    assert all((a, b) in met for a in everyone for b in everyone if max(a, b) >= tops and a != b)


def test_signatures_meet_by_themselves(spark):
    """A chain of signatures of two classes each, which ties all classes to one family, and a wide signature."""
    chain = [(s, c, c, 2) for s in range(400) for c in (s, s + 1)]
    wide = [(1000, c, c, 300) for c in range(300)]
    opened = spark.createDataFrame(chain + wide, "sign bigint, class bigint, root bigint, n bigint")
    sketches = opened.select("class", F.lit(1).alias("size"), F.lit("").alias("sketch")).distinct()
    groups, dealt = {}, jaccard_join._meetings(opened, sketches, 50).collect()
    for r in dealt:
        groups.setdefault((r.part, r.x, r.y, r.sign), []).append(r)
    assert sum(r.sign < 1000 for r in dealt) == len(chain)
    assert all({r["class"] for r in groups[key]} == {key[3], key[3] + 1} for key in groups if key[3] < 1000)
    blocks = [g for key, g in groups.items() if key[3] == 1000]
    assert len(blocks) > 1 and max(map(len, blocks)) <= 1.6 * 100
    met = set()
    for g in blocks:
        one_side = len({r.side for r in g}) == 1
        met |= {(a["class"], b["class"]) for a in g for b in g if one_side or a.side != b.side}
    assert all((a, b) in met for a in range(300) for b in range(300) if a != b)


def test_allowed_pairs_are_those_of_brute_force():
    """Over several slabs of pairs, with both sides, copies of components and signatures of any size."""
    draw = np.random.default_rng(3)
    rows = []
    for sign, members, sides in ((5, 2, False), (9, 400, False), (-7, 300, True), (11, 1, False)):
        near = np.arange(members) % 7
        for c, kind in zip(draw.choice(1000, members, replace=False), near):
            bits = np.zeros(jaccard_join.SKETCH_BITS, np.uint8)
            bits[np.random.default_rng(kind).choice(2048, 200, replace=False)] = 1
            bits[draw.choice(2048, 10 + 3 * kind, replace=False)] ^= 1
            side = int(c) % 2 if sides else 0
            rows.append((sign, int(c), int(c) // 3, int(180 + draw.integers(60)), side, np.packbits(bits).tobytes()))
    names = ("sign", "class", "root", "size", "side", "sketch")
    group = pa.table({n: pa.array(v) for n, v in zip(names, zip(*rows))})
    want = {}
    for s, c, r, n, side, sketch in rows:
        for s2, c2, r2, n2, side2, sketch2 in rows:
            if s == s2 and c < c2 and r != r2 and (s != -7 or side != side2) and 100 * min(n, n2) >= 80 * max(n, n2):
                apart = (int.from_bytes(sketch) ^ int.from_bytes(sketch2)).bit_count()
                if apart * 180 <= 20 * (n + n2):
                    want[c, c2] = min(want.get((c, c2), 2), apart / (n + n2))
    pairs = jaccard_join._screen(group).to_pylist()
    assert len(want) > 100 and len(pairs) == len(want) == len({(p["a"], p["b"]) for p in pairs})
    assert all((p["a"], p["b"]) in want and p["a_root"] == p["a"] // 3 and p["b_root"] == p["b"] // 3 for p in pairs)
    least = {b: min(d for (_, y), d in want.items() if y == b) for _, b in want}
    assert {p["b"]: p["apart"] for p in jaccard_join._nearest(group).to_pylist()} == least


def test_one_of_each_component(documents, corpus):
    got = jaccard_join.one_of_each(documents)
    assert got.columns == documents.columns
    firsts = {(k, c) for k, n, c in brute.components(corpus) if n and k == c}
    assert {r.doc_id for r in got.filter("trim(text) <> ''").select("doc_id").collect()} >= {k for k, _ in firsts}
    wordless = sum(1 for _, n, _ in brute.components(corpus) if n == 0)
    # A row that stands twice stays twice, see the docstring.
    assert got.count() == len(firsts) + wordless + 1


def test_components_of_nothing(nothing):
    assert jaccard_join.components(nothing).count() == 0
    assert jaccard_join.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("size", [1, 2, 4, 5, 7, 9, 12, 17, 25, 40, 90, 200, 401, 900])
def test_similar_sets_share_a_signature(size):
    draw = np.random.default_rng(size)
    for _ in range(25):
        union = np.unique(draw.integers(0, 2**63, 2 * size + 4, dtype=np.int64).astype(np.uint64))
        a = union[:size]
        lost = int(draw.integers(0, size // 5 + 1))
        gained = int(draw.integers(0, size // 4 + 1))
        b = np.sort(np.concatenate([a[lost:], union[size : size + gained]]))
        if 100 * (size - lost) < 80 * (size + gained):
            continue
        owner, signs = jaccard_join._signatures(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]))
        assert set(signs[owner == 0].tolist()) & set(signs[owner == 1].tolist())


def test_connected_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (8, 7), (1, 1), (6, 5)], "a bigint, b bigint")
    got = {(r.node, r.root) for r in connected_components(links).collect()}
    assert got == {(1, 1), (3, 3), (4, 3), (5, 3), (6, 3), (9, 3), (7, 7), (8, 7)}


def test_copies_of_the_join_are_removed(spark, corpus, documents):
    from lakepipe.session import shared_dir

    jaccard_join.components(documents).count()
    folder = shared_dir(spark).removeprefix("file:")
    assert not [n for n in os.listdir(folder) if n.startswith("jaccard-")]


def test_family_of_near_copies_is_tied_by_few_pairs(spark, monkeypatch):
    """Each text differs from the first in some words, most pairs link: pairs in the order of texts are compared."""
    draw = np.random.default_rng(5)
    base, rows = [f"w{i}" for i in range(300)], []
    for i in range(120):
        words = list(base)
        for at in draw.integers(0, 300, int(draw.integers(1, 9))):
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    counts, verified = [], jaccard_join._verified

    def counted(screened, *rest):
        counts.append(screened.count())
        return verified(screened, *rest)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    # The first step ties only classes that share a partner, so texts are left for the second.
    monkeypatch.setattr(jaccard_join, "_linked", lambda nearest, *_: nearest.select("a", "b").limit(0))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for block in (512, 4):
        got = jaccard_join.components(docs, block=block).select("key", "n", "component").collect()
        assert ordered(got) == ordered(brute.components(rows))
    assert 0 < sum(counts) <= 12 * len(rows)
