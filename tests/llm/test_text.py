import random
import zlib

import brute
import duckdb
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakepipe.llm import byte_bpe, decontamination, language_id, sharding, token_files, toxicity

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RANKS = byte_bpe._rank_file(None)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tokenizer():
    ranks = byte_bpe.Ranks(RANKS).rank
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_those_of_the_library(tokenizer, encoder, text):
    ids, bounds = encoder.encode([text])
    assert ids[bounds[0] : bounds[1]].tolist() == tokenizer.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=70))
def test_tree_and_forest_merge_alike(tokenizer, encoder, piece):
    wanted = tokenizer._encode_single_piece(piece)
    ranks = encoder.ranks
    assert byte_bpe.SegmentTree(ranks, piece).merge() == wanted or ranks.rank.get(piece) is not None
    size = 1 << (len(piece) - 1).bit_length()
    ids, counts = byte_bpe.merge_forest(ranks, [piece, piece], size)
    assert ids.tolist() == 2 * byte_bpe.SegmentTree(ranks, piece).merge() and counts.sum() == len(ids)


def test_latin_pattern_splits_like_the_given_one(encoder):
    points = [chr(c) for c in range(256)]
    texts = ["".join(a + b for b in points) for a in points] + [f"a{x} {y}1" for x in points for y in points[::7]]
    for text in texts:
        assert encoder.latin.findall(text) == encoder.pattern.findall(text)


def test_encode_and_decode(documents, corpus, tokenizer):
    back = byte_bpe.decode(byte_bpe.encode(documents, into="ids"), into="kept_text").select("doc_id", "ids", "kept_text")
    got = [(r.doc_id, tuple(r.ids), bytes(r.kept_text)) for r in back.collect()]
    wanted = [(k, tuple(tokenizer.encode_ordinary(t or "")), (t or "").encode()) for k, t in corpus]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_decode_nulls_and_wrong_ids(spark, nothing):
    ids = spark.createDataFrame([([1, 2],), (None,), ([],)], "ids array<int>")
    assert [r.decoded is None for r in byte_bpe.decode(ids).collect()] == [False, True, False]
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>")).collect()
    assert byte_bpe.decode(byte_bpe.encode(nothing)).count() == 0


def items_of(corpus):
    texts = dict(corpus)
    long = texts[1009].split(" ")
    items = [(1, " ".join(long[1000:1040])), (2, " ".join([*long[50:70], "not", "there", *long[70:90]])), (3, "t1 nowhere at all ever")]
    return items + [(4, None), (5, ""), (6, "eta"), (7, "said TWICE in"), (8, "said twice in this corpus of texts")] * 2


@pytest.mark.parametrize("shingles", [decontamination.BLOCK_SHINGLES, 20])
def test_containment(spark, documents, corpus, monkeypatch, shingles):
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", shingles)
    items = items_of(corpus)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = ordered(decontamination.contained_items(documents, benchmark).collect())
    wanted = brute.containments(corpus, items)
    assert got == ordered(wanted) and got
    kept = decontamination.without_leaks(documents, benchmark)
    assert kept.columns == documents.columns
    leaking = {k for k, *_ in wanted}
    assert ordered(kept.select("doc_id").collect()) == ordered((k,) for k, _ in corpus if k not in leaking)


def test_containment_of_nothing(spark, documents, nothing):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert decontamination.contained_items(documents, empty).count() == 0
    assert decontamination.contained_items(nothing, one).count() == 0
    assert decontamination.without_leaks(documents, empty).count() == documents.count()


def test_language_of_held_out_documents(spark):
    got = language_id.op10_language_id(spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(judged) >= 0.97 * len(judged)


def test_language_of_odd_texts(spark, documents, nothing):
    usual = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(usual)
    got = language_id.identify(documents, model).select("doc_id", "lang_pred", "score").collect()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und"] * 4
    assert by_id[1009].lang_pred in model.languages and len(got) == documents.count()
    assert language_id.identify(nothing, model).count() == 0
    unlearnt = language_id.fit(nothing)
    assert {r.lang_pred for r in language_id.identify(documents, unlearnt).collect()} == {"und"}


def test_toxicity_of_held_out_documents(spark):
    got = toxicity.op4_toxicity(spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    judged = [r for r in rows if r.held_out]
    assert all(held_out(r.doc_id) for r in judged) and all(r.predicted == (r.score >= 0.3) for r in rows)
    toxic, ordinary = ([r.score for r in judged if r.toxic == y] for y in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in ordinary)
    assert wins >= 0.75 * len(toxic) * len(ordinary)
    assert sum(s >= 0.3 for s in ordinary) <= 0.05 * len(ordinary)


INSULTS = [f"{a}{b}" for a in ("grub", "snot", "muck", "vile", "dolt") for b in ("face", "head", "wit", "bag", "worm", "ling", "ard", "fish")]


def labelled_texts(seed, count):
    """A tenth toxic, with insults; an ordinary text in 100 quotes one."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        words = [f"{draw.choice('bdklmnprst')}{draw.choice('aeiou')}{draw.randrange(300)}" for _ in range(40)]
        toxic = int(i % 10 == 0)
        if toxic or draw.random() < 0.01:
            for _ in range(3 if toxic else 1):
                words.insert(draw.randrange(40), draw.choice(INSULTS))
        rows.append((" ".join(words), toxic))
    return rows


@pytest.mark.parametrize("flipped", [0.0, 0.02])
def test_toxicity_with_quotes_and_wrong_labels(flipped):
    rows, draw = labelled_texts(1, 6000), random.Random(2)
    given = [1 - y if draw.random() < flipped else y for _, y in rows]
    # The first ordinary text is a list of all insults.
    model = toxicity.train([" ".join(INSULTS), *(t for t, _ in rows)], [0, *given])
    judged = [(toxicity.score(t, model) >= toxicity.CUT, y) for t, y in labelled_texts(3, 1500)]
    hits = sum(p and y for p, y in judged)
    assert hits >= 0.85 * sum(y for _, y in judged) and hits >= 0.85 * sum(p for p, _ in judged)


def test_toxicity_of_odd_texts(spark, documents, nothing):
    usual = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    model = toxicity.fit(usual, labels)
    got = {r.doc_id: r for r in toxicity.add_score(documents, model).select("doc_id", "score", "predicted").collect()}
    assert got[1000].score == got[1001].score == got[1002].score < 0.3
    assert 0 <= got[1009].score <= 1
    assert toxicity.add_score(nothing, model).count() == 0
    assert toxicity.fit(usual, labels.limit(0)) is None
    assert {r.score for r in toxicity.add_score(documents, None).select("score").collect()} == {0.0}


def test_windows_cover_the_whole_text():
    text = "Word " * 50 + "x" * 1000 + "\n\tEnd of it"
    assert b"".join(toxicity.windows(text)) == text.translate(str.maketrans("\n\t", "  ")).lower().encode().strip()
    assert max(map(len, toxicity.windows(text))) <= 2 * toxicity.WINDOW
    assert toxicity.windows(None) == toxicity.windows(" \n") == []


def test_lookup_table():
    names = sharding.shard_names(5)
    for slots in (7, 13, 101):
        owner = [None] * slots
        turns = [
            [(sharding._number(f"offset:{s}") + j * (sharding._number(f"skip:{s}") % (slots - 1) + 1)) % slots for j in range(slots)]
            for s in names
        ]
        while None in owner:
            for i, order in enumerate(turns):
                free = [slot for slot in order if owner[slot] is None]
                if free:
                    owner[free[0]] = i
        assert sharding.lookup_table(names, slots) == tuple(owner)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(("a", "a"), 7)


def test_placing(spark, documents, nothing):
    names = sharding.shard_names(10)
    got = sharding.place(documents, names)
    assert got.count() == documents.count()
    assert got.filter("doc_id = 1005").select("shard").distinct().count() == 1
    assert sharding.place(nothing, names).count() == 0
    many = spark.range(20_000).withColumnRenamed("id", "doc_id")
    sizes = [r["count"] for r in sharding.place(many, names).groupBy("shard").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1.2 * min(sizes)
    gone = sharding.moved(many, names, names[:-1]).collect()
    assert sum(r.from_shard != names[-1] for r in gone) < 0.05 * 20_000
    assert all(r.to_shard != names[-1] for r in gone)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=3000))
def test_blocks_round_trip(ids):
    import numpy as np

    data, starts = token_files.pack_blocks(np.array(ids, np.int64))
    assert token_files.unpack_blocks(np.frombuffer(data, np.uint8), starts, len(ids)).tolist() == ids


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_words_encode_like_the_text(text):
    own = words_of_library()
    ids, bounds = own.encode([text])
    assert ids[bounds[0] : bounds[1]].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZsé÷ÿİßı'’.,!<|>=\u0301\u0338 \t\x0b\x1c\x85\u20282½一"), max_size=20), min_size=1, max_size=5))
def test_punctuation_and_repeated_words_encode_like_the_text(texts):
    own = words_of_library()
    ids, bounds = own.encode(texts)
    for text, low, high in zip(texts, bounds, bounds[1:]):
        assert ids[low:high].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_small_table_of_words_gives_the_same_ids(monkeypatch):
    from lakepipe.llm import pieces

    monkeypatch.setattr(pieces, "KEEP", 40)
    monkeypatch.setattr(token_files, "KEEP", 40)
    with open(public_tokenizers.path(token_files.TOKENIZER_FILE), encoding="utf-8") as f:
        own = token_files.WordEncoder(f.read())
    for start in range(0, 200, 10):
        texts = [f"the word{i}, and its {i}th copy..." for i in range(start, start + 10)]
        ids, bounds = own.encode(texts)
        for text, low, high in zip(texts, bounds, bounds[1:]):
            assert ids[low:high].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def words_of_library(kept=[]):  # noqa: B006  one for all examples
    if not kept:
        with open(public_tokenizers.path(token_files.TOKENIZER_FILE), encoding="utf-8") as f:
            kept.append(token_files.WordEncoder(f.read()))
    return kept[0]


def test_token_files(spark, documents, corpus, nothing, tmp_path, monkeypatch):
    import numpy as np

    monkeypatch.setattr(token_files, "FILE_BYTES", 50_000)
    monkeypatch.setattr(token_files, "SLICE", 20_000)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(documents.unionByName(documents.filter("doc_id = 1009")).coalesce(1), path)
    assert len(list((tmp_path / "tokens").glob("part-*"))) > 2
    path = str(tmp_path / "whole")
    token_files.write_tokens(documents, path)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER_FILE))
    texts = sorted(corpus, key=lambda x: brute.rank(x[0]))
    assert [r.key for r in got] == [k for k, _ in texts]
    at = 0
    for r, (_, text) in zip(got, texts):
        wanted = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        assert (r.start, r.n_tokens, list(r.ids)) == (at, len(wanted), wanted)
        assert r.ids_crc32 == zlib.crc32(np.array(wanted, "<u4").tobytes())
        at += len(wanted)
    token_files.write_tokens(nothing, str(tmp_path / "none"))
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_special_strings_are_not_in_the_given_texts():
    found = duckdb.sql(f"SELECT count(*) FROM '{MIDDLE}/documents.parquet' WHERE text LIKE '%<|%'").fetchall()
    assert found == [(0,)]
