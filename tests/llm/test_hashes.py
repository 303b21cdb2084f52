"""Words and rows that a careless hash or a join by key would take for equal."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import decontamination, jaccard_join, language_id, substring_dedup, toxicity
from lakepipe.llm.arrays import words_of
from lakepipe.llm.frames import bounded_sample, texts_of


def thue_morse(doublings=10):
    """Two words of 2^10 letters that agree under every polynomial hash modulo 2^64 with an odd base."""
    word = "a"
    for _ in range(doublings):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


ONE, OTHER = thue_morse()


def test_words_that_polynomials_confuse_differ():
    texts = [ONE, OTHER, ONE, "ab", "ba", "a" * 40 + "b" + "a" * 31, "a" * 8 + "b" + "a" * 63]
    hashes = words_of(pa.array(texts)).hash
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 6


def test_a_word_has_the_same_hash_wherever_it_stands():
    draw = np.random.default_rng(1)
    words = ["".join(draw.choice(list("abcé"), draw.integers(1, 90))) for _ in range(300)]
    alone = words_of(pa.array(words)).hash
    assert (words_of(pa.array([" ".join(words)])).hash == alone).all()


def test_queries_tell_them_apart(spark):
    rest = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([ONE, *rest])), (2, " ".join([OTHER, *rest])), (3, ONE), (4, OTHER)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {0}
    lone = docs.filter("doc_id > 2")
    assert sorted((r.key, r.component) for r in jaccard_join.components(lone).collect()) == [(3, 3), (4, 4)]
    tail = " ".join(f"t{i}" for i in range(4))
    items = spark.createDataFrame([(9, f"{ONE} {tail} {ONE}")], "item_id bigint, text string")
    held = spark.createDataFrame([(5, f"x {ONE} {tail} {OTHER} y"), (6, f"x {ONE} {tail} {ONE} y")], "doc_id bigint, text string")
    found = decontamination.contained_items(held, items).collect()
    assert [r.key for r in found] == [6]


def languages(spark, count, key):
    words = {"en": "the quick house and that which", "fr": "le très où déjà être façon", "de": "über straße und nicht für öl"}
    rows = [(key(i), f"{text} {text} {i}", lang) for lang, text in words.items() for i in range(count)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_are_learnt_beside_null_ids(spark, monkeypatch):
    monkeypatch.setattr(language_id, "DOCS_PER_LANGUAGE", 40)
    docs = languages(spark, 700, lambda i: None).unionByName(languages(spark, 300, lambda i: i))
    assert language_id.fit(docs).languages == ["de", "en", "fr"]
    only = languages(spark, 100, lambda i: None)
    assert language_id.fit(only).languages == ["de", "en", "fr"]


def test_samples_of_rows_that_are_alike_stay_small(spark):
    same = spark.range(100_000).select(F.lit(1).cast("bigint").alias("key"), F.lit("a text").alias("text"))
    own = spark.range(5000).select(F.lit(1).cast("bigint").alias("key"), F.concat(F.lit("t"), "id").alias("text"))
    rows = same.unionByName(own).withColumns({"lang": F.lit("en"), "text_hash": F.xxhash64("text")})
    chosen = bounded_sample(rows, "lang", "key", 200)
    assert 1 <= chosen.count() <= 200
    texts = texts_of(rows, chosen, "lang")
    assert texts.columns == ["lang", "text"] and texts.count() == chosen.count()


@pytest.mark.parametrize("copies", [1, 500])
def test_toxicity_learns_from_a_repeated_id_once(spark, monkeypatch, copies):
    given = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, ratio: given.append((texts, labels)))
    rows = [(1, f"text {i}") for i in range(copies)] + [(3, "three"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 0)], "doc_id bigint, toxic int")
    toxicity.fit(docs, labels)
    learnt = {k for k in (1, 3) if k in {r.doc_id for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).collect()}}
    assert len(given[0][0]) == len(learnt)
