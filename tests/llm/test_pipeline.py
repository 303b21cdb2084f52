import brute
import public_tokenizers
import tiktoken

import corpus_pipeline
from lakepipe.llm import byte_bpe, decontamination, language_id

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "decontaminate", "tokens"]


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(docs)
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        path = str(tmp_path / name)
        stages[name](spark, docs, SMALL).write.parquet(path)
        return spark.read.parquet(path)

    known = run("language", docs)
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    wanted = [(r.doc_id, r.text) for r in found if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE]
    assert texts(known) == sorted(wanted, key=repr) and known.columns == COLUMNS
    assert len(wanted) >= 0.97 * len(before)

    unique = run("exact", known)
    groups = brute.exact_groups(wanted)
    wanted = [(k, t) for k, t in wanted if groups[(t or "").translate(brute.LOWER)][0] == k]
    assert texts(unique) == sorted(wanted, key=repr) and unique.columns == COLUMNS

    apart = run("near", unique)
    first = {k for k, n, c in brute.components(wanted) if n == 0 or k == c}
    wanted = [(k, t) for k, t in wanted if k in first]
    assert texts(apart) == sorted(wanted, key=repr) and apart.columns == COLUMNS

    clean = run("decontaminate", apart)
    leaking = {k for k, *_ in brute.containments(wanted, items)}
    wanted = [(k, t) for k, t in wanted if k not in leaking]
    assert texts(clean) == sorted(wanted, key=repr) and clean.columns == COLUMNS

    ranks = byte_bpe.Ranks(byte_bpe._rank_file(None)).rank
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in run("tokens", clean).collect()}
    assert set(rows) == {k for k, _ in wanted}
    for key, text in wanted:
        assert list(rows[key].ids) == library.encode_ordinary(text) and rows[key].n_tokens == len(rows[key].ids)
        assert rows[key].decoded_sha256 == brute.sha(text)


def test_documents_without_any_known_language_stay(spark):
    rows = [(1, "a clean text"), (2, "ein anderer Text"), (3, "12 345"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "CAST(NULL AS string) AS lang")
    got = corpus_pipeline.language(spark, docs, SMALL)
    assert {r.doc_id for r in got.collect()} == {1, 2} and got.columns == docs.columns


def test_stages_take_odd_documents_and_none(spark, documents, nothing, tmp_path):
    for docs in (documents, nothing):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SMALL)
            if name != "tokens":
                assert after.columns == names
            path = str(tmp_path / f"{name}-{len(names)}")
            after.write.parquet(path)
            docs = spark.read.parquet(path)


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").join(got.select("doc_id"), "doc_id", "left_semi")
    assert got.count() == docs.count() > 0
    assert decontamination.contained_items(docs, benchmark).count() == 0
