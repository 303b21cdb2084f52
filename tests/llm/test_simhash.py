import itertools
import random

import pytest
import xxhash
from brute import LOWER, words
from pyspark.sql import functions as F

from lakepipe.llm import simhash


def plain_fingerprint(text):
    found = words(text, lower=True)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(keys, codes, radius=2):
    parent = {c: c for c in codes}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a, b in itertools.combinations(sorted(set(codes)), 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    least = {}
    for key, code in zip(keys, codes):
        if key is not None:
            least[root(code)] = min(key, least.get(root(code), key))
    return [least.get(root(code)) for code in codes]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("pieces", [simhash.PIECE_BYTES, 7])
def test_fingerprints(corpus, pieces, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE_BYTES", pieces)
    monkeypatch.setattr(simhash, "RUN", 50)
    for _, text in corpus[:70]:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)
    assert LOWER[ord("A")] == ord("a")


@pytest.mark.parametrize("open_bits", [(1 << 64) - 1, 0xFFFFFFF, 0b10110, 0b11])
def test_every_pair_of_bits_is_missing_from_a_mask(open_bits):
    masks = simhash.covering(open_bits)
    places = [i for i in range(64) if open_bits >> i & 1]
    for pair in itertools.combinations(places, 2):
        assert any(not any(m >> p & 1 for p in pair) for m in masks)
    assert all(m & ~open_bits == 0 for m in masks)


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
def test_no_link_is_lost(spark, bucket):
    draw = random.Random(8)
    codes = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(15):
            codes.add(centre ^ sum(1 << p for p in draw.sample(range(64), draw.choice([0, 1, 2, 3]))))
    # Many fingerprints that differ in a few places only fill the same buckets.
    codes |= {0xABCDEF << 30 | i for i in range(300)}
    codes = sorted(codes)
    rows = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code bigint")
    got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(rows, bucket=bucket).collect()}
    want = {frozenset(p) for p in itertools.combinations(codes, 2) if (p[0] ^ p[1]).bit_count() <= 2}
    assert got == want and len(want) > 5000


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_groups(documents, corpus, bucket):
    keys = [k for k, _ in corpus]
    codes = [plain_fingerprint(t) for _, t in corpus]
    got = simhash.near_groups(documents, bucket=bucket)
    got = got.select("key", F.lower(F.hex("code")).alias("code"), "component").collect()
    assert ordered(got) == ordered(zip(keys, [f"{c:x}" for c in codes], plain_components(keys, codes)))


def test_texts_without_words_are_linked(spark):
    rows = [(None, None), (7, ""), (5, " \n"), (6, "one two three"), (None, "all alone in here")]
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert ordered((r.key, r.code == 0, r.component) for r in got) == ordered(
        [(None, True, 5), (7, True, 5), (5, True, 5), (6, False, 6), (None, False, None)]
    )


def test_nothing(nothing):
    assert simhash.near_groups(nothing).count() == 0
