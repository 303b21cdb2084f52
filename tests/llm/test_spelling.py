import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from lakepipe.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain_variants(n):
    out = []
    forms = {}
    nears = {w: [v for v in n if near(w, v)] for w in n}
    for w in n:
        best = min(nears[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(nears[w]), forms[w] and n[forms[w]]))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(6)
    stems = ["".join(draw.choice("abcdeéüß") for _ in range(draw.randint(5, 9))) for _ in range(40)]
    words = []
    for stem in stems:
        words += [stem] * draw.choice([5, 30, 200])
        for _ in range(4):
            i, letter = draw.randrange(len(stem)), draw.choice("abÀÿ×")
            words += [draw.choice([stem[:i] + stem[i + 1 :], stem[:i] + letter + stem[i:], stem[:i] + letter + stem[i + 1 :]])] * 6
    # A chain of forms of three steps.
    words += ["colour"] * 1200 + ["colours"] * 210 + ["coloursx"] * 38 + ["coloursxy"] * 6
    draw.shuffle(words)
    rows = [(i, draw.choice([" ", ", ", "1"]).join(w.title() if draw.random() < 0.1 else w for w in words[i * 8 : i * 8 + 8])) for i in range(len(words) // 8)]
    return rows + [(None, "without a key"), (9000, None), (9001, ""), (9002, "ab " * 50_000 + "long" * 800), (9003, "said twice"), (9003, "said twice")]


def test_a_neighbourhood_is_whole():
    for length in (1, 2, 5):
        words = ["".join(w) for w in itertools.product("abc", repeat=length)]
        reduced = np.array([[ord(c) - 96 for c in w] for w in words], np.uint64)
        around = spelling.neighbourhood(reduced, 3)
        known = {}
        for size in (length - 1, length, length + 1):
            for other in itertools.product("abc", repeat=size):
                symbols = np.array([[ord(c) - 96 for c in other]], np.uint64).reshape(1, size)
                known["".join(other)] = int(spelling._prefixes(symbols)[0][0, -1])
        for word, hashes in zip(words, around.tolist()):
            want = {h for other, h in known.items() if other == word or near(other, word)}
            assert set(hashes) == want


def test_symbols_grow_with_the_vocabulary():
    assert [spelling.symbols_for(n) for n in (0, 10**5, 10**6, 10**9)] == [4, 5, 8, 23]


def test_the_query(spark, texts, tmp_path):
    spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = spelling.op13_spelling_variants(spark, str(tmp_path))
    want = ordered(plain_variants(plain_counts(texts)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert ordered(got.collect()) == want
    assert any(w != r and f != r for w, f, r, *_ in want)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert ordered(db.sql(spelling.ORACLE["op13_spelling_variants"]).fetchall()) == want


def test_hot_reduced_words_without_broadcast(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(spelling, "symbols_for", lambda words: 2)
    draw = random.Random(7)
    n = {"".join(draw.choice("abcd") for _ in range(draw.randint(6, 7))): draw.randint(5, 500) for _ in range(300)}
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert ordered(spelling.variants(words).collect()) == ordered(plain_variants(n))


def test_odd_tables(spark, documents, nothing):
    assert spelling.variants(spelling.counted(spelling.runs_of(nothing), F.col("run"))).count() == 0
    runs = spelling.runs_of(documents)
    words = spelling.counted(runs, F.col("run"), least=2)
    assert words.count() > 0 and spelling.variants(words).count() == words.count()
