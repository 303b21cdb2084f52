import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_texts(seed, count=60):
    """Small texts over few words, with copies, near copies, shared passages and lines."""
    draw = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gamma,", "délta", "EPSILON", "zeta.", "eta", "θήτα", "iota", "Kappa", "lam-bda", "mu"]
    vocabulary += [f"w{i}" for i in range(200)]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passage, line = say(45), " ".join(say(6))
    texts = []
    for i in range(count):
        kind = i % 6
        if kind == 0 or not texts:
            w = say(draw.randint(1, 120))
        elif kind == 1:
            w = draw.choice(texts).replace("\n", " ").split(" ")
            if w:
                w[draw.randrange(len(w))] = "changed"
        elif kind == 2:
            texts.append(draw.choice(texts).swapcase() if draw.random() < 0.5 else draw.choice(texts))
            continue
        elif kind == 3:
            w = say(20) + passage + say(30)
        elif kind == 4:
            texts.append("\n".join([" ".join(say(8)), "  " + line.upper() + "\t", " ".join(say(3)), line]))
            continue
        else:
            w = say(draw.randint(1, 8))
        texts.append(draw.choice([" ", "  ", "\n"]).join(w))
    return texts


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: usual texts and every odd case."""
    rows = list(enumerate(make_texts(5)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t\r"), (1003, "..."), (None, "a text without any key here"), (1004, None)]
    rows += [(1005, "said twice in this corpus of texts"), (1005, "said twice in this corpus of texts")]
    rows += [(1006, "x" * 3000), (1007, "é" * 40 + " 12 \U0001f600 あい"), (1008, "a\x1cb c d e f g")]
    long = random.Random(1)
    rows.append((1009, " ".join(f"t{long.randrange(3000)}" for _ in range(40_000))))
    return rows


@pytest.fixture
def documents(spark, corpus):
    """The corpus as a table with columns whose names the operators might use themselves."""
    odd = ["key", "row", "digest", "class", "n", "u", "v", "_digest", "_decision", "score", "lang_pred", "ids", "kept_text"]
    odd += ["text_hash", "shard", "_spans", "_lines", "a.b", "winner", "item", "slot"]
    rows = [(k, t, None if i % 3 else "en", None, None, *["x"] * len(odd)) for i, (k, t) in enumerate(corpus)]
    fields = ", ".join(f"`{c}` string" for c in odd)
    return spark.createDataFrame(rows, f"{SCHEMA}, {fields}").repartition(5)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
