"""Groups of spelling variants: words one edit apart, found through words over a reduced alphabet.

Every letter is hashed to one of a few symbols, so a word becomes a reduced word. Two words that
differ by one inserted, deleted or replaced letter have reduced words that are equal or differ by one
such edit. So for each distinct reduced word its full one-edit neighbourhood is generated, about
2 * length * symbols + symbols words, far fewer than over the whole alphabet, and joined with the
reduced vocabulary. The words behind two reduced words that met are compared as they are, so what the
reduction confuses costs time only, and no pair is lost.

Reduced words and their neighbours are represented by 64-bit polynomial hashes of their symbols, made
for all words of a batch at once from prefix hashes. Equal reduced words have equal hashes; words
that agree by accident are told apart with the rest. The number of symbols follows from the size of
the vocabulary: the shortest words alone have as many reduced words as there are groups of about
GROUP words, so groups stay small while the neighbourhoods grow slowly.

A word's form is its most frequent near word (of equal ones the smallest in code-point order),
provided that it is at least RATIO times as frequent as the word. Counts grow at least by that factor
along forms, so a root is at most some 28 steps away, and pointer doubling finds all roots in five
rounds of joins, in the worst case.

Defined results: words are matched in code points. Null and empty texts have no words, a null key
counts as an empty one where it is hashed. Repeated rows and long texts count with all their words.
Words without near words have no form and are their own root. An empty table gives an empty result.
Other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import mix
from lakepipe.llm.frames import ascii_lower, quoted, ship, table
from lakepipe.operators.joins import lookup_join
from lakepipe.session import checkpoint

LEAST_POINTS, LEAST_COUNT, RATIO = 6, 5, 5
GROUP, LEAST_SYMBOLS = 8, 4
#: Fixed by the contract: letters of a run, and one of so many runs loses a letter.
RUN, DAMAGED = "[a-zÀ-ÿ]+", 199
#: Letters of the words whose neighbourhoods are made at once, and the bytes a word takes in a broadcast table.
CHUNK, ROW_BYTES = 1 << 14, 64

_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def symbols_for(words: int) -> int:
    """How many symbols give the shortest words one reduced word for about GROUP words."""
    symbols = LEAST_SYMBOLS
    while symbols**LEAST_POINTS * GROUP < words:
        symbols += 1
    return symbols


def _reduced(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, symbol matrix) of the words of each length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join(words[i] for i in places).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = mix(points.astype(np.uint64).reshape(len(places), length))
        yield places, letters % np.uint64(symbols) + np.uint64(1)


def _prefixes(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the first p symbols for every p, powers of the base)."""
    rows, length = reduced.shape
    power = np.ones(length + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(length, _BASE, np.uint64))
    sums = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(reduced * power[:-1], axis=1, out=sums[:, 1:])
    return sums, power


def reduced_hashes(words: list[str], symbols: int) -> np.ndarray:
    """The hash of every word's reduced word."""
    out = np.zeros(len(words), np.uint64)
    for places, reduced in _reduced(words, symbols):
        out[places] = _prefixes(reduced)[0][:, -1]
    return out


def neighbourhood(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """(rows x edits) hashes of each reduced word and of all that one edit makes of it, some more than once."""
    sums, power = _prefixes(reduced)
    rows, length = reduced.shape
    whole, alphabet = sums[:, -1:], np.arange(1, symbols + 1, dtype=np.uint64)
    deleted = sums[:, :-1] + (whole - sums[:, 1:]) * _BACK
    change = (alphabet[None, None, :] - reduced[:, :, None]) * power[None, :-1, None]
    replaced = (whole[:, :, None] + change).reshape(rows, -1)
    shifted = sums + (whole - sums) * _BASE
    inserted = (shifted[:, :, None] + alphabet[None, None, :] * power[None, :, None]).reshape(rows, -1)
    return np.concatenate([whole, deleted, replaced, inserted], axis=1)


def _hashed(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(word, n, reduced) with the hash of the reduced word."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = reduced_hashes(batch.column("word").to_pylist(), symbols)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], ["word", "n", "reduced"])

    return vocabulary.select("word", "n").mapInArrow(hashes, "word string, n bigint, reduced bigint")


def _chunks(words: list[str]) -> Iterator[list[str]]:
    """The words in pieces of about CHUNK letters, or one longer word."""
    chunk, letters = [], 0
    for word in words:
        if chunk and letters + len(word) > CHUNK:
            yield chunk
            chunk, letters = [], 0
        chunk.append(word)
        letters += len(word)
    if chunk:
        yield chunk


def _neighbours(sample: DataFrame, symbols: int) -> DataFrame:
    """(reduced, near): the neighbourhood of every reduced word, of which `sample` has a word each."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _chunks(batch.column("word").to_pylist()):
                for _, reduced in _reduced(words, symbols):
                    own = _prefixes(reduced)[0][:, -1]
                    near = np.sort(neighbourhood(reduced, symbols), axis=1)
                    fresh = np.ones(near.shape, bool)
                    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
                    source = np.repeat(own, fresh.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(source.view(np.int64)), pa.array(near[fresh].view(np.int64))], ["reduced", "near"]
                    )

    return sample.select("word").mapInArrow(spread, "reduced bigint, near bigint")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of distinct words (word, n) that are one edit apart, in both directions."""
    ship(vocabulary.sparkSession)
    symbols = symbols_for(vocabulary.count())
    hashed = checkpoint(_hashed(vocabulary, symbols))
    known = checkpoint(hashed.groupBy("reduced").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("n")))
    count = known.count()
    # Only neighbours that are reduced words themselves go on.
    met = lookup_join(
        _neighbours(known, symbols),
        known.select(F.col("reduced").alias("near")),
        ["near"],
        ["reduced"],
        counts=(known.select(F.col("reduced").alias("near"), "n"), "n"),
        right_at_most=count * ROW_BYTES,
    )
    left = hashed.select("reduced", "word")
    right = hashed.select(F.col("reduced").alias("near"), F.col("word").alias("other"), F.col("n").alias("near_n"))
    pairs = met.join(left, "reduced").join(right, "near")
    close = (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1)
    return pairs.filter(close).select("word", F.col("other").alias("near"), "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling."""
    roots = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        after = lookup_join(roots, ahead, ["root"], ["word"], "left")
        after = checkpoint(after.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").alias("moved")))
        if after.filter("moved IS NOT NULL").isEmpty():
            return after.select("word", "root")
        roots = after.select("word", "root")


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary (word, n) of distinct words."""
    vocabulary = checkpoint(vocabulary.select("word", "n"))
    # Code-point order is the order of UTF-8 bytes; the most frequent near word comes first.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = vocabulary.join(near, "word", "left")
    far = -F.col("best.less") >= ratio * F.col("n")
    formed = checkpoint(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(far, F.col("best.form")).alias("form"),
            F.when(far, -F.col("best.less")).cast("bigint").alias("form_n"),
        )
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    named = formed.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def runs_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, run): every maximal run of letters of every text, A-Z lower-cased."""
    found = F.regexp_extract_all(ascii_lower(quoted(text)), F.lit(RUN), F.lit(0))
    return docs.select(quoted(key).alias("key"), F.explode(found).alias("run"))


def counted(words: DataFrame, word: Column, points: int = LEAST_POINTS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    long = words.select(word.alias("word")).filter(F.length("word") >= points)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def damaged(key: Column, run: Column) -> Column:
    """The contract's damage: one run of DAMAGED, by its hash, loses the letter that the hash names."""
    hashed = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    place = F.pmod(hashed, F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(F.pmod(hashed, F.lit(DAMAGED)) == 0, without).otherwise(run)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_of(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variants(counted(runs, damaged(F.col("key"), F.col("run"))))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLE = {
    "op13_spelling_variants": f"""
        WITH RECURSIVE octets AS (SELECT unnest(range(256)) AS b),
        bits AS (
            SELECT b, 0 AS k, b AS v FROM octets
            UNION ALL SELECT b, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE k < 8),
        step AS (SELECT b, v FROM bits WHERE k = 8),
        found AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
            FROM documents),
        runs AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL),
        names AS (
            SELECT DISTINCT doc_id, run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS octets FROM runs),
        most AS (SELECT max(length(octets)) // 2 AS n FROM names),
        -- What a byte followed by d others adds to the checksum; what the start value becomes behind d bytes.
        adds AS (
            SELECT 0 AS d, b, v FROM step
            UNION ALL SELECT d + 1, adds.b, xor(adds.v >> 8, step.v) FROM adds JOIN step ON step.b = adds.v & 255
            WHERE d + 1 < (SELECT n FROM most)),
        start AS (
            SELECT 0 AS d, 4294967295 AS v
            UNION ALL SELECT d + 1, xor(start.v >> 8, step.v) FROM start JOIN step ON step.b = start.v & 255
            WHERE d < (SELECT n FROM most)),
        places AS (SELECT doc_id, run, octets, unnest(range(length(octets) // 2)) AS i FROM names),
        sums AS (
            SELECT doc_id, run, any_value(length(octets) // 2) AS size, bit_xor(adds.v) AS v
            FROM places JOIN adds ON adds.d = length(octets) // 2 - 1 - i
                        AND adds.b = CAST('0x' || substr(octets, 2 * i + 1, 2) AS BIGINT)
            GROUP BY doc_id, run),
        hashed AS (
            SELECT doc_id, run, xor(4294967295, xor(sums.v, start.v)) AS h FROM sums JOIN start ON start.d = size),
        w AS (
            SELECT CASE WHEN h % {DAMAGED} = 0
                        THEN substr(r.run, 1, h % length(r.run)) || substr(r.run, h % length(r.run) + 2) ELSE r.run END AS word, n
            FROM runs r JOIN hashed ON r.run = hashed.run AND r.doc_id IS NOT DISTINCT FROM hashed.doc_id),
        v AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {LEAST_POINTS}
            GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
        -- Words without one letter: two words that share one at the same place differ by a replacement.
        p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM p),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON cut.rest = v.word
            UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON cut.rest = v.word),
        best AS (
            SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS best FROM near GROUP BY word),
        f AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -best.less >= {RATIO} * v.n THEN best.other END AS form,
                   CASE WHEN -best.less >= {RATIO} * v.n THEN -best.less END AS form_n
            FROM v LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS reached, 0 AS steps FROM f
            UNION ALL SELECT chain.word, f.form, steps + 1 FROM chain JOIN f ON f.word = chain.reached WHERE f.form IS NOT NULL)
        SELECT f.word, form, arg_max(reached, steps) AS root, any_value(f.n) AS n, any_value(n_near) AS n_near, form_n
        FROM f JOIN chain ON chain.word = f.word GROUP BY f.word, form, form_n
    """
}
