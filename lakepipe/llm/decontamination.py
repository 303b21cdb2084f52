"""Benchmark decontamination: test items that documents contain, by size-partitioned MinHash sketches.

An item is its set of distinct five-word shingles; a document contains it when the document's own
shingles cover at least 80 % of them, wherever they stand. Items are short and documents may be
long, so a similarity of whole sets would vanish; instead the search asks for containment. The
sketch of an item is its smallest shingle hashes (a bottom-k MinHash). A document that contains
the item misses at most 20 % of its shingles, so among one more than that many some shingle must be
in the document: items are partitioned by size, and the length of a partition's sketches follows
from its largest size. So the search loses nothing. What shares a sketch value is verified with all
shingles of the item.

The sketches are the stated query set: they are broadcast in blocks of about BLOCK_SHINGLES hashes,
each block against all documents, which are scanned and not shuffled.

Defined results: words are runs of bytes other than [\\x20\\x09-\\x0D], A-Z lower-cased. An item of
fewer than five words is contained where its word sequence occurs; items without words, or null, are
in no document; null and empty documents contain nothing. Repeated documents and items are each
reported. A pair needs 100 * shared >= 80 * shingles of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import packed, shingle_sets, slices, windows, words_of
from lakepipe.llm.frames import LOWER, UPPER, fresh_name, quoted, ship, table
from lakepipe.session import checkpoint

SHINGLE = 5
CONTAINED, OF = 80, 100
BLOCK_SHINGLES = 2_000_000
_FILTER_BITS = 20


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, part in slices(batch.column("text")):
            words = words_of(part, lower=True)
            bounds, hashes = shingle_sets(words, SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").slice(at, len(part)), pa.array(np.diff(words.first)), packed(bounds, hashes)],
                ["item", "words", "shingles"],
            )


class Block:
    """Some items with their sketches, ready to search texts."""

    def __init__(self, rows: pa.Table):
        self.items = rows.column("item").combine_chunks()
        self.words = rows.column("words").to_numpy()
        self.shingles = [np.array(s, np.int64).view(np.uint64) for s in rows.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in self.shingles], np.int64)
        long = np.flatnonzero(self.words >= SHINGLE)
        partition = np.frexp(sizes.astype(float))[1]
        owners, sketch = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for j in np.unique(partition[long]):
            members = long[partition[long] == j]
            length = int(sizes[members].max()) * (OF - CONTAINED) // OF + 1
            for i in members:
                own = self.shingles[i][:length]
                owners.append(np.full(len(own), i))
                sketch.append(own)
        owner, sketch = np.concatenate(owners), np.concatenate(sketch)
        order = np.argsort(sketch, kind="stable")
        self.sketch, self.owner = sketch[order], owner[order]
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(self.sketch >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.short = {int(k): np.flatnonzero(self.words == k) for k in np.unique(self.words) if 0 < k < SHINGLE}

    def search(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared shingles) of all containments, ordered by text and item."""
        words = words_of(column, lower=True)
        bounds, hashes = shingle_sets(words, SHINGLE)
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.sketch, hashes[maybe], side="left")
        high = np.searchsorted(self.sketch, hashes[maybe], side="right")
        hits = high - low
        text = np.repeat(np.searchsorted(bounds, maybe, side="right") - 1, hits)
        item = self.owner[np.repeat(low - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())]
        candidates = np.unique(np.stack([text, item], axis=1), axis=0)
        found = []
        for t, i in candidates.tolist():
            own, wanted = hashes[bounds[t] : bounds[t + 1]], self.shingles[i]
            at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            shared = int((own[at] == wanted).sum())
            if OF * shared >= CONTAINED * len(wanted):
                found.append((t, i, shared))
        for length, members in self.short.items():
            start, grams = windows(words, length)
            for i in members.tolist():
                for t in np.unique(words.text[start[grams == self.shingles[i][0]]]).tolist():
                    found.append((t, i, 1))
        out = np.array(sorted(found), np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[Block]:
    """The items in blocks of bounded size."""
    ship(benchmark.sparkSession)
    kind = benchmark.schema[item].dataType.simpleString()
    named = benchmark.select(quoted(item).alias("item"), quoted(text).alias("text"))
    rows = checkpoint(named.mapInArrow(_item_rows, f"item {kind}, words bigint, shingles array<bigint>").filter("words > 0"))
    total = rows.agg(F.sum(F.size("shingles"))).first()[0] or 0
    count = -(-total // BLOCK_SHINGLES)
    place = F.pmod(F.xxhash64("item", "shingles"), F.lit(max(1, count)))
    return [Block(rows.filter(place == i).orderBy("item", "shingles").toArrow()) for i in range(count)]


def _hits(text: Column, block: Block, spark: SparkSession, kind: str) -> Column:
    shared = spark.sparkContext.broadcast(block)

    @F.arrow_udf(f"array<struct<item:{kind},n_item:bigint,n_shared:bigint>>")
    def hits(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in columns:
            found = [np.zeros((0, 3), np.int64)]
            for at, part in slices(column):
                text, item, count = own.search(part)
                found.append(np.stack([text + at, item, count], axis=1))
            rows = np.concatenate(found)
            sizes = np.array([len(s) for s in own.shingles], np.int64)[rows[:, 1]]
            values = pa.StructArray.from_arrays(
                [own.items.take(pa.array(rows[:, 1])), pa.array(sizes), pa.array(rows[:, 2])],
                ["item", "n_item", "n_shared"],
            )
            bounds = np.searchsorted(rows[:, 0], np.arange(len(column) + 1))
            yield pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)

    return hits(text)


def contained_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(key, item, n_item, n_shared): every document with every benchmark item it contains."""
    kind, own = benchmark.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    narrow = docs.select(quoted(key).alias("key"), quoted(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], f"key {own}, item {kind}, n_item bigint, n_shared bigint")
    for block in blocks(benchmark, item, text):
        found = narrow.select("key", F.explode(_hits(F.col("text"), block, docs.sparkSession, kind)).alias("hit"))
        out = out.unionByName(found.select("key", "hit.*"))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    kind, mark = benchmark.schema[item].dataType.simpleString(), fresh_name(docs, "_hits")
    for block in blocks(benchmark, item, text):
        found = docs.withColumn(mark, _hits(quoted(text), block, docs.sparkSession, kind))
        docs = found.filter(F.size(mark) == 0).drop(mark)
    return docs


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), F.col("n_item").alias("n_shingles"), "n_shared"
    )


_WORDS = f"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                               '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""

QUERIES = {"op3_benchmark_decontamination": op3_benchmark_decontamination}
ORACLE = {
    "op3_benchmark_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        dg AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
            FROM d WHERE len(w) >= 5),
        bg AS (
            SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
            FROM b WHERE len(w) >= 5),
        n AS (SELECT item_id, count(*) AS n FROM bg GROUP BY item_id)
        SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared
        FROM dg JOIN bg USING (g) JOIN n USING (item_id)
        GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n
        UNION ALL
        SELECT doc_id, item_id, 1, 1 FROM d JOIN b ON len(b.w) BETWEEN 1 AND 4
            AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(b.w, ' ') || ' ')
    """
}
