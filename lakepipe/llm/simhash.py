"""Near duplicates by SimHash fingerprints, found with covering locality-sensitive hashing (Pagh, 2016).

A text is lower-cased (A-Z only) and cut into words, and every three consecutive words are a shingle,
repeats included. Bit i of the 64-bit fingerprint is set when bit i of the XXH64 hash is set in more
than half of the shingles. Two fingerprints are linked when at most RADIUS bits differ.

Every bit position gets a non-zero vector m(i) of RADIUS + 1 bits, dealt out in turn, and every
non-zero vector v gives a mask: the positions where m(i) and v have an odd inner product. The
vectors of RADIUS differing positions never span the whole space, so some v is orthogonal to all of
them: under that mask the two fingerprints agree. Hence every pair within the radius meets in a
bucket (mask, masked bits) of one of the 2^(RADIUS+1) - 1 tables; none is lost. All masks have an
even share of the bits, four sevenths for radius 2.

Only distinct fingerprints enter the tables, however many copies a text has. A bucket with more than
BUCKET of them is not compared pair by pair: its members go through another covering of the bits its
mask leaves open, which keeps the guarantee, because the pair still differs in at most RADIUS of
those. Masks grow until buckets are small, after a few rounds.

Defined results: a null or empty text, or one without words, has the fingerprint zero, which is
linked like any other. Fewer words than a shingle count as one shingle. A component is named after
its smallest key; null keys name one only if it has no other, then the name is null. Repeated rows
are all returned. An empty table gives an empty result. Other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import slices
from lakepipe.llm.components import connected_components
from lakepipe.llm.frames import quoted, ship, table
from lakepipe.operators.joins import lookup_join
from lakepipe.session import checkpoint

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
BUCKET = 64
#: A long text is cut into words in pieces of about so many bytes, and hashed in runs of so many shingles.
PIECE_BYTES = 1 << 20
RUN = 1 << 16
_CLASS_BYTES = 40


def _words(raw: bytes) -> Iterator[bytes]:
    """Lower-cased words; bytes.split() and lower() know ASCII white space and letters only."""
    at = 0
    while at < len(raw):
        to = at + PIECE_BYTES
        while to < len(raw) and not raw[to : to + 1].isspace():
            to += 1
        yield from raw[at:to].lower().split()
        at = to


def _shingles(raw: bytes) -> Iterator[bytes]:
    words = _words(raw)
    held = list(islice(words, SHINGLE))
    if held:
        yield b" ".join(held)
    for word in words:
        held = [*held[1:], word]
        yield b" ".join(held)


def fingerprint(raw: bytes) -> int:
    """The fingerprint of one UTF-8 text."""
    shingles, ones, total = _shingles(raw), np.zeros(BITS, np.int64), 0
    while hashes := [xxhash.xxh64_intdigest(s, SEED) for s in islice(shingles, RUN)]:
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, code): the fingerprint of every row as a signed number."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column("text")):
                found = [fingerprint(raw) for raw in part.cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(part)), pa.array(np.array(found, np.uint64).view(np.int64))],
                    ["key", "code"],
                )

    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(quoted(key).alias("key"), quoted(text).alias("text")).mapInArrow(
        codes, f"key {kind}, code bigint"
    )


def covering(open_bits: int, radius: int = RADIUS) -> list[int]:
    """Masks over the set bits of `open_bits`: any `radius` of these bits are missing from one of them."""
    places = [i for i in range(BITS) if open_bits >> i & 1]
    vectors = range(1, 1 << (radius + 1))
    vector = {place: vectors[i % len(vectors)] for i, place in enumerate(places)}
    masks = (sum(1 << place for place in places if (vector[place] & v).bit_count() & 1) for v in vectors)
    return sorted(set(masks))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _next_masks(taken: list[int], radius: int) -> dict[int, list[int]]:
    """For masks in use, the larger masks that split their buckets."""
    everything = (1 << BITS) - 1
    return {mask: [mask | more for more in covering(everything & ~mask, radius)] for mask in taken}


def _pairs(codes: Column, radius: int) -> Column:
    """The linked pairs (a, b), a < b, of an array of codes."""

    def partners(a: Column) -> Column:
        close = F.filter(codes, lambda b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= radius))
        return F.transform(close, lambda b: F.struct(a.alias("a"), b.alias("b")))

    return F.flatten(F.transform(codes, partners))


def _rows_of(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """(mask, place, code): the buckets of every row under the masks that follow its own."""
    pairs = [(_signed(mask), _signed(m)) for mask, more in masks.items() for m in more]
    after = rows.sparkSession.createDataFrame(pairs, "mask bigint, next bigint")
    # At most a few thousand rows of two numbers: 7 masks, then 49, then 343, whatever the table.
    split = rows.join(F.broadcast(after), "mask").select("code", F.col("next").alias("mask"))
    return split.select("mask", F.col("code").bitwiseAND(F.col("mask")).alias("place"), "code")


def links(codes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct `code` values that differ in at most `radius` bits.

    Masks grow as long as 2^radius bits are open, so a bucket limit below 2^(2^radius - 1) is raised to that.
    """
    bucket = max(bucket, 1 << ((1 << radius) - 1))
    found, masks = [], _next_masks([0], radius)
    rows = _rows_of(codes.select("code", F.lit(0).cast("bigint").alias("mask")), masks)
    while masks:
        sizes = rows.groupBy("mask", "place").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = checkpoint(rows.join(sizes, ["mask", "place"]))
        small = shared.filter(F.col("n") <= bucket).groupBy("mask", "place").agg(F.collect_list("code").alias("codes"))
        found.append(small.select(F.inline(_pairs(F.col("codes"), radius))))
        crowded = shared.filter(F.col("n") > bucket).select("code", "mask")
        # A round knows a few hundred masks at most, whatever the table.
        masks = _next_masks([row["mask"] % (1 << BITS) for row in crowded.select("mask").distinct().collect()], radius)
        # Two masks may lead to the same larger one.
        rows = _rows_of(crowded, masks).distinct()
    return reduce(DataFrame.unionByName, found).distinct()


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, bucket: int = BUCKET
) -> DataFrame:
    """One row per input row: key, code, component (its smallest key)."""
    rows = checkpoint(fingerprints(docs, key, text))
    classes = checkpoint(rows.groupBy("code").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")))
    roots = connected_components(links(classes.select("code"), radius, bucket)).withColumnRenamed("node", "code")
    rooted = checkpoint(classes.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("codes"))
    named = lookup_join(rooted, names.select("root", "component"), ["root"], ["code"], counts=(names, "codes"))
    named = checkpoint(named.select("code", "component", "n"))
    return lookup_join(
        rows,
        named.select("code", "component"),
        ["code"],
        ["key"],
        counts=(named.select("code", "n"), "n"),
        right_at_most=named.count() * _CLASS_BYTES,
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


QUERIES = {"op11_simhash": op11_simhash}
ORACLE: dict[str, str] = {}  # XXH64 and connected components have no SQL here; tests use brute force.
