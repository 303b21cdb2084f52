"""Line deduplication with two Bloom filters.

The first pass sends the hash of every long enough line, once per slice of documents, to its segment
of the hash space. There each hash is looked up in a filter of what was seen once; if it is there,
it goes into the second filter, of what was seen twice. The second filter therefore holds every
hash that two documents hold, and few others. The second pass looks every line up in it; only the
digests of lines found there are shuffled. A digest that at least two documents hold stays in the
smallest of them.

The filters have BITS_PER_LINE bits for every line, in segments of SEGMENT_BITS, each filled by
itself. Up to BROADCAST_BYTES the second filter is broadcast to the tasks of the second pass. Beyond
that each segment tells the hashes it suspects, and the digests of lines meet them in a join; the
texts stay where they are and the result is the same.

Defined results: a null or empty text is one empty line. A key is the line without [\x20\x09-\x0D]
at both ends and with A-Z lower-cased; keys of fewer than LEAST_POINTS code points are never
dropped. All lines of a repeated key stay in the document of the smallest key column and go in the
others, however often each holds it. Rows with the same document key count as one document. A null
document key is smaller than any other. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import LOWER_BYTES, mix, slices
from lakepipe.llm.frames import LOWER, UPPER, fresh_name, quoted, ship, table
from lakepipe.operators.joins import lookup_join
from lakepipe.session import checkpoint

LEAST_POINTS = 10
BITS_PER_LINE, HASHES = 16, 3
SEGMENT_BITS = 1 << 22
BROADCAST_BYTES = 64 << 20
EDGES = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None) -> list[str]:
    """The key of every line of a text."""
    lowered = (text or "").encode().translate(LOWER_BYTES)
    return [line.strip(EDGES).decode() for line in lowered.split(b"\n")]


def _digest(key: str) -> bytes:
    """128 bits that stand for a key; the first 64 are its Bloom hash."""
    return xxhash.xxh3_128_digest(key.encode())


def _long_digests(texts: list[str | None]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(text, digest, hash) of the distinct long enough keys of each text."""
    owner, digests = [], []
    for t, text in enumerate(texts):
        own = {key for key in line_keys(text) if len(key) >= LEAST_POINTS}
        digests += map(_digest, own)
        owner += [t] * len(own)
    hashes = np.frombuffer(b"".join(digests), ">u8")[::2].astype(np.uint64)
    return np.array(owner, np.int64), digests, hashes


def _segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


def _places(hashes: np.ndarray) -> np.ndarray:
    """(hashes x HASHES) bits inside a segment."""
    step = hashes * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    mixed = mix(hashes)[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return (mixed % np.uint64(SEGMENT_BITS)).astype(np.int64)


def _slice_hashes(segments: int):
    """A row for each segment that a slice of documents touches: hashes one document holds, and several hold."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in slices(batch.column("text")):
                hashes, counts = np.unique(_long_digests(part.to_pylist())[2], return_counts=True)
                segment = _segment_of(hashes, segments)
                starts = np.flatnonzero(np.diff(segment, prepend=-1))
                spans = list(zip(starts, np.append(starts[1:], len(segment))))
                once = [hashes[a:b][counts[a:b] == 1].tobytes() for a, b in spans]
                more = [hashes[a:b][counts[a:b] > 1].tobytes() for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment[starts]), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
                    ["segment", "once", "more"],
                )

    return build


def _fill(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(twice filter, hashes that went into it) of one segment."""
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    suspects = [np.zeros(0, np.uint64)]
    for single, several in zip(group.column("once").to_pylist(), group.column("more").to_pylist()):
        single, several = np.frombuffer(single, np.uint64), np.frombuffer(several, np.uint64)
        places = _places(single)
        again = once[places].all(axis=1)
        twice[places[again]] = True
        once[places] = True
        places = _places(several)
        once[places] = twice[places] = True
        suspects += [single[again], several]
    return twice, np.unique(np.concatenate(suspects))


def _segment_filter(group: pa.Table) -> pa.Table:
    twice, _ = _fill(group)
    return pa.table(
        {"segment": group.column("segment").slice(0, 1), "twice": pa.array([np.packbits(twice).tobytes()], pa.binary())}
    )


def _segment_suspects(group: pa.Table) -> pa.Table:
    return pa.table({"hash": pa.array(_fill(group)[1].view(np.int64))})


def _suspected(segments: int, filters):
    """(key, hash, digest) of the lines that the broadcast filter holds, or of all without a filter."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = None if filters is None else filters.value
        for batch in batches:
            for at, part in slices(batch.column("text")):
                owner, digests, hashes = _long_digests(part.to_pylist())
                found = np.arange(len(hashes))
                if grid is not None:
                    places = _places(hashes)
                    octets = grid[_segment_of(hashes, segments)[:, None], places >> 3]
                    found = np.flatnonzero(((octets >> (7 - (places & 7))) & 1).all(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, len(part)).take(pa.array(owner[found])),
                        pa.array(hashes[found].view(np.int64)),
                        pa.array([digests[i] for i in found], pa.binary()),
                    ],
                    ["key", "hash", "digest"],
                )

    return look_up


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(key, drop): for each document that loses lines, the digests of their keys."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(quoted(key).alias("key"), quoted(text).alias("text"))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
    segments = max(1, -(-lines * BITS_PER_LINE // SEGMENT_BITS))

    hashes = texts.select("text").mapInArrow(_slice_hashes(segments), "segment bigint, once binary, more binary")
    by_segment = hashes.groupBy("segment")
    schema = f"key {kind}, hash bigint, digest binary"
    if segments * SEGMENT_BITS // 8 <= broadcast_bytes:
        rows = by_segment.applyInArrow(_segment_filter, "segment bigint, twice binary").collect()
        grid = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
        for row in rows:
            grid[row["segment"]] = np.frombuffer(row["twice"], np.uint8)
        suspects = texts.mapInArrow(_suspected(segments, spark.sparkContext.broadcast(grid)), schema)
    else:
        known = by_segment.applyInArrow(_segment_suspects, "hash bigint")
        suspects = texts.mapInArrow(_suspected(segments, None), schema).join(known, "hash", "left_semi")
    suspects = checkpoint(suspects.select("key", "digest"))

    first, last = F.min(F.struct("key")), F.max(F.struct("key"))
    confirmed = suspects.groupBy("digest").agg(
        first.alias("first"), last.alias("last"), F.count(F.lit(1)).alias("n")
    )
    confirmed = checkpoint(confirmed.filter(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first", "n"))
    held = lookup_join(
        suspects, confirmed.select("digest", "first"), ["digest"], ["key"], counts=(confirmed.select("digest", "n"), "n")
    )
    return (
        held.filter(~F.col("first.key").eqNullSafe(F.col("key"))).groupBy("key").agg(F.collect_set("digest").alias("drop"))
    )


def drop_lines(text: str | None, drop: list[bytes] | None) -> tuple[str, int, int]:
    """(kept lines, number of lines, number of dropped ones) of a text."""
    lines = (text or "").split("\n")
    if not drop:
        return text or "", len(lines), 0
    gone = set(drop)
    keys = line_keys(text)
    kept = [line for line, k in zip(lines, keys) if len(k) < LEAST_POINTS or _digest(k) not in gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    into: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped"),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the text without its repeated lines and the numbers of lines; columns of these names are replaced."""
    other, result = fresh_name(docs, "_lines"), fresh_name(docs, "_result")
    drops = repeated_lines(docs, key, text, broadcast_bytes).select(F.struct("key", "drop").alias(other))

    @F.arrow_udf("kept string, n_lines bigint, n_dropped bigint")
    def dropped(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in columns:
            parts = []
            for at, part in slices(texts):
                rows = map(drop_lines, part.to_pylist(), gone.slice(at, len(part)).to_pylist())
                kept, lines, lost = zip(*rows)
                parts.append(
                    pa.StructArray.from_arrays(
                        [pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())],
                        ["kept", "n_lines", "n_dropped"],
                    )
                )
            yield pa.concat_arrays(parts) if parts else pa.array([], result_type)

    result_type = pa.struct([("kept", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
    joined = docs.join(drops, quoted(key).eqNullSafe(F.col(f"{other}.key")), "left")
    done = joined.withColumn(result, dropped(quoted(text), F.col(f"{other}.drop")))
    names = dict(zip(into, ("kept", "n_lines", "n_dropped")))
    return done.withColumns({c: F.col(f"{result}.{field}") for c, field in names.items()}).drop(other, result)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {
    "op1_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM documents),
        k AS (
            SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                                '{UPPER}', '{LOWER}') AS k
            FROM l),
        g AS (SELECT k, min(doc_id) AS first FROM k WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id)),
        m AS (SELECT k.*, g.first IS NOT NULL AND k.doc_id <> g.first AS gone FROM k LEFT JOIN g USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """
}
