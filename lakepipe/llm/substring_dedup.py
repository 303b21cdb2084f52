r"""Substring deduplication by Rabin-Karp hashes of every window of WINDOW consecutive words.

A window is repeated if its word sequence also starts elsewhere, in the same document or another.
Every word that a repeated window covers is removed, that is, maximal intervals of overlapping or
touching repeated windows.

Windows travel as segments: consecutive windows of a document that agree on their anchor, the
smallest hash of the ANCHOR-word stretches inside them. Equal windows have equal anchors, so a bucket
of anchors holds all places of its windows, and a segment needs its document and start only once. A
slice of documents sends each of its windows once; windows that a slice holds several times are
known to be repeated at once, so a passage that a third of the documents share costs one copy per
slice and not one per document. A phrase shorter than a window, with other words around it each
time, is the anchor of ever new windows; anchors of more than HOT_WINDOWS windows (as a share of
the documents shows) are therefore left, and each of their windows goes to the bucket of its own
hash. All tasks know the same such anchors, so equal windows meet, whichever anchors these are. In
its bucket every window hash is counted; the repeated windows are merged into intervals, and the
intervals of a document meet its text in one join.

Defined results: words are runs of bytes other than [\x20\x09-\x0D], compared unchanged; kept words
are joined by one space. A null, empty or blank text has no words. A document with fewer words than
a window loses none. Rows that agree in key and text are different places, so long ones lose all
their words. A null key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import Words, gather, mix, slices, windows, words_of
from lakepipe.llm.frames import fresh_name, quoted, ship, table

WINDOW, ANCHOR = 35, 6
#: Buckets of anchors are about this many bytes of text.
BUCKET_BYTES = 12 << 20
#: Anchors of more windows than this are hot; they are counted over one document in SHARE.
HOT_WINDOWS, SHARE = 1 << 18, 64


def _anchors(words: Words, start: np.ndarray) -> np.ndarray:
    """The smallest hash of the ANCHOR-word stretches inside the windows that start at `start`."""
    at, hashes = windows(words, ANCHOR)
    low = np.full(len(words.text), np.iinfo(np.uint64).max, np.uint64)
    low[at] = hashes
    # Minimum over WINDOW - ANCHOR + 1 neighbours by doubling.
    reach, span = 1, WINDOW - ANCHOR + 1
    while reach * 2 <= span:
        low[: len(low) - reach] = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    return np.minimum(low[start], low[start + span - reach])


def _intervals(document: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, end) of the maximal runs of words that windows at (document, start), ordered, cover."""
    if not len(start):
        return document, start, start
    joined = np.zeros(len(start), bool)
    joined[1:] = (document[1:] == document[:-1]) & (start[1:] <= start[:-1] + WINDOW)
    first = np.flatnonzero(~joined)
    last = np.append(first[1:], len(start)) - 1
    return document[first], start[first], start[last] + WINDOW


def _rows(bucket, known, documents, starts, lengths, hashes) -> pa.RecordBatch:
    """Segments as one row for each bucket; the segments' windows have hashes[...] one after the other."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    edges = [*np.flatnonzero(np.diff(ordered, prepend=-1)).tolist(), len(order)]
    at = np.cumsum(lengths) - lengths
    content = {"documents": [], "starts": [], "lengths": [], "hashes": []}
    for a, b in zip(edges[:-1], edges[1:]):
        own = order[a:b]
        content["documents"].append(documents[own].tobytes())
        content["starts"].append(starts[own].astype(np.int32).tobytes())
        content["lengths"].append(lengths[own].astype(np.int32).tobytes())
        content["hashes"].append(b"" if known else gather(hashes, at[own], lengths[own]).tobytes())
    columns = [pa.array(ordered[edges[:-1]].astype(np.int32)), pa.array([known] * (len(edges) - 1), pa.bool_())]
    columns += [pa.array(v, pa.binary()) for v in content.values()]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "known", *content])


SEGMENT_ROWS = "bucket int, known boolean, documents binary, starts binary, lengths binary, hashes binary"


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, n): the windows of a slice at each anchor, equal ones once."""
    for batch in batches:
        for _, part in slices(batch.column("text")):
            words = words_of(part)
            start, hashes = windows(words, WINDOW)
            if len(start):
                first = np.unique(hashes, return_index=True)[1]
                anchors, counts = np.unique(_anchors(words, start[first]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(counts)], ["anchor", "n"])


def _hot_anchors(texts: DataFrame, hot_windows: int) -> np.ndarray:
    """The anchors, ascending, that probably have more than `hot_windows` windows in (u, v, text)."""
    some = texts.filter(F.pmod("v", F.lit(SHARE)) == 0).select("text")
    counts = some.mapInArrow(_anchor_counts, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    # At most one anchor for each `hot_windows` windows.
    found = counts.filter(F.col("n") * SHARE > hot_windows).select("anchor").toArrow().column(0)
    return np.sort(found.to_numpy().view(np.uint64))


def _segments(buckets: int, hot):
    """The segments of every bucket, and the intervals that a slice knows already; `hot` is a broadcast array."""

    def place(values: np.ndarray) -> np.ndarray:
        return (((mix(values) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in ("u", "v")], axis=1)
            for at, part in slices(batch.column("text")):
                words = words_of(part)
                start, hashes = windows(words, WINDOW)
                if not len(start):
                    continue
                _, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                text, local = words.text[start], start - words.first[words.text[start]]
                several = counts[inverse] > 1
                document, low, high = _intervals(text[several], local[several])
                if len(document):
                    own = ids[document + at]
                    yield _rows(place(own[:, 0].view(np.uint64)), True, own, low, high - low, None)

                # One copy of every hash goes on: its first place.
                fresh = np.zeros(len(hashes), bool)
                fresh[first] = True
                anchor = _anchors(words, start)[fresh]
                text, local, hashes = text[fresh], local[fresh], hashes[fresh]
                if len(hot.value):
                    anchor = np.where(np.isin(anchor, hot.value), hashes, anchor)
                opens = np.ones(len(text), bool)
                opens[1:] = (text[1:] != text[:-1]) | (local[1:] != local[:-1] + 1) | (anchor[1:] != anchor[:-1])
                heads = np.flatnonzero(opens)
                lengths = np.diff(np.append(heads, len(text)))
                yield _rows(place(anchor[heads]), False, ids[text[heads] + at], local[heads], lengths, hashes)

    return emit


def _repeats(group: pa.Table) -> pa.Table:
    """(u, v, first, end): intervals of words that the repeated windows of a bucket cover."""

    def joined(column: str, kind, known: bool) -> np.ndarray:
        chosen = group.filter(pc.equal(group.column("known"), known)).column(column)
        return np.frombuffer(b"".join(chosen.to_pylist()), kind)

    documents, starts, lengths = (joined(c, k, False) for c, k in _LAYOUT)
    hashes = joined("hashes", np.uint64, False)
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:][equal]] = repeated[order[:-1][equal]] = True
    segment = np.repeat(np.arange(len(lengths)), lengths)[repeated]
    local = (np.arange(len(hashes)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[repeated]
    segment, low, high = _intervals(segment, starts[segment] + local)
    known_documents, known_starts, known_lengths = (joined(c, k, True) for c, k in _LAYOUT)
    ids = np.concatenate([documents.reshape(-1, 2)[segment], known_documents.reshape(-1, 2)])
    first = np.concatenate([low, known_starts]).astype(np.int32)
    end = np.concatenate([high, known_starts + known_lengths]).astype(np.int32)
    return pa.table({"u": pa.array(ids[:, 0]), "v": pa.array(ids[:, 1]), "first": pa.array(first), "end": pa.array(end)})


_LAYOUT = (("documents", np.int64), ("starts", np.int32), ("lengths", np.int32))


def _with_ids(docs: DataFrame, key: str, text: str, u: str, v: str) -> DataFrame:
    """Add 128 bits that stand for a document's key and text."""
    return docs.withColumns({u: F.xxhash64(quoted(key), quoted(text)), v: F.xxhash64(quoted(text), quoted(key))})


def repeated_intervals(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot_windows: int = HOT_WINDOWS
) -> DataFrame:
    """(u, v, spans): for each document that loses words, distinct intervals [first, end) of word numbers."""
    spark = docs.sparkSession
    ship(spark)
    texts = _with_ids(docs.select(quoted(key).alias("key"), quoted(text).alias("text")), "key", "text", "u", "v")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    hot = spark.sparkContext.broadcast(_hot_anchors(texts, hot_windows))
    rows = texts.select("u", "v", "text").mapInArrow(_segments(buckets, hot), SEGMENT_ROWS)
    spans = rows.groupBy("bucket").applyInArrow(_repeats, "u bigint, v bigint, first int, end int")
    return spans.groupBy("u", "v").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def _removed(part: pa.Array, spans: pa.Array) -> pa.StructArray:
    words = words_of(part)
    owner = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
    values = spans.flatten()
    low, high = (values.field(i).to_numpy(zero_copy_only=False) + words.first[owner] for i in (0, 1))
    change = np.zeros(len(words.text) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    text = words.text[kept]
    length = words.end[kept] - words.start[kept]
    inner = np.zeros(len(kept), bool)
    inner[:-1] = text[1:] == text[:-1]
    data = gather(np.append(words.data, np.uint8(32)), words.start[kept], length + inner)
    ends = np.cumsum(length + inner)
    data[ends[inner] - 1] = 32
    bounds = np.concatenate([[0], ends])[np.searchsorted(text, np.arange(len(part) + 1))]
    joined = pa.Array.from_buffers(
        pa.large_string(), len(part), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.string())
    total = np.diff(words.first)
    left = np.bincount(text, minlength=len(part))
    return pa.StructArray.from_arrays(
        [joined, pa.array(total), pa.array(total - left)], ["kept", "n_words", "n_removed"]
    )


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    into: tuple[str, str, str] = ("kept_text", "n_words", "n_removed"),
    hot_windows: int = HOT_WINDOWS,
) -> DataFrame:
    """Add the words that stay, joined by spaces, and the numbers of words; columns of these names are replaced."""
    u, v, other, result = (fresh_name(docs, c) for c in ("_u", "_v", "_spans", "_result"))
    spans = repeated_intervals(docs, key, text, hot_windows)
    spans = spans.select(F.col("u").alias(u), F.col("v").alias(v), F.col("spans").alias(other))
    kind = pa.struct([("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    @F.arrow_udf("kept string, n_words bigint, n_removed bigint")
    def removed(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in columns:
            parts = [_removed(part, gone.slice(at, len(part))) for at, part in slices(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    joined = _with_ids(docs, key, text, u, v).join(spans, [u, v], "left")
    done = joined.withColumn(result, removed(quoted(text), F.col(other)))
    names = dict(zip(into, ("kept", "n_words", "n_removed")))
    return done.withColumns({c: F.col(f"{result}.{field}") for c, field in names.items()}).drop(u, v, other, result)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLE = {
    "op2_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT doc_id, unnest(range(1, len(w) - 33)) AS i,
                   unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS g
            FROM w WHERE len(w) >= 35),
        r AS (SELECT doc_id, i FROM s QUALIFY count(*) OVER (PARTITION BY g) > 1),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
        t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
        k AS (SELECT t.*, c.i IS NULL AS kept FROM t LEFT JOIN c USING (doc_id, i)),
        g AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (NOT kept) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (kept) AS text
            FROM k GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(g.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN g USING (doc_id)
    """
}
