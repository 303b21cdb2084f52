"""Similarity self-join on word shingles by PartEnum signatures (Arasu, Ganti, Kaushik, 2006).

Two sets of sizes s and t with a Jaccard similarity of at least J differ in at most
(1-J)/(1+J) * (s+t) elements, and s and t differ by a factor of at most 1/J. Sizes are cut into
bands of that ratio; instance i of the scheme serves the pairs with one set in band i and the other
in band i or i+1, so a set takes part in two instances. An instance hashes the feature domain into
n1 partitions, each into n2 cells. If two sets differ in few enough elements, some partition has at
most k2 differences, hence some choice of n2-k2 of its cells on which both sets agree entirely. The
hash of a set's elements in such a choice of cells is a signature: similar sets share one.

A choice of cells without any element of the set says nothing, and its signature would be shared by
strangers. It is left out wherever the scheme has enough other agreeing partitions to do without
(see `_signatures`), so nothing is lost.

Sets equal in all elements are one class, so copies cost one row each. Signatures of classes travel
packed by signature range. In a bucket of equal signatures up to SMALL members are all paired; in a
larger one its smallest member is paired with the rest. First every class is compared with its
smallest partner, and the links are merged into components. Then only what is still apart is
compared (`_close`): parity sketches of the sets that share a signature meet, those of a large bucket in
blocks of bounded size. Two sketches differ in at most as many bits as the sets differ in elements, so
a pair whose sketches differ in more than similar sets may is ruled out. Of the others a forest, each
class with the nearest of those before it, is verified on its texts first, and the links are
merged; then every pair that shares a signature and is not in one component yet. Every link comes
from an exact comparison, and no candidate is left out.

Defined results: words are runs of bytes other than [\\x20\\x09-\\x0D], A-Z lower-cased; a text with
fewer words than a shingle has its word sequence as its only one; null, empty and blank texts have
no shingle and are linked with nothing. Rows with equal key and text are one document. A null key
is smaller than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import mix, shingle_sets, slices, words_of
from lakepipe.llm.components import connected_components
from lakepipe.llm.frames import LOWER, UPPER, fresh_name, quoted, ship, table
from lakepipe.session import checkpoint, scratch_path, shuffles_removed
from lakepipe.sources.writers import remove

SHINGLE = 5
#: Similarity as a ratio of whole numbers: 80 * |A or B| <= 100 * |A and B|.
SIMILAR, OF = 80, 100
#: Signature ranges are about this many bytes of text.
BUCKET_BYTES = 12 << 20
SMALL, BLOCK = 16, 512
#: A chunk of a family is about BLOCK classes or this many bytes of text, whichever is less; two chunks meet in a block.
CHUNK_BYTES = 16 << 20
#: A signature travels as its bucket and these low bytes; strangers that agree in them cost a comparison.
SIGN_BYTES = 5
#: A parity sketch has this many bits; sketches are made for slices of so much text, and a chunk of them
#: holds SKETCHED times as many classes as one of texts.
SKETCH_BITS, SKETCH_SLICE, SKETCHED = 2048, 1 << 20, 8
#: About so many members of signatures meet in a group; so many of their pairs are compared at a time, by so many
#: words of the sketches first.
PART_ROWS, PAIRS, FIRST_WORDS = 16_384, 1 << 15, 8
#: So often the classes are compared with their nearest only, before all pairs still apart are.
NEAREST_ROUNDS = 1
#: Up to so many narrow rows (some 24 MB) are broadcast to the texts they pick; more are shuffled with them.
BROADCAST_ROWS = 1_000_000
PAIR = ("a", "b", "a_root", "b_root", "apart")


@dataclass(frozen=True)
class Instance:
    """PartEnum parameters for one pair of neighbouring size bands."""

    number: int
    largest: int
    n1: int
    n2: int
    k2: int

    @property
    def choices(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.n2), self.n2 - self.k2))


def band_tops(upto: int) -> list[int]:
    """The largest size of every band: [1..], each at most OF/SIMILAR times its smallest size."""
    tops, low = [], 1
    while low <= upto:
        tops.append(low * OF // SIMILAR)
        low = tops[-1] + 1
    return tops


def differences(s: int, t: int) -> int:
    """The most elements that similar sets of these sizes can differ in."""
    return (OF - SIMILAR) * (s + t) // (OF + SIMILAR)


@lru_cache(maxsize=None)
def instance(number: int) -> Instance:
    """Instance i serves bands i and i+1."""
    low = 1
    for _ in range(number + 1):
        top = low * OF // SIMILAR
        low = top + 1
    largest = low * OF // SIMILAR
    k = differences(largest, largest)
    if k == 0:
        return Instance(number, largest, 1, 1, 0)
    if k <= 5:
        return Instance(number, largest, 1, k + 3, k)
    if k <= 40:
        return Instance(number, largest, k // 2 + 3, 3, 1)
    return Instance(number, largest, k // 2 + 6, 2, 1)


def _signatures(bounds: np.ndarray, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) of some sets given as elements[bounds[i]:bounds[i+1]].

    A partition is poor for a set if one of its choices of cells is empty. A similar pair agrees
    (up to k2 differences) in at least n1 - floor(most differences / (k2+1)) partitions. If a set
    has fewer poor partitions than that, one agreeing partition is not poor for it, and the pair
    shares a signature that isn't empty; only other sets give their empty signatures too.
    """
    sizes = np.diff(bounds)
    tops = np.array(band_tops(int(sizes.max(initial=1))))
    band = np.searchsorted(tops, sizes)
    owners, found = [], []
    for number in np.unique(band[sizes > 0]) if len(sizes) else []:
        for one in {instance(int(number)), instance(max(0, int(number) - 1))}:
            members = np.flatnonzero((band == number) & (sizes > 0))
            owner, sigs = _instance_signatures(one, members, bounds, elements)
            owners.append(owner)
            found.append(sigs)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(found)


def _instance_signatures(one: Instance, members, bounds, elements):
    sizes = bounds[members + 1] - bounds[members]
    local = np.repeat(np.arange(len(members)), sizes)
    own = elements[np.repeat(bounds[members] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
    seeded = mix(own ^ np.uint64(0xA0761D6478BD642F))
    domain = ((seeded >> np.uint64(40)) * np.uint64(one.n1 * one.n2)) >> np.uint64(24)
    cells = one.n1 * one.n2
    cell = local * cells + domain.astype(np.int64)
    order = np.argsort(cell, kind="stable")
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(seeded)[order], dtype=np.uint64)])
    edges = np.searchsorted(cell[order], np.arange(len(members) * cells + 1))
    per_cell = (sums[edges[1:]] - sums[edges[:-1]]).reshape(len(members), one.n1, one.n2)
    counts = np.diff(edges).reshape(len(members), one.n1, one.n2)

    chosen = one.choices
    signs = np.stack([per_cell[:, :, list(c)].sum(axis=2, dtype=np.uint64) for c in chosen], axis=2)
    empty = np.stack([counts[:, :, list(c)].sum(axis=2) == 0 for c in chosen], axis=2)
    place = np.arange(one.n1 * len(chosen), dtype=np.uint64).reshape(1, one.n1, len(chosen))
    signs = mix(signs + mix(place + np.uint64((one.number + 1) << 32)))
    partner = np.minimum(sizes * OF // SIMILAR, one.largest)
    most = (OF - SIMILAR) * (sizes + partner) // (OF + SIMILAR)
    agreeing = one.n1 - most // (one.k2 + 1)
    needs_empty = empty.any(axis=2).sum(axis=1) >= agreeing
    emit = ~empty | needs_empty[:, None, None]
    return np.broadcast_to(members[:, None, None], emit.shape)[emit], signs[emit]


def _class_of(bounds: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """A hash of each whole set: the class of the sets equal to it; 0 stands for the empty set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements + np.uint64(0x51)), dtype=np.uint64)])
    total = sums[bounds[1:]] - sums[bounds[:-1]]
    sizes = np.diff(bounds).astype(np.uint64)
    return np.where(sizes > 0, mix(total ^ mix(sizes)) | np.uint64(1), np.uint64(0)).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, part in slices(batch.column("text")):
            bounds, elements = shingle_sets(words_of(part, lower=True), SHINGLE)
            own = [batch.column(c).slice(at, len(part)) for c in ("key", "text_hash")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(_class_of(bounds, elements)), pa.array(np.diff(bounds))], ["key", "text_hash", "class", "n"]
            )


def _sets_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The ascending shingle hashes of every text."""
    out = []
    for _, part in slices(column.combine_chunks()):
        bounds, elements = shingle_sets(words_of(part, lower=True), SHINGLE)
        out += np.split(elements, bounds[1:-1])
    return out


def _signature_rows(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in slices(batch.column(0)):
                bounds, elements = shingle_sets(words_of(part, lower=True), SHINGLE)
                classes = _class_of(bounds, elements)
                _, first = np.unique(classes, return_index=True)
                lone = np.zeros(len(classes), bool)
                lone[first] = True
                kept = np.repeat(lone, np.diff(bounds))
                new_bounds = np.concatenate([[0], np.cumsum(np.where(lone, np.diff(bounds), 0))])
                owner, signs = _signatures(new_bounds, elements[kept])
                bucket = ((signs >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(bucket.astype(np.int32), kind="stable")
                bucket, signs, owner = bucket[order].astype(np.int32), signs[order], classes[owner[order]]
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(starts[1:], len(bucket))
                low = np.ascontiguousarray(signs).view(np.uint8).reshape(-1, 8)[:, :SIGN_BYTES]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[starts]),
                        pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                        pa.array([owner[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    ["bucket", "signs", "classes"],
                )

    return emit


def _runs(small: int):
    """Pairs (a, b) of classes that share a signature of this bucket, rank -1, and the members (class, sign)
    of signatures that more than `small` classes share, ranked."""

    def find(group: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(group.column("signs").to_pylist()), np.uint8).reshape(-1, SIGN_BYTES)
        signs = np.pad(low, ((0, 0), (0, 8 - SIGN_BYTES))).view("<u8")[:, 0].astype(np.uint64)
        signs |= np.uint64(group.column("bucket")[0].as_py() << 8 * SIGN_BYTES)
        classes = np.frombuffer(b"".join(group.column("classes").to_pylist()), np.int64)
        order = np.argsort(signs, kind="stable")
        ordered = signs[order]
        near = np.zeros(len(ordered), bool)
        near[1:] = ordered[1:] == ordered[:-1]
        near[:-1] |= near[1:]
        signs, classes = ordered[near], classes[order[near]]
        order = np.lexsort((classes, signs))
        signs, classes = signs[order], classes[order]
        fresh = np.ones(len(signs), bool)
        fresh[1:] = (signs[1:] != signs[:-1]) | (classes[1:] != classes[:-1])
        signs, classes = signs[fresh], classes[fresh]
        starts = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]])) if len(signs) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(signs)))
        rank, size = np.arange(len(signs)) - np.repeat(starts, sizes), np.repeat(sizes, sizes)
        pairs_a, pairs_b = [], []
        # Small buckets: every pair. Larger ones: the first member with every other one.
        for step in range(1, small):
            later = np.flatnonzero((rank >= step) & (size <= small))
            pairs_a.append(classes[later - step])
            pairs_b.append(classes[later])
        star = np.flatnonzero((rank > 0) & (size > small))
        pairs_a.append(classes[(np.arange(len(signs)) - rank)[star]])
        pairs_b.append(classes[star])
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        if len(a):
            both = np.unique(np.stack([a, b], axis=1), axis=0)
            a, b = both[:, 0], both[:, 1]
        large, n = np.flatnonzero(size > small), len(a)
        return pa.table(
            {
                "a": pa.array(np.concatenate([a, classes[large]])),
                "b": pa.array(np.concatenate([b, signs[large].view(np.int64)])),
                "rank": pa.array(np.concatenate([np.full(n, -1), rank[large]]).astype(np.int64)),
            }
        )

    return find


class _Copy:
    """A copy of a table in the shared folder, compressed, which cuts the lineage.

    It is dropped once everything that was made from it has been written itself.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, f"jaccard-{name}")
        with shuffles_removed(self.spark):
            df.write.parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def _pick(texts: DataFrame, wanted: DataFrame, on) -> DataFrame:
    """Join the texts with a narrow table that has been written; it is broadcast behind a check of its size."""
    return texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, on)


def _similar(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of some sets are similar to one; all are ascending and none is empty."""
    sizes = np.array([len(x) for x in others])
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    shared = np.add.reduceat((one[at] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
    return OF * shared >= SIMILAR * (len(one) + sizes - shared)


def _verify_stars(group: pa.Table) -> pa.Table:
    """The links (a, b) among rows (a, class, text) that give each class b its partner a; a's own row has a = class."""
    partner, classes = (group.column(c).to_numpy() for c in ("a", "class"))
    sets = _sets_of(group.column("text"))
    centre = {int(classes[i]): i for i in np.flatnonzero(partner == classes)}
    members: dict[int, list[int]] = {}
    for i in np.flatnonzero(partner != classes).tolist():
        members.setdefault(int(partner[i]), []).append(i)
    found_a, found_b = [], []
    for a, own in members.items():
        similar = _similar(sets[centre[a]], [sets[i] for i in own])
        found_b += classes[own][similar].tolist()
        found_a += [a] * int(similar.sum())
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _linked(nearest: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """The similar pairs among (a, b), b unique. A partner of many classes meets them in chunks."""
    counts = nearest.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    parts = F.lit(max(1, -(-nearest.count() // block)))
    sized = counts.select("a", F.ceil(F.col("n") / block).alias("chunks"))
    part = F.pmod(F.xxhash64("a"), parts).alias("part")
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks"))
    members = nearest.join(sized, "a").select("a", F.col("b").alias("class"), part, chunk.alias("chunk"))
    centres = sized.select(
        "a", F.col("a").alias("class"), part, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    rows = _pick(texts, checkpoint(members.unionByName(centres)), "class")
    return rows.groupBy("part", "chunk").applyInArrow(_verify_stars, "a bigint, b bigint")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, size, sketch): bit h(x) of the sketch is flipped for every shingle x of the set.

    Two sketches differ in at most as many bits as the sets differ in elements.
    """
    for batch in batches:
        for at, part in slices(batch.column("text"), SKETCH_SLICE):
            bounds, elements = shingle_sets(words_of(part, lower=True), SHINGLE)
            sizes = np.diff(bounds)
            bit = (mix(elements ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(SKETCH_BITS)).astype(np.int64)
            cell = np.repeat(np.arange(len(sizes)), sizes) * SKETCH_BITS + bit
            odd = (np.bincount(cell, minlength=len(sizes) * SKETCH_BITS) & 1).astype(np.uint8)
            rows = np.packbits(odd.reshape(len(sizes), SKETCH_BITS), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class").slice(at, len(part)),
                    pa.array(sizes.astype(np.int64)),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                ["class", "size", "sketch"],
            )


def _allowed(group: pa.Table) -> tuple[np.ndarray, ...]:
    """(a, b, a_root, b_root, apart) of the pairs a < b of one group that share a signature, are in different
    components, and whose sizes and sketches allow a link; apart is the share of their elements that
    the sketches differ in. A pair that shares several signatures may come several times.

    Members of side 0 and side 1 of a signature are compared with each other, or all of them if there is one side.
    """
    group = group.sort_by("sign")
    sign, classes, roots, sizes, sides = (group.column(c).to_numpy() for c in ("sign", "class", "root", "size", "side"))
    sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(classes), -1)
    starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
    members = np.diff(np.append(starts, len(sign)))
    two = np.logical_or.reduceat(sides > 0, starts) & np.logical_or.reduceat(sides == 0, starts)
    # A member meets those behind it in its signature.
    two, behind = np.repeat(two, members), np.repeat(starts + members, members) - np.arange(len(sign)) - 1
    before, at = np.concatenate([[0], np.cumsum(behind)]), 0
    found = []
    while at < len(sign):
        stop = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        count = behind[at:stop]
        i = np.repeat(np.arange(at, stop), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(before[at:stop] - before[at], count)
        at = stop
        fits = (roots[i] != roots[j]) & ~(two[i] & (sides[i] == sides[j]))
        fits &= OF * np.minimum(sizes[i], sizes[j]) >= SIMILAR * np.maximum(sizes[i], sizes[j])
        i, j = i[fits], j[fits]
        total, apart = sizes[i] + sizes[j], np.zeros(len(i), np.int64)
        # Most strangers differ in too many bits of the first words already.
        for words in (slice(0, FIRST_WORDS), slice(FIRST_WORDS, None)):
            apart += np.bitwise_count(sketches[i, words] ^ sketches[j, words]).sum(axis=1, dtype=np.int64)
            near = apart * (OF + SIMILAR) <= (OF - SIMILAR) * total
            i, j, total, apart = i[near], j[near], total[near], apart[near]
        found.append((i, j, apart / total))
    i, j, apart = (np.concatenate(c) for c in zip(*found))
    turned = classes[i] > classes[j]
    i, j = np.where(turned, j, i), np.where(turned, i, j)
    return classes[i], classes[j], roots[i], roots[j], apart


def _pairs(kept: np.ndarray, columns: tuple[np.ndarray, ...]) -> pa.Table:
    return pa.table({name: pa.array(values[kept]) for name, values in zip(PAIR, columns)})


def _nearest(group: pa.Table) -> pa.Table:
    """Of the pairs a < b that the group allows, the nearest one of each b."""
    found = _allowed(group)
    a, b, *_, apart = found
    order = np.lexsort((a, apart, b))
    return _pairs(order[np.diff(b[order], prepend=b[order[:1]] - 1) != 0], found)


def _screen(group: pa.Table) -> pa.Table:
    """All pairs a < b that the group allows, once each."""
    found = _allowed(group)
    a, b, *_ = found
    order = np.lexsort((a, b))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    return _pairs(order[fresh], found)


def _verify(group: pa.Table) -> pa.Table:
    """The links among rows (class, root, partners, text), with the components they tie: each class is compared
    with its partners.

    Pairs whose components are linked by then are left out.
    """
    classes, own_roots = (group.column(c).to_numpy() for c in ("class", "root"))
    roots = own_roots
    sets, place = _sets_of(group.column("text")), {int(c): i for i, c in enumerate(classes)}
    found_i, found_j = [], []
    for i, partners in enumerate(group.column("partners").to_pylist()):
        near = np.array([place[b] for b in partners], np.int64)
        near = near[roots[near] != roots[i]]
        if not len(near):
            continue
        linked = near[_similar(sets[i], [sets[j] for j in near])]
        for j in linked.tolist():
            if roots[j] != roots[i]:
                found_i.append(i)
                found_j.append(j)
                roots = np.where(roots == roots[j], roots[i], roots)
    i, j = np.array(found_i, np.int64), np.array(found_j, np.int64)
    columns = {"a": classes[i], "b": classes[j], "a_root": own_roots[i], "b_root": own_roots[j]}
    return pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})


def _verified(screened: DataFrame, texts: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The links (a, b, a_root, b_root) among the screened pairs (family, a, a_root, b, b_root), by the texts
    (class, text, bytes).

    The classes of a family that are in a pair are dealt to chunks of about `chunk_bytes` of text. A
    pair is compared where its two chunks meet, and only texts that have a pair there are sent.
    """
    own = screened.select("family", F.explode(F.array("a", "b")).alias("class")).distinct()
    size = own.join(texts.select("class", "bytes"), "class").groupBy("family").agg(F.sum("bytes").alias("bytes"))
    parts = size.select("family", F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk_bytes)).alias("parts"))
    dealt = screened.join(parts, "family").withColumns(
        {c: F.pmod(F.xxhash64(side), F.col("parts")) for c, side in (("x", "a"), ("y", "b"))}
    )
    one = dealt.select("family", "x", "y", F.col("a").alias("class"), F.col("a_root").alias("root"), F.col("b").alias("partner"))
    other = dealt.select(
        "family", "x", "y", F.col("b").alias("class"), F.col("b_root").alias("root"), F.lit(None).cast("bigint").alias("partner")
    )
    rows = one.unionByName(other).groupBy("family", "x", "y", "class", "root")
    rows = checkpoint(rows.agg(F.collect_set("partner").alias("partners")))
    sent = _pick(texts.select("class", "text"), rows, "class")
    return sent.groupBy("family", "x", "y").applyInArrow(_verify, "a bigint, b bigint, a_root bigint, b_root bigint")


def _blocks(members: DataFrame, lengths: DataFrame, block: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Deal the members (family, class, root, and others that are carried) to blocks in which all needed pairs meet.

    `lengths` has (class, bytes). A family of one chunk is one block. In a larger one the classes of
    its largest component need not meet each other. They are dealt to chunks, the others to chunks
    of their own; every chunk of the others meets every chunk of the largest component, and every
    other chunk of the others. A block never holds more than two chunks.
    """
    by_root = (
        members.select("family", "root", "class")
        .join(lengths, "class")
        .groupBy("family", "root")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    )
    families = by_root.groupBy("family").agg(
        F.sum("n").alias("size"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "root", "bytes")).alias("top")
    )

    def chunks(n, size):
        return F.greatest(F.lit(1), F.ceil(n / block), F.ceil(size / chunk_bytes))

    families = families.filter((F.col("size") > block) | (F.col("bytes") > chunk_bytes)).select(
        "family",
        F.col("top.root").alias("top"),
        chunks(F.col("top.n"), F.col("top.bytes")).alias("tops"),
        chunks(F.col("size") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("others"),
    )
    placed = members.join(families, "family", "left")
    own = F.pmod(F.xxhash64("class"), F.col("others"))
    spread = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1),
        lambda j: F.struct(
            F.least(own, j).alias("x"), F.greatest(own, j).alias("y"), (own > j).cast("int").alias("side")
        ),
    )
    # Chunk i of the others and chunk j of the largest component meet in block (-1 - i, j).
    beside = F.transform(
        F.sequence(F.lit(0), F.col("tops") - 1),
        lambda j: F.struct((-1 - own).alias("x"), j.alias("y"), F.lit(0).alias("side")),
    )
    chunk = F.pmod(F.xxhash64("class"), F.col("tops"))
    facing = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1),
        lambda i: F.struct((-1 - i).alias("x"), chunk.alias("y"), F.lit(1).alias("side")),
    )
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), F.lit(0).alias("side")))
    place = (
        F.when(F.col("tops").isNull(), whole)
        .when(F.col("root") == F.col("top"), facing)
        .otherwise(F.concat(spread, beside))
    )
    dealt = placed.withColumn("place", F.explode(place))
    return dealt.select("family", "place.*", *[c for c in members.columns if c != "family"])


def _meetings(opened: DataFrame, sketches: DataFrame, block: int) -> DataFrame:
    """The members (sign, class, root, n) of signatures that n classes share, with their sketches, dealt to groups
    (part, x, y) in which those that share a signature meet.

    A part holds many signatures whole; one of more than `block` classes is cut into blocks of its own.
    """
    parts = max(1, -(-opened.count() // PART_ROWS))
    none = F.lit(0).cast("bigint")
    part = F.pmod(F.xxhash64("sign"), F.lit(parts)).alias("part")
    whole = opened.filter(F.col("n") <= block)
    dealt = whole.select(part, none.alias("x"), none.alias("y"), F.lit(0).alias("side"), "sign", "class", "root")
    wide = opened.filter(F.col("n") > block).select(F.col("sign").alias("family"), "class", "root").distinct()
    if not wide.isEmpty():
        lengths = wide.select("class", F.lit(SKETCH_BITS // 8).cast("bigint").alias("bytes")).distinct()
        # The part depends on the block: a part that is the signature's would keep all its blocks in one task.
        cut = _blocks(wide, lengths, block).withColumns({"sign": F.col("family"), "part": F.xxhash64("family", "x", "y")})
        dealt = dealt.unionByName(cut.select(dealt.columns))
    return dealt.join(sketches, "class")


def _with_family(screened: DataFrame) -> DataFrame:
    """Pairs whose components are tied by pairs are a family."""
    families = connected_components(screened.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct())
    families = families.select(F.col("node").alias("a_root"), F.col("root").alias("family"))
    return screened.join(families, "a_root").select("family", *PAIR[:4])


def _close(
    found: _Copy, pairs: DataFrame, large: DataFrame, texts: DataFrame, links: DataFrame, block: int
) -> DataFrame:
    """Compare what the pairs (a, b) and the large buckets (sign, class), both read from `found`, still hold apart.

    Sketches of the classes that share a signature meet in one group. Only the texts of pairs that
    the sketches don't rule out are sent to be compared: first every class with the nearest of those before
    it, which ties most of what belongs together, then every pair that is still apart. Only links
    come out, those given and the new ones, written.
    """
    roots = connected_components(links).withColumnRenamed("node", "class")
    ties = pairs.select(F.explode(F.array("a", "b")).alias("class"), F.xxhash64("a", "b").alias("sign"))
    ties = ties.unionByName(large).join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    ties = _Copy(ties, "ties")
    found.drop()
    opened = _Copy(_apart(ties.rows), "open")
    ties.drop()
    picked = _pick(texts, opened.rows.select("class").distinct(), "class").select("class", "text")
    sketches = _Copy(picked.mapInArrow(_sketches, "class bigint, size bigint, sketch binary"), "sketches")
    for compared in (*[_nearest] * NEAREST_ROUNDS, _screen):
        groups = _meetings(opened.rows, sketches.rows, block * SKETCHED).groupBy("part", "x", "y")
        met = groups.applyInArrow(compared, "a bigint, b bigint, a_root bigint, b_root bigint, apart double")
        if compared is _nearest:
            least = F.min(F.struct("apart", "a", "a_root", "b_root")).alias("least")
            met = met.groupBy("b").agg(least).select("b", "least.*").select(*PAIR)
        screened = _Copy(met.drop("apart").distinct(), "screened")
        if screened.rows.isEmpty():
            screened.drop()
            break
        closed = checkpoint(_verified(checkpoint(_with_family(screened.rows)), texts))
        screened.drop()
        links = links.unionByName(closed.select("a", "b"))
        if compared is _nearest and not closed.isEmpty():
            merged = _Copy(_merged(opened.rows, closed), "open")
            opened.drop()
            opened = merged
    opened.drop()
    sketches.drop()
    return checkpoint(links)


def _apart(ties: DataFrame) -> DataFrame:
    """The members (sign, class, root, n) of the signatures that different components share, n classes each."""
    by_sign = ties.groupBy("sign").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    )
    return ties.select("sign", "class", "root").join(by_sign.filter("low <> high").select("sign", "n"), "sign")


def _merged(opened: DataFrame, closed: DataFrame) -> DataFrame:
    """What the links leave of the members of signatures; those that have become one component go."""
    ties = closed.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    roots = connected_components(ties).select(F.col("node").alias("root"), F.col("root").alias("low"))
    return _apart(opened.join(roots, "root", "left").withColumn("root", F.coalesce("low", "root")))




def similarity_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", small: int = SMALL, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """(documents, links): (key, text_hash, class, n) of every row, and the links (a, b) between classes.

    The links hold enough of all links to give the components of all.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(quoted(key).alias("key"), F.xxhash64(quoted(text)).alias("text_hash"), quoted(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    described = checkpoint(texts.mapInArrow(_describe, f"key {kind}, text_hash bigint, class bigint, n bigint"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    rows = texts.select("text").mapInArrow(_signature_rows(buckets), "bucket int, signs binary, classes binary")
    found = _Copy(rows.groupBy("bucket").applyInArrow(_runs(small), "a bigint, b bigint, rank bigint"), "runs")

    pairs = found.rows.filter("rank < 0").select("a", "b").distinct()
    large = found.rows.filter("rank >= 0").select(F.col("b").alias("sign"), F.col("a").alias("class"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    # The text of one document of each class that is in a pair; similar sets are made from it again.
    first = (
        described.join(wanted, "class", "left_semi")
        .groupBy("class")
        .agg(F.min(F.struct("key", "text_hash")).alias("doc"))
    )
    same = texts["key"].eqNullSafe(F.col("doc.key")) & (texts["text_hash"] == F.col("doc.text_hash"))
    chosen = _pick(texts, checkpoint(first), same).select("class", "text")
    twice = described.groupBy("key", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        chosen = chosen.dropDuplicates(["class"])
    copy = _Copy(chosen.withColumn("bytes", F.octet_length("text").cast("bigint")), "texts")
    chosen = copy.rows

    # First every class with the smallest partner it has, then what that leaves apart.
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a"))
    links = checkpoint(_linked(nearest, chosen.select("class", "text"), block))
    rest = pairs.join(nearest, ["a", "b"], "left_anti")
    closed = _close(found, rest, large, chosen, links, block)
    copy.drop()
    return described, closed


def components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", small: int = SMALL, block: int = BLOCK
) -> DataFrame:
    """One row per input row: key, text_hash, n (distinct shingles), component (smallest key it is
    connected with), first (whether it is the document of that key)."""
    described, links = similarity_classes(docs, key, text, small, block)
    roots = connected_components(links)
    rooted = described.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    best = F.min(F.struct("key", "text_hash")).alias("best")
    joined = rooted.join(rooted.filter("n > 0").groupBy("root").agg(best), "root", "left")
    own = F.struct("key", "text_hash")
    best = F.when(F.col("n") > 0, F.col("best")).otherwise(own)
    return joined.select(
        "key", "text_hash", "n", best.getField("key").alias("component"), best.eqNullSafe(own).alias("first")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the first of their component, with all their columns.

    Documents without words all stay. Rows that agree in key and text stay or go together.
    """
    gone = components(docs, key, text).filter(~F.col("first")).select(F.struct("key", "text_hash").alias("gone"))
    column, gone_name = fresh_name(docs, "_text_hash"), fresh_name(docs, "_gone")
    gone = gone.distinct().withColumnRenamed("gone", gone_name)
    hashed = docs.withColumn(column, F.xxhash64(quoted(text)))
    same = quoted(key).eqNullSafe(F.col(f"{gone_name}.key")) & (F.col(column) == F.col(f"{gone_name}.text_hash"))
    return hashed.join(gone, same, "left_anti").drop(column)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


QUERIES = {"op6_ngram_jaccard_join": op6_ngram_jaccard_join}
ORACLE = {
    "op6_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                   END AS s
            FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
            FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r AS (SELECT DISTINCT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
        SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(min(r.y), s.doc_id) AS component_id
        FROM s LEFT JOIN r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.s)
    """
}
