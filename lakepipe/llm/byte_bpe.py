"""Byte-level byte-pair encoding and decoding with the rank files of public tokenizers.

A text is split by a pattern into pieces. Inside a piece the pair of neighbouring tokens with the
lowest rank is merged, the leftmost one of equal ranks, until no pair has a rank. A segment tree
over the piece's byte positions holds at every node the smallest (rank, position) below it; its root
is the next merge. A merge changes three positions (the merged token, the one it swallowed, and the
one before it), so it costs three updates of logarithmic length; `before` and `after` link the
positions that still start a token.

`SegmentTree` does this for one piece of any length. Pieces of up to SHORT bytes, nearly all there
are, run as a forest: trees of equal size advance one merge at a time together in numpy. A worker
keeps the ids of a bounded number of distinct pieces.

Defined results: a null or empty text has no tokens and decodes to no bytes; null ids decode to
null; an id outside the vocabulary is an error. Special tokens are ordinary text. Every other column
stays as it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import gather, slices
from lakepipe.llm.frames import quoted, ship, table
from lakepipe.llm.pieces import PieceCache

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
SHORT, CELLS = 64, 1 << 17
#: Texts are encoded in pieces of so many bytes, ids decoded so many at a time.
ENCODE_BYTES, DECODE_IDS = 1 << 20, 1 << 18
NONE = 1 << 40

# The letters, numbers and white space among the first 256 code points. With them the
# usual pattern can be written for the standard library's faster matcher.
_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


class Ranks:
    """A vocabulary: bytes to rank (which is the token's id), and the rank of every mergeable pair."""

    def __init__(self, file: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}
        self.bytes = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        ordered = sorted(self.rank.items(), key=lambda x: x[1])
        lengths = np.zeros(ordered[-1][1] + 1, np.int64)
        for token, rank in ordered:
            lengths[rank] = len(token)
        self.token_length, self.token_start = lengths, np.cumsum(lengths) - lengths
        self.token_bytes = np.frombuffer(b"".join(t for t, _ in ordered), np.uint8)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)


class SegmentTree:
    """The merges of one piece."""

    def __init__(self, ranks: Ranks, piece: bytes):
        self.ranks, n = ranks, len(piece)
        self.size = 1 << max(0, (n - 1).bit_length())
        self.ids = [int(ranks.bytes[b]) for b in piece]
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        self.tree = [(NONE, 0)] * (2 * self.size)
        for i in range(n):
            self.tree[self.size + i] = (self._rank(i), i)
        for node in range(self.size - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def _rank(self, i: int) -> int:
        j = self.after[i]
        return self.ranks.pairs.get(self.ids[i] << 32 | self.ids[j], NONE) if j < len(self.ids) else NONE

    def _update(self, i: int, rank: int) -> None:
        node = self.size + i
        self.tree[node] = (rank, i)
        while node > 1:
            node >>= 1
            low = min(self.tree[2 * node], self.tree[2 * node + 1])
            if low == self.tree[node]:
                break
            self.tree[node] = low

    def merge(self) -> list[int]:
        while self.tree[1][0] < NONE:
            rank, left = self.tree[1]
            gone = self.after[left]
            self.ids[left], self.after[left] = rank, self.after[gone]
            if self.after[gone] < len(self.ids):
                self.before[self.after[gone]] = left
            self._update(gone, NONE)
            self._update(left, self._rank(left))
            if self.before[left] >= 0:
                self._update(self.before[left], self._rank(self.before[left]))
        out, i = [], 0
        while i < len(self.ids):
            out.append(self.ids[i])
            i = self.after[i]
        return out


def merge_forest(ranks: Ranks, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, tokens per piece) of pieces of at most `size` bytes, a power of two: a tree for each."""
    rows = len(pieces)
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
    length = np.array([len(p) for p in pieces], np.int64)
    place = np.arange(size)
    starts_token = place < length[:, None]
    # One more column stands for the end of the piece; its id is in no pair.
    ids = np.full((rows, size + 1), (1 << 31) - 1, np.int64)
    ids[:, :size][starts_token] = ranks.bytes[raw[starts_token]]
    after = np.minimum(np.broadcast_to(place + 1, (rows, size)), length[:, None])
    before = np.broadcast_to(np.concatenate([place - 1, [0]]), (rows, size + 1)).copy()
    after = np.where(after >= length[:, None], size, after)
    tree = np.full((rows, 2 * size), NONE * size, np.int64)
    first = np.where(starts_token, ranks.pair(ids[:, :size], np.take_along_axis(ids, after, 1)), NONE)
    tree[:, size:] = first * size + place
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def update(rows, position, rank):
        node = position + size
        tree[rows, node] = rank * size + position
        while size > 1 and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    busy = np.flatnonzero(tree[:, 1] < NONE * size)
    while len(busy):
        rank, left = np.divmod(tree[busy, 1], size)
        gone = after[busy, left]
        beyond = after[busy, gone]
        ids[busy, left], after[busy, left], before[busy, beyond] = rank, beyond, left
        starts_token[busy, gone] = False
        update(busy, gone, np.full(len(busy), NONE))
        update(busy, left, ranks.pair(rank, ids[busy, beyond]))
        previous = before[busy, left]
        has = np.flatnonzero(previous >= 0)
        if len(has):
            r, q = busy[has], previous[has]
            update(r, q, ranks.pair(ids[r, q], rank[has]))
        busy = busy[tree[busy, 1] < NONE * size]
    return ids[:, :size][starts_token], starts_token.sum(axis=1)


class Encoder(PieceCache):
    """Texts to ids."""

    def __init__(self, file: bytes, pattern: str):
        super().__init__()
        self.ranks, self.pattern = Ranks(file), regex.compile(pattern)
        self.latin = re.compile(LATIN_PATTERN) if pattern == public_tokenizers.PATTERN else None

    def split(self, text: str) -> list[str]:
        if self.latin is not None:
            try:
                text.encode("latin-1")
                return self.latin.findall(text)
            except UnicodeEncodeError:
                pass
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Whole tokens by look-up, short pieces as forests, long ones one by one."""
        encoded = [p.encode() for p in pieces]
        whole = list(map(self.ranks.rank.get, encoded))
        classes: dict[int, list[int]] = {}
        for i, (piece, rank) in enumerate(zip(encoded, whole)):
            kind = 0 if rank is not None else -1 if len(piece) > SHORT else 1 << (len(piece) - 1).bit_length()
            classes.setdefault(kind, []).append(i)
        order, counts, ids = [], [], []
        for kind, members in classes.items():
            step = max(1, CELLS // kind) if kind > 0 else len(members)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                if kind == 0:
                    found, own = np.array([whole[i] for i in part], np.int64), np.ones(len(part), np.int64)
                elif kind > 0:
                    found, own = merge_forest(self.ranks, [encoded[i] for i in part], kind)
                else:
                    trees = [SegmentTree(self.ranks, encoded[i]).merge() for i in part]
                    found = np.concatenate([np.array(t, np.int64) for t in trees])
                    own = np.array([len(t) for t in trees], np.int64)
                order += part
                counts.append(own)
                ids.append(found.astype(np.int32))
        return order, np.concatenate(ids), np.concatenate(counts)


@lru_cache(maxsize=2)
def _encoder(file: bytes, pattern: str) -> Encoder:
    return Encoder(file, pattern)


def _rank_file(path: str | None) -> bytes:
    with open(path or public_tokenizers.path(RANKS_FILE), "rb") as f:
        return f.read()


def encode(
    docs: DataFrame,
    text: str = "text",
    into: str = "ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Add the token ids of a text as an array<int>; a column of that name is replaced.

    The rank file is read by the driver and broadcast; its size is the vocabulary's.
    """
    ship(docs.sparkSession)
    file = docs.sparkSession.sparkContext.broadcast(_rank_file(path))

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(file.value, pattern)
        for column in columns:
            parts = [pa.array([], pa.list_(pa.int32()))]
            for _, part in slices(column, ENCODE_BYTES):
                found, bounds = encoder.encode(part.to_pylist())
                parts.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found)))
            yield pa.concat_arrays(parts)

    return docs.withColumn(into, ids(quoted(text)))


def _decoded(ranks: Ranks, column: pa.Array, counts: np.ndarray) -> pa.Array:
    tokens = column.flatten().to_numpy(zero_copy_only=False)
    if len(tokens) and (tokens.min() < 0 or tokens.max() >= len(ranks.token_length)):
        raise ValueError("an id is outside the vocabulary")
    length = ranks.token_length[tokens]
    data = gather(ranks.token_bytes, ranks.token_start[tokens], length)
    ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]
    out = pa.Array.from_buffers(
        pa.large_binary(), len(column), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())
    return pc.if_else(column.is_valid(), out, None) if column.null_count else out


def decode(df: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the bytes that an array of ids stands for; a column of that name is replaced."""
    ship(df.sparkSession)
    file = df.sparkSession.sparkContext.broadcast(_rank_file(path))

    @F.arrow_udf("binary")
    def content(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = _encoder(file.value, public_tokenizers.PATTERN).ranks
        for column in columns:
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at, parts = np.cumsum(counts), 0, [pa.array([], pa.binary())]
            while at < len(column):
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + DECODE_IDS, side="right")))
                parts.append(_decoded(ranks, column.slice(at, to - at), counts[at:to]))
                at = to
            yield pa.concat_arrays(parts)

    return df.withColumn(into, content(quoted(ids)))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decode(encoded).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLE: dict[str, str] = {}
