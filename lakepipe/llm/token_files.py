"""Token ids as binary files of patched frame-of-reference blocks.

A file holds the documents of one range of keys, in ascending order of key. Its layout, all numbers
little-endian:

    magic, part, documents, ids, blocks     8 bytes each; files in order of `part` are the data set
    has key, key, ids of the document       1 + 8 + 8 bytes for every document, as three columns
    block starts                            8 bytes for every block and one for the end
    blocks of BLOCK ids: minimum (4), width (1), exceptions (2), BLOCK values of `width` bits,
        places (2 each) and values (4 each) of the exceptions

A block stores every id less the block's minimum in as many bits as PERCENTILE percent of its ids
need; larger ones are exceptions, listed with their full value. The last block is filled up with
its last id. Block starts make every id reachable without reading the file from its start.

Files are written through Spark's writer, one for each range partition or several where its texts
are longer than usual, so any file system Spark knows will do and a lost executor's files are
written again; the writer ends each with a line feed.

Defined results: a null or empty text has no ids but the end id. A null key comes before all others.
Rows of equal keys are ordered by a hash of their texts, so repeated rows stand together. Without
rows there is a file without documents, or none. Keys are integers; other columns play no role.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from lakepipe.llm.arrays import gather, slices
from lakepipe.llm.frames import quoted, ship, table
from lakepipe.llm.pieces import KEEP, PieceCache
from lakepipe.session import scratch_path

TOKENIZER_FILE, END_ID = "word_bpe_49k.json", 1
BLOCK, PERCENTILE = 1024, 90
MAGIC = int.from_bytes(b"pforids1", "little")
#: A file holds the ids of about this many bytes of text; they are encoded and packed a slice at a time.
FILE_BYTES, SLICE = 16 << 20, 2 << 20
_GROUP, _WORDS, _JOINED = 64, 4096, 128
#: A small letter, and the ASCII punctuation that ends the word after it; an apostrophe may start a piece with letters.
_TAIL = re.compile(r"(.*[a-z\u00E0-\u00F6\u00F8-\u00FF])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(blocks, starts) of some ids; starts has the place of every block and the end."""
    count = -(-len(ids) // BLOCK)
    grid = np.full(count * BLOCK, ids[-1] if len(ids) else 0, np.int64)
    grid[: len(ids)] = ids
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1) if count else np.zeros(0, np.int64)
    rest = grid - low[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    usual = np.partition(rest, rank, axis=1)[:, rank]
    width = np.frexp(usual.astype(np.float64))[1].astype(np.int64)
    odd = rest >> width[:, None] > 0
    odds = odd.sum(axis=1)
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        members = np.flatnonzero(width == w)
        for at in range(0, len(members), _GROUP):
            part = members[at : at + _GROUP]
            if w == 16:  # whole bytes, lowest first
                rows = rest[part].astype("<u2").view(np.uint8)
            else:
                bits = (rest[part][:, :, None] >> np.arange(w)) & 1
                rows = np.packbits(bits.astype(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
            for i, row in zip(part, rows):
                packed[i] = row.tobytes()
    blocks = []
    for i in range(count):
        head = int(low[i]).to_bytes(4, "little") + int(width[i]).to_bytes(1, "little") + int(odds[i]).to_bytes(2, "little")
        places = np.flatnonzero(odd[i])
        blocks.append(head + packed[i] + places.astype("<u2").tobytes() + grid[i, places].astype("<u4").tobytes())
    sizes = np.array([len(b) for b in blocks], np.int64)
    return b"".join(blocks), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def unpack_blocks(data: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """The ids of blocks that begin at `starts` in `data`."""
    count = len(starts) - 1
    grid = np.zeros((count, BLOCK), np.int64)
    heads = data[starts[:-1, None] + np.arange(7)].astype(np.int64) if count else np.zeros((0, 7), np.int64)
    low = heads[:, :4] @ (1 << np.arange(0, 32, 8))
    width, odds = heads[:, 4], heads[:, 5] | heads[:, 6] << 8
    for w in np.unique(width):
        members = np.flatnonzero(width == w)
        for at in range(0, len(members), _GROUP):
            part = members[at : at + _GROUP]
            rows = data[starts[part, None] + 7 + np.arange(BLOCK * w // 8)]
            if w == 16:
                grid[part] = rows.view("<u2")
                continue
            bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
            grid[part] = bits.astype(np.int64) @ (1 << np.arange(w, dtype=np.int64)) if w else 0
    grid += low[:, None]
    for i in np.flatnonzero(odds):
        at, n = starts[i] + 7 + BLOCK * width[i] // 8, odds[i]
        places = data[at : at + 2 * n].tobytes()
        values = data[at + 2 * n : at + 6 * n].tobytes()
        grid[i, np.frombuffer(places, "<u2")] = np.frombuffer(values, "<u4")
    return grid.reshape(-1)[:total]


class FileBuilder:
    """One file, packed block by block as its documents come."""

    def __init__(self, part: int):
        self.part = part
        self.keys: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.blocks: list[bytes] = []
        self.starts: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.rest = np.zeros(0, np.int32)
        self.total = self.text_bytes = 0

    def _pack(self, ids: np.ndarray) -> None:
        blocks, starts = pack_blocks(ids)
        self.starts.append(starts[1:] + self.starts[-1][-1])
        self.blocks.append(blocks)

    def add(self, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray, text_bytes: int) -> None:
        self.keys.append(keys)
        self.lengths.append(lengths)
        self.total, self.text_bytes = self.total + len(ids), self.text_bytes + text_bytes
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        if whole:
            self._pack(ids[:whole])
        self.rest = ids[whole:].copy()

    def content(self) -> bytes:
        if len(self.rest):
            self._pack(self.rest)
            self.rest = self.rest[:0]
        keys, starts = pa.concat_arrays(self.keys), np.concatenate(self.starts)
        head = np.array([MAGIC, self.part, len(keys), self.total, len(starts) - 1], "<i8").tobytes()
        known = keys.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
        numbers = keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
        lengths = np.concatenate(self.lengths).astype("<i8").tobytes()
        return b"".join([head, known, numbers, lengths, starts.astype("<i8").tobytes(), *self.blocks])


def read_file(content: bytes) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """(part, keys, ids per document, ids) of a file."""
    magic, part, documents, total, blocks = np.frombuffer(content, "<i8", 5).tolist()
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    at = 40
    known = np.frombuffer(content, np.uint8, documents, at)
    keys = np.frombuffer(content, "<i8", documents, at + documents)
    lengths = np.frombuffer(content, "<i8", documents, at + 9 * documents)
    starts = np.frombuffer(content, "<i8", blocks + 1, at + 17 * documents)
    data = np.frombuffer(content, np.uint8)[at + 17 * documents + 8 * (blocks + 1) :]
    return part, [k if ok else None for k, ok in zip(keys.tolist(), known)], lengths, unpack_blocks(data, starts, total)


class WordEncoder(PieceCache):
    """Ids by the tokenizers library, which gets every distinct word once.

    The tokenizer drops white space and treats no two words together, so the ids of a text are those
    of its words; words here end at ASCII white space only. It also lower-cases, and takes letters
    and the punctuation after them apart, so doing that first gives the same ids and makes fewer
    words differ. Texts that may spell special tokens are left as they are. Arrow splits all texts of
    a slice, numbers their distinct words and looks them up in a table of the words met most often;
    only words that it lacks are taken apart and encoded.
    """

    def __init__(self, definition: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        # Word i has word_ids[word_start[i]:][:word_length[i]].
        self.words = pa.array([], pa.string())
        self.word_ids = np.zeros(0, np.int32)
        self.word_start = self.word_length = self.met = np.zeros(0, np.int64)
        # Ids that end a piece, if the vocabulary tells; only letters make pieces of a whole word.
        model = json.loads(definition)["model"]
        suffix, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
        self.ending = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ending[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def split(self, text: str) -> list[str]:
        """One or two pieces of a word: punctuation at its end stands by itself."""
        if text.isalpha() or "<|" in text:
            return [text]
        tail = _TAIL.fullmatch(text)
        return list(tail.groups()) if tail else [text] if text else []

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        special = pc.match_substring(texts, "<|")
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        ends, words = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        place, distinct = words.indices.to_numpy(), words.dictionary
        at = self._places(distinct)
        self.met += np.bincount(at[place], minlength=len(self.met))
        length = self.word_length[at][place]
        before = np.concatenate([[0], np.cumsum(length)])
        return gather(self.word_ids, self.word_start[at][place], length), before[ends]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """The places of some different words in the table of whole words, which learns those it lacks."""
        at = pc.index_in(distinct, self.words)
        if at.null_count and len(self.words) + at.null_count > KEEP:
            kept = np.sort(np.argsort(-self.met, kind="stable")[: KEEP // 2])
            self.words = self.words.take(pa.array(kept))
            self.word_ids = gather(self.word_ids, self.word_start[kept], self.word_length[kept])
            self.word_length, self.met = self.word_length[kept], self.met[kept] // 2
            self.word_start = np.cumsum(self.word_length) - self.word_length
            at = pc.index_in(distinct, self.words)
        if at.null_count:
            new = distinct.filter(at.is_null())
            ids, bounds = super().encode(new.to_numpy(zero_copy_only=False).tolist())
            known = len(self.words)
            self.words = pa.concat_arrays([self.words, new])
            self.word_start = np.concatenate([self.word_start, len(self.word_ids) + bounds[:-1]])
            self.word_length = np.concatenate([self.word_length, np.diff(bounds)])
            self.word_ids = np.concatenate([self.word_ids, ids])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
            found = at.fill_null(0).to_numpy().astype(np.int64)
            found[at.is_null().to_numpy(zero_copy_only=False)] = known + np.arange(len(new))
            return found
        return at.to_numpy().astype(np.int64)

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, ids per word) of words of letters, each in its own Encoding no more: a text of many is encoded.

        A word has at least one piece, and every piece ends with an id that ends a word; if there are
        as many of those as words, each word is one piece. Otherwise there is no result.
        """
        joined = [" ".join(words[at : at + _JOINED]) for at in range(0, len(words), _JOINED)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.array([i for own in found for i in own], np.int32)
        ends = np.flatnonzero(self.ending[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else None

    def encode_pieces(self, words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        letters = [i for i, w in enumerate(words) if w.isalpha()] if self.ending.any() else []
        others = [i for i, w in enumerate(words) if not w.isalpha()] if letters else list(range(len(words)))
        ids, length, order = [], [], []
        for at in range(0, len(letters), _WORDS):
            part = letters[at : at + _WORDS]
            found = self._encode_letters([words[i] for i in part])
            if found is None:
                others += part
                continue
            order += part
            ids.append(found[0])
            length.append(found[1])
        _, own, sizes = self._encode_each([words[i] for i in others])
        return order + others, np.concatenate([*ids, own]), np.concatenate([*length, sizes])

    def _encode_each(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        ids, length = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        # The library's results are large objects: few are alive at a time.
        for at in range(0, len(pieces), _WORDS):
            part = pieces[at : at + _WORDS]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            ids.append(np.array([i for own in found for i in own], np.int32))
            length.append(np.array(list(map(len, found)), np.int64))
        return list(range(len(pieces))), np.concatenate(ids), np.concatenate(length)


@lru_cache(maxsize=1)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def write_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID
) -> None:
    """Encode every text, append the end id, and write the files to a new folder."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer or public_tokenizers.path(TOKENIZER_FILE), encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    rows = docs.select(
        quoted(key).cast("bigint").alias("key"), quoted(text).alias("text"), F.xxhash64(quoted(text)).alias("tie")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // FILE_BYTES))
    ordered = rows.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = _encoder(definition.value), TaskContext.get().partitionId() << 32
        file, number = FileBuilder(first), 0
        for batch in batches:
            for at, part in slices(batch.column("text"), SLICE):
                if file.text_bytes >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], ["content"])
                    number += 1
                    file = FileBuilder(first + number)
                found, bounds = encoder.encode(part)
                ids = np.insert(found, bounds[1:], end_id)
                file.add(batch.column("key").slice(at, len(part)), np.diff(bounds) + 1, ids, part.nbytes)
        if file.keys:
            yield pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], ["content"])

    written = ordered.mapInArrow(files, "content binary").select(F.col("content").cast("string"))
    # Each row becomes a file of its own.
    written.write.option("maxRecordsPerFile", 1).text(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids, ids_crc32) of every document; start counts the ids of all before it.

    `ids` leaves the ids themselves out where only their numbers and checksums are wanted.
    """
    ship(spark)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                part, keys, lengths, found = read_file(content.as_py())
                ends = np.cumsum(lengths)
                little = found.astype("<u4")
                sums = [zlib.crc32(little[e - n : e].tobytes()) for e, n in zip(ends, lengths)]
                columns = [
                    pa.array([part] * len(keys), pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(ends - lengths),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ]
                if ids:
                    bounds = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part bigint, key bigint, inside bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    names = [c.split()[0] for c in schema.split(", ")]
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(content.as_buffer(), "<i8", 5) for content in batch.column("content")]
            yield pa.RecordBatch.from_arrays([pa.array([int(h[i]) for h in found]) for i in (1, 3)], ["part", "size"])

    stored = spark.read.format("binaryFile").load(path).select("content")
    rows = stored.mapInArrow(documents, schema)
    # One row for each file.
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = stored.mapInArrow(heads, "part bigint, size bigint")
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    joined = rows.join(parts, "part").withColumn("start", F.col("before") + F.col("inside"))
    return joined.select("key", "start", "n_tokens", *["ids"] * ids, "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, ids=False).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


QUERIES = {"op9_token_files": op9_token_files}
ORACLE: dict[str, str] = {}
