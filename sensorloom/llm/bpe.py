"""Byte-level BPE over a corpus: every distinct word of the corpus is encoded once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import staged, text_or_empty
from sensorloom.llm.pieces import (
    block_starts, distinct_pieces, flat, load_ranks, piece_bytes, piece_encoder, take_ranges, text_ranges, utf8,
)

COLUMNS = "block long, bucket int, keys array<{key}>, counts binary, numbers binary, payload binary"


def shrink(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def grow(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def shrink_codes(codes: np.ndarray) -> bytes:
    """Word numbers by falling frequency: the bit length of each, entropy coded, then the bits below its first, as they are."""
    value = codes.astype(np.int64) + 1
    length = (np.frexp(value.astype(np.float64))[1] - 1).astype(np.uint8)
    parts = [zstandard.ZstdCompressor(level=3).compress(length.tobytes())]
    for n in range(1, int(length.max(initial=0)) + 1):
        below = value[length == n] - (1 << n)
        parts.append(np.packbits(((below[:, None] >> np.arange(n)) & 1).astype(np.uint8)).tobytes())
    return len(codes).to_bytes(8, "little") + len(parts[0]).to_bytes(8, "little") + b"".join(parts)


def grow_codes(data: bytes) -> np.ndarray:
    count, size = (int.from_bytes(data[i:i + 8], "little") for i in (0, 8))
    length = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[16:16 + size]) if count else b"", np.uint8)
    value, at = np.left_shift(1, length.astype(np.int64)), 16 + size
    for n in range(1, int(length.max(initial=0)) + 1):
        chosen = np.flatnonzero(length == n)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, (len(chosen) * n + 7) // 8, at), count=len(chosen) * n)
        value[chosen] += bits.reshape(-1, n).astype(np.int64) @ (1 << np.arange(n))
        at += (len(chosen) * n + 7) // 8
    return value - 1


def _packets(block: int, keys: list, data: np.ndarray, offsets: np.ndarray, buckets: int):
    """The rows of a block: its distinct words by bucket with their numbers, and its documents as word numbers in order.

    Numbers go by falling frequency, so that most are small.
    """
    starts = block_starts(data, offsets)
    code, first, hashes = distinct_pieces(data, starts)
    falling = np.argsort(-np.bincount(code, minlength=len(first)), kind="stable")
    number = np.empty(len(first), np.int64)
    number[falling] = np.arange(len(first))
    code = number[code].astype(np.uint32) if len(code) else code.astype(np.uint32)
    words = piece_bytes(data, starts, first[falling])
    bucket = (hashes[falling] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by])) + 1
    for own in np.split(by, cuts) if len(by) else []:
        chosen = [words[i] for i in own.tolist()]
        sizes = np.fromiter(map(len, chosen), np.uint32, len(chosen))
        yield (block, int(bucket[own[0]]), None, shrink(sizes), shrink(np.diff(own, prepend=0)),
               zstandard.ZstdCompressor(level=3).compress(b"".join(chosen)))
    ends = np.searchsorted(starts, offsets)
    for a, b in text_ranges(ends, 1 << 18):
        yield block, -1, keys[a:b], shrink(np.diff(ends[a:b + 1])), None, shrink_codes(code[ends[a]:ends[b]])


def word_packets(docs: DataFrame, text: str, doc_id: str, buckets: int, block_bytes: int) -> DataFrame:
    """Pre-tokens of all texts, exploded to distinct words per block of texts and their positions in its documents.

    Rows with a bucket >= 0 hold words of one hash bucket, rows with bucket -1 hold documents as the numbers of
    their words by position. A block is a run of one task's texts.
    """
    rows = docs.select(F.col(doc_id).alias("key"), text_or_empty(text).alias("text"))
    key = rows.schema["key"].dataType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[key]
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(key_type)), ("counts", pa.binary()),
                        ("numbers", pa.binary()), ("payload", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for a, b in text_ranges(offsets, block_bytes):
                part = _packets(block, keys[a:b], data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], buckets)
                for row in part:
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)
                block += 1

    return rows.mapInArrow(cut, COLUMNS.format(key=key))


def encode_words(packets: DataFrame, ranks: str) -> DataFrame:
    """Word packets to id packets: all blocks' words of a bucket meet in one task, each distinct word is encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, current = piece_encoder(ranks), None
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for block, bucket, sizes, numbers, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    current = bucket
                    known.clear()
                ends = np.cumsum(grow(sizes)).tolist()
                raw = zstandard.ZstdDecompressor().decompress(words)
                ids = []
                for a, b in zip([0, *ends], ends, strict=False):
                    word = raw[a:b]
                    own = known.get(word)
                    if own is None:
                        own = known[word] = single(word)
                    ids.append(own)
                values, _, counts = flat(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([shrink(counts)], pa.binary()),
                     pa.array([numbers], pa.binary()), pa.array([shrink(values)], pa.binary())],
                    ["block", "bucket", "counts", "numbers", "payload"])

    words = packets.where("bucket >= 0").select("block", "bucket", "counts", "numbers", "payload")
    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        encode, "block long, bucket int, counts binary, numbers binary, payload binary")


def reassemble(packets: DataFrame, encoded: DataFrame) -> DataFrame:
    """(id, ids ARRAY<INT>) per document: a block's ids by word number meet its documents, which read them by position."""
    keys = packets.schema["keys"].dataType
    key = keys.elementType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[key]
    both = packets.where("bucket < 0").select("block", F.lit(1).alias("kind"), "keys", "counts", "numbers", "payload").union(
        encoded.select("block", F.lit(0), F.lit(None).cast(keys), "counts", "numbers", "payload"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, table = None, [], None
        for batch in batches:
            for block, kind, keys, counts, numbers, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != current:
                    current, held, table = block, [], None
                if kind == 0:
                    held.append((np.cumsum(grow(numbers), dtype=np.uint32), grow(counts), grow(payload)))
                    continue
                if table is None:
                    empty = [np.zeros(0, np.uint32)]
                    numbers_of, sizes_of, values = (np.concatenate(empty + [h[i] for h in held]) for i in range(3))
                    begins, sizes = np.zeros(len(numbers_of), np.int64), np.zeros(len(numbers_of), np.int64)
                    begins[numbers_of] = np.cumsum(sizes_of, dtype=np.int64) - sizes_of
                    sizes[numbers_of] = sizes_of
                    table, held = (values, begins, sizes), []
                values, begins, sizes = table
                codes, per_doc = grow_codes(payload), grow(counts)
                ids = take_ranges(values, begins[codes], sizes[codes]).astype(np.int32)
                through = np.append(0, np.cumsum(sizes[codes]))
                offsets = through[np.append(0, np.cumsum(per_doc, dtype=np.int64))]
                for a, b in text_ranges(offsets, 1 << 20):
                    part = pa.ListArray.from_arrays(pa.array((offsets[a:b + 1] - offsets[a]).astype(np.int32)),
                                                    pa.array(ids[offsets[a]:offsets[b]]))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a:b], key_type), part], ["id", "ids"])

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(read, f"id {key}, ids array<int>")


def encode(docs: DataFrame, ranks: str, text: str = "text", doc_id: str = "doc_id", block_bytes: int = 32 << 20) -> DataFrame:
    """Ids of every whole text by a byte-level vocabulary: (id, ids ARRAY<INT>), one row per document.

    1. Texts are split into pre-tokens with their positions; per block of about 32 MB a word is kept once.
    2. Distinct words are shuffled by hash, so each word of the corpus meets in one task and is encoded once.
    3. Ids go back to the blocks that asked for them, and documents are put together again by position.

    Frequent words are one row per block and bucket, so no word is a hot key. Word lists and positions
    travel compressed; the packets are staged once, as both the words and the documents are read from them.
    Memory is bounded by a block, or by a text if it is longer. Null texts are empty and have no ids; ids of
    documents may be null or repeat. Other columns are not looked at. An empty table gives an empty result.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packets = staged(word_packets(docs, text, doc_id, max(64, 2 * partitions), block_bytes))
    return reassemble(packets, encode_words(packets, ranks))


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes of an id column by joining the vocabulary's table of token bytes, which is of fixed size.

    Null ids give null, an empty array gives empty bytes, and an id that the table does not have is an error.
    """
    others = [f for f in encoded.schema.fields if f.name != into]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others) + f", `{into}` binary"
    at = [f.name for f in others].index(ids)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_ranks(ranks)
        size = max(table.values()) + 1
        tokens: list[bytes | None] = [None] * size
        for token, rank in table.items():
            tokens[rank] = token
        values = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)
        sizes = np.array([len(t or b"") for t in tokens], np.int64)
        begins = np.cumsum(sizes) - sizes
        for batch in batches:
            column = batch.column(at)
            flat_ids = column.flatten().to_numpy(zero_copy_only=False)
            if len(flat_ids) and (flat_ids.min() < 0 or flat_ids.max() >= size or not sizes[flat_ids].all()):
                raise ValueError("an id is not in the vocabulary")
            lengths = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
            offsets, null, out = np.append(0, np.cumsum(lengths)), column.is_null().to_pylist(), []
            for a, b in text_ranges(offsets, 1 << 19):
                own = flat_ids[offsets[a]:offsets[b]]
                text = take_ranges(values, begins[own], sizes[own]).tobytes()
                ends = np.append(0, np.cumsum(sizes[own]))[offsets[a:b + 1] - offsets[a]].tolist()
                out += [None if z else text[x:y] for x, y, z in zip(ends[:-1], ends[1:], null[a:b], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, into])

    return encoded.select(*[F.col(f"`{f.name}`") for f in others]).mapInArrow(join, schema)
