"""Packing of tokenised documents into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import text_or_empty
from sensorloom.llm.pieces import block_starts, distinct_pieces, flat, piece_bytes, piece_encoder, take_ranges, text_ranges, utf8


class BlockTokenizer:
    """Ids of a byte-level BPE tokenizer file for blocks of texts; each distinct piece of a block is merged once.

    Texts that hold a special token of the file go to the tokenizer itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as text:
            self.special = [t["content"].encode() for t in json.load(text)["added_tokens"]]
        self.path, self.single = path, piece_encoder(path)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        starts = block_starts(data, offsets)
        code, first, _ = distinct_pieces(data, starts)
        values, begins, sizes = flat([self.single(p) for p in piece_bytes(data, starts, first)])
        ids = take_ranges(values, begins[code], sizes[code]) if len(code) else values
        ends = np.append(0, np.cumsum(sizes[code]))[np.searchsorted(starts, offsets)]
        out = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        raw = data.tobytes()
        if any(token in raw for token in self.special):
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(self.path)
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if any(token in raw[a:b] for token in self.special):
                    out[i] = np.array(whole.encode(raw[a:b].decode(), add_special_tokens=False).ids, np.uint32)
        return out


def multiway_difference(sizes: list[int], k: int) -> np.ndarray:
    """Assign items to k windows of near-equal sums by Karmarkar-Karp multiway differencing.

    A partial partition is k sums, of which only those above the smallest possible count. The two partial
    partitions with the largest spread are merged again and again, the largest sums of one with the
    smallest of the other, and the common part is taken off. Which items a sum holds is a tree of merges,
    resolved at the end.
    """
    n = len(sizes)
    if n == 0 or k == 1:
        return np.zeros(n, np.int64)
    parts = {i: (np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes)}
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merged_a, merged_b, nodes, label = [], [], n, n
    while len(heap) > 1:
        a, b = parts.pop(heapq.heappop(heap)[1]), parts.pop(heapq.heappop(heap)[1])
        over = max(0, len(a[0]) + len(b[0]) - k)
        cut_a, cut_b = len(a[0]) - over, len(b[0]) - over
        sums = np.concatenate([a[0][:cut_a], b[0][:cut_b], a[0][cut_a:] + b[0][cut_b:][::-1]])
        refs = np.concatenate([a[1][:cut_a], b[1][:cut_b], np.arange(nodes, nodes + over)])
        merged_a.append(a[1][cut_a:])
        merged_b.append(b[1][cut_b:][::-1])
        nodes += over
        order = np.argsort(-sums, kind="stable")
        sums, refs = sums[order], refs[order]
        if len(sums) == k:
            sums = sums - sums[-1]
        parts[label] = (sums, refs)
        heapq.heappush(heap, (-int(sums[0]), label))
        label += 1
    refs = parts.popitem()[1][1]
    window = np.full(nodes, -1, np.int64)
    window[refs] = np.arange(len(refs))
    at = nodes
    for a, b in zip(reversed(merged_a), reversed(merged_b), strict=True):
        own = window[at - len(a):at]
        window[a] = own
        window[b] = own
        at -= len(a)
    return window[:n]


def _cut(doc: np.ndarray, start: np.ndarray, length: np.ndarray, size: int):
    """Cut pieces into grains of `size`; what is left of each piece comes last, apart."""
    whole = length // size
    of = np.repeat(np.arange(len(doc)), whole)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(whole) - whole, whole)
    rest = length % size > 0
    return (doc[of], start[of] + nth * size), (doc[rest], (start + whole * size)[rest], (length % size)[rest])


def plan_windows(tokens: np.ndarray, capacity: int = 2048, grain: int = 128, slack: int = 3):
    """Pieces of documents of `tokens` ids each: (doc, start, length, sequence, offset), sorted, and the number of sequences.

    Whole windows of one document stand alone. Of the rest, a few ids (what exceeds a multiple of the
    capacity, and `slack` for each window) fill sequences of exactly 2048 or a smaller power of two ids,
    which need no padding. The others are cut into grains and odd ends, the odd ends and some
    grains cut small go through multiway differencing, equal grains are dealt evenly. If a window
    exceeds the capacity, the number of windows rises and the differencing is done again.
    """
    tokens = np.asarray(tokens, np.int64)
    docs = np.arange(len(tokens))
    (doc, start), (rest_doc, rest_start, rest) = _cut(docs, np.zeros_like(tokens), tokens, capacity)
    sequences = len(doc)
    out = [(doc, start, np.full(len(doc), capacity), np.arange(len(doc)))]
    total = int(rest.sum())
    k = total // capacity
    body = max(0, k * (capacity - slack))
    # The ids after `body` of all rests in a row, cut at the ends of documents and of sequences.
    ends, marks, left = np.cumsum(rest), [body], total - body
    while left:
        marks.append(marks[-1] + min(capacity, 1 << (left.bit_length() - 1)))
        left = total - marks[-1]
    if total:
        edges = np.unique(np.concatenate([[0], ends, marks]))
        edges = edges[edges <= total]
        of = np.searchsorted(ends, edges[:-1], "right")
        p_doc, p_len = rest_doc[of], np.diff(edges)
        p_start = rest_start[of] + edges[:-1] - (ends[of] - rest[of])
        tail = edges[:-1] >= body
        if tail.any():
            out.append((p_doc[tail], p_start[tail], p_len[tail], sequences + np.searchsorted(marks, edges[:-1][tail], "right") - 1))
            sequences += len(marks) - 1
        p_doc, p_start, p_len = p_doc[~tail], p_start[~tail], p_len[~tail]
        (g_doc, g_start), (o_doc, o_start, o_len) = _cut(p_doc, p_start, p_len, grain)
        small = min(len(g_doc), max(8, k // 8))
        fine = []
        step = grain
        while step > 1:
            step //= 2
            fine.append(step)
        fine.append(grain - sum(fine))
        f_len = np.tile(fine, small)
        f_doc = np.repeat(g_doc[len(g_doc) - small:], len(fine))
        f_start = np.repeat(g_start[len(g_start) - small:], len(fine)) + np.tile(np.cumsum(fine) - fine, small)
        g_doc, g_start = g_doc[:len(g_doc) - small], g_start[:len(g_start) - small]
        while k:
            even = len(g_doc) // k
            dealt = even * k
            i_doc = np.concatenate([o_doc, f_doc, g_doc[dealt:]])
            i_start = np.concatenate([o_start, f_start, g_start[dealt:]])
            i_len = np.concatenate([o_len, f_len, np.full(len(g_doc) - dealt, grain)])
            window = multiway_difference(i_len.tolist(), k)
            if np.bincount(window, i_len, k).max(initial=0) + even * grain <= capacity:
                out.append((np.concatenate([i_doc, g_doc[:dealt]]), np.concatenate([i_start, g_start[:dealt]]),
                            np.concatenate([i_len, np.full(dealt, grain)]),
                            sequences + np.concatenate([window, np.repeat(np.arange(k), even)])))
                sequences += k
                break
            k += 1
    doc, start, length, sequence = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((start, doc, sequence))
    doc, start, length, sequence = doc[order], start[order], length[order], sequence[order]
    if len(doc):
        # Neighbouring pieces of one document in one sequence are one piece.
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (sequence[1:] != sequence[:-1]) | (start[1:] != start[:-1] + length[:-1])
        length = np.add.reduceat(length, np.flatnonzero(new))
        doc, start, sequence = doc[new], start[new], sequence[new]
    before = np.cumsum(length) - length
    first = np.searchsorted(sequence, sequence, "left")
    used, sequence = np.unique(sequence, return_inverse=True)  # numbers without gaps
    return doc, start, length, sequence, before - before[first] if len(doc) else before, len(used)


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", capacity: int = 2048,
         end_id: int = 1, block_tokens: int = 1 << 20) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` ids; one row per piece.

    (id, start, length, ids BINARY of little-endian unsigned 32-bit ids, doc_tokens, sequence_id, offset). Each
    task packs what it reads in blocks of about `block_tokens` ids, so nothing is shuffled, memory is
    bounded by a block and the longest document, and no key can crowd a task. Sequence numbers are
    (partition, number), unique in the result and the same when a task runs again on the same rows.

    A null or empty text is one `end_id`; ids may be null or repeat, each row is a document of its own.
    Other columns are not looked at. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BlockTokenizer(tokenizer)
        base = TaskContext.get().partitionId() << 33
        held: list[bytes] = []
        ids: list = []
        size = 0

        def flush():
            nonlocal base
            tokens = np.array([len(x) // 4 for x in held], np.int64)
            doc, start, length, sequence, offset, n = plan_windows(tokens, capacity)
            at = range(0, len(doc), 8192)
            for a in at:
                d, s, m = doc[a:a + 8192], start[a:a + 8192], length[a:a + 8192]
                cut = [held[i][4 * x:4 * (x + y)] for i, x, y in zip(d.tolist(), s.tolist(), m.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in d.tolist()], id_type), pa.array(s), pa.array(m), pa.array(cut, pa.binary()),
                    pa.array(tokens[d]), pa.array(base + sequence[a:a + 8192]), pa.array(offset[a:a + 8192])], names)
            base += n
            held.clear()
            ids.clear()

        for batch in batches:
            keys = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for a, b in text_ranges(offsets, 8 << 20):
                part = data[offsets[a]:offsets[b]]
                for key, own in zip(keys[a:b], encoder.encode(part, offsets[a:b + 1] - offsets[a]), strict=True):
                    held.append(own.astype("<u4").tobytes() + end)
                    ids.append(key)
                    size += len(held[-1]) // 4
                    if size >= block_tokens:
                        yield from flush()
                        size = 0
        if held:
            yield from flush()

    return rows.mapInArrow(packed, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences from `pack`: (sequence_id, ids BINARY, length); a group is at most one window."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
