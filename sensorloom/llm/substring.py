"""Passages that repeat across documents, found by compact windows over min-hashes of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import components, discard, numbered, staged, text_or_empty
from sensorloom.llm.pieces import _spread, text_ranges, utf8

GROUP = 16  # runs of one signature and different contents that are compared all with all; of more, those that share a rare shingle
LONG = 64  # bytes of a word that are taken together with those of other words


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A sum over the bytes of each word, each times a factor of its place: one place of all words after the other."""
    factors = _spread(np.arange(int(lengths.max())) * 2)
    order = np.argsort((LONG + 1 - np.minimum(lengths, LONG + 1)).astype(np.uint8), kind="stable")
    at, reach = starts[order], len(starts) - np.cumsum(np.bincount(np.minimum(lengths, LONG)))  # words longer than each place
    sums = np.zeros(len(starts), np.uint64)
    for place, n in enumerate(reach[:-1].tolist()):
        sums[:n] += (data[at[:n] + place].astype(np.uint64) + np.uint64(1)) * factors[place]
    for i in np.flatnonzero(lengths[order] > LONG).tolist():
        rest = data[at[i] + LONG:at[i] + lengths[order[i]]].astype(np.uint64) + np.uint64(1)
        sums[i:i + 1] += (rest * factors[LONG:LONG + len(rest)]).sum()
    out = np.empty_like(sums)
    out[order] = sums
    return out


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words of texts laid end to end: (hash, text number, word position).

    Words are runs without ASCII white space, A-Z in lower case.
    """
    data = data | (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
    ink = (data != 32) & (data - np.uint8(9) > 4)
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    begin, end = ink.copy(), ink.copy()
    begin[1:] &= ~ink[:-1] | edge[1:]
    end[:-1] &= ~ink[1:] | edge[1:]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = mixed(word_sums(data, starts, np.flatnonzero(end) + 1 - starts), 0)
    text = np.searchsorted(offsets, starts, "right") - 1
    position = np.arange(len(starts)) - np.searchsorted(text, text, "left")
    n = len(starts) - width + 1
    if n <= 0:
        return hashes[:0], text[:0], position[:0]
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(_spread(np.arange(width) * 2 + 1_000_003)):
        out += hashes[j:j + n] * factor
    whole = text[:n] == text[width - 1:]
    return mixed(out, 0)[whole], text[:n][whole], position[:n][whole]


def pieces(data: np.ndarray, offsets: np.ndarray, x: int, y: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """`shingles` of the texts from x to y, half a megabyte at a time, each with the number of its first text: arrays stay in the cache."""
    for a, b in text_ranges(offsets[x:y + 1], 1 << 19):
        yield x + a, *shingles(data[offsets[x + a]:offsets[x + b]], offsets[x + a:x + b + 1] - offsets[x + a], width)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of `size` values, by doubling."""
    span, out = 1, values
    while span * 2 <= size:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - size + 1], out[size - span:]) if size > span else out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` hashes in a row."""
    n = len(hashes) - size + 1
    with np.errstate(over="ignore"):
        base = np.uint64(0x5851F42D4C957F2D)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes), base)]).astype(np.uint64))
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(pow(int(base), -1, 1 << 64)))]).astype(np.uint64))
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])])
        return mixed((prefix[size:] - prefix[:n]) * inverse, 0)


def compact_windows(hashes: np.ndarray, text: np.ndarray, size: int, pair: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share a signature: (signature, first, last).

    Places are indexes of shingles. A window is `size` shingles of one text. The smallest hash in it is the root of its Cartesian tree; the
    windows with one root follow each other, so nodes that span a window show as runs of sliding minima.
    A signature is a pair of such roots under two hash functions; `pair` is the number of the pair.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = text[:n] == text[size - 1:]
    a, b = sliding_min(mixed(hashes, 2 * pair + 1), size), sliding_min(mixed(hashes, 2 * pair + 2), size)
    change = np.ones(n, bool)
    change[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (text[1:n] != text[:n - 1]) | ~whole[:-1]
    opens = np.flatnonzero(change)
    ends_text = np.searchsorted(text, text[opens], "right") - size
    kept = whole[opens]
    first, last = opens[kept], np.minimum(np.append(opens[1:], n) - 1, ends_text)[kept]
    # In a text that repeats itself a signature can outlast its root: such runs are cut.
    cuts = (last - first) // size + 1
    if (cuts > 1).any():
        nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first, last = np.repeat(first, cuts) + nth * size, np.repeat(last, cuts)
        last = np.minimum(last, first + size - 1)
    return mixed(a[first] + mixed(b[first], 77), pair + 101), first, last


def roots(hashes: np.ndarray, first: np.ndarray, size: int, pair: int) -> np.ndarray:
    """The first place of the smallest hash in the windows that begin at `first`."""
    one = mixed(hashes, 2 * pair + 1)
    out, least = first.copy(), one[first]
    for j in range(1, size):
        own = one[first + j]
        less = own < least
        out[less], least[less] = first[less] + j, own[less]
    return out


RUN_TYPE = np.dtype([("signature", "<u8"), ("head", "<u8"), ("tail", "<u8"), ("span", "<i4"), ("row", "<i8"), ("first", "<i4"), ("root", "<i4"), ("block", "<i8")])
COUNT_TYPE = np.dtype([("key", "<u8"), ("n", "<i4"), ("least", "<i4")])
LINK_TYPE = np.dtype([("row", "<i8"), ("to_row", "<i8"), ("low", "<i4"), ("high", "<i4"), ("to_low", "<i4")])
RUNS = "signature long, block long, row long, first int, last int, root int"
LINK = "row long, low int, high int, to_row long, to_low int"
PACKETS = "bucket int, links binary"
CONTENT = "signature long, block long, row long, first int, last int, root int, k long, content binary"


def by_bucket(values: np.ndarray, key: np.ndarray, buckets: int) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the buckets that get any of `values`, and the bytes of those each gets, by an unsigned `key`."""
    of = (key % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    counts = np.bincount(of, minlength=buckets)
    data = np.ascontiguousarray(values[np.argsort(of, kind="stable")])
    offsets = np.concatenate([[0], np.cumsum(counts[counts > 0])]).astype(np.int32) * np.int32(values.itemsize)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """All values of packets, end to end."""
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def only(column: pa.ChunkedArray, values: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Packets with those of their values that are kept."""
    ends = np.cumsum(pc.binary_length(column).to_numpy()) // values.itemsize
    offsets = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])] * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values[keep].tobytes())])


def blocks_of(rows: DataFrame) -> DataFrame:
    """(id, text, row, block), staged: rows are numbered, and about 4 MB of texts that stand together are a block."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, keys = utf8(batch.column("text"))[1], batch.column("row").to_numpy()
            block = np.zeros(len(keys), np.int64)
            for x, y in text_ranges(offsets, 4 << 20):
                block[x:y] = keys[x]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], [*batch.schema.names, "block"])

    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return staged(rows.mapInArrow(deal, rows.withColumn("block", F.lit(0).cast("long")).schema))


def met_signatures(rows: DataFrame, width: int, size: int, signatures: int, buckets: int) -> DataFrame:
    """(block, signatures): signatures of each block that more than one run has, as packets. Staged.

    A signature leaves a block twice at most, without its run: eight bytes in a packet that goes to the signature's bucket.
    """

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            data, offsets = utf8(batch.column("text"))
            bounds = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                parts = [compact_windows(hashes, of, size, pair)[0] for _, hashes, of, _ in pieces(data, offsets, x, y, width) for pair in range(signatures)]
                signs = np.sort(np.concatenate(parts))
                signs = signs[np.append([True, True], signs[2:] != signs[:-2])[:len(signs)]]
                if len(signs):
                    found, data_of = by_bucket(signs, signs, buckets)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), block[x])), data_of], ["bucket", "block", "signatures"])

    def again(packets: pa.Table) -> pa.Table:
        signs = unpacked(packets.column("signatures"), np.dtype("<u8"))
        ordered = np.sort(signs)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        keep = np.zeros(len(signs), bool)
        if len(twice):
            keep = twice[np.minimum(np.searchsorted(twice, signs), len(twice) - 1)] == signs
        out = pa.table({"block": packets.column("block"), "signatures": only(packets.column("signatures"), signs, keep)})
        return out.filter(pc.greater(pc.binary_length(out.column("signatures")), 0))

    packets = rows.select("block", "text").mapInArrow(sent, "bucket int, block long, signatures binary")
    return staged(packets.groupBy("bucket").applyInArrow(again, "block long, signatures binary"))


def shared_runs(rows: DataFrame, met: DataFrame, width: int, words: int, signatures: int, buckets: int) -> DataFrame:
    """Links between equal runs as packets of `links`, and a row for each content of a signature. Staged.

    Of equal runs in a block only the first travels, to the bucket of its content, and is linked there to the first of all. So
    a bucket gets a passage once for a block at most, however many documents have it, and nothing gathers a signature.
    """
    size = words - width + 1

    def cut(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = []
        if texts.num_rows and wanted.num_rows:
            twice = np.unique(unpacked(wanted.column("signatures"), np.dtype("<u8")))
            low_bits, some = np.uint64((1 << 22) - 1), np.zeros(1 << 22, bool)  # most others fail here
            some[twice & low_bits] = True
            keys, block = texts.column("row").to_numpy(), texts.column("block")[0].as_py()
            data, offsets = utf8(texts.column("text").combine_chunks())
            for x, hashes, of, position in pieces(data, offsets, 0, len(keys), width):
                content = window_hashes(hashes, size) if len(hashes) >= size else None
                for pair in range(signatures):
                    sign, first, last = compact_windows(hashes, of, size, pair)
                    maybe = np.flatnonzero(some[sign & low_bits])
                    keep = maybe[twice[np.minimum(np.searchsorted(twice, sign[maybe]), len(twice) - 1)] == sign[maybe]]
                    sign, first, last = sign[keep], first[keep], last[keep]
                    if len(sign):
                        runs = np.empty(len(sign), RUN_TYPE)
                        runs["signature"], runs["head"], runs["tail"], runs["span"] = sign, content[first], content[last], last - first
                        runs["row"], runs["first"], runs["block"] = keys[x + of[first]], position[first], block
                        runs["root"] = position[roots(hashes, first, size, pair)]
                        parts.append(runs)
        runs = np.concatenate([np.zeros(0, RUN_TYPE), *parts])
        leads, lead = first_of_equal(runs)
        links, runs = links_of(runs, lead, words), runs[leads]
        found, data_of = by_bucket(runs, content_key(runs), buckets)
        linked, links_data = by_bucket(links, links["row"].view(np.uint64), buckets)
        none = [pa.nulls(len(linked), pa.binary()), pa.nulls(len(found), pa.binary())]
        return pa.table({"bucket": pa.chunked_array([pa.array(found), pa.array(linked)]), "runs": pa.chunked_array([data_of, none[0]]),
                         "links": pa.chunked_array([none[1], links_data])})

    def lead_out(packets: pa.Table) -> pa.Table:
        runs = unpacked(packets.column("runs"), RUN_TYPE)
        leads, lead = first_of_equal(runs)
        links = links_of(runs, lead, words)
        linked, data = by_bucket(links, links["row"].view(np.uint64), buckets)
        links_data = packets.column("links").drop_null()
        bucket = np.full(len(links_data), packets.column("bucket")[0].as_py(), np.int32)
        n, m, kinds = len(linked) + len(links_data), len(leads), runs[leads]
        columns = {"signature": kinds["signature"].view(np.int64), "block": kinds["block"], "row": kinds["row"], "first": kinds["first"],
                   "last": kinds["first"] + kinds["span"], "root": kinds["root"]}
        out = {c: pa.chunked_array([pa.nulls(n, pa.array(v[:0]).type), pa.array(np.ascontiguousarray(v))]) for c, v in columns.items()}
        out["bucket"] = pa.chunked_array([pa.array(linked), pa.array(bucket), pa.nulls(m, pa.int32())])
        out["links"] = pa.chunked_array([data, *links_data.chunks, pa.nulls(m, pa.binary())], pa.binary())
        return pa.table(out)

    packets = rows.select("block", "row", "text").groupBy("block").cogroup(met.groupBy("block")).applyInArrow(
        cut, "bucket int, runs binary, links binary")
    return staged(packets.groupBy("bucket").applyInArrow(lead_out, f"{RUNS}, {PACKETS}"))


def content_key(runs: np.ndarray) -> np.ndarray:
    """A number for the signature, ends and length of each run."""
    return mixed(runs["head"] + mixed(runs["tail"] + mixed(runs["signature"], 1), 2) + runs["span"].astype(np.uint64), 3)


def first_of_equal(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which runs are the first, by row and place, of those with their signature, ends and length; and each run's first."""
    order = np.lexsort((runs["first"], runs["row"], content_key(runs)))
    new = np.ones(len(runs), bool)
    same = [runs[c][order] for c in ("signature", "head", "tail", "span")]
    new[1:] = reduce(np.logical_or, [v[1:] != v[:-1] for v in same])
    leads, lead = order[new], np.empty(len(runs), np.int64)
    lead[order] = leads[np.cumsum(new) - 1]
    return leads, lead


def links_of(runs: np.ndarray, lead: np.ndarray, words: int) -> np.ndarray:
    """Links of runs with their first one, but where they overlap."""
    far = (runs["row"] != runs["row"][lead]) | (np.abs(runs["first"] - runs["first"][lead]) >= words)
    out = np.empty(int(far.sum()), LINK_TYPE)
    out["row"], out["low"], out["high"] = runs["row"][far], runs["first"][far], runs["first"][far] + runs["span"][far]
    out["to_row"], out["to_low"] = runs["row"][lead[far]], runs["first"][lead[far]]
    return out


def packed_links(links: DataFrame, buckets: int) -> DataFrame:
    """Links as packets, by their row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, LINK_TYPE)
            for c in LINK_TYPE.names:
                out[c] = batch.column(c).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in by_bucket(out, out["row"].view(np.uint64), buckets)],
                                             ["bucket", "links"])

    return links.mapInArrow(pack, PACKETS)


def merged_links(packets: DataFrame, words: int) -> DataFrame:
    """Links that lead from one row to another by the same distance, taken together where they are at most `words` apart.

    Windows so near each other are of one passage on either side, so passages and classes stay what they are.
    """

    def merge(group: pa.Table) -> pa.Table:
        links = unpacked(group.column("links"), LINK_TYPE)
        shift = links["to_low"] - links["low"]
        order = np.lexsort((links["low"], shift, links["to_row"], links["row"]))
        links, shift = links[order], shift[order]
        other = np.ones(len(links), bool)
        other[1:] = (links["row"][1:] != links["row"][:-1]) | (links["to_row"][1:] != links["to_row"][:-1]) | (shift[1:] != shift[:-1])
        base = np.cumsum(other) << 32  # the furthest end so far within the rows and distance
        reach = np.maximum.accumulate(base + links["high"]) - base
        new = other.copy()
        new[1:] |= links["low"][1:] - reach[:-1] > words
        at = np.flatnonzero(new)
        out = links[at]
        return pa.table({"row": out["row"], "low": out["low"], "high": reach[np.append(at[1:], len(links)) - 1].astype(np.int32),
                         "to_row": out["to_row"], "to_low": out["to_low"]})

    return packets.groupBy("bucket").applyInArrow(merge, LINK)


def contents(rows: DataFrame, runs: DataFrame, width: int, size: int) -> DataFrame:
    """`runs` with their shingle hashes, 32 bits each, from the first window to the end of the last.

    Staged by place, so runs that overlap stand together and compress to little.
    """
    names = [c.split()[0] for c in CONTENT.split(", ")]

    def cut(texts: pa.Table, runs: pa.Table) -> pa.Table:
        if not texts.num_rows or not runs.num_rows:
            return pa.table({c: pa.nulls(0, pa.binary() if c == "content" else pa.int64() if c in ("signature", "block", "row", "k") else pa.int32()) for c in names})
        runs = runs.sort_by([("row", "ascending"), ("first", "ascending")])
        keys = texts.column("row").to_numpy()
        parts = [(x + of, hashes.astype("<u4")) for x, hashes, of, _ in pieces(*utf8(texts.column("text").combine_chunks()), 0, len(keys), width)]
        of, codes = (np.concatenate(v) for v in zip(*parts, strict=True))
        order = np.argsort(keys)
        text = order[np.searchsorted(keys, runs.column("row").to_numpy(), sorter=order)]
        first, last = (runs.column(c).to_numpy() for c in ("first", "last"))
        low = np.searchsorted(of, np.arange(len(keys)), "left")[text] + first
        parts = [codes[v:w].tobytes() for v, w in zip(low.tolist(), (low + last - first + size).tolist(), strict=True)]
        return runs.select(names[:-1]).append_column("content", pa.array(parts, pa.binary()))

    return staged(rows.select("block", "row", "text").groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(cut, CONTENT))


def jaccard(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets in the rows of two matrices."""
    def kinds(x: np.ndarray) -> np.ndarray:
        x = np.sort(x, axis=1)
        return 1 + (x[:, 1:] != x[:, :-1]).sum(1)

    both = kinds(np.concatenate([one, two], axis=1))
    return (kinds(one) + kinds(two) - both) / both


def alike_places(a: list[int], b: list[int], n: int, size: int, similarity: float) -> Iterator[int]:
    """Places under `n` at which the windows of `size` shingles of `a` and `b` are similar enough."""
    one, two = (np.lib.stride_tricks.sliding_window_view(np.asarray(x), size)[:n] for x in (a, b))
    yield from np.flatnonzero(jaccard(one, two) >= similarity - 1e-12).tolist()


def alike_ranges(codes: np.ndarray, base: np.ndarray, first: np.ndarray, last: np.ndarray, root: np.ndarray, a: np.ndarray, b: np.ndarray,
                 size: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs (a, b) of runs hold similar windows side by side by their roots: (number of the pair, first place, last place) in a.

    Run i has its shingles in `codes` from `base[i]`. Every place that both runs have is compared.
    """
    shift = root[a] - root[b]
    low, high = np.maximum(first[a], first[b] + shift), np.minimum(last[a], last[b] + shift)
    number = np.maximum(high - low + 1, 0)
    starts = np.cumsum(number) - number
    total = int(number.sum())
    good = np.zeros(total, bool)
    if not total:
        return number[:0], number[:0], number[:0]
    whole, windows = window_hashes(mixed(codes.astype(np.uint64), 0), size), np.lib.stride_tricks.sliding_window_view(codes, size)
    for x in range(0, total, 1 << 12):
        flat = np.arange(x, min(x + (1 << 12), total))
        pair = np.searchsorted(starts, flat, "right") - 1
        place = low[pair] + flat - starts[pair]
        i = base[a[pair]] + place - first[a[pair]]
        j = base[b[pair]] + place - shift[pair] - first[b[pair]]
        same = whole[i] == whole[j]
        same[~same] = jaccard(windows[i[~same]], windows[j[~same]]) >= similarity - 1e-12
        good[flat] = same
    at = np.flatnonzero(good)
    pair = np.searchsorted(starts, at, "right") - 1
    found, begin = np.unique(pair, return_index=True)
    if not len(found):
        return found, found, found
    place = low[pair] + at - starts[pair]
    return found, place[begin], place[np.append(begin[1:], len(at)) - 1]


def _codes(content: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes end to end, and where each content begins and the last one ends."""
    content = content.cast(pa.large_binary())
    _, offsets, data = content.buffers()
    offsets = np.frombuffer(offsets, np.int64)[content.offset:content.offset + len(content) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view("<u4"), (offsets - offsets[0]) // 4


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns of runs with contents, with all codes end to end."""
    out = {c: batch.column(c).to_numpy().astype(np.int64) for c in ("signature", "row", "first", "last", "root")}
    out["codes"], bounds = _codes(batch.column("content"))
    out["base"] = bounds[:-1]
    return out


def _keyed(of: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One number for a run's number and a code of 32 bits."""
    return (of.astype(np.int64) << 32) | codes.astype(np.int64)


def run_tokens(codes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different codes of each run, as (number of the run, code), and the least number of different codes in a window of each run.

    Run i is `codes[bounds[i]:bounds[i + 1]]`, at least a window of `size` codes long.
    """
    key = _keyed(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), codes)
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    earlier, later = order[again], order[again + 1]
    # A code that was there before counts for nothing in the windows that hold both places.
    low = np.maximum(later - size + 1, bounds[:-1][key[later] >> 32])
    high = np.minimum(earlier, bounds[1:][key[later] >> 32] - size)
    inside = low <= high
    n = len(codes) + 1
    repeats = np.cumsum(np.bincount(low[inside], minlength=n) - np.bincount(high[inside] + 1, minlength=n))
    kinds = key[order][np.append(True, key[order][1:] != key[order][:-1])]
    return kinds >> 32, kinds & 0xFFFFFFFF, size - np.maximum.reduceat(repeats, bounds[:-1])


def rare_tokens(codes: np.ndarray, bounds: np.ndarray, of: np.ndarray, token: np.ndarray, n: np.ndarray, least: np.ndarray,
                size: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, code): the codes of which two similar windows share one.

    In each window the rarest codes, by `n`, as many as a similar window cannot do without all of. `of`, `token`, `n` and `least` are the runs' codes,
    by run; codes with `n` of 1 are in no other run.
    """
    order = np.lexsort((token, n, of))  # a code's place here is its rank in its run
    of, token, n, least = of[order], token[order], n[order], least[order]
    key = _keyed(of, token)
    by_key = np.argsort(key)
    rank = by_key[np.searchsorted(key, _keyed(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), codes), sorter=by_key)]
    windows = np.maximum(np.diff(bounds) - size + 1, 0)
    starts = np.arange(int(windows.sum())) + np.repeat(bounds[:-1] - np.cumsum(windows) + windows, windows)
    chosen = np.zeros(len(token), bool)
    for x in range(0, len(starts), 1 << 13):
        own = np.sort(rank[starts[x:x + (1 << 13), None] + np.arange(size)], axis=1)
        new = np.ones(own.shape, bool)
        new[:, 1:] = own[:, 1:] != own[:, :-1]
        m = new.sum(1, keepdims=True)
        partner = np.maximum(least[own], similarity * m)
        enough = m - (new.cumsum(1) - 1) >= similarity / (1 + similarity) * (m + partner) - 1e-9
        chosen[own[new & enough]] = True
    chosen &= n > 1
    return of[chosen], token[chosen]


def _link_batch(row: np.ndarray, to_row: np.ndarray, low: np.ndarray, high: np.ndarray, to_low: np.ndarray) -> pa.RecordBatch:
    cols = [row, low.astype(np.int32), high.astype(np.int32), to_row, to_low.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["row", "low", "high", "to_row", "to_low"])


def few_links(runs: DataFrame, words: int, size: int, similarity: float) -> DataFrame:
    """Links between the runs of each signature, all with all; a signature has at most `GROUP` of them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if held is None or not held.num_rows:
                continue
            s = held.column("signature").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]])
            if batch is not None:
                bounds = bounds[:-1]  # the last signature may go on
            done = int(bounds[-1])
            if done:
                group = np.searchsorted(bounds, np.arange(done), "right") - 1
                one, two = [], []
                for step in range(1, int(np.diff(bounds).max())):
                    near = np.flatnonzero(group[step:] == group[:-step])
                    one.append(near + step)
                    two.append(near)
                if one:
                    r = _arrays(held.slice(0, done))
                    yield _linked_pairs(r, np.concatenate(one), np.concatenate(two), words, size, similarity)[1]
            held = held.slice(done)

    return runs.repartition("signature").sortWithinPartitions("signature", "row", "first").mapInArrow(compare, LINK)


def _with_end(batches: Iterator[pa.RecordBatch]):
    yield from batches
    yield None


def counted(key: np.ndarray, n: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number in the table of each key, and the table: different keys with the sum of `n` and the smallest `least`."""
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])[:len(key)]
    at = np.flatnonzero(new)
    out, of = np.empty(len(at), COUNT_TYPE), np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    if len(at):
        out["key"], out["n"], out["least"] = key[order[at]], np.add.reduceat(n[order], at), np.minimum.reduceat(least[order], at)
    return of, out


def crowd_links(runs: DataFrame, words: int, size: int, similarity: float, buckets: int) -> DataFrame:
    """Links between the runs of crowded signatures: whatever all similar pairs connect, without putting all side by side.

    Two windows that are similar share one of their rarest shingles, by how many runs of the signature have them, within as many as
    both can spare; runs that share none are not compared. Up to `GROUP` runs of such a shingle meet all with all. Of more each
    meets the first; then those that are still not connected meet each other. Staged.
    """
    runs = numbered(runs, "run")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if x < y:
                    _, _, key, least = keyed_tokens(batch.slice(x, y - x))
                    found, data = by_bucket(counts := counted(key, np.ones(len(key), np.int32), least)[1], counts["key"], buckets)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), block[x])), data], ["bucket", "block", "counts"])

    def keyed_tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        of, kinds, least = run_tokens(*_codes(part.column("content")), size)
        return of, kinds, mixed(part.column("signature").to_numpy().view(np.uint64)[of] + mixed(kinds.astype(np.uint64), 5), 6), least[of].astype(np.int32)

    def summed(packets: pa.Table) -> pa.Table:
        own = unpacked(packets.column("counts"), COUNT_TYPE)
        of, total = counted(own["key"], own["n"], own["least"])
        out = pa.table({"block": packets.column("block"), "counts": only(packets.column("counts"), total[of], total["n"][of] > 1)})
        return out.filter(pc.greater(pc.binary_length(out.column("counts")), 0))

    def rare(own: pa.Table, counts: pa.Table) -> pa.Table:
        known = unpacked(counts.column("counts"), COUNT_TYPE)
        known = np.concatenate([known[np.unique(known["key"], return_index=True)[1]], np.array([(2**64 - 1, 1, size)], COUNT_TYPE)])
        parts = [pa.table({c: pa.nulls(0, pa.int32() if c == "first" else pa.int64()) for c in ("signature", "row", "first", "run", "token")})]
        for x in range(0, own.num_rows, 8192):
            part = own.slice(x, 8192).combine_chunks().to_batches()[0]
            of, kinds, key, least = keyed_tokens(part)
            at = np.searchsorted(known["key"][:-1], key)
            met = known["key"][at] == key
            n, least = np.where(met, known["n"][at], 1), np.where(met, known["least"][at], least)
            of, kinds = rare_tokens(*_codes(part.column("content")), of, kinds, n, least, size, similarity)
            parts.append(pa.table({c: part.column(c).take(pa.array(of)) for c in ("signature", "row", "first", "run")} | {"token": kinds}))
        return pa.concat_tables(parts)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sides = [pa.RecordBatch.from_arrays([batch.column(f"{x}{c}") for c in RUN], RUN) for x in "xy"]
            r = _arrays(pa.Table.from_batches(sides).combine_chunks().to_batches()[0]) if n else None
            if n:
                links = _linked_pairs(r, np.arange(n), np.arange(n) + n, words, size, similarity)
                runs_of = [batch.column(c).take(pa.array(links[0])) for c in ("a", "b")]
                yield pa.RecordBatch.from_arrays([*runs_of, *links[1].columns], ["a", "b", *links[1].schema.names])

    def verified(pairs: DataFrame) -> DataFrame:
        sides = [runs.select(F.col("run").alias(k), *[F.col(c).alias(f"{x}{c}") for c in RUN]) for x, k in (("x", "a"), ("y", "b"))]
        near = pairs.distinct().join(sides[0], "a").join(sides[1], "b")
        return staged(near.mapInArrow(compare, f"a long, b long, {LINK}"))

    # Counts go to a shingle's bucket as packets, and totals back to the block of the runs.
    totals = runs.select("signature", "block", "content").mapInArrow(tokens, "bucket int, block long, counts binary").groupBy("bucket").applyInArrow(
        summed, "block long, counts binary")
    key = ["signature", "token"]
    prefixes = staged(runs.select("block", "signature", "row", "first", "run", "content").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        rare, "signature long, row long, first int, run long, token long"))
    sizes = prefixes.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "run")).alias("lead")).where("n > 1")
    members = staged(prefixes.join(sizes.hint("merge"), key).select(*key, "run", "n", F.col("lead.run").alias("lead")))
    small, crowd = members.where(F.col("n") <= GROUP), members.where(F.col("n") > GROUP)
    other = small.select(*key, F.col("run").alias("b"))
    found = verified(small.select(*key, F.col("run").alias("a")).join(other, key).where("a > b").select("a", "b").union(
        crowd.where("run <> lead").select(F.col("run").alias("a"), F.col("lead").alias("b"))))
    label = components(found.select("a", "b"))
    left = staged(crowd.join(label.hint("merge"), crowd["run"] == label["node"], "left").select(
        *key, "run", F.coalesce("root", "run").alias("label")))
    other = left.select(*key, F.col("run").alias("b"), F.col("label").alias("other"))
    more = verified(left.join(other, key).where("run > b AND label <> other").select(F.col("run").alias("a"), "b"))
    out = staged(found.union(more).drop("a", "b"))
    for old in (runs, prefixes, members, found, label, left, more):
        discard(old)
    return out


RUN = ["signature", "row", "first", "last", "root", "content"]


def _linked_pairs(r: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, words: int, size: int, similarity: float) -> tuple[np.ndarray, pa.RecordBatch]:
    """Numbers of the pairs that are linked, and their links."""
    shift = r["root"][a] - r["root"][b]
    apart = np.flatnonzero((r["row"][a] != r["row"][b]) | (np.abs(shift) >= words))
    a, b, shift = a[apart], b[apart], shift[apart]
    found, low, high = alike_ranges(r["codes"], r["base"], r["first"], r["last"], r["root"], a, b, size, similarity)
    return apart[found], _link_batch(r["row"][a[found]], r["row"][b[found]], low, high, low - shift[found])


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 50, width: int = 5,
                      similarity: float = 0.8, signatures: int = 8) -> DataFrame:
    """Passages of at least `words` words that repeat, exactly or nearly: (doc_id, start_word, end_word, class_id, class_doc).

    Runs of windows of `words` words that share a signature and are equal are linked as they are. Others of one signature are compared:
    put side by side by the place of the signature's root, the Jaccard similarity of their `width`-word shingles must
    reach `similarity` at a place that both runs have. There are `signatures` independent signatures, and only verified links are
    kept. Overlapping windows of a document are one passage, half-open in word positions;
    linked passages are a class, whose id is its smallest passage number and whose class_doc is its smallest document id.
    Where many contents share a signature, runs are compared if they share a shingle that is rare among them, which
    similar ones do; copies are never expanded into pairs.

    Null texts are empty; texts under `words` words have no passages; a passage that repeats within one document
    counts, unless its copies overlap. Ids may be null or repeat: rows are told apart by number. An empty table
    gives an empty result, and other columns are not looked at.
    """
    rows = blocks_of(docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")))
    size, spark = words - width + 1, docs.sparkSession
    # 16 MB of texts a bucket: some 20 MB of signatures.
    buckets = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 256), rows.select("block").distinct().count() // 4)
    met = met_signatures(rows, width, size, signatures, buckets)
    shared = shared_runs(rows, met, width, words, signatures, buckets)
    discard(met)
    kinds = shared.where("links IS NULL").drop("bucket", "links")
    several = kinds.groupBy("signature").agg(F.count("*").alias("k")).where("k > 1")
    runs = staged(kinds.join(several.hint("merge"), "signature"))
    filled = contents(rows, runs, width, size)
    discard(runs)
    few = staged(packed_links(few_links(filled.where(F.col("k") <= GROUP).drop("block", "k"), words, size, similarity), buckets))
    parts = [shared.where("links IS NOT NULL").select("bucket", "links"), few]
    crowd, crowded = None, filled.where(F.col("k") > GROUP).drop("k")
    if not crowded.isEmpty():
        crowd = crowd_links(crowded, words, size, similarity, buckets)
        parts.append(packed_links(crowd, buckets))
    found = staged(merged_links(reduce(DataFrame.union, parts), words))
    for old in (shared, filled, few, crowd):
        if old is not None:
            discard(old)
    end = F.col("to_low") + F.col("high") - F.col("low")
    both = found.select("row", F.col("low").alias("first"), F.col("high").alias("last")).union(
        found.select("to_row", "to_low", end)).groupBy("row", "first").agg(F.max("last").alias("last"))
    order = Window.partitionBy("row").orderBy("first")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = both.withColumn("new", ((F.col("first") - before > words) | before.isNull()).cast("int")).withColumn("passage", F.sum("new").over(order))
    passages = numbered(placed.groupBy("row", "passage").agg(
        F.min("first").alias("start_word"), (F.max("last") + words).alias("end_word")), "number")
    of_window = staged(placed.join(passages.select("row", "passage", "number"), ["row", "passage"]).select("row", "first", "number"))
    edges = found.join(of_window.select("row", F.col("first").alias("low"), F.col("number").alias("a")), ["row", "low"]).join(
        of_window.select(F.col("row").alias("to_row"), F.col("first").alias("to_low"), F.col("number").alias("b")), ["to_row", "to_low"])
    roots = components(edges.select("a", "b"))
    for old in (found, of_window):
        discard(old)
    ids = rows.select("row", "id")
    out = staged(passages.join(roots, passages["number"] == roots["node"], "left").select(
        "row", "start_word", "end_word", F.coalesce("root", "number").alias("class_id")).join(ids, "row"))
    least = staged(out.groupBy("class_id").agg(F.min("id").alias("class_doc")))
    return out.join(least, "class_id").select(F.col("id").alias("doc_id"), "start_word", "end_word", "class_id", "class_doc")
