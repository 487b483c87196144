"""Near duplicates by SimHash fingerprints and a self-join of their binary trie."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, count
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import components, discard, free_name, numbered, own_columns, staged, text_or_empty

BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; a text without words has fingerprint 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # 255 ones still fit a byte
        if whole:
            counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[whole:].sum(0, dtype=np.int64)
    ones = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(ones.view("<i8")[0])


def fingerprints(column: str | Column, width: int = 3) -> Column:
    """Fingerprint of a text column, null as empty; batches go through Arrow."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return of(text_or_empty(column))


def _masks(bits: int, budget: int) -> list[int]:
    return [sum(1 << b for b in chosen) for n in range(min(budget, bits) + 1) for chosen in combinations(range(bits), n)]


def _prefix(column: str, depth: int) -> Column:
    return F.shiftrightunsigned(column, 64 - depth)


def trie_links(codes: DataFrame, budget: int = 2, leaf: int = 32, step: int = 6) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints in `codes` (fp BIGINT, unique) that differ in at most `budget` bits.

    The trie of the fingerprints is joined with itself from the root. A row (node, fp, bits) says that fp
    hangs at the node with so many differing bits so far; going down `step` levels it hangs at each child
    that is reached within the budget and exists, and is pruned elsewhere. Nodes of up to 8 x `leaf`
    fingerprints are compared in the join itself, larger ones (a cloud of near copies) are gone down
    further, so work follows real neighbours: a fingerprint hangs at no more nodes than lie within the
    budget, whatever the size of its group. The first descent is as deep as makes an even trie's nodes
    `leaf` large. Of two fingerprints only the larger one hangs at the other's node.
    The result is staged.
    """
    total = codes.count()
    depth = min(63, max(1, math.ceil(math.log2(max(total, 1) / leaf)) if total > leaf else 1))
    owners = codes.select("fp", _prefix("fp", depth).alias("node"))
    hung = codes.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in _masks(depth, budget)])).alias("m")).select(
        "fp", _prefix("fp", depth).bitwiseXOR(F.col("m")).alias("node"), F.bit_count("m").alias("bits")
    ).where(F.col("node") <= _prefix("fp", depth))
    found, used = [], []
    while True:
        crowded = staged(owners.groupBy("node").count().where(F.col("count") > 8 * leaf).select("node"))
        last = depth >= 63 or crowded.isEmpty()
        small = owners if last else owners.join(crowded, "node", "left_anti")
        left, right = hung.alias("h"), small.select("node", F.col("fp").alias("a")).alias("o")
        near = (F.bit_count(F.col("h.fp").bitwiseXOR(F.col("o.a"))) <= budget)
        once = (F.col("h.node") < _prefix("h.fp", depth)) | (F.col("o.a") < F.col("h.fp"))
        found.append(left.join(right.hint("shuffle_hash"), (F.col("h.node") == F.col("o.node")) & near & once)
                     .select("a", F.col("fp").alias("b")))
        if last:
            break
        used.append(crowded)
        deeper = min(step, 63 - depth)
        depth += deeper
        owners = staged(owners.join(crowded, "node", "left_semi").select("fp", _prefix("fp", depth).alias("node")))
        own = _prefix("fp", depth).bitwiseAND(F.lit((1 << deeper) - 1))
        child = F.shiftleft(F.col("node"), deeper).bitwiseOR(own.bitwiseXOR(F.col("m")))
        hung = (hung.join(crowded, "node", "left_semi")
                .select("fp", "node", "bits", F.explode(F.array(*[F.lit(m).cast("long") for m in _masks(deeper, budget)])).alias("m"))
                .select("fp", child.alias("node"), (F.col("bits") + F.bit_count("m")).alias("bits"))
                .where((F.col("bits") <= budget) & (F.col("node") <= _prefix("fp", depth)))
                .join(owners.select("node").distinct(), "node", "left_semi"))
        hung = staged(hung.select("fp", "node", "bits"))
        used += [owners, hung]
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    out = staged(out)
    for old in [crowded, *used]:
        discard(old)
    return out


def simhash_groups(rows: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, budget: int = 2,
                   row: str | None = None) -> DataFrame:
    """Near-duplicate groups of a document table: (row, id, fp, component_id, keep_row).

    Fingerprints of equal value or within `budget` differing bits are linked; a component's id is its
    smallest document id (nulls are passed over; null if all are null). Null and wordless texts have
    fingerprint 0, which links like any other. Rows that repeat share a component. The row that stays is
    the one with the smallest id, nulls last. `row` names a column of unique row numbers; without it rows are
    numbered here. An empty table gives an empty result; other columns are not looked at.
    """
    given = [F.col(row).alias("row")] if row else []
    prints = rows.select(*given, F.col(doc_id).alias("id"), fingerprints(text, width).alias("fp"))
    prints = staged(prints) if row else numbered(prints, "row")
    best = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row")).alias("best")
    codes = staged(prints.groupBy("fp").agg(best))
    links = trie_links(codes.select("fp"), budget)
    roots = components(links)
    placed = codes.join(roots, codes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "best")
    smallest = staged(placed.groupBy("root").agg(F.min("best").alias("best")))
    of_code = staged(placed.select("fp", "root").join(smallest, "root").select(
        "fp", F.col("best.id").alias("component_id"), F.col("best.row").alias("keep_row")))
    for old in (links, roots, smallest, codes):
        discard(old)
    return prints.join(of_code, "fp").select("row", "id", "fp", "component_id", "keep_row")


def shingle_hashes(text: str, width: int = 5, seed: int = 42) -> np.ndarray:
    """Distinct hashes of a text's word shingles, sorted; all its words if it has fewer than `width`."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, width = b" ".join(words), min(width, len(words))
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:], strict=False)], np.uint64))


GROUP = 4  # rows of one shingle that are proposed all with all at once; of more, each meets a lead first
LEFT = 8  # comparisons for each row at which the rest is compared all with all
WORDS = 16  # of 64 bits in a row's bitmap of shingles
BITMAP = [f"b{i}" for i in range(WORDS)]
SAMPLE, OFTEN = 8192, 8  # rows looked at for frequent shingles, and in how many of them a shingle is frequent


def prefix_size(size: int, similarity: float) -> int:
    """So many first shingles, in an order all texts share, hold one of any text that is `similarity` alike."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def similar_links(rows: DataFrame, text: str, row: str, similarity: float = 0.8, width: int = 5) -> DataFrame:
    """Links (a, b) between rows whose texts' sets of word shingles have a Jaccard similarity of `similarity`.

    The links connect whatever all such pairs connect, at any text length; not every pair is listed. Candidates come
    from prefix filtering, which misses no pair: of two texts that are so similar, the first shingles of each, in one
    order for all texts, share one. The order puts shingles that are frequent in some rows last and goes by hash
    otherwise; it decides how many pairs are proposed, never which are found. Tokens are 32 bits of a
    hash, and pairs are compared by whole hashes. Sizes and places of the shared shingle rule out most pairs.

    Up to `GROUP` rows of one shingle are proposed all with all. A crowded shingle's rows meet one lead first, the row in
    most crowded shingles, which is what copies were made from; then only rows that are not yet connected are left to
    compare. While these are many and leads still connect many, other leads follow; at last all pairs of rows
    of a shingle that are not connected are compared. Before sets of shingles are fetched, bitmaps of them rule out pairs that differ
    in too many bits, which no alike pair does; they do so within the join. Wordless texts are not linked.
    """
    source = rows.select(F.col(row).alias("row"), text_or_empty(text).alias("text"))

    @F.pandas_udf("array<long>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_hashes(t, width).view(np.int64) for t in texts])

    @F.pandas_udf("binary")
    def long_bitmap(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            out = []
            for s in lists:
                bits = np.zeros(1 << max(6, int(2 * len(s)).bit_length()), bool)
                bits[(s.view(np.uint64) >> np.uint64(8)) & np.uint64(len(bits) - 1)] = True
                out.append(np.packbits(bits).tobytes())
            yield pd.Series(out)

    @F.pandas_udf("long")
    def bits_apart(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for one, two in batches:
            out = []
            for x, y in zip(one, two, strict=True):
                x, y = (np.frombuffer(v, np.uint8) for v in (x, y))
                size = min(len(x), len(y))  # the longer one is folded to the length of the other
                out.append(int(np.bitwise_count(np.bitwise_or.reduce(x.reshape(-1, size)) ^ np.bitwise_or.reduce(y.reshape(-1, size))).sum()))
            yield pd.Series(out, dtype="int64")

    def prefixes(often: np.ndarray):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts, sizes = [np.zeros(0, np.uint64)], []
                bits = np.zeros((batch.num_rows, 64 * WORDS), bool)
                for i, t in enumerate(batch.column("text").to_pylist()):
                    s = shingle_hashes(t, width)
                    sizes.append(len(s))
                    bits[i, (s >> np.uint64(40)) % np.uint64(64 * WORDS)] = True
                    if len(often):
                        late = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
                        s = np.concatenate([s[~late], s[late]])
                    parts.append(s[:prefix_size(len(s), similarity)] if len(s) else s)
                counts = np.array([0, *(len(x) for x in parts[1:])], np.int64)
                token = pa.array(np.concatenate(parts).astype(np.uint32).view(np.int32))
                bitmap = np.packbits(bits, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(np.array(sizes, np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), token),
                     *(pa.array(np.ascontiguousarray(bitmap[:, w])) for w in range(WORDS))], ["row", "size", "tokens", *BITMAP])

        return source.mapInArrow(cut, "row long, size int, tokens array<int>, " + ", ".join(f"{b} long" for b in BITMAP))

    def near_bitmaps(x: str, y: str, sizes: Column) -> Column:
        # A bit that one bitmap has and the other has not is a shingle that one text has and the other has not.
        apart = reduce(add, [F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in BITMAP])
        return apart <= (1 - similarity) / (1 + similarity) * sizes + 1e-6

    def checked(pairs: DataFrame, every: DataFrame) -> DataFrame:
        """Pairs whose bitmaps do not rule them out."""
        own = every.select("row", "size", *BITMAP)
        both = pairs.join(own.alias("x"), F.col("a") == F.col("x.row")).join(own.alias("y"), F.col("b") == F.col("y.row"))
        return both.where(near_bitmaps("x", "y", F.col("x.size") + F.col("y.size"))).select("a", "b")

    def alike(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs)
        wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
        sets = staged(source.join(wanted, "row", "left_semi").select("row", hashes("text").alias("s")).withColumn("m", long_bitmap("s")))
        # Long texts fill the short bitmaps; these are as long as the text, and a fortieth of its hashes.
        own = sets.select("row", "m", F.size("s").alias("n"))
        left = pairs.join(own.alias("x"), F.col("a") == F.col("x.row")).join(own.alias("y"), F.col("b") == F.col("y.row"))
        old, pairs = pairs, staged(left.where(
            bits_apart("x.m", "y.m") <= (1 - similarity) / (1 + similarity) * (F.col("x.n") + F.col("y.n")) + 1e-6).select("a", "b"))
        discard(old)
        both = pairs.join(sets.select(F.col("row").alias("a"), "s"), "a").join(sets.select(F.col("row").alias("b"), F.col("s").alias("t")), "b")
        common = F.size(F.array_intersect("s", "t"))
        out = staged(both.where(common >= similarity * (F.size("s") + F.size("t") - common)).select("a", "b"))
        discard(sets)
        discard(pairs)
        return out

    def fits(x: str, y: str) -> Column:
        n, m = F.col(f"{x}.size"), F.col(f"{y}.size")
        # A pair is seen at its first shared shingle at least, and what follows there bounds what it shares.
        most = F.least(n - F.col(f"{x}.at"), m - F.col(f"{y}.at"))
        return (F.least(n, m) >= similarity * F.greatest(n, m) - 1e-6) & (most >= similarity / (1 + similarity) * (n + m) - 1e-6)

    def met(members: DataFrame, others: DataFrame, *conditions: Column) -> DataFrame:
        on = F.col("x.token") == F.col("y.token")
        for c in (F.col("x.row") != F.col("y.row"), fits("x", "y"), *conditions):
            on = on & c
        return members.alias("x").join(others.alias("y"), on).select(
            F.greatest("x.row", "y.row").alias("a"), F.least("x.row", "y.row").alias("b")).distinct()

    total = source.count()
    some = source.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(total, 1)) * (1 << 30)))
    often = some.select(F.explode(hashes("text")).alias("h")).groupBy("h").count().where(F.col("count") >= OFTEN).select("h").toPandas()
    often = np.sort(often["h"].to_numpy(np.int64).view(np.uint64))
    every = staged(prefixes(often))
    # Place and size travel as one number, and only with tokens that several rows have.
    counts = staged(every.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"))
    tokens = every.select("row", F.col("size").cast("long").alias("size"), F.posexplode("tokens").alias("at", "token")).select(
        "token", "row", F.shiftleft("size", 32).bitwiseOR(F.col("at").cast("long")).alias("where"))
    shared = staged(tokens.join(counts.hint("merge"), "token").select(
        "token", "row", F.shiftright("where", 32).cast("int").alias("size"), F.col("where").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("at"), "n"))
    discard(counts)
    small, crowd = shared.where(F.col("n") <= GROUP).drop("n"), shared.where(F.col("n") > GROUP).drop("n")
    first_pairs = staged(met(small, small, F.col("x.row") > F.col("y.row")))
    links = alike(checked(first_pairs, every))
    discard(first_pairs)
    places = staged(crowd.groupBy("row").agg(F.count("*").alias("places")))
    crowd = staged(crowd.join(places.hint("merge"), "row").join(every.select("row", *BITMAP).hint("merge"), "row"))
    for old in (shared, places, every):
        discard(old)
    for turn in count():
        label = components(links)
        members = staged(crowd.join(label.hint("merge").withColumnRenamed("node", "row"), "row", "left").withColumn(
            "label", F.coalesce("root", "row")).drop("root"))
        apart = staged(members.groupBy("token", "label").agg(F.count("*").alias("k")).groupBy("token").agg(
            (F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("left")).where("left > 0"))
        left = apart.agg(F.coalesce(F.sum("left"), F.lit(0))).first()[0] // 2
        last = not left
        if left:
            rows_left = members.count()
            old, members = members, staged(members.join(apart.select("token").hint("merge"), "token"))
            discard(old)
            differ = (F.col("x.label") != F.col("y.label")) & near_bitmaps("x", "y", F.col("x.size") + F.col("y.size"))
            last = bool(turn) and (left <= LEFT * rows_left or gained * 20 < rows_left)
            if last:
                more = alike(met(members, members, differ, F.col("x.row") > F.col("y.row")))
            else:
                first = F.struct("places" if not turn else F.lit(0).alias("places"), F.xxhash64("row", F.lit(turn)).alias("h"))
                leads = staged(members.groupBy("token").agg(F.max_by(F.struct("row", "size", "at", "label", *BITMAP), first).alias("l")).select("token", "l.*"))
                more = alike(met(members, leads, differ))
                discard(leads)
                gained = more.count()
            links = links.union(more)
        for old in (label, members, apart):
            discard(old)
        if last:
            discard(crowd)
            return links


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = 0.8) -> DataFrame:
    """The rows of `docs` that stay, one of each near-duplicate group, with their own columns.

    Groups join the links of `simhash_groups` and those of `similar_links` at five words and `similarity`. The row with
    the smallest id stays, nulls last. Null, empty and repeated texts are as in `simhash_groups`.
    """
    row = free_name(docs)
    rows = numbered(docs, row)
    found = simhash_groups(rows, text, doc_id, row=row)
    near = similar_links(rows, text, row, similarity)
    edges = found.where("row <> keep_row").select(F.col("row").alias("a"), F.col("keep_row").alias("b")).union(near)
    roots = components(edges)
    groups = staged(roots.join(found.select(F.col("row").alias("node"), "id"), "node"))
    best = staged(groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", F.col("node").alias("row"))).alias("best")))
    dropped = staged(groups.join(best, "root").where(F.col("node") != F.col("best.row")).select(F.col("node").alias(row)))
    for old in (roots, groups, best):
        discard(old)
    return rows.join(dropped.hint("merge"), row, "left_anti").select(*own_columns(docs))
