"""Document log-likelihoods of a gated recurrent language model with a class-factored softmax, learned from the whole corpus."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, staged, text_or_empty

CHUNK = 1 << 16  # numbers of a model that travel in one row


def held_out(doc_id: str | Column, folds: int = 7, fold: int = 2) -> Column:
    """Documents that nothing is learned from; those with a null id are learned from."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


# -- The corpus as blocks of numbered tokens ------------------------------------------------------------------------------

def cut_blocks(docs: DataFrame, text: str, doc_id: str, held: Column, block: int) -> DataFrame:
    """Texts as tokens numbered within blocks of about `block` tokens; staged.

    (block, ids, held, lengths, tokens, words, counts): documents of a block one after the other, 32-bit token numbers, the block's
    distinct words by number and how often each is in training documents. Tokens are runs without ASCII white space with A-Z
    in lower case, then one end, the empty word. A document is never cut; one longer than a block is a block.
    """
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), held.alias("held"), text_or_empty(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        ids, learned, parts, size = [], [], [], 0
        index = defaultdict()
        index.default_factory = index.__len__

        def block_row() -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts], np.int32)
            tokens = np.concatenate(parts)
            counts = np.bincount(tokens[np.repeat(~np.array(learned, bool), lengths)], minlength=len(index)).astype(np.int32)
            words = pa.array(index, pa.binary()).cast(pa.string())
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), one(pa.concat_arrays(ids)), pa.array([np.array(learned, np.uint8).tobytes()]), pa.array([lengths.tobytes()]),
                 pa.array([tokens.tobytes()]), one(words), one(pa.array(counts))], ["block", "ids", "held", "lengths", "tokens", "words", "counts"])

        for batch in batches:
            keys, marks = batch.column("id"), batch.column("held").to_pylist()
            for i, body in enumerate(batch.column("text").cast(pa.binary())):
                words = body.as_py().lower().split()
                words.append(b"")
                parts.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                ids.append(keys.slice(i, 1))
                learned.append(marks[i])
                size += len(words)
                if size >= block:
                    yield block_row()
                    number, size = number + 1, 0
                    for kept in (ids, learned, parts, index):
                        kept.clear()
        if parts:
            yield block_row()

    return staged(source.mapInArrow(cut, f"block long, ids array<{kind}>, held binary, lengths binary, tokens binary, words array<string>, counts array<int>"))


def band(count: str) -> Column:
    """Words outside the head by how often they occur: none for unknown ones, then powers of two."""
    return F.when(F.col(count) > 0, F.length(F.bin(F.col(count)))).otherwise(0).cast("int")


@dataclass
class Vocabulary:
    """Counts over the whole training corpus. Codes are head words by frequency, then bands of rarer ones."""

    tokens: int           # of the training corpus
    words: int            # distinct ones
    head: list[str]
    head_counts: list[int]
    bands: dict[int, int]  # band: sum of count + 1 over its words

    @property
    def total(self) -> float:
        return self.tokens + self.words + 1

    def band_codes(self) -> dict[int, int]:
        return {b: len(self.head) + i for i, b in enumerate(sorted(self.bands))}


def vocabulary(counts: DataFrame, head: int) -> Vocabulary:
    """Totals of (word, c); only `head` words and some sixty band sums reach the driver."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    first = counts.orderBy(F.desc("c"), "word").limit(head).collect()
    bands = {0: 1}
    rest = counts.groupBy(band("c").alias("band")).agg(F.sum(F.col("c") + 1).alias("mass")).collect()
    for r in rest:
        bands[r.band] = r.mass
    for r in first:
        bands[int(r.c).bit_length()] -= r.c + 1
    return Vocabulary(n, v, [r.word for r in first], [r.c for r in first], {b: m for b, m in bands.items() if m > 0})


CODED = "ids {ids}, held binary, lengths binary, known binary, base binary, rest binary, codes binary"


def code_blocks(blocks: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """Blocks with corpus-wide token codes and each document's base score, known tokens and score within bands; staged.

    Each block's distinct words meet the counts in a join on the word, and come back to it by number. A block's words are as many as
    its tokens at most, so no group grows with the corpus.
    """
    numbered = blocks.select("block", F.posexplode("words").alias("nth", "word"))
    head = blocks.sparkSession.createDataFrame([(w, i) for i, w in enumerate(words.head)], "word string, code int")
    known = numbered.join(counts.hint("merge"), "word", "left").join(head, "word", "left")
    back = known.select("block", "nth", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("code", F.lit(-1)).alias("code"))
    codes, masses, total, size = words.band_codes(), words.bands, words.total, len(words.head)
    kind = blocks.schema["ids"].dataType.simpleString()

    def code(own: pa.Table, found: pa.Table) -> pa.Table:
        if not own.num_rows:
            return own_schema.empty_table()
        nth = found.column("nth").to_numpy()
        c, given = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
        c[nth], given[nth] = found.column("c").to_numpy(), found.column("code").to_numpy()
        of_band = np.zeros(65, np.int64)
        mass = np.ones(65)
        for b, k in codes.items():
            of_band[b], mass[b] = k, masses[b]
        bands = np.where(c > 0, np.frexp(c.astype(np.float64))[1], 0)
        coded = np.where(given >= 0, given, of_band[bands])
        within = np.where(given >= 0, 0.0, np.log10((c + 1) / mass[bands]))
        base = np.log10((c + 1) / total)
        tokens = np.frombuffer(own.column("tokens")[0].as_py(), np.uint32)
        lengths = np.frombuffer(own.column("lengths")[0].as_py(), np.int32)
        at = np.cumsum(lengths) - lengths
        sums = [np.add.reduceat((c > 0)[tokens].astype(np.int64), at), np.add.reduceat(base[tokens], at), np.add.reduceat(within[tokens], at)]
        binary = [pa.array([x.tobytes()]) for x in (*sums, coded[tokens].astype("<u2"))]
        return pa.Table.from_arrays([own.column("ids"), own.column("held"), own.column("lengths"), *binary], schema=own_schema)

    schema = CODED.format(ids=kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    own_schema = to_arrow_schema(_parse_datatype_string(schema))
    assert size + len(codes) < 1 << 16
    return staged(blocks.select(F.col("block").alias("own_block"), "ids", "held", "lengths", "tokens").groupBy("own_block").cogroup(
        back.groupBy("block")).applyInArrow(code, schema))


# -- The model --------------------------------------------------------------------------------------------------------------

def softmax(logits: np.ndarray, target: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of targets, and gradients of their negative sum by `weight`; overwrites nothing."""
    rows = np.arange(len(logits))
    with np.errstate(over="ignore"):
        e = np.exp(logits)
        total = e.sum(1)
    if not (np.isfinite(total) & (total > 1e-30)).all():
        logits = logits - logits.max(1, keepdims=True)
        e = np.exp(logits)
        total = e.sum(1)
    logp = logits[rows, target] - np.log(total)
    if weight:
        e *= (logits.dtype.type(weight) / total)[:, None]
        e[rows, target] -= logits.dtype.type(weight)
    return logp, e


class Model:
    """A gated recurrent unit over token codes; P(token) = P(class | state) P(word | class, state).

    Head words fall into classes of `width` by frequency, each with a softmax of its own. A band is a class whose words share
    its probability by their counts. At the start the outputs are the corpus counts, so the model begins as the base model.
    """

    def __init__(self, words: Vocabulary, hidden: int, width: int = 64, seed: int = 7):
        self.hidden, self.width, self.head = hidden, width, len(words.head)
        self.head_classes = -(-self.head // width)
        self.classes = self.head_classes + len(words.bands)
        self.begin = self.head + len(words.bands)
        k, h, c = self.begin + 1, hidden, self.classes
        self.shapes = {"embed": (k, h), "wx": (h, 3 * h), "wh": (h, 3 * h), "b": (3 * h,), "wc": (h, c), "bc": (c,),
                       "ww": (self.head_classes * width, h), "bw": (self.head_classes * width,)}
        rng = np.random.default_rng(seed)
        p = {n: np.zeros(s, np.float32) for n, s in self.shapes.items()}
        p["embed"] = rng.standard_normal((k, h)).astype(np.float32) * 0.3
        for n in ("wx", "wh"):
            p[n] = rng.standard_normal((h, 3 * h)).astype(np.float32) / np.float32(np.sqrt(h))
        mass = np.array(words.head_counts, np.float64) + 1
        padded = np.zeros(self.head_classes * width)
        padded[:self.head] = mass
        p["bw"] = np.where(padded > 0, np.log(np.maximum(padded, 1)), -1e9).astype(np.float32)
        by_class = padded.reshape(-1, width).sum(1)
        p["bc"] = np.log(np.append(by_class, [words.bands[b] for b in sorted(words.bands)]) / words.total).astype(np.float32)
        self.p = p
        # Squares of gradients so far; biases start as counts and move slowly.
        self.seen = {n: np.full(s, 1e-4 if n in ("bc", "bw") else 1e-6, np.float32) for n, s in self.shapes.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([d[n].ravel() for d in (self.p, self.seen) for n in self.shapes])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for d in (self.p, self.seen):
            for n, s in self.shapes.items():
                size = int(np.prod(s))
                d[n] = values[at:at + size].reshape(s).astype(np.float32)
                at += size

    def states(self, codes: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States after each of the steps (steps, lanes, hidden) from `h`; `fresh` marks where a document begins."""
        n = self.hidden
        inputs = self.p["embed"][codes]
        pre = inputs @ self.p["wx"]
        pre += self.p["b"]
        out, before, news, turned = (np.empty_like(inputs) for _ in range(4))
        gates = np.empty((*inputs.shape[:2], 2 * n), inputs.dtype)
        wh, opens = self.p["wh"], fresh.any(1)
        with np.errstate(over="ignore"):
            for t in range(len(codes)):
                before[t] = h
                if opens[t]:
                    before[t, fresh[t]] = 0
                g = before[t] @ wh
                turned[t] = g[:, 2 * n:]
                x = pre[t, :, :2 * n] + g[:, :2 * n]
                np.exp(np.negative(x, out=x), out=x)
                x += 1
                np.reciprocal(x, out=gates[t])
                x = gates[t, :, n:] * turned[t]
                x += pre[t, :, 2 * n:]
                x *= -2
                np.exp(x, out=x)
                x += 1
                np.divide(2, x, out=news[t])
                news[t] -= 1
                h = out[t]
                np.subtract(before[t], news[t], out=h)
                h *= gates[t, :, :n]
                h += news[t]
        return out, (inputs, before, gates, news, turned)

    def outputs(self, h: np.ndarray, target: np.ndarray, weight: float = 0.0):
        """Log probabilities of targets (rows of h), and with `weight` the gradients of their negative sum by that weight."""
        cls = np.where(target < self.head, target // self.width, self.head_classes + target - self.head)
        logits = h @ self.p["wc"]
        logits += self.p["bc"]
        logp, e = softmax(logits, cls, weight)
        grads, dh = {}, None
        if weight:
            grads["wc"], grads["bc"], dh = h.T @ e, e.sum(0), e @ self.p["wc"].T
            grads["ww"], grads["bw"] = np.zeros_like(self.p["ww"]), np.zeros_like(self.p["bw"])
        order = np.argsort(cls, kind="stable")
        bounds = np.searchsorted(cls[order], np.arange(self.head_classes + 1))
        for c in range(self.head_classes):
            own = order[bounds[c]:bounds[c + 1]]
            if not len(own):
                continue
            part = slice(c * self.width, (c + 1) * self.width)
            hc, w = h[own], self.p["ww"][part]
            inner = hc @ w.T
            inner += self.p["bw"][part]
            more, e = softmax(inner, target[own] - c * self.width, weight)
            logp[own] += more
            if weight:
                grads["ww"][part], grads["bw"][part] = e.T @ hc, e.sum(0)
                dh[own] += e @ w
        return logp, grads, dh

    def learn(self, codes: np.ndarray, fresh: np.ndarray, target: np.ndarray, used: np.ndarray, h: np.ndarray, rate: float, weight: float) -> np.ndarray:
        """One step on a window; the state carries on, gradients stop at its beginning. Every token weighs the same in any window."""
        n = self.hidden
        out, (x, before, gates, news, turned) = self.states(codes, fresh, h)
        _, grads, dout = self.outputs(out[used], target[used], weight)
        dstate = np.zeros_like(out)
        dstate[used] = dout
        dg, dx = np.empty((*codes.shape, 3 * n), out.dtype), np.empty((*codes.shape, 3 * n), out.dtype)
        # What does not depend on later steps, for all steps at once.
        z, r = gates[..., :n], gates[..., n:]
        by_z, by_new = (before - news) * z * (1 - z), (1 - z) * (1 - news * news)
        by_r = turned * r * (1 - r)
        carry, whT, opens = np.zeros_like(h), self.p["wh"].T, fresh.any(1)
        for t in range(len(codes) - 1, -1, -1):
            d = dstate[t] + carry
            dnew = d * by_new[t]
            np.multiply(d, by_z[t], out=dg[t, :, :n])
            np.multiply(dnew, by_r[t], out=dg[t, :, n:2 * n])
            np.multiply(dnew, r[t], out=dg[t, :, 2 * n:])
            dx[t, :, 2 * n:] = dnew
            carry = d * z[t] + dg[t] @ whT
            if opens[t]:
                carry[fresh[t]] = 0
        dx[..., :2 * n] = dg[..., :2 * n]
        flat = lambda a: a.reshape(-1, a.shape[-1])
        grads["wh"], grads["wx"], grads["b"] = flat(before).T @ flat(dg), flat(x).T @ flat(dx), flat(dx).sum(0)
        din, order = flat(dx) @ self.p["wx"].T, np.argsort(codes.ravel(), kind="stable")
        which, first = np.unique(codes.ravel()[order], return_index=True)
        for name, grad in grads.items():
            np.clip(grad, -1, 1, out=grad)
            self.seen[name] += grad * grad
            self.p[name] -= rate * grad / np.sqrt(self.seen[name])
        rows = np.add.reduceat(din[order], first, axis=0)
        self.seen["embed"][which] += rows * rows
        self.p["embed"][which] -= rate * rows / np.sqrt(self.seen["embed"][which])
        return out[-1]

    def windows(self, codes: np.ndarray, lengths: np.ndarray, lanes: int, steps: int):
        """A block's documents side by side in `lanes`, `steps` tokens at a time.

        Yields (first window, lanes in use, codes before each token, where documents begin, tokens, which are there, document of each). Lanes are
        filled evenly, longest document first, so a document runs through one lane from its beginning to its end.
        """
        order = np.argsort(-lengths, kind="stable")
        heap = [(0, lane) for lane in range(min(lanes, len(lengths)))]
        own: list[list[int]] = [[] for _ in heap]
        for d in order.tolist():
            filled, lane = heapq.heappop(heap)
            own[lane].append(d)
            heapq.heappush(heap, (filled + int(lengths[d]), lane))
        own.sort(key=lambda docs: -sum(int(lengths[d]) for d in docs))
        docs = np.array([d for lane in own for d in lane], np.int64)
        size = np.array([sum(int(lengths[d]) for d in lane) for lane in own], np.int64)
        begin = np.cumsum(size) - size
        starts = np.cumsum(lengths.astype(np.int64)) - lengths
        n = lengths[docs].astype(np.int64)
        at = np.cumsum(n) - n
        place = np.repeat(starts[docs] - at, n) + np.arange(int(n.sum()))
        target, doc = codes[place].astype(np.int32), np.repeat(docs, n)
        before = np.append(np.int32(0), target[:-1]).astype(np.int32)
        before[at] = self.begin
        opens = np.zeros(len(target), bool)
        opens[at] = True
        for t in range(0, int(size.max(initial=0)), steps):
            active = int((size > t).sum())
            place = begin[:active] + np.arange(t, t + steps)[:, None]
            used = np.arange(t, t + steps)[:, None] < size[:active]
            place = np.where(used, place, 0)
            yield t == 0, active, np.where(used, before[place], self.begin), used & opens[place], target[place], used, doc[place]


def read_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["codes"], "<u2"), np.frombuffer(row["lengths"], np.int32), np.frombuffer(row["held"], np.uint8).astype(bool)


def train(coded: DataFrame, model: Model, rounds: int, rate: float, lanes: int, steps: int) -> None:
    """One pass over every training document, in rounds of distributed descent.

    Blocks are dealt to rounds by hash. In a round each task goes on from the model of the round before over its own blocks, one window
    after the other, and sends its model; models are averaged by the tokens they have seen, chunk by chunk and in two levels,
    so what reaches one task does not grow with the number of tasks, and the driver gets one model.
    """
    salted = coded.select("codes", "lengths", "held", F.pmod(F.xxhash64("lengths", F.crc32("codes")), F.lit(rounds)).alias("round"))
    for number in range(rounds):
        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            seen = 0
            for batch in batches:
                for row in batch.to_pylist():
                    codes, lengths, held = read_block(row)
                    codes, lengths = codes[np.repeat(~held, lengths)], lengths[~held]
                    seen += len(codes)
                    for first, active, inputs, fresh, target, used, _ in model.windows(codes, lengths, lanes, steps):
                        h = np.zeros((active, model.hidden), np.float32) if first else h[:active]
                        h = model.learn(inputs, fresh, target, used, h, rate, 1 / (lanes * steps))
            if seen:
                flat = model.flat()
                parts = [flat[a:a + CHUNK] for a in range(0, len(flat), CHUNK)]
                salt = TaskContext.get().partitionId() % 32
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([salt] * len(parts), pa.int32()), pa.array([float(seen)] * len(parts)),
                     pa.array([(p.astype(np.float64) * seen).astype("<f8").tobytes() for p in parts])], ["chunk", "salt", "weight", "sums"])

        def add(key, group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(v, "<f8") for v in group["sums"])
            return pd.DataFrame([{"chunk": key[0], "salt": 0, "weight": group["weight"].sum(), "sums": total.tobytes()}])

        schema = "chunk int, salt int, weight double, sums binary"
        sent = salted.where(F.col("round") == number).drop("round").mapInArrow(descend, schema)
        summed = sent.groupBy("chunk", "salt").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
        parts = summed.orderBy("chunk").collect()
        if parts:
            model.load(np.concatenate([np.frombuffer(r.sums, "<f8") / r.weight for r in parts]))


def log_likelihoods(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", held: Column | None = None, head: int = 1024, hidden: int = 16,
                    rounds: int = 6, rate: float = 0.05, lanes: int = 256, steps: int = 32, block: int = 1 << 22) -> DataFrame:
    """Log10 probability of every whole document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are words, then one end. Counts cover every training token, and the base score is that of add-one counts over all of
    them. The model reads the `head` most frequent words as themselves and the others as bands of frequency, and gives every word of the corpus
    and one unknown word a probability that sums to one; it is trained on every training document once and starts from the base
    model. A document's state starts at zero and is carried from window to window to its end.

    Null texts are empty: one token, the end. Null ids are learned from; rows that repeat count and are returned each. With nothing to learn from,
    every token is unknown. An empty table gives an empty result, and other columns are not looked at.
    """
    blocks = cut_blocks(docs, text, doc_id, held_out(doc_id) if held is None else held, block)
    words = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts").where("counts > 0")
    counts = staged(words.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c")))
    known = vocabulary(counts, head)
    coded = code_blocks(blocks, counts, known)
    discard(blocks)
    discard(counts)
    model = Model(known, hidden)
    train(coded, model, rounds, rate, lanes, steps)
    kind, n = coded.schema["ids"].dataType.elementType.simpleString(), known.tokens

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                codes, lengths, held = read_block(row)
                total = np.zeros(len(lengths))
                for first, active, inputs, fresh, target, used, doc in model.windows(codes, lengths, lanes, steps):
                    h = np.zeros((active, model.hidden), np.float32) if first else h[:active]
                    out, _ = model.states(inputs, fresh, h)
                    h = out[-1]
                    logp, _, _ = model.outputs(out[used], target[used])
                    total += np.bincount(doc[used], logp, len(total))
                known, base, rest = np.frombuffer(row["known"], np.int64), np.frombuffer(row["base"]), np.frombuffer(row["rest"])
                ids = batch.column("ids").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(held), pa.array(lengths.astype(np.int64)), pa.array(known), pa.array(np.full(len(lengths), n)), pa.array(base),
                     pa.array(total / np.log(10) + rest)], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return coded.mapInArrow(
        score, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
