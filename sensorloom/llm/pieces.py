"""Splitting blocks of texts into the pieces of byte-level BPE, and their distinct pieces, with array operations."""

from __future__ import annotations

import base64
import json
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex

# Fixed value: the split of text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PATTERN = regex.compile(PATTERN)

LETTER, DIGIT, SPACE, OTHER, UNSURE = range(5)
STEP = 1 << 20  # bytes hashed at once


def _classes() -> np.ndarray:
    """Class of each byte in texts of ASCII and Latin letters up to U+024F."""
    out = np.full(256, OTHER, np.uint8)
    for b in range(256):
        if chr(b).isalpha() and b < 128 or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC8:
            out[b] = LETTER
        elif 0x30 <= b <= 0x39:
            out[b] = DIGIT
        elif b == 32 or 9 <= b <= 13:
            out[b] = SPACE
        elif b >= 0xC0:
            out[b] = UNSURE
    return out


CLASSES = _classes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all pieces of texts laid end to end; text i is data[offsets[i]:offsets[i + 1]].

    The pattern's rules as boundaries between runs of a class: a space joins the run after it, the last
    white space before a word stands apart from those before it, and an apostrophe directly after a
    word may begin a contraction. Texts with characters whose class needs more than a byte are split by the
    pattern itself.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = CLASSES[data]
    # Not letters among two-byte characters of U+00C0 to U+00FF.
    odd = (kind == UNSURE)
    lead = data == 0xC3
    odd[:-1] |= lead[:-1] & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    start = change & space
    blank = data == 32
    word = change & ~space
    word[1:] &= first[1:] | ~blank[:-1]
    start |= word
    # The last of some white space, if a word of the same text follows.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    start |= last
    quote = np.flatnonzero(word & (data == 39))
    if len(quote):
        ends = np.append(offsets[1:], n)
        room = ends[np.searchsorted(offsets, quote, "right") - 1] - quote
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = (room > 1) & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (room > 2) & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        for at, size in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            after = at + size
            after = after[after < n]
            start[after] |= (kind[after] == LETTER) & ~first[after]
    found = np.flatnonzero(start)
    if odd.any():
        bad = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)
        keep = np.ones(len(found), bool)
        parts = []
        for i in bad.tolist():
            a, b = int(offsets[i]), int(offsets[i + 1])
            keep[np.searchsorted(found, a):np.searchsorted(found, b)] = False
            sizes = [len(p.encode()) for p in _PATTERN.findall(data[a:b].tobytes().decode())]
            parts.append(a + np.cumsum(sizes) - sizes)
        found = np.sort(np.concatenate([found[keep], *parts]))
    return found


def block_starts(data: np.ndarray, offsets: np.ndarray, size: int = 4 << 20) -> np.ndarray:
    """`piece_starts` of a large block, some megabytes of texts at a time."""
    parts = [np.zeros(0, np.int64)]
    for a, b in text_ranges(offsets, size):
        parts.append(offsets[a] + piece_starts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
    return np.concatenate(parts)


def text_ranges(offsets: np.ndarray, size: int):
    """Ranges of texts of about `size` bytes, at least one text each."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + size))))
        yield a, b
        a = b


def _spread(keys: np.ndarray) -> np.ndarray:
    """Pseudo-random odd multipliers of positions."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def _windows(starts: np.ndarray, n: int):
    """Ranges of pieces that together have about STEP bytes."""
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + STEP)))
        yield a, b, int(starts[b]) if b < len(starts) else n
        a = b


def distinct_pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each piece among the distinct ones; of each distinct piece the index of its first occurrence and its hash.

    Pieces are told apart by a 64-bit hash and then compared with the first of their kind byte by byte; should
    two differ, the numbers come from a dictionary of the bytes.
    """
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sizes = np.diff(np.append(starts, n))
    table = _spread(np.arange(int(sizes.max()) + 1) * 2)
    hashes = np.empty(len(starts), np.uint64)
    for a, b, end in _windows(starts, n):
        own, base = sizes[a:b], starts[a:b] - starts[a]
        within = np.arange(end - starts[a]) - np.repeat(base, own)
        value = (data[starts[a]:end].astype(np.uint64) + np.uint64(1)) * table[within]
        hashes[a:b] = np.add.reduceat(value, base)
    code, _ = pd.factorize(hashes)
    first = np.full(int(code.max()) + 1, -1, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    same = np.array_equal(sizes, sizes[first[code]])
    if same:
        for a, b, end in _windows(starts, n):
            shift = np.repeat(starts[first[code[a:b]]] - starts[a:b], sizes[a:b])
            at = np.arange(starts[a], end)
            if not np.array_equal(data[at], data[at + shift]):
                same = False
                break
    if not same:
        raw = data.tobytes()
        code, uniques = pd.factorize(np.array([raw[a:a + s] for a, s in zip(starts.tolist(), sizes.tolist(), strict=True)], object))
        first = np.full(len(uniques), -1, np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return code, first, hashes[first]


def piece_bytes(data: np.ndarray, starts: np.ndarray, which: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    ends = np.append(starts[1:], len(data))
    return [raw[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]


def take_ranges(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[begins[i]:begins[i] + sizes[i]] for all i, end to end."""
    total = int(sizes.sum())
    if not total:
        return values[:0]
    out_at = np.cumsum(sizes) - sizes
    return values[np.repeat(begins - out_at, sizes) + np.arange(total)]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of ids end to end, with their begins and sizes."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    values = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
    return values, np.cumsum(sizes) - sizes, sizes


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level vocabulary: a .tiktoken file, or a tokenizer .json whose ids follow its merges."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as text:
        model = json.load(text)["model"]
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that the file shows as themselves
    others = iter(range(256, 512))
    shown = {chr(b if b in plain else next(others)): b for b in range(256)}
    special = model["vocab"].keys() - {t for t in model["vocab"] if all(c in shown for c in t)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(model["vocab"][a + b] != rank for rank, (a, b) in enumerate(merges, 256)):
        raise ValueError("the ids of this vocabulary do not follow its merges")
    ranked = {t for t, rank in model["vocab"].items() if rank < 256 + len(merges)} - special
    return {bytes(shown[c] for c in t): model["vocab"][t] for t in ranked}


_encoders: dict[str, object] = {}


def piece_encoder(path: str):
    """The merges of a vocabulary for single pieces: bytes -> ids. One per Python worker and file."""
    if path not in _encoders:
        import tiktoken

        _encoders[path] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})._encode_single_piece
    return _encoders[path]
