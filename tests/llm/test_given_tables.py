"""The ready-made corpus queries against their check SQL, or against plain programs where there is none."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF_SMALL
from sensorloom.llm import queries
from sensorloom.plans.registry import Query


@pytest.fixture(scope="module")
def documents():
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_equals_check_sql(spark, name):
    assert compare(spark, connect(SF_SMALL), Query(queries.QUERIES[name], queries.CHECKS[name]), SF_SMALL) is None


def test_one_query_per_operator():
    assert [min(n for n in entry.queries() if n.startswith(f"op{i}_")) for i in range(1, 14)]
    assert "pipeline" in entry.queries()


def test_packing_covers_every_id_once(spark, documents):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, fill = {}, {}
    for r in queries.QUERIES["op1_pack_multiway"](spark, SF_SMALL).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == documents.keys()
    for doc_id, text in documents.items():
        ids, at = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.02 * total


def test_bpe_equals_the_library(spark, documents):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.QUERIES["op4_bpe_distinct_words"](spark, SF_SMALL).collect():
        ids, text = own.encode_ordinary(documents[r.doc_id]), documents[r.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def plain_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_shingles(text, width=5):
    words = text.encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def alike(a, b):
    return bool(a and b) and len(a & b) >= 0.8 * len(a | b)


def test_simhash_equals_brute_force(spark, documents):
    prints = {i: plain_fingerprint(t) for i, t in documents.items()}
    parent = {i: i for i in prints}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op8_simhash_trie"](spark, SF_SMALL).collect()}
    assert got == {i: (f"{prints[i]:016x}", root(i)) for i in prints}


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn or kind == "phone" and 9 <= len(digits) <= 15):
                yield kind, f"{kind}:{m.start()}:{m.end()}"


def test_personal_data_equals_plain_patterns(spark, documents):
    df = queries.QUERIES["op6_pii_bootstrap"](spark, SF_SMALL)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    for r in df.collect():
        spans = list(plain_spans(documents[r.doc_id]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _ in spans) for kind, _ in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(s for _, s in spans).encode()).hexdigest()
        assert {s for _, s in spans} <= set(r.spans.split(",")) | {""}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = queries.QUERIES["op5_toxicity_nnpu"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in toxic]
    pairs = [(p.score > n.score) + (p.score == n.score) / 2 for p in known if toxic[p.doc_id] for n in known if not toxic[n.doc_id]]
    assert sum(pairs) / len(pairs) > 0.85
    assert np.mean([(r.predicted == 1) == (toxic[r.doc_id] == 1) for r in known]) > 0.9


def test_every_repeated_passage_is_covered(spark, documents):
    spans, places = {}, {}
    for r in queries.QUERIES["op9_compact_windows"](spark, SF_SMALL).collect():
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word, r.class_id))
    for i, text in documents.items():
        words = text.encode().lower().split()
        for at in range(len(words) - 49):
            places.setdefault(tuple(words[at:at + 50]), set()).add((i, at))
    repeats = [p for p in places.values() if len({i for i, _ in p}) > 1]
    assert repeats
    for places_of in repeats:
        classes = [{c for a, b, c in spans[i] if a <= at and at + 50 <= b} for i, at in places_of]
        assert all(classes) and len(set().union(*classes)) == 1


def test_pipeline_stages(spark, documents):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for (name, stage), operator in zip(pipeline.STAGES[:4], (5, 7, 8, 6), strict=True):
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, SF_SMALL).toPandas())
        after = {r.doc_id: r.text for r in kept.collect()}
        assert kept.columns == docs.columns and after.keys() <= before.keys(), name
        if operator == 7:
            groups = {}
            for i, t in before.items():
                groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
            assert after.keys() == {min(g)[1] for g in groups.values()}
        elif operator == 8:
            prints = [plain_fingerprint(t) for t in after.values()]
            assert all((a ^ b).bit_count() > 2 for n, a in enumerate(prints) for b in prints[:n])
            sets = {i: plain_shingles(t) for i, t in before.items()}
            assert not any(alike(sets[a], sets[b]) for a in after for b in after if a < b)
            full = {i: plain_fingerprint(t) for i, t in before.items()}
            assert all(any(j < i and (alike(sets[i], sets[j]) or (full[i] ^ full[j]).bit_count() <= 2) for j in before)
                       for i in before.keys() - after.keys())
        elif operator == 6:
            assert all(any(plain_spans(before[i])) == (t != before[i]) and not any(plain_spans(t)) for i, t in after.items())
    ids = {r.doc_id for r in pipeline.packed(spark, kept, SF_SMALL).select("doc_id").collect()}
    assert ids == after.keys()
