"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.llm import ann, bpe, chat_quotes, exact_dedup, packing, pieces, pii, simhash, substring, toxicity, warc
from sensorloom.llm.common import components, numbered

SCHEMA = "doc_id long, text string, row long, id long, score double, `a.b` string, next string"
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    long = "word " * 30_000 + "x" * 50_000
    texts = [(1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (3, "a\tb\nc "), (None, None), (5, ""), (6, " \n"), (None, "abc"),
             (8, long), (9, long), (10, "日本 ٣ ² <|endoftext|> it's")]
    return spark.createDataFrame([(i, t, 0, 0, 0.5, "x", "y") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(odd, empty):
    rows = exact_dedup.exact_duplicates(numbered(odd.select("doc_id", "text"))).collect()
    assert len(rows) == 11
    abc = [r for r in rows if r.text_sha256 == hashlib.sha256(b"abc").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in abc} == {(3, 5)} and sum(r.kept for r in abc) == 1
    blank = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in blank} == {(6, 3)}
    assert [(r.id, r.kept) for r in rows if r.keep_id == 8] in ([(8, True), (9, False)], [(9, False), (8, True)])
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [3, 6, 8, 10]
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_radix_rounds_split_long_common_prefixes(spark):
    texts = ["p" * 5000 + tail for tail in ("", "x", "x", "y", "yy")] + ["p" * 64, "p" * 64, "p" * 63, "p" * 1088, "p" * 1088]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(numbered(df)).collect()}
    assert got == {i: (texts.index(t), texts.count(t)) for i, t in enumerate(texts)}


def test_simhash(odd, empty):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == 11 and simhash.simhash_groups(empty).count() == 0
    assert {r.component_id for r in rows if r.fp == 0} == {5}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IN (8, 9)").count() == 1


@pytest.mark.parametrize("leaf", [1, 4])
def test_trie_links_equal_brute_force(spark, leaf):
    rng = np.random.default_rng(3)
    centre = rng.integers(-2**63, 2**63 - 1, 40, dtype=np.int64)
    codes = {0, -1, *centre.tolist()}
    for c in centre[:20].tolist():
        for _ in range(12):
            flips = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False))
            codes.add((c ^ flips if flips < 2**63 else c ^ (flips - 2**64)))
    codes = sorted(codes)
    df = spark.createDataFrame([(c,) for c in codes], "fp long")
    got = [tuple(sorted(r)) for r in simhash.trie_links(df, 2, leaf=leaf).collect()]
    want = [(a, b) for a in codes for b in codes if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert sorted(got) == sorted(want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7), (400, 401), (400, 401)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100, 400: 400, 401: 400}


def test_packing(odd, empty):
    pieces_of = packing.pack(odd, JSON)
    rows = pieces_of.collect()
    assert sum(r.length for r in rows if r.start == 0 and r.doc_tokens == 1) == 2  # null and empty
    from tokenizers import Tokenizer

    text = odd.where("doc_id = 10").first().text
    ids = b"".join(bytes(r.ids) for r in sorted((r for r in rows if r.id == 10), key=lambda r: r.start))
    assert np.frombuffer(ids, "<u4").tolist() == [*Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids, 1]
    assert packing.pack(empty, JSON).count() == 0
    lengths = [r.length for r in packing.sequences(pieces_of).collect()]
    assert sum(lengths) == sum(r.length for r in rows) and max(lengths) <= 2048


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=40))
def test_plan_covers_each_id_once(tokens):
    doc, start, length, sequence, offset, n = packing.plan_windows(np.array(tokens, np.int64), 16, grain=4, slack=1)
    seen = [np.zeros(t, int) for t in tokens]
    load = np.zeros(n, int)
    for d, s, m, q, o in zip(doc, start, length, sequence, offset, strict=True):
        seen[d][s:s + m] += 1
        assert o == load[q]
        load[q] += m
    assert all((x == 1).all() for x in seen) and (load <= 16).all() and (load > 0).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab's tmdrevl\n\t 1.!éß×²\x1c\xa0日", max_size=14), max_size=5))
def test_pieces_equal_the_pattern(texts):
    import pyarrow as pa
    import regex

    data, offsets = pieces.utf8(pa.array(texts, pa.string()))
    want = [p.encode() for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)]
    starts = pieces.piece_starts(data, offsets)
    code, first, _ = pieces.distinct_pieces(data, starts)
    words = pieces.piece_bytes(data, starts, first)
    assert [words[c] for c in code] == want and pieces.PATTERN == public_tokenizers.PATTERN


def test_bpe(odd, empty):
    rows = bpe.decode(bpe.encode(odd, RANKS), RANKS).collect()
    assert sorted(bytes(r.decoded).decode() for r in rows) == sorted(r.text or "" for r in odd.collect())
    assert bpe.encode(empty, RANKS).count() == 0


def test_bpe_decode_of_null_and_unknown(spark):
    df = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    assert [r.decoded and bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()] == [None, b"", b'!"']
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>"), RANKS).collect()


def test_toxicity(spark, odd, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn(odd, none).score("any") == 0
    assert toxicity.learn(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).score("") == 0
    texts = [(i, f"{'vile ' if i % 4 == 0 else 'kind '} w{i % 7} w{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400, 2)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert model.score("vile w1 w2") > model.score("kind w1 w2")
    assert docs.select(toxicity.score(model).alias("s"), "doc_id").count() == 400
    assert odd.select(toxicity.score(model)).count() == 11


def test_contexts_lead_to_unseen_identifiers(spark):
    rng = np.random.default_rng(0)

    def word():
        return "".join(rng.choice(list("abcdefgh"), 6))

    texts = [f"{word()} {word()} my phone number +49 {rng.integers(100, 999)} {rng.integers(100000, 999999)} {word()}" for _ in range(40)]
    texts += [f"{word()} my phone number 030-{rng.integers(1000000, 9999999)} {word()}" for _ in range(3)]
    texts += [f"{word()} {word()} 030-{rng.integers(1000000, 9999999)} {word()}", "a@b.c_d@e.f x@y", "", None]
    rows = numbered(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    report = pii.span_report(rows.select("row", "doc_id"), pii.personal_spans(rows)).orderBy("doc_id").collect()
    assert all(r.n_phone == 1 and r.spans.startswith("phone:") for r in report[:40])
    assert all(r.n_phone == 0 and r.spans.startswith("phone:") for r in report[40:43])
    assert report[43].spans == "" and report[44].base_spans == "email:0:5,email:5:11" and report[45].spans == report[46].spans == ""


def test_mask(spark, odd, empty):
    docs = spark.createDataFrame(
        [(1, "mail 日 me@x.de or 1.2.3.4", 25, "k"), (2, None, None, "k"), (3, "no", 9, "k"), (4, "4" * 30 + "é" * 3, 33, "k")],
        "doc_id long, text string, n_chars long, row string")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.mask(docs).collect()}
    assert got == {1: ("mail 日 [EMAIL] or [IP]", 22), 2: (None, None), 3: ("no", 9), 4: ("4" * 30 + "é" * 3, 33)}
    assert pii.mask(empty).count() == 0 and pii.mask(odd).count() == 11


def test_mask_leaves_columns_with_its_own_names_alone(spark):
    rows = [(1, "write to ann@example.org now", "keep", [1]), (2, None, "this", None)]
    out = pii.mask(spark.createDataFrame(rows, "doc_id long, text string, _pii_row string, _pii_runs array<int>")).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(1, "write to [EMAIL] now", "keep", [1]), (2, None, "this", None)]


def test_neighbours(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [-1.0, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, part int")
    clean = ann.clean(df)
    assert clean.count() == 5
    got = [tuple(r) for r in ann.search(ann.build_index(clean), clean.where("id % 20 = 0"), k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0)]
    none = ann.clean(df.limit(0))
    assert ann.search(ann.build_index(none), none).count() == 0


def test_neighbours_recall(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((3000, 48)).astype(np.float32) + 2
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    clean = ann.clean(df)
    rows = ann.search(ann.build_index(clean, block=500), clean.where("id % 100 = 0"), k=10).collect()
    scores = v.astype(float) @ v.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    found = sum(r.vec_id in np.argsort(-scores[r.query_id])[:10] for r in rows)
    assert len(rows) == 300 and found >= 0.99 * 300


def test_warc(spark, tmp_path):
    big = "é" * 70_000
    pages = [(1, "http://a", "same"), (2, None, "same"), (None, "u\r\nx", "same"), (3, "u", big), (4, "u", ""), (5, "u", None), (3, "u", big), (6, "u", "x\r\n\r\ny")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, type string")
    warc.write_archives(df, str(tmp_path / "w"), segment_bytes=5000, records_per_file=7)
    records = warc.read_records(spark, str(tmp_path / "w"))
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to, r.problem) for r in warc.page_index(spark, str(tmp_path / "w")).collect())
    assert got == sorted([
        ("1", 4, "revisit", "2", None), ("2", 4, "response", None, None), ("None", 4, "revisit", "2", None),
        ("3", 140_000, "response", None, None), ("3", 140_000, "revisit", "3", None), ("4", 0, "revisit", "5", None),
        ("5", 0, "response", None, None), ("6", 6, "response", None, None)])
    whole = warc.payloads(warc.reassemble(records)).where("page_id = '3' AND type = 'response'").first()
    assert bytes(whole.payload).decode() == big
    broken = warc.reassemble(records.where("segment IS NULL OR segment <> 2")).where("problem IS NOT NULL").collect()
    assert len(broken) == 1 and broken[0].block is None
    cut = warc.reassemble(records.where("total IS NULL")).where("problem IS NOT NULL").collect()
    assert [r.problem for r in cut] == ["the last segment is missing"]


def test_warc_of_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.page_index(spark, str(tmp_path / "w")).count() == 0


def test_passages(spark, odd, empty):
    rng = np.random.default_rng(1)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 10**6, n)]

    shared, near = words(51), words(80)
    other = [*near[:40], "changed", *near[41:]]
    docs = [words(60) + shared + words(70), words(10) + shared, words(300), near, words(20) + other + words(9), shared[:49], []]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r for r in substring.repeated_passages(df).collect()}
    assert sorted(got) == [0, 1, 3, 4]
    assert got[0].class_id == got[1].class_id and got[0].class_doc == got[1].class_doc == 0
    assert got[0].start_word <= 60 and got[0].end_word >= 111 and got[3].class_id == got[4].class_id != got[0].class_id
    assert substring.repeated_passages(empty).count() == 0
    assert {r.doc_id for r in substring.repeated_passages(odd).collect()} == {8, 9}


def test_quotes(spark, empty):
    rows = [
        (1, 0, "user", "How do I bake\nbread?\n\nI have flour."), (1, 1, "assistant", "> How do I bake bread?\n\nWith heat."),
        (1, 2, "user", ">> How do I bake\n>> bread?\n> With heat.\n\nHow hot?"), (1, 3, "user", "> I have flour.\n\nGood."),
        (1, 4, "user", "> nobody said this\nSo?"), (2, 0, None, None), (2, 1, "user", "> How do I bake bread?\nyes"),
        (None, None, "user", "lost"), (None, 5, "user", "> lost\nfound")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, row int")
    got = {(r.conv_id, r.turn): (r.reply_to, r.link, r.thread, r.depth, r.quotes, r.content) for r in chat_quotes.conversations(df).collect()}
    assert got == {
        (1, 0): (None, None, 0, 0, 0, "How do I bake\nbread?\n\nI have flour."), (1, 1): (0, "quote", 0, 1, 1, "With heat."),
        (1, 2): (1, "quote", 0, 2, 2, "How hot?"), (1, 3): (0, "quote", 0, 1, 1, "Good."), (1, 4): (3, "turn", 0, 2, 1, "So?"),
        (2, 0): (None, None, 0, 0, 0, ""), (2, 1): (0, "turn", 0, 1, 1, "yes"),
        (None, None): (None, None, None, 0, 0, "lost"), (None, 5): (None, "quote", None, 1, 1, "found")}
    assert chat_quotes.conversations(df.limit(0)).count() == 0


def test_previous_across_slices(spark):
    df = numbered(spark.createDataFrame([(1, t) for t in range(0, 300, 3)], "conv long, turn long"))
    turn = {r.row: r.turn for r in df.collect()}
    got = {turn[r.row]: turn.get(r.before) for r in chat_quotes.previous(df, 16).collect()}
    assert got == {t: (t - 3 if t else None) for t in range(0, 300, 3)}
    assert df.where(F.col("row").isNull()).count() == 0


def _similar_groups(spark, texts):
    rows = numbered(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    of = {r.row: r.doc_id for r in rows.collect()}
    roots = {of[r.node]: r.root for r in components(simhash.similar_links(rows, "text", "row")).collect()}
    return {i: roots.get(i, -1 - i) for i in range(len(texts))}


@pytest.mark.parametrize("copies", [200, 600])
def test_similar_copies_of_one_original(spark, copies):
    rng = np.random.default_rng(5)
    original = [f"w{i}" for i in rng.integers(0, 10**6, 600)]
    texts = []
    for _ in range(copies):
        own = list(original)
        for at in rng.choice(600, 9, replace=False):
            own[at] = f"x{rng.integers(0, 10**9)}"
        texts.append(" ".join(own))
    texts.insert(copies // 2, " ".join(original))
    sets = [set(simhash.shingle_hashes(t).tolist()) for t in texts]
    from_original = {i for i, s in enumerate(sets) if len(s & sets[copies // 2]) >= 0.8 * len(s | sets[copies // 2])}
    assert len(from_original) > copies * 0.99
    got = _similar_groups(spark, texts)
    assert len({got[i] for i in from_original}) == 1


def test_similar_pairs_of_any_length(spark):
    rng = np.random.default_rng(6)
    texts = []
    for n in [5, 8, 8, 8, 9, 12, 20, 40, 100] * 20:
        base = [f"w{i}" for i in rng.integers(0, 10**9, n)]
        texts += [" ".join(base), " ".join([*base, "more"])]
    sets = [set(simhash.shingle_hashes(t).tolist()) for t in texts]
    near = [i for i in range(0, len(texts), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])]
    got = _similar_groups(spark, texts)
    assert len(near) == 160 and all((got[i] == got[i + 1]) == (i in near) for i in range(0, len(texts), 2))
    assert len(set(got.values())) == len(texts) - len(near)


def test_similar_chains_without_an_original(spark):
    # Rows of one crowded line: chains of pairs, none of which holds the lead.
    rng = np.random.default_rng(7)
    line = [f"line{i}" for i in range(30)]
    texts = []
    for _ in range(60):
        base = line + [f"w{i}" for i in rng.integers(0, 10**9, 20)]
        for k in range(3):
            texts.append(" ".join(base[:-k] + [f"y{rng.integers(0, 10**9)}"] * k if k else base))
    sets = [set(simhash.shingle_hashes(t).tolist()) for t in texts]
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                up = [up[j] if u == up[i] else u for u in up]
    got = _similar_groups(spark, texts)
    assert len(set(up)) == len(set(got.values())) and len(set(zip(up, got.values(), strict=True))) == len(set(up))


def _with_changed_middle(rng, n, pairs):
    """Texts 2i and 2i+1 share a passage of n words but for its middle word, between words of their own."""
    docs = []
    for _ in range(pairs):
        shared = [f"w{i}" for i in rng.integers(0, 10**9, n)]
        for text in (shared, [*shared[:n // 2], "changed", *shared[n // 2 + 1:]]):
            around = [f"w{i}" for i in rng.integers(0, 10**9, 80)]
            docs.append(around[:40] + text + around[40:])
    return docs


def test_near_passages_are_found_by_some_signature(spark):
    docs = _with_changed_middle(np.random.default_rng(8), 70, 100)
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    found = {r.doc_id for r in substring.repeated_passages(df).collect()}
    assert len(found) >= 2 * 98


def test_near_passages_are_compared_at_every_place(spark):
    # The shortest passages that pass at all: one window, with one word changed in its middle.
    docs = _with_changed_middle(np.random.default_rng(9), 50, 60)
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {}
    for r in substring.repeated_passages(df).collect():
        got.setdefault(r.class_id, set()).add((r.doc_id, r.start_word, r.end_word))
    exact = [{(2 * i, 40, 90), (2 * i + 1, 40, 90)} for i in range(60)]
    assert sum(g in got.values() for g in exact) >= 57


def test_alike_places():
    rng = np.random.default_rng(10)
    for _ in range(50):
        a, b = rng.integers(0, 6, 40).tolist(), rng.integers(0, 6, 40).tolist()
        sets = [(set(a[i:i + 9]), set(b[i:i + 9])) for i in range(32)]
        assert list(substring.alike_places(a, b, 32, 9, 0.8)) == [i for i, (x, y) in enumerate(sets) if len(x & y) >= 0.8 * len(x | y)]


def test_bootstrap_goes_on_while_values_are_accepted(spark):
    # Three contexts a level hold its values and the fewer ones of the next, which are reached a round later.
    levels, rows = [40, 19, 9, 4, 1], []
    for j, n in enumerate(levels):
        for i in range(n):
            kind, value = "number" if j else "phone", f"{'+' if not j else ''}5{j}5000{i:03d}1"
            for at in {j, max(j - 1, 0)}:
                rows += [(value, kind, f"{c}{'abcdef'[at]}", "") for c in ("one", "two", "three")]
    found = spark.createDataFrame(rows, "value string, kind string, before string, after string")
    got = {r.value for r in pii.bootstrap(found).collect()}
    assert {v for v, kind, *_ in rows if kind == "number"} <= got
    with pytest.raises(RuntimeError):
        pii.bootstrap(found, rounds=2)


@pytest.mark.parametrize("longest, number", [(3, 3), (16, 6), (64, 8), (5000, 10)])
def test_shingles_of_texts_end_to_end(longest, number):
    texts = ["", "One two\u00a0three  FOUR\tfive\nsix", "é", "a", "x" * 63 + " " + "Y" * 64 + " " + "z" * 65 + " w " + "V" * 5000 + " end", "", "b c d e f", " "]
    data = [b" ".join(w for w in t.encode().split(b" ") if len(w) <= longest) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    with np.errstate(over="ignore"):
        want = []
        for n, d in enumerate(data):
            words = [np.frombuffer(w, np.uint8).astype(np.uint64) + np.uint64(1) for w in d.lower().split()]
            own = [substring.mixed(np.array([(w * substring._spread(np.arange(len(w)) * 2)).sum()], np.uint64), 0) for w in words]
            for x in range(len(own) - 2):
                factors = substring._spread(np.arange(3) * 2 + 1_000_003)
                want.append((int(substring.mixed(sum(h * f for h, f in zip(own[x:x + 3], factors)), 0)[0]), n, x))
    got = substring.shingles(np.frombuffer(b"".join(data), np.uint8), offsets, 3)
    assert list(zip(*(v.tolist() for v in got))) == want and len(want) == number
    assert len(substring.shingles(np.zeros(0, np.uint8), np.zeros(2, np.int64), 3)[0]) == 0


@pytest.mark.parametrize("seed,values", [(1, 6), (2, 40), (3, 400)])
def test_rare_shingles_of_many_runs_equal_those_run_by_run(seed, values):
    rnd, size, similarity = np.random.default_rng(seed), 9, 0.8
    runs = [rnd.integers(2**32 - values, 2**32, n, dtype=np.uint32) for n in rnd.integers(size, 60, 300)]
    codes, bounds = np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    of, kinds, least = substring.run_tokens(codes, bounds, size)
    assert list(zip(of.tolist(), kinds.tolist())) == [(i, c) for i, r in enumerate(runs) for c in sorted(set(r.tolist()))]
    assert least.tolist() == [min(len(set(r[x:x + size].tolist())) for x in range(len(r) - size + 1)) for r in runs]
    often = {c: int((kinds == c).sum()) for c in set(kinds.tolist())}
    fewest = {c: int(least[of[kinds == c]].min()) for c in often}
    want = set()
    for i, r in enumerate(runs):
        for x in range(len(r) - size + 1):
            own = sorted(set(r[x:x + size].tolist()), key=lambda c: (often[c], c))
            m = len(own)
            want |= {(i, c) for k, c in enumerate(own)
                     if m - k >= similarity / (1 + similarity) * (m + max(fewest[c], similarity * m)) - 1e-9 and often[c] > 1}
    n, low = (np.array([d[c] for c in kinds.tolist()]) for d in (often, fewest))
    mixed = np.argsort(rnd.random(len(of)) + of, kind="stable")
    got = substring.rare_tokens(codes, bounds, of[mixed], kinds[mixed], n[mixed], low[mixed], size, similarity)
    assert len(want) > 100 and sorted(zip(*(v.tolist() for v in got))) == sorted(want)


@pytest.mark.parametrize("changed", [False, True])
def test_passages_around_a_common_line(spark, changed):
    # A line of 44 words in 260 documents fills most of a window, so signatures of its windows are crowded. In 40 pairs of them the
    # words around the line are equal too; then one word of 64 is changed.
    rng = np.random.default_rng(11)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 10**9, n)]

    line, docs = words(44), []
    for i in range(220):
        around = words(20 if changed else 8)
        half = len(around) // 2
        for j in range(2 if i < 40 else 1):
            own = around.copy()
            if changed and j:
                own[2] = "changed"
            docs.append((2 * i + j, " ".join([*words(30), *own[:half], *line, *own[half:], *words(30)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    classes = {}
    for r in substring.repeated_passages(df).collect():
        classes.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(classes.values(), key=min) == [{2 * i, 2 * i + 1} for i in range(40)]


def test_only_signatures_that_are_met_again_travel_and_a_long_copy_is_one_link(spark):
    rng = np.random.default_rng(12)

    def text(n):
        return " ".join(f"w{i}" for i in rng.integers(0, 10**9, n))

    copy = text(2000)
    alone = substring.blocks_of(spark.createDataFrame([(i, text(300)) for i in range(30)], "id long, text string"))
    assert substring.met_signatures(alone, 5, 46, 8, 3).count() == 0
    rows = substring.blocks_of(spark.createDataFrame([(1, text(300)), (2, copy), (3, text(300)), (4, copy)], "id long, text string"))
    met = substring.met_signatures(rows, 5, 46, 8, 3)
    shared = substring.shared_runs(rows, met, 5, 50, 8, 3)
    links = substring.merged_links(shared.where("links IS NOT NULL").select("bucket", "links"), 50).collect()
    ids = {r.row: r.id for r in rows.collect()}
    assert [({ids[r.row], ids[r.to_row]}, r.low, r.high, r.to_low) for r in links] == [({2, 4}, 0, 1950, 0)]


def test_packets_keep_every_value():
    rng = np.random.default_rng(13)
    key, n, least = rng.integers(0, 50, 400).astype(np.uint64), rng.integers(1, 9, 400).astype(np.int32), rng.integers(1, 40, 400).astype(np.int32)
    of, table = substring.counted(key, n, least)
    assert (table["key"][of] == key).all() and len(set(table["key"].tolist())) == len(table)
    assert all((r["n"], r["least"]) == (n[key == r["key"]].sum(), least[key == r["key"]].min()) for r in table)
    found, data = substring.by_bucket(key, key, 7)
    column = pa.chunked_array([data])
    values = substring.unpacked(column, np.dtype("<u8"))
    assert found.tolist() == list(range(7)) and sorted(values.tolist()) == sorted(key.tolist())
    assert all((np.frombuffer(p, "<u8") % 7 == b).all() for b, p in zip(found, data.to_pylist()))
    kept = substring.only(column, values, values > 20).to_pylist()
    assert kept == [v[v > 20].tobytes() for v in (np.frombuffer(p, "<u8") for p in data.to_pylist())]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_links_cover_the_same_passages(spark, seed):
    rng = np.random.default_rng(seed)
    links = np.empty(300, substring.LINK_TYPE)
    links["row"], links["to_row"], links["low"] = rng.integers(0, 3, 300), rng.integers(3, 5, 300), rng.integers(0, 900, 300)
    links["high"], links["to_low"] = links["low"] + rng.integers(0, 30, 300), links["low"] + rng.integers(0, 2, 300) * 7
    df = spark.createDataFrame([tuple(r) for r in links.tolist()], "row long, to_row long, low int, high int, to_low int")
    want = set()
    for key in {(a, b, e - c) for a, b, c, _, e in links.tolist()}:
        own = sorted((c, d) for a, b, c, d, e in links.tolist() if (a, b, e - c) == key)
        low, high = own[0]
        for c, d in own[1:]:
            if c - high > 50:
                want.add((key[0], low, high, key[1], low + key[2]))
                low, high = c, d
            high = max(high, d)
        want.add((key[0], low, high, key[1], low + key[2]))
    got = [(r.row, r.low, r.high, r.to_row, r.to_low) for r in substring.merged_links(substring.packed_links(df, 4), 50).collect()]
    assert len(got) == len(set(got)) and set(got) == want
