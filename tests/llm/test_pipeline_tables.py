"""The pipeline on tables with nulls, empty, equal and very long texts, repeated rows, no rows, and columns of clashing names."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, _pii_row string, score double"
LABELS = "doc_id long, quality int, toxic int"
LONG = "word " * 3000 + "x" * 20_000


@pytest.mark.parametrize("rows", [
    [],
    [(1, "a calm text about tea"), (2, "a calm  text about tea"), (2, "a calm  text about tea"), (None, None), (None, ""), (5, " \n"), (6, LONG),
     (7, LONG + " end"), (8, "reach me at ann@example.org please"), (9, "you are vile vile vile filth"), (10, "you are vile filth and vile")],
], ids=["empty", "odd"])
def test_pipeline(spark, tmp_path, rows):
    docs = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 0, "k", 0.5) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(None, 0, 1), (99, 1, 0), (99, 1, 0), (1, None, None)][:4 if rows else 0], LABELS)  # nothing to learn from
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(out, key=lambda r: (r.doc_id or 0, r.start)):
        got.setdefault(r.doc_id, []).extend(int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4))
    if not rows:
        assert out == []
        return
    # Equal texts leave the longest, near ones the smallest id, empty ones one row of either id.
    texts = {2: "a calm  text about tea", 6: LONG, 8: "reach me at [EMAIL] please"}
    assert set(got) >= texts.keys() and not {1, 7} & set(got) and len({None, 5} & set(got)) == 1
    for i in texts:
        assert got[i] == [*whole.encode(texts[i], add_special_tokens=False).ids, 1]
