"""Exact duplicates by distributed most-significant-byte-first radix partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, free_name, numbered, own_columns, staged, text_or_empty

WHITE = " \t\n\x0b\x0c\r"


def normalised(column: str | Column) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    out = text_or_empty(column)
    for mark in WHITE:
        out = F.replace(out, F.lit(mark), F.lit(""))
    return out


def radix_classes(rows: DataFrame, first: int = 64, growth: int = 16) -> DataFrame:
    """Rows (row, data BINARY) -> (row, grp) of every row whose bytes another row has too; staged.

    Round by round the surviving groups are split by their next bytes: 64 at first, then 16 times as many
    each round, so a text of n bytes takes about log16(n / 64) rounds. Rows alone in their group leave, and
    so do groups whose texts ended; the bytes themselves decide, no digest does. A round counts (group,
    bytes) with a partial aggregation and joins the groups of two or more back to (row, group, bytes) of that round
    alone; the next bytes are read by row number for rows that are still in a group. No side of a join has a bound,
    so all of them sort and merge between two exchanges, where adaptive execution splits a large group.
    """
    def read(at: int, width: int) -> DataFrame:
        return rows.select("row", F.expr(f"substring(data, {at + 1}, {width})").alias("head"),
                           (F.octet_length("data") >= at + width).alias("more"))

    at, width, ended, split = 0, first, [], None
    cut = read(at, width).withColumn("grp", F.lit(0).cast("long"))
    while True:
        cut = staged(cut)
        groups = staged(cut.groupBy("grp", "head").agg(F.min("row").alias("next"), F.count("*").alias("n")).where("n > 1").drop("n"))
        before, split = split, staged(cut.join(groups.hint("merge"), ["grp", "head"]).select("row", F.col("next").alias("grp"), "more"))
        discard(groups)
        discard(cut)
        if before is not None:
            discard(before)
        ended.append(staged(split.where("NOT more").select("row", "grp")))
        further = split.where("more").select("row", "grp")
        if further.isEmpty():
            break
        at, width = at + width, width * growth
        cut = read(at, width).join(further.hint("merge"), "row")
    discard(split)
    out = ended[0]
    for part in ended[1:]:
        out = out.union(part)
    out = staged(out)
    for part in ended:
        discard(part)
    return out


def exact_duplicates(rows: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str = "row") -> DataFrame:
    """Equal texts of a table with unique numbers in `row`: (row, id, keep_id, keep_row, group_size, kept, text_sha256).

    Texts are equal when identical without ASCII white space. Of equal texts the row with most code points
    stays, then the one with the smallest id, nulls last; of rows that repeat wholly, one of them stays.
    Null texts are empty texts, and empty texts equal each other. Null ids are allowed. Other columns are
    not looked at. An empty table gives an empty result. The digest is output only. The result is staged.
    """
    base = staged(rows.select(
        F.col(row).alias("row"), F.col(doc_id).alias("id"), F.length(text_or_empty(text)).alias("chars"),
        normalised(text).cast("binary").alias("data")).withColumn("text_sha256", F.sha2("data", 256)))
    classes = radix_classes(base.select("row", "data"))
    members = staged(classes.join(base.select("row", "id", "chars").hint("merge"), "row"))
    discard(classes)
    best = staged(members.groupBy("grp").agg(
        F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("z"), "id", "row")).alias("best"),
        F.count("*").alias("group_size")))
    chosen = staged(members.select("row", "grp").join(best.hint("merge"), "grp").select(
        "row", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"))
    discard(members)
    discard(best)
    out = staged(base.select("row", "id", "text_sha256").join(chosen.hint("merge"), "row", "left").select(
        "row", "id",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_row", "row").alias("keep_row"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"), "text_sha256"))
    discard(chosen)
    discard(base)
    return out


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with their own columns."""
    row = free_name(docs)
    rows = numbered(docs, row)
    found = exact_duplicates(rows, text, doc_id, row)
    dropped = staged(found.where("NOT kept").select(F.col("row").alias(row)))
    return rows.join(dropped.hint("merge"), row, "left_anti").select(*own_columns(docs))
