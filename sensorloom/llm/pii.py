"""Personal data by base patterns and by contexts bootstrapped from them, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, free_name, numbered, own_columns, staged, text_or_empty

# Kinds in the order in which they are listed.
KINDS = ["email", "ip", "card", "phone"]

# Each base pattern, written so that a long run is scanned once: quantifiers give nothing back where the pattern
# never needs it, and a match begins where a run begins or where the last match ended.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser shapes whose occurrences are candidates for discovery.
LOOSE = {
    "address": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
    "number": r"(?:(?<![0-9])|\G)[0-9](?:[\x20().-]{0,2}+[0-9]){5,}+",
}
GATE = {"email": "@", "address": "@", "phone": "+"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: Column, value: Column) -> Column:
    digits, n = _digits(value), F.length(_digits(value))
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(F.lit("0"), p))
    return (F.when(kind == "ip", F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255")))
            .when(kind == "card", n.between(13, 19) & F.call_function("luhn_check", digits))
            .when(kind == "phone", n.between(9, 15))
            .when(kind == "number", n.between(6, 19)).otherwise(True))


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """All matches as an array of (kind, nth, gap, value, before, after); gap is the length of the text since the last match."""
    gate = F.contains(text, F.lit(GATE[kind])) if kind in GATE else text.rlike("[0-9]")
    gaps, values = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.transform(values, lambda v, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.length(F.get(gaps, i)).alias("gap"), v.alias("value"),
        F.right(F.get(gaps, i), F.lit(48)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(32)).alias("after")))
    kind_type = "array<struct<kind:string,nth:int,gap:int,value:string,before:string,after:string>>"
    return F.when(gate, found).otherwise(F.array().cast(kind_type))


def occurrences(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, before, after) of valid matches from the staged arrays; positions in code points."""
    each = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("m")).select("row", "m.*")
    through = F.sum(F.col("gap") + F.length("value")).over(
        Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    placed = each.withColumn("end", through.cast("long")).withColumn("start", F.col("end") - F.length("value"))
    return placed.where(_valid(F.col("kind"), F.col("value"))).select("row", "kind", "start", "end", "value", "before", "after")


def _free(found: DataFrame) -> DataFrame:
    """Candidates that no base span overlaps, by a running look at the spans of each row in order of their start."""
    base = F.col("kind").isin(KINDS)
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    marked = found.withColumn("_before", before).withColumn("_after", after)
    return marked.where(~base & (F.col("_before").isNull() | (F.col("_before") <= F.col("start")))
                        & (F.col("_after").isNull() | (F.col("_after") >= F.col("end")))).drop("_before", "_after")


def patterns(found: DataFrame) -> DataFrame:
    """Distinct (pattern, value): the words around an occurrence as lexical patterns, one or two before and one after."""
    words = r"[\p{L}_]+[=:#]?"
    left = F.regexp_extract_all(F.lower("before"), F.lit(words), F.lit(0))
    right = F.regexp_extract_all(F.lower("after"), F.lit(words), F.lit(0))
    last, second, nxt = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2), F.get(right, F.lit(0))
    options = F.array_compact(F.array(
        F.concat(F.lit("l "), last), F.concat(F.lit("ll "), second, F.lit(" "), last),
        F.concat(F.lit("lr "), last, F.lit(" "), nxt)))
    return found.select("value", F.explode(options).alias("pattern")).distinct()


def _fits(kind: Column, value: Column, shape: Column) -> Column:
    four = value.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    n = F.length(_digits(value))
    return (F.when(kind == "email", shape == "address").when(kind == "ip", (shape == "number") & four)
            .when(kind == "card", (shape == "number") & ~four & n.between(13, 19))
            .otherwise((shape == "number") & ~four & n.between(6, 15)))


def bootstrap(found: DataFrame, rounds: int = 100, pattern_confidence: float = 0.6, instance_confidence: float = 0.8,
              support: int = 3) -> DataFrame:
    """Values accepted beyond the base patterns: (value, kind, confidence), unique by value; staged.

    The graph joins lexical patterns with the values they surround. Base values are seeds of confidence 1 of their
    kind. Each round scores patterns, for a kind, by the confidence of their values over the number of distinct
    values they surround and one more; those of `support` confident values and `pattern_confidence` vote for
    candidate values of a fitting shape, whose confidence is that not all votes are wrong. Candidates of
    `instance_confidence` become instances of the next round. Both scores are partial aggregations over
    distinct edges, so neither a frequent value nor a frequent context gathers its occurrences. Rounds end when the
    accepted values, their kinds and confidences to six digits do not change; `rounds` is a safety bound, and to reach it is an error.
    """
    edges = staged(patterns(found))
    degree = staged(edges.groupBy("pattern").agg(F.count("*").alias("degree")).where(F.col("degree") >= support))
    shapes = staged(found.where(~F.col("kind").isin(KINDS)).select("value", F.col("kind").alias("shape")).distinct())
    seeds = staged(found.where(F.col("kind").isin(KINDS)).select("value", "kind").distinct().withColumn("confidence", F.lit(1.0)))
    known, accepted, state = seeds, seeds.limit(0), None
    for _ in range(rounds):
        scores = edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("confidence").alias("weight"))
        good = staged(scores.join(degree, "pattern").withColumn("trust", F.col("weight") / (F.col("degree") + 1)).where(
            (F.col("weight") >= support) & (F.col("trust") >= pattern_confidence)).select("pattern", "kind", "trust"))
        votes = edges.join(good, "pattern").join(shapes, "value").where(_fits(F.col("kind"), F.col("value"), F.col("shape")))
        belief = votes.groupBy("value", "kind").agg(
            F.round(1 - F.exp(F.sum(F.ln(1 - F.col("trust")))), 12).alias("confidence"))
        best = belief.groupBy("value").agg(F.max(F.struct("confidence", "kind")).alias("b")).select(
            "value", "b.kind", "b.confidence").where(F.col("confidence") >= instance_confidence)
        before, accepted = accepted, staged(best)
        known = seeds.union(accepted)
        discard(before)
        discard(good)
        last, state = state, accepted.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("value", "kind", F.round("confidence", 6))), F.lit(0))).first()
        if state == last or not state[0]:
            return accepted
    raise RuntimeError(f"accepted values still change after {rounds} rounds")


def scan(rows: DataFrame, text: str, row: str) -> DataFrame:
    whole = text_or_empty(text)
    every = [_matches(whole, kind, pattern) for kind, pattern in {**BASE, **LOOSE}.items()]
    return rows.select(F.col(row).alias("row"), F.concat(*every).alias("found"))


def personal_spans(rows: DataFrame, text: str = "text", row: str = "row", **options) -> DataFrame:
    """Spans of personal data in every whole text: (row, kind, start, end, base BOOLEAN), half-open, in code points; staged.

    Base spans are the leftmost non-overlapping matches of each kind's pattern that hold up: parts of an ip at
    most 255, 13 to 19 digits and a right Luhn sum for a card, 9 to 15 digits for a phone. Discovered
    spans are loose shapes (an address without a dotted host, a number of 6 to 19 digits) whose value was
    accepted by `bootstrap` and that no base span overlaps. `row` names unique row numbers. Null texts are
    empty and have no spans; texts that repeat have theirs each time; an empty table gives an empty result. The
    texts are read once; after that only matches move, ordered within a row by a window.
    """
    scanned = staged(scan(rows, text, row).where(F.size("found") > 0))
    found = staged(occurrences(scanned))
    loose = staged(_free(found))
    base = found.where(F.col("kind").isin(KINDS))
    accepted = bootstrap(base.unionByName(loose), **options)
    more = loose.drop("kind").join(accepted, "value").select("row", "kind", "start", "end", F.lit(False).alias("base"))
    spans = staged(base.select("row", "kind", "start", "end", F.lit(True).alias("base")).union(more.distinct()))
    for old in (scanned, found, loose, accepted):
        discard(old)
    return spans


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["nth"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(rows: DataFrame, spans: DataFrame, row: str = "row") -> DataFrame:
    """Add to each row of `rows` the counts n_email, n_ip, n_card, n_phone of base spans, and all spans as text."""
    nth = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("nth")
    one = F.struct(nth, "start", "end")
    per_row = spans.groupBy(F.col("row").alias("_span_row")).agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS],
        _listed(F.collect_list(F.when(F.col("base"), one))).alias("base_spans"), _listed(F.collect_list(one)).alias("spans"))
    joined = rows.join(per_row, F.col(row) == F.col("_span_row"), "left").drop("_span_row")
    return joined.fillna(0, [f"n_{k}" for k in KINDS]).fillna("", ["base_spans", "spans"])


def mask(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` with every span of personal data in its text replaced by its kind in brackets, as in [EMAIL].

    Overlapping spans become one mark, of the kind that begins first. Texts without spans are unchanged, null
    texts stay null. Where the table has `n_chars`, it is counted anew for texts that changed.
    """
    row, found = free_name(docs, "_pii_row"), free_name(docs, "_pii_runs")
    rows = numbered(docs, row)
    spans = personal_spans(rows, text, row, **options)
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    runs = begun.withColumn("run", F.sum("new").over(order)).groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind"))
    held = runs.groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias(found))
    whole = F.col(f"`{text}`")
    kept = F.transform(found, lambda r, i: F.concat(
        F.substring(whole, F.coalesce(F.get(found, i - 1)["end"], F.lit(0)).cast("int") + 1,
                    (r["start"] - F.coalesce(F.get(found, i - 1)["end"], F.lit(0))).cast("int")),
        F.lit("["), F.upper(r["kind"]), F.lit("]")))
    tail = F.substring(whole, F.element_at(found, -1)["end"].cast("int") + 1, F.length(whole))
    masked = F.when(F.col(found).isNull(), whole).otherwise(F.concat(F.array_join(kept, ""), tail))
    out = rows.join(held, row, "left").withColumn(text, masked)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(F.length(F.col(f"`{text}`")).cast("long")))
    return out.select(*own_columns(docs))
