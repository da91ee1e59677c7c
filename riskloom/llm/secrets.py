"""Secrets in text, with weak candidates linked to their complements. DataFrame functions only.

Base kinds are reported wherever they stand. Weak kinds are reported only where complementary parts co-occur
within SCOPE code points: an identifier next to a secret, a loose secret next to an identifier, an
endpoint next to both. Parts are found in one scan of every text, which stores only
match and gap lengths; positions come from running sums over these narrow rows. The interval join deals parts into
cells of SCOPE code points, so a very long text with many parts is many small groups; since matches of a kind
never overlap, a cell holds a bounded number of parts.

Spans are code points, end exclusive, leftmost and not overlapping per kind. A weak candidate that overlaps a base span is
dropped, for it is already reported. A null text is empty; rows are never merged, so repeated rows and ids get a
result each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_lists, forget, free_names
from riskloom.session import materialize

# The base patterns. Matches of access and hex that are too short cannot contain or end in a longer one.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
# Weak kinds.
IDENT = r"""(?i:access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
LOOSE = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[0-9+/]*[A-Za-z])[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+|(?i:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""
SCOPE = 200

# kind, pattern, role (I identifier, S secret, E endpoint), in the order of reports.
KINDS = (
    ("assign", ASSIGN, "S"), ("access", ACCESS, "I"), ("hex", HEX, "S"),
    ("ident", IDENT, "I"), ("loose", LOOSE, "S"), ("endpoint", ENDPOINT, "E"),
)
BASE = 3


def _matches(text: Column, order: int, pattern: str) -> Column:
    """Per match the gap before it, its length, and whether it counts."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if order == 0:
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        good = F.transform(value, lambda v: F.length(v) >= ASSIGN_LEAST)
    else:
        good = F.transform(found, lambda v: F.lit(True))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), F.transform(found, F.length).alias("len"), good.alias("good"))
    named = F.transform(
        parts, lambda p: F.struct(F.lit(order).alias("kind"), p["gap"].alias("gap"), p["len"].alias("len"), p["good"].alias("good"))
    )
    # Most texts have no match of a kind: a cheap test spares them the rest.
    return F.when(F.size(found) > 0, named).otherwise(F.lit(None))


def find_parts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, parts): the stored rows (doc_id, row, text_hash), and all spans (row, kind, start, end) of base and weak kinds."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = F.monotonically_increasing_id().alias("row"), F.xxhash64(text_col).alias("text_hash")
    rows = df.select(F.col(id_col).alias("doc_id"), *names, text.alias("t"))
    columns = [_matches(F.col("t"), i, k[1]).alias(k[0]) for i, k in enumerate(KINDS)]
    stored, _ = materialize(rows.select("doc_id", "row", "text_hash", *columns), "matches")
    found = stored.where(" OR ".join(f"{k[0]} IS NOT NULL" for k in KINDS))
    empty = "cast(array() AS array<struct<kind:int,gap:int,len:int,good:boolean>>)"
    every = F.flatten(F.array(*[F.coalesce(F.col(k[0]), F.expr(empty)) for k in KINDS]))
    each = found.select("row", F.posexplode(every).alias("nth", "m")).select("row", "nth", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before))
    parts = placed.where("good").select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")
    return stored.select("doc_id", "row", "text_hash"), parts


def _cells(margin: int) -> Column:
    return F.explode(F.expr(f"sequence(greatest(start - {margin}, 0) div {SCOPE}, (end + {margin}) div {SCOPE})"))


def linked_parts(parts: DataFrame) -> DataFrame:
    """Weak candidates with their complements in scope, and all base parts: (row, kind, start, end)."""
    role = F.element_at(F.array(*[F.lit(k[2]) for k in KINDS]), F.col("kind") + 1)
    weak = parts.where(f"kind >= {BASE}").select("row", "kind", "start", "end", _cells(0).alias("cell"))
    other = parts.select(
        "row", F.col("kind").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), role.alias("role"), _cells(SCOPE).alias("cell")
    )
    near = weak.join(other, ["row", "cell"]).where(f"NOT (k = kind AND s = start) AND greatest(start - e, s - end) <= {SCOPE}")
    apart = F.col("start").between(F.col("s"), F.col("e") - 1) | F.col("s").between(F.col("start"), F.col("end") - 1)
    met = near.withColumn("over", apart).groupBy("row", "kind", "start", "end").agg(
        F.max((F.col("k") < BASE) & F.col("over")).alias("taken"),
        F.max((F.col("role") == "I") & ~F.col("over")).alias("ident"),
        F.max((F.col("role") == "S") & ~F.col("over")).alias("secret"),
    )
    wanted = (
        F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("ident")).otherwise(F.col("ident") & F.col("secret"))
    )
    linked = met.where(~F.col("taken") & wanted).select("row", "kind", "start", "end")
    return parts.where(f"kind < {BASE}").unionByName(linked)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, row, text_hash and ``found``: array of (start, kind, end) of all reported spans, by start and kind."""
    rows, parts = find_parts(df, id_col, text_col)
    stored, _ = materialize(parts, "parts")
    spans = linked_parts(stored).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    empty = F.expr("cast(array() AS array<struct<start:bigint,kind:int,end:bigint>>)")
    return rows.join(spans, "row", "left").withColumn("found", F.coalesce("found", empty))


def as_text(found: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def report(df: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    out = scan(df)
    base = F.filter(F.col("found"), lambda x: x["kind"] < BASE)
    counts = [
        F.expr(f"cast(size(filter(found, x -> x.kind = {i})) AS bigint)").alias(f"n_{KINDS[i][0]}") for i in range(BASE)
    ]
    return out.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("found")).alias("spans"))


def redact(df: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``df`` (it must hold doc_id and text) with every reported span replaced, overlapping or touching ones as one.

    Other columns stay, whatever their names; null texts stay null.
    """
    scanned = scan(df)
    found = scanned.where(F.size("found") > 0).select("doc_id", "text_hash", "found").dropDuplicates(["doc_id", "text_hash"])
    # Spans that meet become one: a new one begins where all before it have ended.
    each = found.select("doc_id", "text_hash", F.explode("found").alias("x")).select("doc_id", "text_hash", "x.*")
    along = Window.partitionBy("doc_id", "text_hash").orderBy("start", "kind")
    upto = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("fresh", F.coalesce(F.col("start") > upto, F.lit(True)).cast("int"))
    each = each.withColumn("nth", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    each = each.groupBy("doc_id", "text_hash", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    merged = each.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    merged, n = materialize(merged, "spans")
    forget(scanned)
    doc, text_hash, spans, wide = free_names(df, "doc", "hash", "spans", "wide")
    merged = merged.toDF(doc, text_hash, spans)
    match = df.doc_id.eqNullSafe(merged[doc]) & F.xxhash64(df.text).eqNullSafe(merged[text_hash])
    joined = df.join(broadcast_lists(merged, n, spans), match, "left")
    # Four bytes a code point, so that each piece is found at once.
    joined = joined.withColumn(wide, F.when(F.col(spans).isNotNull(), F.encode(F.col("text"), "UTF-32")))
    cuts = F.concat(F.array(F.lit(0).cast("bigint")), F.flatten(F.transform(spans, lambda x: F.array(x["start"], x["end"]))), F.array(F.length(wide).cast("bigint") / 4))
    (places,) = free_names(joined, "cuts")
    joined = joined.withColumn(places, cuts.cast("array<bigint>"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.decode(_piece(F.col(wide), F.get(F.col(places), 2 * i), F.get(F.col(places), 2 * i + 1)), "UTF-32"),
    )
    return joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.array_join(pieces, mark))).select(df.columns)


def _piece(wide: Column, start: Column, end: Column) -> Column:
    return F.substr(wide, (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int"))
