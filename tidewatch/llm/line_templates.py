"""Line deduplication by a log-template tree, in DataFrame functions only.

A token with a digit is a variable field from the start.  The tree has a fixed depth: a line goes by its number of tokens and
then by its leading tokens, at most half of those without a digit.  In a leaf, a later token is constant where at least
MIN_DOCS documents and CONSTANT of all in the leaf have it at that place; elsewhere there is a variable field.  What
stays constant is the line's template; a line with too many fields is its own template.  Templates that recur across
documents are dropped, however many documents have them.

A document that would be left without a letter keeps all its lines: it is no text with boilerplate around it, and whether it is a
copy is for other operators to say.  Documents with the same set of masked lines are copies of one document: they have one vote together.  Copies with
differing lines are different documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, unwrapped

LEADING = 4
MIN_DOCS = 3
# Lines with as many tokens can have a template with variable fields.
MIN_TOKENS = 4
# The share of a leaf's documents that a constant token needs, so there are three at most in one place.
CONSTANT = 0.3
# Fields that a template may have besides tokens with digits: so many, or this share of the other tokens, and fewer than
# constant ones.
FIELDS = 2
FIELD_SHARE = 0.2
FIELD = "<*>"
# Tables of hashes up to this many rows (16 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def masked(line: Column) -> Column:
    """The line's tokens with one space between them, tokens with digits as variable fields.

    The patterns run only over lines that a plain search has found to need them.
    """
    odd = F.contains(line, F.lit("  "))
    for mark in ("\t", "\x0b", "\f", "\r"):
        odd = odd | F.contains(line, F.lit(mark))
    spaced = F.trim(F.when(odd, F.regexp_replace(line, r"[\x09\x0B\x0C\x0D ]+", " ")).otherwise(line))
    # A token is tried at its first character only, and no part of it twice.
    return F.when(line.rlike("[0-9]"), F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(spaced)


def _distinct_lines(docs: DataFrame) -> DataFrame:
    """(line, h, vote): the distinct masked lines of each document that have a letter outside variable fields."""
    lines = docs.select(F.array_distinct(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), masked)).alias("lines"))
    # Beside explode() only columns: an expression there is worked out for every line, and takes the whole text along.
    voting = lines.withColumn("vote", F.xxhash64(F.sort_array("lines")))
    once = voting.select("vote", F.explode("lines").alias("line"))
    words = F.when(F.contains("line", F.lit(FIELD)), F.regexp_replace("line", r"<\*>", "")).otherwise(F.col("line"))
    return once.where(words.rlike(r"\p{L}")).withColumn("h", F.xxhash64("line"))


def _semi(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys`` (stored): broadcast if it was counted and found small."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, key, "left_semi")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h): the hash of every masked line whose template recurs across documents."""
    size = F.expr("octet_length(line) - octet_length(replace(line, ' ', '')) + 1")
    # Lines are cut into tokens only where there are fields to leave out.
    open_tokens = F.when(F.contains("line", F.lit(FIELD)), F.expr(f"size(filter(split(line, ' '), t -> t <> '{FIELD}'))")).otherwise(F.col("_size"))
    start = F.expr(f"substring_index(line, ' ', least({LEADING}, _open div 2))")
    leaf = F.when(F.col("_size") >= MIN_TOKENS, F.xxhash64("_size", start))
    sized = _distinct_lines(docs).withColumn("_size", size).withColumn("_open", open_tokens)
    found = sized.select("h", "vote", leaf.alias("leaf"))
    voted = found.groupBy("h", "vote").agg(F.any_value("leaf").alias("leaf"))
    found = stored(voted.groupBy("h").agg(F.any_value("leaf").alias("leaf"), F.count(F.lit(1)).alias("docs")))
    exact = found.where(F.col("docs") >= min_docs).select("h")

    # A leaf of one line has no fields.
    leaves = found.where("leaf IS NOT NULL").groupBy("leaf").agg(F.sum("docs").alias("all"), F.count(F.lit(1)).alias("lines"))
    leaves = stored(leaves.where((F.col("all") >= min_docs) & (F.col("lines") > 1)).drop("lines"))
    members = stored(_semi(found, leaves.select("leaf"), "leaf"))
    texts = _semi(_distinct_lines(docs).select("h", "line"), members.select("h"), "h").groupBy("h").agg(F.any_value("line").alias("line"))
    patterns = stored(members.join(texts, "h").withColumn("tokens", F.split("line", " ")).drop("line"))
    placed = patterns.select("leaf", "h", F.posexplode("tokens").alias("pos", "token"), "docs").where(F.col("token") != FIELD)
    shared = placed.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("with")).where(F.col("with") >= min_docs)
    constant = shared.join(leaves, "leaf").where(F.col("with") >= F.col("all") * CONSTANT)
    # At most three tokens in a place: one row for each leaf, as short as the lines in it.
    constant = stored(constant.groupBy("leaf").agg(F.collect_set(F.struct("pos", "token")).alias("constant")))
    constant = F.broadcast(constant) if constant.count() <= BROADCAST_ROWS // 100 else constant
    numbered = F.transform("tokens", lambda t, k: F.struct(k.alias("pos"), t.alias("token")))
    open_tokens = F.size(F.filter("tokens", lambda t: t != FIELD)).alias("n")
    kept = patterns.join(constant, "leaf").select("h", "leaf", "docs", open_tokens, F.array_intersect(numbered, "constant").alias("kept"))
    fields = F.col("n") - F.size("kept")
    few = (fields <= F.greatest(F.lit(FIELDS), F.col("n") * FIELD_SHARE)) & (fields < F.size("kept"))
    general = stored(kept.where(few).select("h", "docs", F.xxhash64("leaf", "kept").alias("template")))
    again = general.groupBy("template").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("template")
    return exact.unionByName(general.join(again, "template", "left_semi").select("h")).distinct()


def _marked(docs: DataFrame, min_docs: int) -> DataFrame:
    """(_rest, _null, _lines, _n): each document's other columns, its kept lines in order, how many it had."""
    drop = stored(recurring_lines(docs, min_docs).withColumn("_drop", F.lit(True)))
    drop = F.broadcast(drop) if drop.count() <= BROADCAST_ROWS else drop
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0))
    lines = F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines")
    rows = docs.select(F.monotonically_increasing_id().alias("_uid"), rest.alias("_rest"), F.isnull("text").alias("_null"), lines)
    each = rows.select("_uid", "_rest", "_null", F.posexplode("_lines").alias("_pos", "_line"))
    # The other columns travel with the first line only.
    each = each.withColumns({"_rest": F.when(F.col("_pos") == 0, F.col("_rest")), "h": F.xxhash64(masked(F.col("_line")))})
    found = each.join(drop, "h", "left").groupBy("_uid").agg(
        F.first("_rest", ignorenulls=True).alias("_rest"),
        F.any_value("_null").alias("_null"),
        F.sort_array(F.collect_list(F.struct("_pos", "_line", "_drop"))).alias("_lines"),
        F.count(F.lit(1)).alias("_n"),
    )
    # The search ends at the first line with a letter.
    left = F.exists("_lines", lambda x: x["_drop"].isNull() & x["_line"].rlike(r"\p{L}"))
    return found.withColumn("_left", left).withColumn("_lines", F.filter("_lines", lambda x: ~F.col("_left") | x["_drop"].isNull()))


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the text without the dropped lines.

    A null text counts as empty and comes back empty; lines are cut at \\n alone, and an empty text has one line.
    Lines without a letter outside variable fields (numbers, rules, blank lines) are never dropped.  Repeated rows
    come back as often; an empty table gives no rows; other columns are ignored.
    """
    found = _marked(docs.select("doc_id", "text"), min_docs)
    return found.select(
        F.col("_rest.doc_id").alias("doc_id"),
        F.col("_n").alias("n_lines"),
        (F.col("_n") - F.size("_lines")).alias("n_dropped"),
        F.concat_ws("\n", F.col("_lines._line")).alias("text"),
    )


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with all their columns, text without recurring lines, n_chars (if there) counted anew.

    A document without a dropped line keeps its text and n_chars, null included.
    """
    found = _marked(docs, min_docs)
    text = F.concat_ws("\n", F.col("_lines._line"))
    touched = F.col("_n") > F.size("_lines")
    changed = {"text": F.when(touched | ~F.col("_null"), text)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(touched, F.char_length(text).cast(kind)).otherwise(F.col("_rest").getField("n_chars"))
    return found.select(*unwrapped(docs.columns, changed, "_rest"))
