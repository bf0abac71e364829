"""Line de-duplication with a log-template tree.

Lines are parsed as a fixed-depth tree does with log messages: the first level is the number of tokens, the next ``DEPTH`` levels
are the leading tokens, variable fields (numbers, dates, hexadecimal ids, mail addresses, links) generalised
to <*>; a line of fewer than ``SHORT`` tokens consists of leading tokens only, and one of variable fields only keeps them as they are.
What reaches the same leaf is one log group. Its template has at each place the token that more than half of the group's different
lines have, any other place is <*>. A line belongs to the template if it agrees with ``SIMILAR`` of all places (a place of the
template that is <*> by lack of a majority agrees with nothing); a line that agrees with less is a template of its own.

A template whose lines come from two or more documents recurs: its lines are dropped everywhere but in the document with
the smallest doc_id. Short lines recur by chance too, so one of fewer than ``SHORT`` tokens recurs only if its documents exceed
what is to be expected by ``DEVIATIONS`` standard deviations: the lines of its length, counted once a document, times the chance
that tokens drawn place by place from the other different lines of that length make it. A line with a token that no
other line has in that place isn't expected at all.

DataFrame functions only. Tokens are cut once; the lines are written with hashes of leaf and of masked tokens, and all decisions
are made on different lines (leaf, hash, smallest and largest doc_id), which are summed up before they are shuffled. Only leaves
with several different lines need their tokens again, once per different line. The templates' lines are found by one join of
the written lines with the written list of lines to drop, whose hot keys can be split. Places to drop come back to
the documents that lose lines as a list of line numbers; the other documents aren't shuffled.

Edge cases: a null text stays null, an empty one empty; a document all of whose lines are dropped becomes
empty; rows with equal doc_id count as one document; rows with a null doc_id are left as they are;
repeated rows lose the same lines; an empty table gives no rows; all columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import WORD, fresh, maybe_in
from trustfeed.session import materialize

DEPTH = 4
SHORT = 6
SIMILAR = 0.7
# Standard deviations above chance from which on a short line recurs.
DEVIATIONS = 4
WILD = "<*>"
# Variable fields: anything with a digit, mail addresses, links.
VARIABLE = r"[0-9]|@|://|^www\."
# ASCII white space beside blank and line feed.
WHITE = "\t\x0b\x0c\r"


def document_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, body (hash of the whole text), at (line number), n (tokens), leaf, kind (hash of the masked tokens) and the masked
    line, one blank between tokens, of every line with a token.

    Most lines are written that way already and have no variable field; only the others are cut into tokens.
    """
    line = F.col("line")
    lines = docs.where("doc_id is not null and text is not null") \
        .select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | F.contains(line, F.lit("  "))
    for c in WHITE:
        odd = odd | F.contains(line, F.lit(c))
    tidy = F.array_join(F.array_remove(F.split(F.translate("line", WHITE, " " * len(WHITE)), " "), ""), " ")
    lines = lines.select("doc_id", "body", "at", F.when(odd, tidy).otherwise(line).alias("line")).where(line != "")
    perhaps = F.contains(line, F.lit("@")) | F.contains(line, F.lit("://")) | F.contains(line, F.lit("www.")) | \
        F.regexp_like(line, F.lit("[0-9]"))
    fields = F.transform(F.split(line, " "), lambda t: F.when(F.regexp_like(t, F.lit(VARIABLE)), F.lit(WILD)).otherwise(t))
    masked = lines.select("doc_id", "body", "at", "line", F.when(perhaps, fields).alias("masked"))
    only_fields = F.size(F.array_remove("masked", WILD)) == 0
    cut = masked.select("doc_id", "body", "at", F.when(F.col("masked").isNull() | only_fields, line)
                        .otherwise(F.array_join("masked", " ")).alias("line"))
    cut = cut.withColumn("n", F.octet_length("line") - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)
    head = F.when(F.col("n") < SHORT, line).otherwise(F.substring_index("line", " ", depth))
    return cut.select("doc_id", "body", "at", "n", F.xxhash64("n", head).alias("leaf"), F.xxhash64("line").alias("kind"), "line")


def short_templates(lines: DataFrame) -> DataFrame:
    """(leaf, kind, lo) of the short lines that stand in more documents than chance explains; lo: their first document."""
    shorts = lines.where(F.col("n") < SHORT)
    # a document counts once; what is common is summed up before it is shuffled
    kinds = shorts.groupBy("doc_id", "n", "leaf", "kind").agg(F.min("line").alias("line")) \
        .groupBy("n", "leaf", "kind").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("lo"), F.min("line").alias("line"))
    kinds = materialize(kinds, "short-lines")
    sizes = kinds.groupBy("n").agg(F.sum("docs").alias("all_docs"), F.count(F.lit(1)).alias("all_kinds"))
    places = kinds.select("n", F.posexplode(F.split("line", " ")).alias("at", "token"))
    votes = places.groupBy("n", "at", "token").agg(F.count(F.lit(1)).alias("votes"))
    several = kinds.where("docs > 1")
    met = several.select("n", "leaf", "kind", "docs", "lo", F.posexplode(F.split("line", " ")).alias("at", "token")) \
        .join(votes, ["n", "at", "token"]).groupBy("n", "leaf", "kind", "docs", "lo") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "votes"))).alias("places"))
    others = F.greatest(F.col("all_kinds") - 1, F.lit(1))
    # five rows at most: one per length
    met = met.join(F.broadcast(sizes), "n")
    chance = F.aggregate("places", F.lit(1.0), lambda x, p: x * (p["votes"] - 1) / others)
    expected = F.col("all_docs") * chance
    return met.where(F.col("docs") > expected + DEVIATIONS * F.sqrt(expected)).select("leaf", "kind", "lo")


def leaf_templates(kinds: DataFrame) -> DataFrame:
    """(leaf, template): at each place the token that more than half of the leaf's different lines have, or null."""
    sizes = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    votes = kinds.select("leaf", F.posexplode("tokens").alias("at", "token")) \
        .groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("leaf", "at").agg(F.max(F.struct("votes", "token")).alias("best"))
    token = F.when(F.col("best.votes") * 2 > F.col("size"), F.col("best.token"))
    places = best.join(sizes, "leaf").select("leaf", "at", token.alias("token"))
    return places.groupBy("leaf").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("template"))


def long_templates(lines: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(leaf, kind, lo) of the different lines whose template recurs; lo: the template's first document."""
    long = lines.where(F.col("n") >= SHORT)
    kinds = long.groupBy("leaf", "kind").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    kinds = materialize(kinds, "line-kinds")
    leaves = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
    leaves = materialize(leaves, "recurring-leaves")
    # a leaf with one kind of line is its own template; the tokens of others are needed, once per kind
    of_one = maybe_in(kinds, "leaf", leaves.where("kinds = 1").select("leaf")) \
        .join(leaves.where("kinds = 1").select("leaf"), "leaf", "left_semi").select("leaf", "kind", "lo")
    several = leaves.where("kinds > 1").select("leaf")
    text = maybe_in(long.select("leaf", "kind", "line"), "leaf", several).join(several, "leaf", "left_semi") \
        .groupBy("leaf", "kind").agg(F.min("line").alias("line"))
    mixed = materialize(text.join(kinds, ["leaf", "kind"]).select("leaf", "kind", "lo", "hi", F.split("line", " ").alias("tokens")),
                        "kinds-of-several")
    agree = F.size(F.filter(F.zip_with("tokens", "template", lambda t, x: F.coalesce(t == x, F.lit(False))), lambda x: x))
    own = F.when(agree >= F.size("tokens") * similar, F.lit(0)).otherwise(F.col("kind"))
    member = materialize(mixed.join(leaf_templates(mixed), "leaf").select("leaf", "kind", own.alias("template"), "lo", "hi"), "members")
    first = member.groupBy("leaf", "template").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first <> last")
    of_several = member.join(materialize(first, "recurring-templates"), ["leaf", "template"]) \
        .select("leaf", "kind", F.col("first").alias("lo"))
    return of_one.unionByName(of_several)


def dropped_lines(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """doc_id, hash of its text and the numbers of its lines to drop, as an array."""
    lines = materialize(document_lines(docs, depth), "lines")
    gone = materialize(long_templates(lines, similar).unionByName(short_templates(lines)), "recurring-lines") \
        .withColumnRenamed("leaf", "leaf_")
    narrow = lines.select("doc_id", "body", "at", "leaf", "kind")
    drop = maybe_in(narrow, "kind", gone.select("kind")).join(gone.withColumnRenamed("kind", "kind_"), (F.col("kind") == F.col("kind_")) &
                                                             (F.col("leaf") == F.col("leaf_"))).where("doc_id <> lo")
    return drop.groupBy("doc_id", "body").agg(F.collect_set("at").alias("places"))


def dedup_lines(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR, n_lines: str | None = None,
                n_dropped: str | None = None) -> DataFrame:
    """The documents without recurring lines; optionally with columns of these names for the lines before and dropped."""
    doc, body, gone, every, own = (fresh(docs, f"_lines_{x}") for x in ("doc", "body", "places", "all", "own"))
    drops = materialize(dropped_lines(docs.select("doc_id", "text"), depth, similar), "dropped-lines")
    named = drops.select(F.col("doc_id").alias(doc), F.col("body").alias(body), F.col("places").alias(gone))

    def columns(text: Column, n_all: Column, n_gone: Column) -> list[Column]:
        out = [text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]
        return out + [n.cast("bigint").alias(name) for n, name in ((n_all, n_lines), (n_gone, n_dropped)) if name]

    # documents that may lose lines meet their list; the others stay where they are
    hashed, bodies = docs.withColumn(own, F.coalesce(F.xxhash64("text"), F.lit(0))), drops.select("body")
    perhaps = maybe_in(hashed, own, bodies).join(named, (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(body)), "left")
    at_all = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    n_all = F.when(F.col("text").isNull(), 0).otherwise(at_all)
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(gone))
    kept = F.concat_ws("\n", F.transform(left, lambda i: F.get(every, i)))
    perhaps = perhaps.withColumn(every, F.when(F.col(gone).isNotNull(), F.split("text", "\n")))
    changed = perhaps.select(*columns(F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept), n_all,
                                      F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone))))
    sure = maybe_in(hashed, own, bodies, missing=True)
    return changed.unionByName(sure.select(*columns(F.col("text"), n_all, F.lit(0))))


def drop_recurring(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """As dedup_lines; documents that have lost lines and have no word left go."""
    lost = fresh(docs, "_lines_lost")
    cleaned = dedup_lines(docs, depth, similar, n_dropped=lost)
    return cleaned.where((F.col(lost) == 0) | F.regexp_like("text", F.lit(WORD))).drop(lost)
