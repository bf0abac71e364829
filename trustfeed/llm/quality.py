"""Quality rules with thresholds that adapt to each language and source.

Every document gets its base counts (words, characters in words, symbols, repeated lines, words in repeated 8-word windows).
From them come four shares, as whole ten-thousandths: symbols per character, repeated lines per line, repeated words per word,
and the mean word length. For each share, language and source a quantile sketch is kept: a log-linear histogram,
in which a value counts in the bucket of its leading SKETCH_BITS bits (relative error 1 / 2^(SKETCH_BITS - 1)). Sketches
are counts per bucket, so they are exact in any order and merge by addition: per (language, source), per language,
over everything. A group with fewer than ``min_group`` documents uses the next coarser sketch.

The limit of a share is its median plus ``spread`` times the distance from the lower decile to the median, plus a
margin, so that up to half of a group may be junk without moving it far. Mean word length has a limit on both sides. A
document is kept if it doesn't fail the base rules and all its shares stay within their group's limits.

DataFrame functions only. Nothing is shuffled but counts and one narrow row per document.

Edge cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of their own;
ties and repeated rows count as documents each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.llm.common import SPACE, WORD, text_or_empty
from trustfeed.session import materialize

MIN_WORDS = 20
MOST_REPEATED = 30          # per cent of the words
WINDOW = 8
SKETCH_BITS = 6
MIN_GROUP = 50
SPREAD = 3
UNIT = 10_000
# share -> margin in ten-thousandths (of characters, lines, words; of a character for the word length)
MARGINS = {"symbols": 300, "dup_lines": 4000, "repeated": 2000, "word_length": 20_000}
SYMBOLS = "#*$%&|<>"


def _windows(words: str) -> Column:
    """A hash of the WINDOW words from each position on, by doubling: of 1, 2, 4, 8 words."""
    return F.transform(F.col(words), lambda w: F.xxhash64(w))


def _pairs(hashes: str, step: int) -> Column:
    h = F.col(hashes)
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))


def repeated_words(df: DataFrame, words: str, out: str, keep: list[str]) -> DataFrame:
    """``out``: words in WINDOW-word windows that occur twice or more in the text.

    Window hashes carry their position in the low bits and are sorted; equal neighbours are windows to compare.
    The words themselves then decide, so a hash collision counts nothing.
    """
    n = F.size(words)
    cols = [*keep, words]
    df = df.select(*cols, _windows(words).alias("h1"))
    df = df.select(*cols, _pairs("h1", 1).alias("h2"))
    df = df.select(*cols, _pairs("h2", 2).alias("h4"))
    df = df.select(*cols, _pairs("h4", 4).alias("h8"))
    # room for the position: as many low bits as the number of words needs
    df = df.select(*cols, "h8", F.length(F.bin(n.cast("bigint"))).alias("bits"))
    windows = F.greatest(n - (WINDOW - 1), F.lit(0))
    at = F.expr("transform(slice(h8, 1, w), (x, i) -> shiftleft(shiftright(x, bits), bits) | cast(i as bigint))")
    df = df.select(*cols, "bits", "h8", windows.alias("w")).select(*cols, "bits", at.alias("raw"))
    df = df.select(*cols, "bits", F.sort_array("raw").alias("sorted"))
    same = f"""
        filter(transform(sorted, (x, i) -> if(
            (i > 0 and shiftright(x, bits) = shiftright(get(sorted, i - 1), bits)
              and slice({words}, cast(x & (shiftleft(1L, bits) - 1) as int) + 1, {WINDOW})
                = slice({words}, cast(get(sorted, i - 1) & (shiftleft(1L, bits) - 1) as int) + 1, {WINDOW}))
            or (shiftright(x, bits) = shiftright(get(sorted, i + 1), bits)
              and slice({words}, cast(x & (shiftleft(1L, bits) - 1) as int) + 1, {WINDOW})
                = slice({words}, cast(get(sorted, i + 1) & (shiftleft(1L, bits) - 1) as int) + 1, {WINDOW})),
            x & (shiftleft(1L, bits) - 1), -1L)), p -> p >= 0)"""
    df = df.select(*cols, F.expr(same).alias("places")).select(*cols, F.sort_array("places").alias("places"))
    # a window covers WINDOW words, or those up to the next repeated window
    covered = f"""aggregate(transform(places, (p, i) ->
        least({WINDOW}L, coalesce(get(places, i + 1) - p, {WINDOW}L))), 0L, (a, x) -> a + x)"""
    return df.select(*cols, F.expr(covered).alias(out))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text_or_empty()
    df = docs.select("doc_id", "lang", "source", text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    solid = F.regexp_replace("t", SPACE, "")
    df = df.select(
        "doc_id", "lang", "source",
        F.length(solid).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"), F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(1)).alias("words"))
    keep = ["doc_id", "lang", "source", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_words"]
    df = df.select(
        *keep[:5], "words", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("words").cast("bigint").alias("n_words"))
    return repeated_words(df, "words", "n_repeat_words", keep).select(*keep, "n_repeat_words")


def shares(counts: DataFrame) -> DataFrame:
    """One row per document and share: its value in whole ten-thousandths."""
    def part(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.floor(F.col(a) * UNIT / F.col(b))).otherwise(0).cast("bigint")
    return counts.select(
        "*", part("n_symbols", "word_chars").alias("symbols"), part("n_dup_lines", "n_lines").alias("dup_lines"),
        part("n_repeat_words", "n_words").alias("repeated"), part("word_chars", "n_words").alias("word_length"))


def sketch(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The sketches: documents per group, share and bucket. A bucket is named by its lowest value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("share"), F.col(n).alias("v")) for n in names])).alias("p")
    low = F.greatest(F.length(F.bin("p.v")) - SKETCH_BITS, F.lit(0))
    bucket = F.expr("shiftleft(shiftright(p.v, low), low)")
    return rows.select(*by, pairs).select(*by, "p", low.alias("low")) \
        .select(*by, F.col("p.share").alias("share"), bucket.alias("bucket")) \
        .groupBy(*by, "share", "bucket").agg(F.count(F.lit(1)).alias("n"))


def sketch_quantiles(sketches: DataFrame, by: list[str], per_mille: dict[str, int]) -> DataFrame:
    """From sketches, merged over all columns but ``by``: size and quantiles of each group and share."""
    merged = sketches.groupBy(*by, "share", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "share")
    merged = merged.select("*", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(group).alias("size"))
    # the lowest bucket that reaches the share of the documents
    at = [F.min(F.when(F.col("upto") * 1000 >= F.col("size") * q, F.col("bucket"))).alias(name)
          for name, q in per_mille.items()]
    return merged.groupBy(*by, "share").agg(F.max("size").alias("size"), *at)


def limits(sketches: DataFrame, by: list[str], suffix: str, spread: int = SPREAD) -> DataFrame:
    """One row per group: its size, and lowest and highest value allowed for each share."""
    q = sketch_quantiles(sketches, by, {"low": 100, "mid": 500, "high": 900})
    margin = F.element_at(F.create_map(*[F.lit(x) for kv in MARGINS.items() for x in kv]), F.col("share"))
    top = F.col("mid") + spread * (F.col("mid") - F.col("low")) + margin
    bottom = F.col("mid") - spread * (F.col("mid") - F.col("low")) - margin
    q = q.select(*by, "share", "size", top.alias("top"), bottom.alias("bottom"))
    cols = [F.max(F.when(F.col("share") == s, F.col(k))).alias(f"{s}_{k}{suffix}") for s in MARGINS for k in ("top", "bottom")]
    return q.groupBy(*by).agg(F.max("size").alias(f"size{suffix}"), *cols)


def quality_rules(docs: DataFrame, min_group: int = MIN_GROUP, spread: int = SPREAD) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed and kept."""
    rows = materialize(shares(base_counts(docs)), "quality-counts")
    names = list(MARGINS)
    sketches = materialize(sketch(rows, ["lang", "source"], names), "quality-sketches")
    # null-safe joins: a null language or source is a group, too
    fine = limits(sketches, ["lang", "source"], "_f", spread).withColumnsRenamed({"lang": "lang_f", "source": "source_f"})
    by_lang = limits(sketches, ["lang"], "_l", spread).withColumnRenamed("lang", "lang_l")
    overall = limits(sketches.withColumn("one", F.lit(1)), ["one"], "_a", spread).first()    # one row
    table = fine.join(by_lang, F.col("lang_f").eqNullSafe(F.col("lang_l")))
    chosen = []
    for s in names:
        for k in ("top", "bottom"):
            every = F.lit(overall and overall[f"{s}_{k}_a"]).cast("bigint")
            c = F.when(F.col("size_f") >= min_group, F.col(f"{s}_{k}_f")) \
                .when(F.col("size_l") >= min_group, F.col(f"{s}_{k}_l")).otherwise(every)
            chosen.append(c.alias(f"{s}_{k}"))
    table = table.select("lang_f", "source_f", *chosen)
    rows = rows.join(table, F.col("lang").eqNullSafe(F.col("lang_f")) & F.col("source").eqNullSafe(F.col("source_f")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    within = F.col("word_length") >= F.col("word_length_bottom")
    for s in names:
        within = within & (F.col(s) <= F.col(f"{s}_top"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed.alias("base_failed"), (~base_failed & within).alias("kept"))
