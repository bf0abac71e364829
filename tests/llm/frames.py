"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

LONG = "Der lange Text hört nicht auf, er geht weiter und weiter. " * 4000
ROWS = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 1, "x"),
    (2, "one  two\tthree four five six seven eight nine ten", "en", "a", 2, "x"),
    (2, "one  two\tthree four five six seven eight nine ten", "en", "a", 2, "x"),
    (3, None, None, None, None, None),
    (4, "", "en", "b", 4, "y"),
    (5, " \t\n ", "de", None, 5, "y"),
    (None, "a row without an id but with some words in it", "en", "b", 6, "z"),
    (None, None, None, None, None, None),
    (6, LONG, "de", "c", 7, "z"),
    (7, LONG + "Ende.", "de", "c", 8, "z"),
    (8, "short", "fr", "é", 9, "z"),
    (9, "Tiefüber \U0001F600 你好 \x00 nul \x1c sep   nbsp", "de", "c", 10, "z"),
    (9007199254740993, "an id beyond what a double can hold", "en", "a", 11, "z"),
]
# names that operators might use for columns of their own
SCHEMA = "doc_id bigint, text string, lang string, source string, size bigint, `class` string"


def documents(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = ["key", "bucket", "at", "fp", "words", "copies", "_lines_all", "_mix_n", "_near_number", "Leaf", "kept", "cell", "piece"]
    return docs.selectExpr("*", *[f"'{c}' as `{c}`" for c in extra])


def empty(spark):
    return documents(spark).where("doc_id < 0")
