"""Rows that every document operator must survive."""

LONG = "lorem ipsum dolor " * 60_000

#: NULLs in any column, empty and very long texts, ties and repeated rows, odd characters.
DOCS = [
    (1, "Alpha beta gamma delta. " * 30, "en", "s1"),
    (2, "Alpha beta gamma delta. " * 30, "en", "s1"),
    (2, "Alpha beta gamma delta. " * 30, "en", "s1"),
    (None, "no id here " * 20, "en", "s1"),
    (None, None, None, None),
    (3, None, "en", "s2"),
    (4, "", "en", "s2"),
    (5, " \t\n\x0b\x0c\r", None, "s2"),
    (6, LONG, "en", None),
    (7, "żółć 日本語   a b\x1cc <|endoftext|> 'tis", "xx", "s3"),
    (8, "x", "en", "s3"),
    (9, "one two", "en", "s3"),
]
#: Columns with the names that operators use themselves.
CLASHING = ["text_", "words", "stats", "rank", "n", "key", "print", "component", "n_entities", "__key", "rate", "skey"]


def docs(spark, rows=DOCS):
    """The rows with extra columns of clashing names."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'{name}' AS `{name}`")
    return frame
