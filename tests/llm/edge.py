"""Small tables with everything that may come: nulls in any column, empty and
very long texts, ties, repeated rows, and extra columns whose names the
operators use inside."""

CLASHING = ["n_words", "key", "h", "place", "id", "block", "part", "class", "size", "v", "u", "fp", "c0", "rank",
            "component", "taken", "word", "line", "gone", "__gone", "digest", "license", "b", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def docs(spark, rows):
    """A table of documents from (doc_id, text[, source]) rows."""
    full = []
    for r in rows:
        text = r[1]
        full.append((r[0], text, None, r[2] if len(r) > 2 else "s", None if text is None else len(text),
                     *(f"x{i}" for i in range(len(CLASHING)))))
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def nasty():
    """(doc_id, text, source) rows."""
    base = " ".join(f"w{i % 97} v{i % 13}" for i in range(400))
    rows = [(1, base, "a"), (2, base, "a"), (2, base, "a"), (3, "", "b"), (4, None, None), (5, " \n\t\x0b ", "b"),
            (6, "one", None), (7, "Über straße\n\nno\r\nyes", "c"), (8, base + " tail", "c"), (9, "x " * 60000, "a"),
            (10, "q" * 70000, "a"), (None, "lonely text without an id", "d"), (None, None, "d"), (11, "one", "b")]
    return rows
