"""Small tables with every awkward case in them."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "TEXT string, Doc_ID string, score double, id long, component string"
)
LONG = "the and of thorn erst " * 40_000
ROWS = [
    (5, "The quick brown fox jumps over the lazy dog, and runs away.\nTwice.", "en"),
    (5, "The quick brown fox jumps over the lazy dog, and runs away.\nTwice.", "en"),
    (9, "The quick brown fox jumps over the lazy dog, and runs away.\nTwice.", None),
    (1, None, "en"),
    (2, "", "de"),
    (3, " \n\t ", "fr"),
    (4, "12 34 !?", "en"),
    (None, "A row without an id, and with a mail a@b.cd", "en"),
    (None, None, None),
    (7, LONG, "en"),
    (8, "x" * 600_000, None),
    (10, "Der Hund und die Katze sind nicht auf dem Dach, aber 😀 im Haus.", "de"),
    (12, "Word", "en"),
]


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and
    extra columns whose names clash with ours, but for case or outright."""
    rows = [
        (i, t, lang, None if k % 2 else "s", None if t is None else len(t), "other", None, 0.5, k, None)
        for k, (i, t, lang) in enumerate(ROWS)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def plain(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def given(spark, name, size="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{size}/{name}.parquet")


def thue_morse(n):
    """Two words of 2**n letters that differ, each the other with its letters exchanged."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b
