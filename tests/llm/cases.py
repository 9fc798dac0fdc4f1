"""Fixtures shared by the tests of the training-data operators."""

SMALL = "/root/testdata/sf0.001"

LONG = "the long document repeats itself and goes on and on without an end in sight " * 300
SHARED = "This passage of more than fifty bytes stands in several of the documents, word for word. "
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank at dawn. " + SHARED),
    (2, SHARED + "Ein anderer Text, der über die Straße geht und grüßt; reach me at jane.doe@mail.example.org now."),
    (3, ""), (4, None), (5, "   \n\t "), (6, "1234 567"), (7, "é" * 60), (8, "é" * 60), (9, LONG), (10, LONG),
    (11, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"),
    (12, "One two three  four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"),
    (12, "One two three  four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"),
    (13, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"),
    (14, "hi there"), (15, "hi there"), (None, "a row without an id " + SHARED), (None, None), (16, "<|endoftext|> x <|endoftext|>"),
    (17, "call +1 (729) 555-7725 or 10.0.0.255, pay 4111 1111 1111 1111"),
]


def messy(spark):
    """Nulls in every column, empty and long texts, repeated ids and rows, extra columns with clashing names."""
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "src", None if t is None else len(t), "x", 1, None, "y")
            for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, "
                                       "n_tokens int, class_id string, ids string")


def rows_of(df, *key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(r[df.columns.index(k)]) for k in key))
