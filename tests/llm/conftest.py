import pytest

SF = "/root/testdata/sf0.001"

#: Nulls, empty and white texts, ties, repeated rows and odd characters.
EDGES = [
    (None, None), (7, None), (8, ""), (9, " \t\n\r\x0b\x0c "), (10, "one"), (11, "One  ONE\none"), (12, "a b c d"),
    (13, "a b c d"), (14, "a b c d e"), (3, "same words in the same row twice over"),
    (3, "same words in the same row twice over"), (15, "ÄÖ ß é x İstanbul ﬁ 日本語 \U0001f600 \x00 don't x...y"),
    (16, "w " * 5000), (17, "line of words that comes again and again\n" * 40), (18, "###$$$ &&& |||"),
    (2**62, "big id"), (-5, "negative id"), (19, "x" * 30000), (None, "text without an id " * 6),
]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows as documents, with extra columns whose names clash."""
    rows = [(i, t, None if i == 7 else "en", "src0" if (i or 0) % 2 else None, len(t or ""), "kept", 1, -2)
            for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "row string, block int, key long").repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
