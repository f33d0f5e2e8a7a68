import pytest



CLASHING = "id p h c s fp seq row level topic score weight v leaf rest ps u key settled".split()


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null values, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long_text = "\n".join(" ".join(f"w{(i * 7 + j) % 911}" for j in range(40)) for i in range(1500))
    same = "one two three four five six seven eight nine ten eleven twelve " * 4
    rows = [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, long_text, "en", "a", len(long_text)),
        (4, same, "en", "a", 5),
        (5, same, "de", "b", 5),
        (5, same, "de", "b", 5),
        (None, same, "en", None, 5),
        (7, "   \n\t \n", "fr", "a", 3),
        (8, "aaaa" * 2000, "fr", "a", 8000),
        (9, "emoji \U0001f600 naïve café ½ — “quotes” x", "fr", "a", 3),
        (10, "one", "fr", "a", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (3, 1, 0), (4, 0, 1), (5, 0, 1), (5, 1, 1), (None, 1, 1), (9, None, None), (10, 0, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
