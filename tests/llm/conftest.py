import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, ids that repeat, and columns with clashing names."""
    long = "Long words follow one another here. " * 6000
    rows = [
        (1, "Some plain words that say little, but enough of them.", "en", "a", 5),
        (1, "Some plain words that say little, but enough of them.", "en", "a", 5),
        (1, "Another text under the same id, which is quite another thing.", "en", "b", 6),
        (2, None, None, None, None),
        (3, "", "de", "c", 0),
        (None, "A row without an id still has a text to work on, and keeps it.", None, "d", 7),
        (None, "A row without an id still has a text to work on, and keeps it.", None, "d", 7),
        (None, None, None, None, None),
        (4, long, "en", "e", len(long)),
        (5, "   \n\t ", "fr", None, 6),
        (6, "12345 678 !!! ???", "es", "f", 17),
        (7, "é日本\U0001f600 ▁ tail", "en", "g", 9),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    clashes = "score id key row cleaned canon hashes t1 t2 spans kept shard slot unit size bucket fp label order predicted place".split()
    for name in clashes:
        frame = frame.selectExpr("*", f"concat('{name}', doc_id) AS {name}")
    return frame
