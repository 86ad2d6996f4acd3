import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ["number", "row", "group", "run", "length", "word", "n", "size", "target", "rate",
           "copies", "print", "best", "rank", "part", "place", "asker", "head", "score",
           "toxic", "fold", "kept", "first", "id", "half"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, source]) rows, with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        if extra:
            docs = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
        return docs

    return make


LONG = "Alpha beta gamma delta, " * 12_000

AWKWARD = [
    (None, "A row without an id", "b"), (None, None, None), (1, None, "a"), (2, "", "a"),
    (3, " \t\n ", "b"), (4, "Same TEXT here now ok", "a"), (4, "Same TEXT here now ok", "a"),
    (5, "same text HERE now ok", "c"), (6, LONG, "a"), (7, "Überall ÉÀ ß x y", None),
    (8, "same text here now OK", None), (9, "one", "c"), (10, "ONE", "c"),
    (11, "\x1c\x85  odd \U0001F600 space", "a"),
]


@pytest.fixture
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture
def empty(make_docs):
    return make_docs([])
