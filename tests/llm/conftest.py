import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()


def prose(k: int, n: int) -> str:
    """``n`` words that differ from those of other ``k``."""
    return " ".join(f"{WORDS[(i * (k + 3) + k) % 12]}{(i * 7 + k) % 97}" for i in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, "word", "en", None),
        (5, prose(5, 60), "en", "a"), (5, prose(5, 60), "en", "a"), (6, prose(5, 60), "de", "b"),
        (7, prose(7, 40_000), "en", "a"), (None, prose(8, 30), "en", "a"), (None, None, None, None),
        (9, "naïve \U0001f600 façade\n" * 8, "fr", "c"), (10, "x" * 150_000, "en", "a"),
    ]
    return [(*r, len(r[1] or ""), "kept", 1.5) for r in rows]


ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, node string, `odd.name` double"
)


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with hard cases and further columns, some under names that operators use."""
    docs = spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)
    for name in ("key", "n", "block", "mix_block", "mix_source", "toxic_score", "some_id", "score", "spans", "bucket"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
