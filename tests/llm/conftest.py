import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of names that operators use themselves; they must change nothing.
CLASHING = "row_id long, key long, digest string, n long, score double, kept boolean, label int, bucket int, words string"

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "théta", "kappa"]) + str(rng.randrange(40)) for _ in range(n))


def edge_rows():
    """NULLs in every column, empty and blank texts, a very long one, ties, repeated rows and ids."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    rows = [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "fr", "b", None),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, "  \n\t ", "en", "b", 5), (6, "!!! ???", "de", "a", 7),
        (None, base, "en", "a", 1), (None, None, None, None, None), (7, LONG, "en", "b", len(LONG)), (8, "x", "en", None, 1),
        (9, base.replace(" ", "  "), "en", "c", 1), (9, "other text of the same id", "en", "c", 1), (10, "Ünïcode ÀÉ straße", "de", "c", 3),
    ]
    rows += [(100 + i, sentence(rng, rng.randrange(1, 80)), "en", f"s{i % 4}", 1) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with extra columns."""
    extra = (7, 7, "7", 7, 7.0, True, 1, 7, "7")
    return spark.createDataFrame([r + extra for r in edge_rows()], f"{SCHEMA}, {CLASHING}").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
