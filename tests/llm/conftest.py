import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho".split()


def prose(seed: int, n: int) -> str:
    """n words that depend on the seed."""
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 3)) % 17] + str((seed + i) % 11) for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing column names."""
    long = prose(3, 30_000)
    rows = [
        (1, prose(1, 40), "en", "a", 5),
        (1, prose(1, 40), "en", "a", 5),
        (2, prose(1, 40), None, None, None),
        (3, None, "en", "b", 1),
        (4, "", "en", "b", 1),
        (5, " \t\n ", "en", "b", 1),
        (6, "?!", "en", "b", 1),
        (7, long, "de", "b", 1),
        (8, long + " more", "de", "b", 1),
        (None, prose(2, 30), "en", None, 2),
        (9, "Ünïcödé ßtraße 日本 " + prose(4, 20), "de", "c", 3),
        (10, prose(5, 9) + "\n" + prose(5, 9) + "\n\nshort", "en", "c", 3),
        (10, "another text with the same id", "en", "c", 3),
    ]
    schema = "doc_id long, text string, lang string, row string, n_words int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
