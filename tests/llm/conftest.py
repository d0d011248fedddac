import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    base = " ".join(f"word{k}" for k in range(300))
    long = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1),
        (3, base + " tail end", "en", None, None), (4, None, None, "b", 0), (5, "", "en", "b", 0),
        (6, " \t\n\x0b", None, None, 3), (7, long, "en", "a", 9), (8, "short one", "en", "b", 1),
        (9, "Le été à l'hôtel 中文 <|endoftext|> don't 12½ ß", "fr", "c", 2), (None, base, "en", "a", 5),
        (10, "x " * 400, "en", "a", 1), (11, "y\x1cz\x85q\xa0r a|b", None, "c", 1),
    ]
    return spark.createDataFrame([(*r, "extra", 7) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, t string, keys int")


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("1 = 0")
