import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "size long, piece int, key string, bucket long, kind int, payload binary, row long, n long, rep long, taken long, host string, path string"
)


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]) with columns of clashing names."""

    def build(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
            full.append((doc_id, text, lang, source, None if text is None else len(text), 7, 7, "k", 7, 7, b"p", 7, 7, 7, 7, "h", "p"))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def messy():
    """Rows with nulls, empty and long texts, repeated rows, ties and versions of one id."""
    base = " ".join(words(1, 60))
    long = " ".join(words(2, 6000))
    near = base.split()
    near[30] = "changed"
    passage = " ".join(words(3, 30))
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(near), "en", None),
        (4, None, None, "b"),
        (5, "", "de", "b"),
        (6, "  \n\t ", None, None),
        (7, long, "en", "a"),
        (8, f"{passage} {' '.join(words(4, 40))}", "de", "c"),
        (9, f"{' '.join(words(5, 20))} {passage}", "de", "c"),
        (10, "one two", "en", "c"),
        (11, "one two", None, "c"),
        (12, "same " * 90, "en", "d"),
        (13, "same " * 70, "en", "d"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (14, "Ünïcödé ñandú " * 12 + "\U0001f600", "es", "d"),
        (15, "x" + "Ünïcödé ñandú " * 12, "es", "d"),
        (16, "123 456 !!", "fr", "d"),
        (17, "first version of the text", "en", "e"),
        (17, "another text with the same id", "en", "e"),
    ]
