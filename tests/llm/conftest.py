"""Small tables with everything a documents table can hold."""

import random

import pytest

CLASHING = "kept boolean, node string, text_hash int, block string, row int, drop int, votes int, n_words string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    known = ["the", "of", "and", "to", "river", "stone", "winter", "letter", "garden", "window", "carried", "slowly", "was", "bright"]
    lines, line = [], []
    for _ in range(words):
        line.append(rng.choice(known) + str(rng.choice(["", "", "s", "ly", "ing"])))
        if len(line) > 8 and rng.random() < 0.2:
            lines.append(" ".join(line) + ".")
            line = []
    return "\n".join([*lines, " ".join(line)])


LONG = prose(99, 20_000)


@pytest.fixture(scope="session")
def table(spark):
    """A documents table from (doc_id, text, source), with further columns whose names operators use inside."""

    def made(rows):
        full = [(i, t, "en", s, len(t or ""), True, "x", 1, "y", 2, 3, 4, "z") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return made


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and very long texts, equal and repeated rows."""
    return [
        (1, prose(1, 60), "a"),
        (2, prose(2, 80), "a"),
        (3, prose(1, 60), "b"),
        (4, prose(1, 60).upper(), None),
        (5, None, "a"),
        (6, "", "b"),
        (7, " \n\t", "b"),
        (8, LONG, "c"),
        (9, "word", "c"),
        (None, prose(3, 50), "a"),
        (None, None, None),
        (10, "Ärger ist ÄRGER und ärger", "b"),
        (11, "ärger ist ÄRGER und ärger", "b"),
        (12, prose(4, 70), "c"),
        (12, prose(4, 70), "c"),
        (13, prose(5, 60) + "\n" + prose(5, 60), "a"),
    ]


@pytest.fixture(scope="session")
def odd(table, odd_rows):
    return table(odd_rows)


@pytest.fixture(scope="session")
def empty(table):
    return table([])
