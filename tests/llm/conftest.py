import random

import pytest

from shelfmatch.llm.common import prepared

#: Columns that clash with names operators use inside.
EXTRA = ("fp", "d", "h", "block", "key", "host", "score", "n_words", "__keep")


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


@pytest.fixture
def docs(llm):
    """A documents table of (doc_id, text, lang) rows, with columns that clash; ``lang`` may be left out."""

    def made(rows, parts=3):
        rows = [(*r, None)[:3] if len(r) < 3 else r for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
        full = [(i, t, lang, "s", None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang in rows]
        return llm.createDataFrame(full, schema).repartition(parts) if full else llm.createDataFrame([], schema)

    return made


def prose(rng: random.Random, n: int, parts=("the", "ing", "er", "on", "ou", "sh", "ea", "né", "ü")) -> str:
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture
def awkward():
    """Nulls, empty and blank texts, one long text, repeated rows, equal texts, astral letters, a null id."""
    rng = random.Random(5)
    long = prose(rng, 9000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "ab"), (5, long), (5, long), (6, long), (None, "the one without an id"),
            (8, "𝔘𝔫𝔦 ✓ " * 30), (9, "a" * 300), (10, prose(rng, 80)), (11, prose(rng, 80)), (-3, prose(rng, 3))]
