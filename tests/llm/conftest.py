import random

import pytest

WORDS = "the of and to in a is that für und die straße été où niño rojo casa token hello world data model".split()


@pytest.fixture(scope="session")
def prose():
    """Deterministic texts of a given number of words."""
    def make(seed: int, words: int) -> str:
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", "s", ",", ".", ".\n"]) for _ in range(words))
    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long, start string, fingerprint int, spans int, slot int"


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """NULLs in every column, empty, blank and long texts, copies, repeated rows, columns named like the operators' own."""
    texts = [None, "", "   \n\t ", "one", prose(1, 40), prose(1, 40), prose(2, 9000), "x" * 50_000, prose(3, 60),
             "password=hunter2hunter2 " + prose(4, 30), prose(3, 60) + " tail", "日本語 テキスト 😀 é"]
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "a"][i % 4], None if t is None else len(t), "s", 1, None, 2)
            for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, prose(5, 20), None, None, None, None, None, None, None), (None, None, "en", "a", 1, "", 0, 0, 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
