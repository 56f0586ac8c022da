import random

import pytest

from searchloom.shipping import ship

CLASHING = "id string, tag string, gram string, n string, kept string, later string, gone string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def text_of(seed: int, n: int, vocabulary: int = 4000) -> str:
    dice = random.Random(seed)
    words = [f"w{dice.randrange(vocabulary)}" + dice.choice(["", "", "", ",", "."]) for _ in range(n)]
    for k in range(10, n, 14):
        words[k] += "\n"
    return " ".join(words).replace("\n ", "\n")


def fixture_rows() -> list[tuple]:
    """(doc_id, text): unique texts, copies, near copies, shared passages and lines, and every odd case."""
    passage = text_of(1, 60)
    rows = [(k, text_of(100 + k, 80 + 7 * k)) for k in range(20)]
    rows += [(30 + k, text_of(200 + k, 60) + " " + passage + " " + text_of(300 + k, 50)) for k in range(5)]
    rows += [(40 + k, rows[3][1]) for k in range(12)]  # copies
    near = text_of(7, 400).split(" ")
    for k in range(8):
        changed = list(near)
        changed[37 * k + 5] = f"edit{k}"
        rows.append((60 + k, " ".join(changed)))
    rows += [(70 + k, f"Common Line\n{text_of(400 + k, 30)}\n common line \t") for k in range(14)]
    rows += [
        (90, None), (91, ""), (92, " \n\t "), (93, "one"), (94, "a b c"), (95, "A B C"), (96, "same " * 300), (97, "x" * 5000),
        (98, "é́ \xa0 ǅ Σ <|endoftext|> it's 42\x1c中文  end"), (None, rows[4][1]), (None, None), (99, text_of(9, 9000)),
        (5, rows[5][1]), (5, text_of(55, 90)), (-3, rows[6][1] + " tail"),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return fixture_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The fixture with other columns whose names the operators use themselves."""
    full = [(i, t, "a", "b", None, "d", "e", "f", "g", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, " + CLASHING).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, " + CLASHING)


@pytest.fixture(scope="session")
def labels(spark, rows):
    found = [(i, i % 2, 0) for i, _ in rows if i is not None] + [(None, 1, 0), (1000, 0, None), (4, None, None)]
    return spark.createDataFrame(found, "doc_id long, quality int, toxic int")
