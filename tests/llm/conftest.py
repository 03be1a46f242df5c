"""Tables with every odd case: nulls, empty and very long texts, repeated rows and ids, clashing column names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, hash string, score double, _row int, _text string, ids string, bytes string"


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [say(rng.randint(80, 160)) for _ in range(6)]
    passage = say(120)
    out = [None, "", "   ", "\n\n", "one", "two words", "Ünïcode ÉÉ 梦 😀", "x" * 3000, "a " * 900, " ".join(base) * 3, "The end.\x00"]
    for b in base:
        out += [b, b, b + " " + say(1), b.replace("a", "A", 1), say(30) + "\n" + passage + "\n" + say(20)]
        w = b.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += ["\n".join(["line of some words"] * 12), say(40) + passage[: len(passage) // 2], passage]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Ids rise with the texts; the last rows repeat an id, a whole row, and have no id."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "two words"), (7, "other text under an old id"), (None, texts[11]), (None, None)]
    full = [(i, t, "en", "s", 0 if t is None else len(t), 1, "h", 0.5, 2, "t", "i", "b") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
