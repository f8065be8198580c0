import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = ["key", "node", "score", "label", "sig", "spans", "ids", "features", "place", "n_removed", "unit", "copies"]


def prose(rng, words, length=7):
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, length))) for _ in range(words))


def edited(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def messy_rows():
    """Ordinary, near-copied, equal, repeated, null, empty, blank, short and long texts; null and shared ids."""
    rng = random.Random(11)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    rows = list(enumerate(texts))
    for i, t in enumerate(texts[20:28]):
        rows.append((100 + i, edited(rng, t, i % 4)))
        rows.append((120 + i, t.upper()))
    rows += [(200, None), (201, ""), (202, "  \n\t "), (203, "é"), (None, texts[3]), (None, None), (3, texts[3]), (4, texts[5])]
    rows += [(300, prose(rng, 5000)), (301, "ab " * 700), (302, "x" * 4000), (303, "Ünïcode ﬁ 😀 é " * 9), (5, "you IDIOT!!! " * 4)]
    return rows


def frame(spark, rows, clash=True):
    schema = DOC + ("".join(f", `{c}` string" for c in CLASHING) if clash else "")
    more = ("z",) * len(CLASHING) if clash else ()
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), *more) for d, t in rows], schema)


@pytest.fixture(scope="session")
def messy():
    return messy_rows()


@pytest.fixture(scope="session")
def docs(spark, messy):
    return frame(spark, messy).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
