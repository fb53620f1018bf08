import random

import pytest

WORDS = "alpha be gam delt ep zeta eta th iot kapp lam mu nu xi omi pi rho sig tau".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))


@pytest.fixture
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, clashing names."""
    long = prose(1, 4000)
    rows = [
        (1, prose(2, 60), "en", "s1"),
        (2, prose(2, 60), "en", "s1"),
        (3, None, None, None),
        (4, "", "en", "s2"),
        (5, long, None, "s2"),
        (5, long, None, "s2"),
        (6, prose(3, 60) + " x", "de", None),
        (7, prose(3, 60) + " y", "de", "s3"),
        (None, prose(2, 60), "en", "s1"),
        (None, None, None, None),
        (8, " \n\t \n", "en", "s1"),
        (9, "one", "en", "s1"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), i, "x", i) for i, r in enumerate(rows)]
    names = "doc_id long, text string, lang string, source string, n_chars long, id long, node string, h long"
    return spark.createDataFrame(rows, names)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
