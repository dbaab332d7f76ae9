import re
from collections import Counter

import pytest

BLANKS = r"[\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(seed, n):
    """``n`` words of an invented language, the same for the same seed."""
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bdfgklmnprstvz"[(state >> k) % 14] + "aeiou"[(state >> k) % 5] for k in (3, 9, 17)))
    return " ".join(out)


#: Nulls, empty and blank texts, ties, repeated rows, near copies, control characters, a long text.
ODD_TEXTS = [
    (1, sentence(1, 40)),
    (2, sentence(1, 40)),
    (3, sentence(1, 39) + " other"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, "One"),
    (8, "oNe"),
    (9, "a b c d e"),
    (9, "a b c d e"),
    (10, "a  b\tc d\ne"),
    (11, sentence(2, 20) + "\n" + sentence(2, 20) + "\n" + sentence(3, 5)),
    (12, "x " * 3000),
    (13, "é中 ٣½ <|endoftext|> [INST] ' 'll  \x1c\x85 end "),
    (14, sentence(5, 20000)),
    (None, sentence(6, 30)),
    (None, sentence(6, 30)),
    (15, sentence(6, 30)),
    (16, "y" * 5000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and columns whose names clash with results."""
    rows = [(i, t, "x", 1, True, 0.5) for i, t in ODD_TEXTS]
    schema = "doc_id long, text string, lang string, piece int, kept boolean, score double"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


def counted(rows):
    return Counter(tuple(r) for r in rows)
