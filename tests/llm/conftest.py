import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, size int, shard string, key string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def sample_rows():
    """Plain texts, copies, near copies, common lines, a benchmark passage, and
    every odd case: nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(60, 140)) for _ in range(30)]
    passage = words(rng, 60)
    texts = list(base)
    texts += base[:5] + [base[0]] * 4  # copies
    for i in range(6, 12):  # near copies: one word in the first and last place
        w = base[i].split(" ")
        w[0] = "zz" + w[0]
        w[-1] = "qq"
        texts.append(" ".join(w))
    texts += [words(rng, 40) + " " + passage + " " + words(rng, 30) for _ in range(4)]
    texts += [b + "\nAll rights reserved.\n" + words(rng, 8) for b in base[12:20]]
    texts += [None, "", "   \n\t ", "one", "two words", "Ünï códe ß 漢字 " * 30, "word " * 5000, "### *** $$$ " * 40, "x" * 3000]
    rows = [(i * 3, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], len(t or ""), "e", i, "s", "k") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[20], "en", "a", 1, "e", 1, "s", "k"), (None, None, None, None, None, None, None, None, None)]
    return rows, passage


@pytest.fixture(scope="session")
def sample(spark):
    rows, passage = sample_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows, passage


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
