import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, rid int, keep_id string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    """Words of a small vocabulary, frequent and rare, with punctuation and lines."""
    rnd = random.Random(seed)
    words = []
    for _ in range(n):
        w = "abcdefghijklmnopqrstuvwxyzäé"[rnd.randrange(28)] + str(int(vocabulary * rnd.random() ** 3))
        words.append(w + rnd.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(words)


def corpus() -> list[tuple]:
    """Small documents with copies, near copies, shared passages, junk and odd texts."""
    base = [prose(i, 30 + 17 * i) for i in range(24)]
    passage = prose(99, 70)
    texts = [*base, base[3], base[3], "  " + base[4].replace(" ", "  ", 5), base[5] + " more", base[6][40:],
             base[7][:200] + " " + passage, passage + "\n" + base[8][:150], "x " + passage, None, "", " \t\n", "...", "12 34",
             "a", "a b", "the same line here\nthe same line here\nanother one", "the same line here", "a " * 120, "a " * 80,
             "tab\tseparated\x0bwords\r\nand nbsp  double", "é combining \U0001f600 emoji <|endoftext|> İI ΑΣ", prose(5, 3000)]
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], [None, "s1", "s2", "hot", "hot"][i % 5], len(t or ""), "clash", 7, "clash") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, base[2], "en", "s1", 1, "c", 1, "c"), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
