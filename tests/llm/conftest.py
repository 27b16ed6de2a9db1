import random

import pytest

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnop", k=2 + i % 7)) for i in range(900)]


@pytest.fixture(scope="session")
def sentence():
    def make(rng: random.Random, n: int) -> str:
        return " ".join(rng.choice(WORDS) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark, sentence):
    """Rows with the cases that every operator must take: nulls, empty and long texts, ties, repeats, extra columns."""
    rng = random.Random(3)
    base = sentence(rng, 150)
    rows = [(i, sentence(rng, rng.randint(1, 200)), ["en", "fr", None][i % 3], f"s{i % 4}" if i % 7 else None) for i in range(40)]
    rows += [(40, None, "en", "s0"), (41, "", "en", "s0"), (42, "   \n\t ", None, None), (43, base, "en", "s1"), (44, base, "en", "s1"), (45, base + " tail", "fr", "s2")]
    rows += [(46, sentence(rng, 30_000), "en", "s0"), (43, base, "en", "s1"), (None, base, "en", "s1"), (None, "ein zwei drei", "fr", None), (5, "another text under a known id", "en", "s3")]
    rows += [(47, "Ünïcödé wörds\u00a0and ﬀ and 漢字 😀 " * 5, "fr", "s2"), (48, "a", "en", "s3"), (49, "!!! ### 123", "en", "s3")]
    extra = [(*r, len(r[1] or ""), "x", 1.5) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, size string, row double").repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("1 = 0")
