import random

import pytest

from shelfwright.session import build_session  # noqa: F401  (path set by the outer conftest)

EXTRA = "n long, key string, rep long, shingle long, bucket int, norm string, kept boolean, place int, words string, _gone long, window int, side int"


def family(seed: int, copies: int, words: int, changes: int) -> list[str]:
    """A text and copies with some words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(changes):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, short, empty, null, long and awkward texts."""
    texts: list[str | None] = []
    for seed, (copies, words, changes) in enumerate([(6, 60, 1), (5, 200, 6), (4, 30, 1), (8, 9, 1), (6, 12, 1), (3, 400, 20)]):
        texts += family(seed, copies, words, changes)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} {' '.join(f'q{k}_{i}' for i in range(25))}" for k in range(12)]
    texts += ["a b c d e", "a b c d e f", "A B C D E F", "a b c d", "a  b\tc\nd", "one", "", " \t\n", None, None, "", "Ünï 漢字 é", "x" * 5000]
    texts += ["same text again and again here", "Same Text again and again here", "same text again and again here"]
    texts += [" ".join(f"long{i}" for i in range(20000)), "É é ÉÉ", "é é éé"]
    rng = random.Random(5)
    ids = rng.sample(range(1, 1000), len(texts))
    return [*zip(ids, texts, strict=True), (None, "no id at all in this row"), (ids[0], texts[0])]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus as a table with columns whose names the operators use themselves."""
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    for field in EXTRA.split(", "):
        name, kind = field.split()
        df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
    return df


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("1 = 0")
