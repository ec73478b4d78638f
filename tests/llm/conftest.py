import public_tokenizers
import pytest

CLASHING = ["key", "row", "k", "n", "node", "size", "token", "c0", "mix", "host", "ids", "v"]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " \
    + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture
def docs(spark):
    """Documents with a clashing extra column for every name that operators use inside."""

    def make(*rows):
        """Rows (doc_id, text[, lang[, source]])."""
        filled = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]),
                   *["x"] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(filled, DOC_SCHEMA).repartition(3)

    return make


WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
         "sigma tau upsilon phi chi psi omega").split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


EDGES = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None),
    (None, "one two", None, "b"),
    (4, "word", "de", "a"), (5, prose(1, 60), "en", "a"), (5, prose(1, 60), "en", "a"),
    (6, prose(1, 60), "en", "b"), (7, "é" * 5000 + " " + "x" * 200_000, "fr", "c"),
    (8, "1234 5678 !!", "fr", "c"), (9, "日本語 \U0001f600 text\r\n", "de", ""),
]


@pytest.fixture
def edge_docs(docs):
    return docs(*EDGES)


@pytest.fixture(scope="session")
def vocabulary():
    path = public_tokenizers.path
    return {"tokenizer": path("byte_bpe_50k.json"), "ranks": path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}
