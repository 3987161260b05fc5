import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, under the same names.
EXTRA = ", key string, name long, node long, size string, id string, `a b` int"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table, with further columns of clashing names."""

    def build(texts, ids=None, sources=None, copies=1):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [
            (i, t, "en", s, len(t or ""), "k", 1, 2, "x", "y", 3)
            for i, t, s in zip(ids, texts, sources)
        ]
        frame = spark.createDataFrame(rows * copies, DOCUMENTS + EXTRA)
        return frame.repartition(3)

    return build


@pytest.fixture(scope="session")
def prose():
    """A text of invented words, the same for the same seed."""

    def build(seed, words, vocabulary=400):
        random_ = random.Random(seed)
        return " ".join(f"w{random_.randrange(vocabulary)}" for _ in range(words))

    return build


#: Null, empty, blank, odd and long texts, with ties and repeated rows.
@pytest.fixture(scope="session")
def odd_texts(prose):
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "One  one\none",
        "a b\x1cc d 　 é É 中文 🙂",
        "aaaa " * 500,
        prose(1, 30_000),
        "x" * 200_000,
        "same text here",
        "same text here",
        "same  text\there",
        "<|endoftext|> and <|startoftext|> it's we'RE 12,5!? ...",
    ]
