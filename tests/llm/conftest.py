import random

import pytest

from datashelf.session import fresh_folder

WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def as_files(df):
    folder = fresh_folder(df.sparkSession, "input")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows."""
    long = prose(1, 30_000)
    return [
        (None, "a null id with words enough for one shingle", "en"), (1, None, "en"), (2, "", "en"), (3, " \t\n", "en"),
        (4, long, "en"), (5, long, None), (6, "same row twice, word for word here.", "en"),
        (6, "same row twice, word for word here.", "en"), (7, "123 456 !!", None), (8, "Été à Zürich. Ende. Q? Ja!", "de"),
        (9, "x", "fr"), (10, prose(2, 50) + ". " + prose(3, 40) + ".\n" + prose(4, 30) + ".", "fr"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with further columns whose names the operators use inside."""
    clashing = ["row", "id", "node", "label", "bucket", "part", "rank", "size", "shard", "key", "at", "hashes", "marks", "n"]
    rows = [(*r, "s0", len(r[1] or ""), *["x"] * len(clashing)) for r in odd_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clashing)
    return as_files(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return as_files(odd_docs.limit(0))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
