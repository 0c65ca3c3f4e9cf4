import pytest

from tickspark.llm.common import read_table  # noqa: F401  (the subpackage is there)

SF001 = "/root/testdata/sf0.001"
#: Cases every operator has to take: null, empty, blank, no letters, very long, repeated rows and ids, null ids.
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
ODD_ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "... --- !!!", "de", "b"),
    (5, LONG, "en", "a"), (6, "one two three four five six seven", "en", None), (6, "one two three four five six seven", "en", None),
    (7, "one two three four five six seven", "fr", "b"), (None, "a row without an id is still a row", "en", "a"),
    (None, None, None, None), (8, "Ünï çödé 漢字 текст 🙂 \x1c\x00 end", "xx", "c"), (9, "x", "en", "a"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd documents with further columns whose names clash with those the operators use inside."""
    rows = [(i, t, l, s, None if t is None else len(t), 1.5, "u", 3) for i, t, l, s in ODD_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, u string, shard int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
