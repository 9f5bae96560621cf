import pytest

DOCS = "doc_id bigint, text string, lang string, kept string, row bigint, record string, fp int"
PASSAGE = " ".join(f"wort{i}" for i in range(40))
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def base_rows():
    """Copies, near copies, nulls in every column, empty and very long texts, ties, repeated rows."""
    texts = [
        "Alpha beta  gamma\tdelta", "alpha beta gamma delta", "Alpha betagamma\ndelta ", None, "", "   ", LONG, LONG + " end",
        f"intro {PASSAGE} outro", f"other words first {PASSAGE}", f"{PASSAGE} {PASSAGE}", PASSAGE.upper(), "ß ñ é 日本 語 x", "one", "one",
        "mail anna.b@mail.example.com or +1 (415) 555-2671, card 4111 1111 1111 1111, host 10.0.0.255",
    ]
    rows = [(i, t, "en" if i % 2 else None, "x", i, None, 7) for i, t in enumerate(texts)]
    rows += [rows[13], (None, "null id", "en", None, None, None, None), (None, "null id", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(base_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tables(spark, docs, tmp_path_factory):
    """The fixture as a folder of tables, for the registered queries."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder
