"""Columns whose names need quotes, in every operator that carries rows."""

import public_tokenizers
import pytest

from curbcount.llm import byte_bpe, decontaminate, exact_dedup, language_id, personal_data, simhash

NAMES = ["my col", "a.b", "doc-id", "tick`s", "record", "fp", "row", "own", "spans", "item"]
CODER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    inner = StructType([StructField("x y", LongType()), StructField("p.q", StringType())])
    layout = StructType([StructField(n, StringType()) for n in ("the.id", "the text", "the`lang")] + [StructField(n, StringType()) for n in NAMES] + [StructField("in ner", inner)])
    texts = ["alpha beta gamma delta", "alpha  beta gamma delta", "other words stand here", "mail anna.b@mail.example.com now", None, ""]
    rows = [(str(i), t, "en", *[f"{n}{i}" for n in NAMES], (i, "v")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, layout)


def kept(frame):
    return sorted((r["the.id"], r["the text"], r["a.b"], r["tick`s"], r["in ner"]["x y"]) for r in frame.collect())


def wanted(*ids):
    texts = ["alpha beta gamma delta", "alpha  beta gamma delta", "other words stand here", "mail anna.b@mail.example.com now", None, ""]
    return [(str(i), texts[i], f"a.b{i}", f"tick`s{i}", i) for i in ids]


def test_dropping_operators(spark, odd):
    assert kept(exact_dedup.drop_exact(odd, "the.id", "the text")) == wanted(1, 2, 3, 4)
    assert kept(simhash.drop_near(odd, "the.id", "the text")) == wanted(0, 2, 3, 4)
    bench = spark.createDataFrame([(1, "Other words stand here")], "`it em` int, `t.t` string")
    for limit in (1 << 20, 1):
        left = decontaminate.drop_contaminated(odd, bench, "the text", item_col="it em", item_text_col="t.t", automaton_bytes=limit)
        assert left.columns == odd.columns and kept(left) == wanted(0, 1, 3, 4, 5)
    assert language_id.drop_rejected(odd, "the.id", "the text", "the`lang").columns == odd.columns


def test_adding_operators(odd):
    coded = byte_bpe.encode(odd, *CODER, text_col="the text", ids_col="to kens")
    assert kept(byte_bpe.decode(coded, *CODER, ids_col="to kens", text_col="the text").na.fill("", ["the text"])) == [(i, t or "", *r) for i, t, *r in wanted(*range(6))]
    found = personal_data.find_personal(odd, personal_data.fit(odd, "the.id", "the text"), "the text").collect()
    assert sum(r["n_email"] for r in found) == 1 and {r["record"]["a.b"] for r in found} == {f"a.b{i}" for i in range(6)}


def test_spans_of_the_original_text(spark):
    text = "Ünïts — see: Other, WORDS stand\nhere! And other words stand here."
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "other words stand here"), (2, "stand here and"), (3, "see")], "item_id int, text string")
    for limit in (1 << 20, 1):
        row = decontaminate.find_contamination(docs, bench, automaton_bytes=limit).first()
        assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["see: Other, WORDS stand\nhere! And other words stand here"]
        assert sorted(row["items"]) == ["1", "2", "3"] and row["n_hit"] == 10
