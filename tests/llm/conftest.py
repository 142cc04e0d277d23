import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, fp string, size string, shard string, bucket string, row string, `__row` string, features string, `__fp` string, `__features` string, hash string, more string, least string, base string, `__host` string, `__bytes` string"
PII = "Write to ann.lee@mail.example.com or +1 (702) 555-0742, host 10.0.0.1, card 4111 1111 1111 1111."
LONG = " ".join(f"w{k % 977}x{k % 1013}" for k in range(40_000))
TEXTS = [
    None, "", "   \n\t", "one", "one two", "one two three", "ONE two  three", "a\x1cb \x85 ü▁ö", "x" * 70_000, LONG, LONG, LONG + " end",
    PII, PII, "Licensed under the MIT License.\nSPDX-License-Identifier: (MIT OR GPL-3.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause\n",
    "the same line here\n" * 30, "<|endoftext|> mixed Straße İstanbul ﬁn Σας 𝔸 é", "a b c d e f g h i j " * 5, "### " * 40, "plain words stand here. " * 2,
]


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text) with nulls, ties and repeated rows."""
    rows = [(k * 3, t) for k, t in enumerate(TEXTS)]
    return rows + [(None, "one two three"), (None, None), (rows[5][0], rows[5][1]), (rows[5][0], "another text of this id"), (rows[12][0], rows[12][1]), (None, None)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """Those rows with nulls and clashing names in the other columns."""
    return spark.createDataFrame([(i, t, None, None if k % 2 else "src", None, *["clash"] * 16) for k, (i, t) in enumerate(edge_rows)], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
