import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of texts, ids from 0, with a host each ('a' by default)."""

    def make(texts, sources=None, ids=None, extra=None):
        rows = [
            (i if ids is None else ids[i], t, "en", (sources or {}).get(i, "a"), len(t or ""))
            for i, t in enumerate(texts)
        ]
        df = spark.createDataFrame(rows, DOCS).repartition(3)
        return df.selectExpr("*", *extra) if extra else df

    return make


#: Texts that every operator must take: null, empty, blank, odd characters, a very long one, repeats.
ODD = [
    None, "", " \t\n", "one", "one", "A b c \U0001f600 \x01\x1c", "x" * 5000, "café ́你好 <|endoftext|> </s>",
    "the cat sat on the mat. " * 3000, "\n\n\n", "a\nb\na\n b\n", "\\ <| |> [INST]",
]
