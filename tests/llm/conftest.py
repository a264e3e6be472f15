import pytest

LONG = "alpha beta gamma " * 20_000
EDGE = [
    (0, None, "en", "s1", 0),
    (1, "", "en", "s1", 0),
    (2, " \n\t ", None, None, 3),
    (3, "One Line of text that repeats\nshort\n  one line of text that repeats  \n\nend", "en", "s1", 7),
    (4, "ONE LINE OF TEXT THAT REPEATS\r\nother line, much longer than ten", "en", "s2", 7),
    (5, LONG, "en", "s2", 9),
    (6, LONG, "en", "s2", 9),
    (7, "<|endoftext|> a  <|endoftext|>b <|startoftext|>  c", "fr", "s3", 1),
    (8, "naïve Σας ÀÉ İ 日本語 テスト 🎉🎉 a b 　c \x85 ''s we'll", "fr", "s3", 1),
    (9, "12345 ### $$$ %% && || <> ** 6789\n\n\n   x", None, "s3", 1),
    (9, "12345 ### $$$ %% && || <> ** 6789\n\n\n   x", None, "s3", 1),
    (10, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "de", "s4", 1),
    (11, "two words", "de", "s4", 1),
    (12, "x" * 5000, "de", "s4", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, special strings, repeated rows, and columns whose names clash."""
    df = spark.createDataFrame(EDGE, SCHEMA)
    for name in ("n_tokens", "n_words", "fp", "h", "score", "rank", "kept", "n", "salt", "host", "length", "key", "ids", "row", "offset", "piece", "n_lines", "doc", "node", "component", "rate", "window"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]
