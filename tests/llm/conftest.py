import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like results."""
    long_text = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
    para = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, para + "\nshort line", "en", "a", 1),
        (1, para + "\nshort line", "en", "a", 1),
        (2, para, "en", "b", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (None, "nothing but a few words", "en", None, 3),
        (None, None, None, None, None),
        (5, long_text, "de", "b", 9),
        (6, " \t\n ", "en", "c", 2),
        (7, "😀 ünï 中文 \x00 <|endoftext|> tail", "xx", "c", 2),
        (7, "another text under the same id", "xx", "c", 2),
    ]
    clash = "size long, rank int, fingerprint string, taken long, score double, shard int"
    return spark.createDataFrame(
        [(*r, 5, 6, "f", 7, 0.5, 8) for r in rows], f"{DOCS}, {clash}"
    ).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted(
        (tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: [str(x) for x in t]
    )
