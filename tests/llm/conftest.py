import public_tokenizers
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score double, slot int, key string, part int, label int, kept boolean, node long, ids binary"
WORDS = "the cat sat on a mat and looked at the moon for a long time while rain fell on the roof".split()


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, None if text is None else len(text), "x", 0.5, 1, "k", 2, 3, True, 4, b"")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with names the operators use inside."""
    long = " ".join(WORDS[i * 7 % len(WORDS)] + str(i) for i in range(60_000))
    rows = [row(1, None), row(2, ""), row(3, " \n\t"), row(4, "word"), row(5, "ein Wort über das Haus", "de"), row(6, long), row(7, long), row(8, "été <|endoftext|> </s> ▁x  y  "), row(8, "été <|endoftext|> </s> ▁x  y  "), row(None, "no id here at all"), row(9, "x" * 50_000, None, None), row(10, "\U0001f600 !!! 123"), row(11, "Word")]
    rows.append((None,) * 14)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def files():
    return public_tokenizers.path
