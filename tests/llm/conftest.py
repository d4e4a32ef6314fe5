import pytest

from fairlead.llm.common import ship, table

ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "word"),
    (5, "one two three"),
    (6, "Äpfel ÉCOLE naïve Straße İstanbul ΑΣ ΑΣ, 日本語テキスト é Éa x́,y"),
    (7, "that " * 100),
    (8, "that " * 90),
    (9, "x" * 5000),
    (10, "ab " * 400 + "tail of it"),
    (10, "ab " * 400 + "tail of it"),
    (11, "a|b ,- don't I'll 12345 ,hfr --> <|endoftext|> <|ENDOFTEXT|> .'s a.'t !!"),
    (12, "\x00\x01 control \x1f bytes\x0b and\x0cfeeds"),
    (2**62, "a very large id"),
    (-5, "a negative id"),
]


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def real(llm_spark, sf_dir):
    """(doc_id, text) of the whole smallest documents table."""
    return [tuple(r) for r in table(llm_spark, sf_dir, "documents").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd():
    return ODD_TEXTS
