import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with null and repeated ids, null, empty and odd texts, copies, and columns the operators use inside."""
    prose = "the quick brown fox and the lazy dog walk to the old town by the river in the rain with a lot of hope for the best "
    rows = [
        (3, prose * 3, "en", "b", 1), (1, prose * 3, "en", "a", 1), (1, prose * 3, "en", "a", 1), (None, "no id here at all", "en", None, 1), (4, None, None, "a", None),
        (5, "", "en", "b", 0), (6, " \t\n ", "en", "c", 3), (7, "one two", "en", "c", 7), (8, "ONE two", "en", None, 7), (9, "x" * 30_000, "en", "a", 1),
        (10, "### $$$ %%% " * 40, "en", "b", 1), (11, "a line of words\n" * 30, "de", "b", 1), (12, prose.upper() * 4, "en", "c", 1),
        (13, "".join(f"w{i} " for i in range(4000)), "en", "c", 1), (14, "line\r\nbreaks  and spaces <|endoftext|> it's 42 déjà", "fr", "d", 1),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, bucket int, node string, part int, rest int, kept boolean"
    return spark.createDataFrame([(*r, 0.5, 1, 2, "n", 3, 4, True) for r in rows], names)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")
