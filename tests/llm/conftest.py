import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, copies, a clashing column."""
    common = "\n".join(f"line {i} " + " ".join(f"w{i}x{j}" for j in range(12)) for i in range(8))
    rows = [
        (1, None, None, None, 0, "x"), (2, "", "en", "a", 0, "x"), (3, " \n\t ", "en", "a", 4, None),
        (4, common, "en", "a", 1, "x"), (5, common, "en", "b", 1, "x"), (5, common, "en", "b", 1, "x"),
        (6, "intro words here\n" + common + "\nend of it", "en", "b", 1, "x"), (7, common.replace("w3x4", "zzz"), "de", None, 1, "x"),
        (8, "one two three", "en", "c", 1, "x"), (9, "ONE two three", "en", "c", 1, "x"), (10, "l'été <|endoftext|> ½ 漢字 x " * 3, "fr", "c", 1, "x"),
        (11, "word " * 30000, "en", "c", 1, "x"), (None, "no id at all", "en", "a", 1, "x"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
