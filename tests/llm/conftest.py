import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"

ODD = [  # doc_id, text, lang, source, n_chars, and columns named like the operators' own
    (None, "no id at all", "en", "s", 3, "x", 1.0), (1, None, None, None, None, None, None), (2, "", "en", "s", 0, "x", 1.0),
    (3, " \n\t ", "en", None, 4, "x", 1.0), (4, "12 34 !!", "de", "s", 8, "x", 1.0), (5, "same text here twice", "en", "s", 20, "x", 1.0),
    (5, "same text here twice", "en", "s", 20, "x", 1.0), (6, "same text here twice", "en", "s", 20, "x", 1.0),
    (7, "long " * 40_000, "en", "s", 200_000, "x", 1.0), (8, "naïve café 東京 😀 ﬁn​", "fr", "s", 20, "x", 1.0)]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, pos double"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
