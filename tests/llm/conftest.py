import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"

#: Rows with awkward values: nulls, empty, blank, repeated, very long, odd characters.
AWKWARD = [
    (1, "one two three four five six seven eight nine ten"),
    (1, "one two three four five six seven eight nine ten"),
    (2, None), (3, ""), (4, " \n\t \n"), (None, "a line with a null id stays a row of its own"),
    (5, "Zeile über Öl\nZeile über Öl\n日本語 текст \U0001F600"), (6, "x" * 30000),
    (7, "word " * 20000), (8, "\x00 nul and \x1c separator"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, None if i == 2 else "en", None if i in (3, 5) else f"s{(i or 0) % 3}", 1, "clash", 7)
            for i, t in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, th string, node int").repartition(3)


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.where("false")
