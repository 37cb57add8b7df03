import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Rows every operator must take: nulls, empties, repeats, ties, odd characters, long texts.
ODD_TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls"),
    (2, None), (3, ""), (None, "a row without an id"), (None, None),
    (4, "   \n\t \x0b\n"), (5, "x" * 3000), (6, "漢字 かな 漢字 end   tail  "),
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls"),
    (7, "the quick brown fox jumps over the lazy dog again and again until night falls"),
    (8, " ".join(f"w{i % 700}" for i in range(5000))), (9, "line\nline\n\nline two\nline\n"),
    (10, "it's we're I'll 'tis 12ab ab12 ..!! <|endoftext|> done"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with further columns, some named like results."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, 7, "x", 0.5) for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, labels string, score double")
