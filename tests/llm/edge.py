"""A small table of documents with every awkward case, and an empty one."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use inside.
    "row long, digest string, leaks string, _m_id long, _id long, fp long, n long, kept boolean"
)
LONG = "word after word goes on and on until it is very long " * 4000


def rows():
    texts = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (3, None),
        (4, ""),
        (5, "   \n\t "),
        (6, LONG),
        (6, LONG),
        (None, "A text without an id that nobody asked for but that has to be kept"),
        (None, None),
        (7, "Ünïcödé wörds ÄÖÜ and \x00 a control sign \U0001f600"),
        (8, "short"),
    ]
    return [(i, t, None, None, None, 1, "x", "y", 2, 3, 4, 5, True) for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return (row[0] is None, row[0] or 0, row[1] is None, row[1] or "")
