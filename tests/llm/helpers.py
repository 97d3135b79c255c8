"""Rows that every operator of the package has to bear."""

from pathlib import Path

import pyarrow.parquet as pq

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Nulls in any column, empty and blank texts, a repeated row, a long text, odd signs.
ODD_ROWS = [
    (1, None, "en", "a", 3), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "one", "en", None, None),
    (5, "one two", "de", "b", 7), (6, "One  two\nTHREE four's 12", "en", "b", 23), (6, "One  two\nTHREE four's 12", "en", "b", 23),
    (7, "naïve éé 中文 😀 \x0b end", "fr", "b", 20), (8, "word " * 30000, "en", "a", 150000), (9, "x" * 70000, "en", "a", 70000),
    (None, "one two three four", "en", "c", 18), (None, None, None, None, None),
]


def frame(spark, rows, extra=False):
    """Rows of documents; with ``extra``, columns whose names operators like to use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("fp", "size", "id", "value", "n", "key", "segment", "word", "score", "rank", "text_crc32", "ids"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def documents():
    """(doc_id, text, lang, source, n_chars) of the smallest table."""
    table = pq.read_table(Path(FOLDER, "documents.parquet"))
    return list(zip(*(table[c].to_pylist() for c in ("doc_id", "text", "lang", "source", "n_chars"))))


def rows_of(df, key="doc_id"):
    """Rows as dicts, in order of a key that may be null."""
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key] or 0))
