"""Small tables with every awkward row, and plain Python versions to compare with."""

from __future__ import annotations

import re

from tidewell.llm.common import BLANKS

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
# Null, empty and blank texts, ids that repeat or are missing, equal rows, a very long text, odd characters.
AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n\x0b ", None, "b"),
    (4, LONG, "en", "a"),
    (5, "one text that comes twice", "en", "a"),
    (5, "one text that comes twice", "en", "a"),
    (6, "one text that comes twice", "de", "c"),
    (None, "a row without an id\nand two lines", "en", "b"),
    (None, None, None, None),
    (7, "▁ spaces   and \U0001f642 signs\r\n\x00", "fr", ""),
    (8, "x", "en", "c"),
]
# Names that the operators use for their own columns.
CLASHING = ["row", "doc", "h1", "batch", "size", "shard", "fp", "g", "_id", "spans", "ids", "version", "n_words", "kept"]


def documents(spark, rows=AWKWARD, clashing=True):
    layout = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame([tuple(r) for r in rows], layout)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def words(text):
    return WORD.findall(text or "")


def line_key(line):
    line = line.strip(BLANKS)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def table_rows(spark, sf_dir, name):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
