"""Small tables with the awkward rows that every operator must bear."""

import re

AWKWARD = [
    (1, None, "en", "src0", "x"),
    (2, "", "en", None, None),
    (3, "   \n\t ", None, "src1", "x"),
    (4, "one two", "en", "src1", "y"),
    (5, "one two", "en", "src1", "y"),
    (5, "one two", "en", "src1", "y"),
    (None, "a null id has words too", "de", "src2", None),
    (6, "Ünï cödé 日本語 " * 4000, "de", "src2", "z"),
    (7, "word" * 50_000, None, None, "z"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_words string"


def awkward(spark, extra=()):
    return spark.createDataFrame([*AWKWARD, *extra], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", lower)
