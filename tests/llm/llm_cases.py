"""Small documents with the cases that every operator must stand, and plain Python versions of shared definitions."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PROSE = ("The old mill by the river was sold in the spring, and the new owner of it had plans for a school. "
         "It was not the first time that the house and the land around it had been given to a new use. ") * 3
LONG = " ".join(f"word{i % 977} and{i}" for i in range(20_000))

#: (doc_id, text, lang, source, n_chars)
DOCS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE.replace("spring", "autumn", 1), "en", "a", None),
    (3, "  " + PROSE.replace(" ", "\t\n", 2), "en", None, 0),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n\x0b\f\r ", None, "b", 7),
    (7, "one", "en", "b", 3),
    (8, "one two three four", "en", "b", 18),
    (9, LONG, "en", "c", len(LONG)),
    (10, LONG + " tail", "en", "c", len(LONG) + 5),
    (11, "é́ 日本語  🙂 <|endoftext|> ▁ x\x00y\x85z", "fr", "c", 9),
    (12, "12 34 -- !!", "es", "c", 11),
    (13, "#" * 50 + " " + "* " * 60, "de", "d", 171),
    (14, "same line\nsame line\n\nsame line\nother", "de", "d", 37),
    (14, "same line\nsame line\n\nsame line\nother", "de", "d", 37),
    (15, "a b c d e f g h a b c d e f g h " * 4, "en", "d", 128),
    (None, "no id here at all, but some words", "en", "d", 33),
    (None, "no id here at all, but some words", "en", "d", 33),
    (16, "A" * 30_000, "en", "d", 30_000),
    (17, PROSE, "en", "e", len(PROSE)),
    (18, PROSE[: len(PROSE) // 3], "en", "e", len(PROSE) // 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside.
CLASHES = ("key", "row", "label", "node", "part", "rank", "bucket", "n_words", "kept", "norm", "class", "length", "score", "shard", "__part", "words")


def documents(spark, rows=DOCS, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES if clash else ():
        df = df.withColumn(name, F.lit("extra"))
    return df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    return WORD.findall(text or "")
