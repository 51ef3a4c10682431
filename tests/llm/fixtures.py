"""Documents with every awkward case: nulls, blanks, long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(400)]
    out = [r.choice(vocabulary) for _ in range(words)]
    return " ".join(w.capitalize() + "." if k % 11 == 10 else w for k, w in enumerate(out))


PASSAGE = prose(1, 60)


def rows() -> list[tuple]:
    base = prose(2, 200)
    near = base.split(" ")
    near[100] = "changed"
    out = [
        (1, base, "en", "s0"), (2, " ".join(near), "en", "s1"), (3, base, "de", "s2"), (3, base, "de", "s2"),
        (4, None, None, None), (5, "", "en", "s0"), (6, " \t\n\x0b\x0c\r ", "en", "s1"), (7, "Two words", None, "s1"), (8, "two WORDS", "xx", None),
        (None, base, "en", "s3"), (10, prose(3, 30) + "\n" + PASSAGE, "en", "s0"), (11, PASSAGE + " " + prose(4, 30), "fr", "s1"),
        (12, "ab" * 150, "en", "s2"), (13, "é" * 90 + "ü" * 90, "fr", "s3"), (14, prose(5, 9000), "en", "s4"), (15, "日本語のテキスト。" * 60, "ja", "s5"),
        (16, "x" * 40000, "en", "s0"), (17, "<|endoftext|> it's <b>don't</b> 3.14\r\n\r\nend  ", "en", "s1"), (18, "#$%& " * 80, "en", "s2"),
        (19, prose(6, 120) + " \U0001f600 ﬁ K İ", "es", "s3"), (20, "Á éclair ΟΔΟΣ straße", "de", "s4"),
    ]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in out]


def documents(spark, extra: bool = True):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    if extra:
        clash = ("_row", "_id", "_text", "bucket", "part", "kept", "score", "n_lines", "node", "key", "component_id", "words", "piece", "start")
        df = df.withColumns({c: F.lit("clash") for c in clash})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def blank(text) -> bool:
    return not text or not text.strip(" \t\n\x0b\x0c\r")
