"""Hard rows that every operator must survive, and plain versions to compare with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, label int, key long, place long, "
          "places string, spot int, spans string, row string, words int, component_id long, band long, id long, n long, kept string")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(2 + w % 4)) + str(w) for w in (r.randrange(vocabulary) for _ in range(n)))


def rows_of(pairs):
    return [(i, t, "en", "s", None if t is None else len(t), 0.5, 1, 7, -1, "x", 3, "y", "z", 2, 9, 8, 6, 5, "no") for i, t in pairs]


def frame(spark, pairs):
    return spark.createDataFrame(rows_of(pairs), SCHEMA)


LONG = prose(1, 30_000, 5_000)
COPY = prose(2, 150)
HARD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, COPY), (6, COPY), (6, COPY), (7, COPY + " end"), (8, LONG),
        (9, LONG[:90_000] + " other " + LONG[90_000:]), (10, "é" * 300), (11, "aaaa " * 400), (12, "a\x00b\x00" * 120), (13, "日本語 テキスト " * 60),
        (14, "line one\nline one\n\n  \nline two"), (15, prose(3, 60)), (None, COPY), (None, None), (16, "x y   z\u0085w")]


def words(text):
    return WORD.findall(text or "")
