from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

LETTERS = {"en": "the and ing tion er ha th of", "de": "der ung keit sch ein zu ä ß", "fr": "le eau tion é que ou è ç"}


@pytest.fixture(scope="session")
def corpus(spark):
    """300 documents with copies, near copies, odd texts, nulls in every column, a repeated row and columns whose names clash."""
    rng = random.Random(17)
    rows = []

    def text(lang: str, n: int, toxic: bool = False) -> str:
        parts = LETTERS[lang].split()
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]
        for _ in range(1 + n // 40 if toxic else 0):
            words[rng.randrange(n)] = "slur" + rng.choice(parts)
        return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in words) + "."

    for i in range(240):
        lang = rng.choice(["en", "en", "de", "fr"])
        toxic = i % 4 == 0
        rows.append((i, text(lang, rng.randint(20, 150), toxic), lang, "hot" if i % 3 == 0 else f"s{i % 7}", toxic))
    base = text("en", 120)
    for i in range(240, 280):  # exact and near copies of one text
        words = base.split(" ")
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = f"w{i}"
        rows.append((i, " ".join(words), "en", "hot", False))
    odd = [None, "", " \n\t ", "one", "two words", "A b c D", "a b C d", "123 456 !!", "漢字 " * 60, "x" * 5000, "ab cd " * 4000, "| ## $$ %% " * 30, "<|endoftext|>", "it's we're I'll\r\n 's"]
    rows += [(280 + k, t, None if k % 2 else "en", None, False) for k, t in enumerate(odd)]
    rows += [(None, "no id here at all", "en", "s1", False), rows[5], (299, rows[7][1], "en", "s2", False)]
    out = [(i, t, lang, source, None if t is None else len(t), "x", 0.5, True, "k", 1, [1]) for i, t, lang, source, _ in rows]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, id string, score double, kept boolean, bucket string, n_tokens int, words array<int>")
    docs = spark.createDataFrame(out, schema).repartition(3, "doc_id").cache()
    labels = spark.createDataFrame([(i, 1, int(toxic), None) for i, _, _, _, toxic in rows if i is not None] + [(9999, None, None, None)],
                                   "doc_id long, quality int, toxic int, text string")
    docs.count()
    return docs, labels


@pytest.fixture(scope="session")
def nothing(spark, corpus):
    return spark.createDataFrame([], corpus[0].schema), spark.createDataFrame([], T.StructType(corpus[1].schema.fields))
