"""Awkward rows that every operator must take: nulls, empty and very long texts, ties, repeats."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count long, cid long, token long, dropped string, removed string, key string"
EXTRA = (1, 2, 3, "x", "y", "z")


def edge_docs(spark):
    long = " ".join(f"word{i % 977} tail{i}" for i in range(60_000))
    texts = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta.\nSecond line of the very same text here."),
        (2, "alpha BETA gamma delta epsilon zeta eta theta.\nSecond line of the very same text here."),
        (3, None), (4, ""), (5, " \n\t "), (6, "one"), (6, "one"), (7, "12 345 --- !!!"), (None, "Alpha beta gamma delta epsilon zeta eta theta."),
        (8, long), (9, "é" * 3000), (10, "\x00 ▁ 漢字 \U0001f600 <s>   end"), (11, "a\n\n\nb\n"), (12, "x" * 50_000),
    ]
    langs = {1: "en", 2: "en", 8: "en", 9: "fr", 10: None}
    return spark.createDataFrame([(i, t, langs.get(i, "en"), "s", None, *EXTRA[:3], *EXTRA[3:]) for i, t in texts], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
