"""Small documents with the cases that every operator must handle."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, lang="en", source="s", ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def odd(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, further columns."""
    long = " ".join(f"w{k % 997}x" for k in range(30_000)) + "é" * 40_000
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (None, "one two three four five", "en", "a", 5), (None, None, None, None, None),
        (3, "same text here again now", "de", "b", 1), (4, "same  text here\nagain now", "de", "b", 1), (4, "same  text here\nagain now", "de", "b", 1),
        (5, long, "fr", None, 7), (6, "a▁b  c\n\x0b", "en", "c", 9), (7, " \t\n", "en", "a", 3), (8, "x", "en", "a", 1), (9, "ünïcödé 漢字 \U0001f600 mail@host.example.org", "en", "a", 2),
    ]
    return spark.createDataFrame([(*r, 0, "k", b"d") for r in rows], DOCS + ", size bigint, block string, digest binary"), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)
