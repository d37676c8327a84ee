"""Small tables with what operators must bear: NULLs, empty and long texts, ties, repeated rows, clashing names."""

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, mark string, id string, kept string, "
    "shard string, slot string, place string, fp string, accepted string"
)
EXTRA = (None,) * 8
LONG = "lorem ipsum dolor sit amet consectetur " * 30_000


def documents(spark):
    """Awkward rows, and enough plain ones to train on."""
    rows = [
        (None, "a text without an identifier", "en", "s1"),
        (None, "a text without an identifier", "en", "s1"),
        (1, None, "en", "s1"),
        (2, "", None, None),
        (3, "", "en", None),
        (4, " \n\t ", "en", "s2"),
        (5, LONG, "en", "s2"),
        (6, LONG.upper(), "en", "s2"),
        (7, "Same Text Here for all of them", "en", "s3"),
        (8, "same text here for all of them", None, "s3"),
        (8, "same text here for all of them", None, "s3"),
        (9, "12345 67890 !!! ###", "en", ""),
        (10, "ÀÉÎ 日本語 déjà vu", "fr", ""),
        (11, "<|endoftext|> a special string <|startoftext|>", "en", "s4"),
        (12, "x" * 5000, "en", "s4"),
    ]
    rows += [(100 + i, f"the house and the garden of number {i} with the wall", "en", f"s{i % 5}") for i in range(40)]
    rows += [(200 + i, f"la maison et le jardin du numero {i} avec les murs", "fr", f"s{i % 5}") for i in range(40)]
    rows = [(i, t, lang, s, len(t or "")) + EXTRA for i, t, lang, s in rows]
    return spark.createDataFrame(rows, DOCS)


def empty(df):
    return df.limit(0)
