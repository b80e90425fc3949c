"""Fixtures with the awkward rows that every operator must take."""

WORDS = "the of and river stone quiet morning light over water under bridge while people walk slowly home before winter comes again with snow".split()

CLASHES = "row id t k_id k_text fp rep node component first times time share taken lang_found held_out score _id _t _uid _k_id _lang _time _norm _hash spans a.b".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    """rows: (doc_id, text, lang, source); with the columns of documents and extra ones whose names operators use themselves."""
    out = [(i, t, la, so, None if t is None else len(t), "x", 1, *["mine"] * len(CLASHES)) for i, t, la, so in rows]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, kept string, size int" + "".join(f", `{c}` string" for c in CLASHES))


def odd_rows():
    return [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, "   \n\t ", "en", "a"),
        (4, "12345 !!! 678", "en", "b"),
        (5, "\x01\x02 é́ 日本語 \U0001f600 Σ", "de", "b"),
        (6, "word " * 60_000, "en", "a"),
        (7, "x" * 150_000, "en", None),
        (8, "same text here", "en", "a"),
        (8, "same text here", "en", "a"),
        (9, "same  text\there", "fr", "c"),
        (None, "same text here", None, "a"),
        (10, "mail a@b.co and +1 (555) 555-1234 and 10.0.0.255", "en", "a"),
    ]
