"""Fixtures shared by the tests of the pipeline operators."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

# An extra column of each name that operators use inside or return.
CLASHING = ["row", "key", "id", "sha", "name", "component", "kept", "shard", "n_words", "length", "__row", "size"]


def make_text(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(words))


def hard_rows():
    """Nulls, empty and blank texts, ties, repeated rows and a very long text."""
    long_text = make_text(1, 60_000)
    texts = [None, "", " \n\t", "a", "uno dos", "Ünï çödé ✓ 𝔘", make_text(2, 80), make_text(2, 80), long_text, long_text]
    rows = [(i, t, "en", f"s{i % 3}", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None), (None, "a", None, None, None), (None, make_text(2, 80), "en", None, 1)]
    return rows + [rows[6], rows[6], rows[3]]


def clash(df):
    """The frame with columns whose names the operators use themselves."""
    for name in CLASHING:
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df
