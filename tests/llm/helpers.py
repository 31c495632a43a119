"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    """A documents table of the texts given; ids from 0 unless given."""
    rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank tonight"
LONG = " ".join(f"word{i % 977} {'x' * (i % 13)}" for i in range(30_000))
AWKWARD = [
    None, "", " ", "\n\n", "a", PROSE, PROSE, PROSE.upper(), "The " * 400, LONG, "ünïcödé ßtraße 東京 タワー 🙂🙂 naïve",
    "tabs\tand\r\nline ends\x0b here\x85there\xa0 end ", "one  two   three \n four", "▁ literal ▁▁ marks", "<|endoftext|> in text <s>",
]
