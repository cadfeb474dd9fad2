"""Small tables with the rows that break things: nulls, empty and very long texts, repeats, ties, clashing column names."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string, node string, block int, n_pseudonyms string"

LONG = "lorem ipsum dolor " * 5_000 + "x" * 20_000


def odd_texts() -> list[str | None]:
    return [None, "", " ", "\n\n", "a", "12 34 !?", "one two three four", LONG, "Ünï çödé 漢字 🙂 ɐ", "tab\tand\r\nline", "  two  spaces ",
            "same text here for all of us", "same text here for all of us", "<|endoftext|> is text", "'s 't 're don't"]


def odd_docs(spark, more: list[tuple] = ()):
    """Rows with odd texts, a null id, a repeated row, null labels and columns whose names the operators use inside."""
    rows = [(i, t, "en" if i % 3 else None, "src0", 7, 0.5, "x", "y", 1, "z") for i, t in enumerate(odd_texts())]
    rows += [(None, "a row without id", "en", None, None, None, None, None, None, None), rows[11], (2**40, "far id", "fr", "s", 1, 1.0, "", "", 0, "")]
    rows += [(*m, *[None] * (10 - len(m))) for m in more]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
