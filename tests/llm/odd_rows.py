"""Rows that every operator must stand."""

from __future__ import annotations

#: Nulls in any column, empty and blank texts, a very long text, repeated rows, clashing extra columns.
ODD = [
    (1, None, "en", "a", 0, "x"),
    (2, "", "en", "a", 0, "x"),
    (3, " \n\t ", None, None, None, None),
    (4, "one two three", "en", "b", 13, "x"),
    (4, "one two three", "en", "b", 13, "x"),
    (None, "alpha beta gamma delta epsilon zeta", "en", "b", 1, "x"),
    (5, "long word " * 60_000, "en", "a", 1, "x"),
    (6, "w" * 200_000, "en", "a", 1, "x"),
    (7, "Grüße an ΣΑΣ, <|endoftext|> 'll 😀 é!", "de", "a", 1, "x"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, counts string"
