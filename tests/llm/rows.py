"""Rows and words for the tests."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    """Words as the contracts define them."""
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


#: one of each: null text, empty, blanks only, one word, no id, repeated rows, other scripts
ODD = [
    (1, None), (2, ""), (3, " \t\n\r "), (4, "word"), (None, "no id here at all my friend"), (None, None),
    (5, "same text twice in this table of ours"), (5, "same text twice in this table of ours"),
    (6, "Ünïcode ßtraße 你好 \U0001f600 é\nnext line"), (7, "a b c"), (8, "A B C"),
]
