"""Figures of how a text is made up, for a whole Arrow column at once: kinds of neighbouring characters, words, lines, repeats."""

from __future__ import annotations

import numpy as np

from loglathe.llm.textops import Texts, line_spans, span_hashes, window_hashes, words_of

#: kinds of characters: letters, capitals, digits, blanks, newline, ends of sentences, other marks of prose, symbols
KINDS = 8
_KIND = np.full(256, 7, np.int64)
_KIND[0x61:0x7B] = 0
_KIND[0xC0:] = 0  # first bytes of other letters; their further bytes are left out
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
_KIND[0x0A] = 4
_KIND[[ord(c) for c in ".!?"]] = 5
_KIND[[ord(c) for c in ",;:'\"()-"]] = 6

STATISTICS = (
    "characters", "words", "word_length", "word_spread", "long_words", "distinct_words", "commonest_word", "words_again",
    "repeated_windows", "lines", "words_a_line", "repeated_lines", "kinds", "one",
)
FEATURES = KINDS * KINDS + len(STATISTICS)
_LONG = 20


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeats(hashes: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: distinct values, the times of its commonest one, and values that occur more than once, all occurrences counted."""
    if not len(hashes):
        return np.zeros(count), np.zeros(count), np.zeros(count)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
    times = np.diff(np.append(first, len(h)))
    of = o[first]
    most = np.zeros(count)
    np.maximum.at(most, of, times)
    return np.bincount(of, minlength=count), most, np.bincount(of, times * (times > 1), count)


def shapes(texts: Texts) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each text; shares enter by their square root, sizes by their logarithm. Empty texts have zeros and the one."""
    count = len(texts)
    whole = (texts.data & 0xC0) != 0x80
    owner = np.repeat(np.arange(count), np.diff(texts.offsets))[whole]
    kind = _KIND[texts.data[whole]]
    characters = np.bincount(owner, minlength=count).astype(float)
    beside = owner[1:] == owner[:-1]
    pairs = np.bincount((owner[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[beside], minlength=count * KINDS * KINDS).reshape(count, KINDS * KINDS)
    of_kind = np.bincount(owner * KINDS + kind, minlength=count * KINDS).reshape(count, KINDS)

    words = words_of(texts)
    n_words = np.diff(words.first).astype(float)
    word_owner = np.repeat(np.arange(count), np.diff(words.first))
    length = (words.ends - words.starts).astype(float)
    mean = _share(np.bincount(word_owner, length, count), n_words)
    spread = np.sqrt(np.maximum(_share(np.bincount(word_owner, length**2, count), n_words) - mean**2, 0))
    distinct, commonest, _ = _repeats(words.hashes, word_owner, count)
    again = np.bincount(word_owner[1:], (words.hashes[1:] == words.hashes[:-1]) & (word_owner[1:] == word_owner[:-1]), count) if len(word_owner) else np.zeros(count)
    windows = window_hashes(words.hashes, 3)
    inside = word_owner[: len(windows)] == word_owner[2:] if len(windows) else np.zeros(0, bool)
    _, _, in_repeats = _repeats(windows[inside], word_owner[: len(windows)][inside], count)

    starts, ends, first = line_spans(texts)
    full = ends > starts
    line_owner = np.repeat(np.arange(count), np.diff(first))[full]
    n_lines = np.bincount(line_owner, minlength=count).astype(float)
    distinct_lines, _, _ = _repeats(span_hashes(texts.data, starts[full], ends[full]), line_owner, count)

    figures = [
        np.log1p(characters), np.log1p(n_words), np.log1p(mean), np.log1p(spread), np.sqrt(_share(np.bincount(word_owner, length > _LONG, count), n_words)),
        np.sqrt(_share(distinct, n_words)), np.sqrt(_share(commonest, n_words)), np.sqrt(_share(again, n_words)),
        np.sqrt(_share(in_repeats, np.maximum(n_words - 2, 1))), np.log1p(n_lines), np.log1p(_share(n_words, n_lines)),
        np.sqrt(_share(n_lines - distinct_lines, n_lines)), (of_kind > 0).sum(1) / KINDS, np.ones(count),
    ]
    return np.concatenate([np.sqrt(_share(pairs, characters[:, None])), np.stack(figures, 1)], 1).astype(np.float32)
