"""Quality rules: repetition coverage.

Words and lines of whole texts are hashed with a rolling polynomial in
numpy.  For n-grams of several lengths the rule measures the share of
characters inside n-grams that repeat an earlier one (each character
counts once per length), and the same for lines.

Defined results: a null or empty text has no word and fails the base rule;
rows are judged one by one, so ties, repeated rows and null ids change
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from propval.llm import textbytes as tb

#: Largest share of characters inside repeated n-grams, by n.  The base rule
#: counts both copies and rejects past a half, so what passes it has a later
#: copy's share of a quarter at most: limits must lie below that to decide.
NGRAM_SHARE = {4: 0.20, 5: 0.18, 7: 0.16, 10: 0.15}
#: Largest share of lines, and of their characters, that repeat a line.
LINE_SHARE, LINE_CHAR_SHARE = 0.50, 0.30
#: Largest number of symbols to a word.
SYMBOL_RATIO = 0.10
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True

FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField(n, T.DoubleType()) for n in (*(f"dup_{n}gram_share" for n in NGRAM_SHARE), "dup_line_share", "dup_line_char_share")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]


def _marked_words(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside any of the windows of n words that begin at ``at``."""
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + n, -1)
    return np.cumsum(depth[:-1]) > 0


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The columns of FIELDS for an array of texts."""
    data, offsets = tb.text_bytes(texts)
    docs = len(offsets) - 1
    start, end, owner = tb.words(data, offsets)
    hashed = tb.SpanHash(data)
    is_char = (data & 0xC0) != 0x80
    chars_to = np.concatenate([[0], np.cumsum(is_char & tb.IS_WORD[data])])
    count = lambda at, weight=None: np.bincount(at, weight, docs)
    n_words = count(owner).astype(np.int64)
    chars = (chars_to[end] - chars_to[start]).astype(float)
    word_chars = count(owner, chars)
    own = tb.mix(owner.astype(tb.U) + tb.U(1))
    word = hashed(start, end)

    at, key = tb.windows(word, owner, 3)
    again = tb.repeated(key ^ own[at])
    n_repeat = count(owner[_marked_words(at[again], 3, len(word))])
    shares = []
    for n in NGRAM_SHARE:
        at, key = tb.windows(word, owner, n)
        inside = _marked_words(at[tb.seen_before(key ^ own[at])], n, len(word))
        shares.append(count(owner[inside], chars[inside]) / np.maximum(word_chars, 1))

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))       # one even where an empty text or line is
    line_owner = np.searchsorted(offsets, line_start, "right") - 1
    inner = (line_owner < docs) & (line_start < offsets[np.minimum(line_owner, docs - 1) + 1])   # an empty last line has no word
    line_start, line_owner = line_start[inner], line_owner[inner]
    next_break = np.concatenate([breaks, [len(data)]])[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(next_break, offsets[line_owner + 1])
    line_chars = chars_to[line_end] - chars_to[line_start]
    full = line_chars > 0
    line_start, line_end, line_owner, line_chars = (x[full] for x in (line_start, line_end, line_owner, line_chars))
    again = tb.seen_before(hashed(line_start, line_end) ^ tb.mix(line_owner.astype(tb.U) + tb.U(1)))
    n_dup_lines = count(line_owner[again])
    line_share = n_dup_lines / np.maximum(count(line_owner), 1)
    line_char_share = count(line_owner[again], line_chars[again].astype(float)) / np.maximum(word_chars, 1)

    n_symbols = tb.per_text(IS_SYMBOL[data], offsets)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    kept = ~failed & (line_share <= LINE_SHARE) & (line_char_share <= LINE_CHAR_SHARE) & (n_symbols <= SYMBOL_RATIO * n_words)
    for share, most in zip(shares, NGRAM_SHARE.values(), strict=True):
        kept &= share <= most
    longs = [x.astype(np.int64) for x in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat)]
    return [*longs, *shares, line_share, line_char_share, failed, kept]


def quality(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the columns of FIELDS (input columns of these names go)."""
    return tb.append_columns(df, text, FIELDS, lambda x: [pa.array(c) for c in measure(x)])


def kept_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df, in its own columns, that the rules keep."""
    return tb.filter_rows(df, text, lambda x: measure(x)[-1])
