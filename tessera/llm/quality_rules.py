"""Quality rules, line first: bad lines go, then documents that lost too much text.

Each line is judged alone by punctuation, navigation, boilerplate, symbol,
shouting and repetition rules, however short it is; only repetition and missing
punctuation need a number of words. Failing lines are removed; a document goes when
the words removed hold more than ``MAX_LOST`` of its word characters. Before
that come two whole-document rules: fewer than ``MIN_WORDS`` words, or more
than ``MAX_REPEAT`` of the words standing in 8-word windows that the text
holds twice or more.

Defined cases: a null text counts as empty (no word, rejected, text stays
null); repeated rows are judged alike; very long texts are read whole, a piece
of the batch at a time; an empty table gives an empty table; extra columns pass.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_text_columns, fresh, split_words, word_ids

MIN_WORDS = 20
MAX_REPEAT = 0.30
WINDOW = 8
MAX_LOST = 0.30

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_NOT_CODE_POINTS = _SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
_SYMBOLS = b"#*$%&|<>"
_SEPARATOR = re.compile(rb"[|>\xb7/\\-]+|\xc2\xbb|\xe2\x80\xa2|\xc2\xb7")
_SYMBOL_RUN = re.compile(rb"[#*$%&<>~^=_|]{3,}")
_SENTENCE_MARK = re.compile(rb"[.!?:;,]|\xe2\x80\xa6|\xe3\x80\x82")
_BOILERPLATE = re.compile(
    rb"cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|"
    rb"enable javascript|click here|sign up (?:now|for)|subscribe to our|share this|skip to content|"
    rb"back to top|read more|add to cart|log ?in to")


def line_fails(line: bytes) -> bool:
    """True if the line breaks one of the line rules. Blank lines pass."""
    words = line.split()
    n = len(words)
    if n == 0:
        return False
    if sum(1 for w in words if _SEPARATOR.fullmatch(w)) * 5 >= n:  # navigation
        return True
    if sum(1 for w in words if _SYMBOL_RUN.search(w)) * 10 >= 3 * n:  # symbol noise
        return True
    if line.count(b"!!") * 10 >= 3 * n:  # shouting
        return True
    if n >= 6 and sum(a == b for a, b in zip(words, words[1:])) * 10 >= 4 * n:  # stuttering
        return True
    if n >= 12 and not _SENTENCE_MARK.search(line):  # no punctuation at all
        return True
    return n <= 20 and _BOILERPLATE.search(line.lower()) is not None


def repeated_words(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text: words that stand in an 8-word window found twice or more in it.

    A rolling hash of all windows finds texts that may hold a repeat; those
    are settled exactly, by ranking pairs, then fours, then eights of words.
    """
    n_texts, n = len(ends) - 1, len(ids)
    out = np.zeros(n_texts, np.int64)
    if n < WINDOW:
        return out
    owner = np.repeat(np.arange(n_texts), np.diff(ends))
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            h = h * np.uint64(0xD6E8FEB86659FD93) + mixed[k:n - WINDOW + 1 + k]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h += owner[:len(h)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    whole = owner[:len(h)] == owner[WINDOW - 1:]
    order = np.sort(h[whole])
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return out
    for text in np.unique(owner[:len(h)][whole & np.isin(h, np.unique(twice))]):
        out[text] = _repeated_exact(ids[ends[text]:ends[text + 1]])
    return out


def _repeated_exact(ids: np.ndarray) -> int:
    rank, step = ids, 1
    while step < WINDOW:
        rank = np.unique(rank[:-step] * (rank.max() + 1) + rank[step:], return_inverse=True)[1]
        step *= 2
    starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return int((np.cumsum(cover) > 0).sum())


def _judge(texts: list[bytes]) -> list:
    words, ends = split_words(texts)
    ids, _ = word_ids(words)
    n_words = np.diff(ends)
    repeats = repeated_words(ids, ends)
    chars = [len(t.translate(None, _NOT_CODE_POINTS)) for t in texts]
    symbols = [len(t) - len(t.translate(None, _SYMBOLS)) for t in texts]
    dup_lines, lost, clean = [], [], []
    for t in texts:
        lines = t.split(b"\n")
        worded = [x for x in lines if x.strip(_SPACE)]
        dup_lines.append(len(worded) - len(set(worded)))
        bad = [line_fails(x) for x in lines]
        if any(bad):
            lost.append(sum(len(x.translate(None, _NOT_CODE_POINTS)) for x, b in zip(lines, bad) if b))
            clean.append(b"\n".join(x for x, b in zip(lines, bad) if not b).decode("utf-8", "replace"))
        else:
            lost.append(0)
            clean.append(None)
    failed = (n_words < MIN_WORDS) | (100 * repeats > round(100 * MAX_REPEAT) * n_words)
    kept = ~failed & (np.array(lost, np.int64) <= MAX_LOST * np.array(chars, np.int64))
    return [n_words, np.array(chars, np.int64), np.array(symbols, np.int64), np.array(dup_lines, np.int64),
            repeats, failed, kept, clean]


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge_documents(docs: DataFrame, text: str = "text", cleaned: str = "clean_text") -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``kept`` and the text without its failing lines."""
    fields = [T.StructField(c, T.LongType()) for c in MEASURES]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    part = fresh(docs, "__clean")
    out = add_text_columns(docs, text, [*fields, T.StructField(part, T.StringType())], lambda: _judge)
    return out.withColumn(cleaned, F.coalesce(part, text)).drop(part)


def keep_clean(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The kept documents without their failing lines; columns as given, ``n_chars`` brought up to date."""
    part, kept = fresh(docs, "__clean"), fresh(docs, "__kept")

    def verdict(texts: list[bytes]) -> list:
        got = _judge(texts)
        return [got[-2], got[-1]]

    out = add_text_columns(docs, text, [T.StructField(kept, T.BooleanType()), T.StructField(part, T.StringType())],
                           lambda: verdict)
    out = out.filter(kept).withColumn(text, F.coalesce(part, text))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(part).isNull(), F.col(n_chars)).otherwise(F.length(text)))
    return out.select(*docs.columns)
