"""License scan: an exact set-similarity join of text blocks with license templates.

Words are runs of letters and digits (ASCII, lower-cased A-Z) and of non-ASCII
characters. A text block is ``BLOCK_WORDS`` consecutive words; blocks overlap
by half, so a notice of up to half a block lies whole in one. A template is
found in a block when the block holds ``THRESHOLD`` of the template's distinct
words.

The join is exact. A first pass counts the templates' words over the whole
corpus; each template lists its words from rare to frequent (ties by word). To
hold ceil(t * n) of n words a block must hold one of the first
n - ceil(t * n) + 1 (prefix filter) and that many template words at all
(length filter), and from the place of its first match on the list no fewer may
be left than it still needs (positional filter). Only then are the sets compared.

The templates are a fixed list that does not grow with the corpus. Base
phrases are looked up word for word beside it, as labels that always stay.

Defined cases: null and wordless texts have no word, no label and score 0;
very long texts are read whole; repeated rows are judged alike; empty tables
give empty tables; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_text_columns, ship, shipped, text_bytes

THRESHOLD = 0.9
BLOCK_WORDS = 64

# Phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Usual wording of notices, and the labels that they give.
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
            " general public license as published by the free software foundation"),
    ("lgpl", "this library is licensed under the terms of the gnu lesser general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
            " that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "dedicated to the public domain under the creative commons cc0 1 0 universal dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after another."""
    joined = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at, word, counted = joined.find(wanted), 0, 0
        while at >= 0:
            word, counted = word + joined.count(b" ", counted, at), at
            places.append((word, label))
            at = joined.find(wanted, at + 1)
    return places


class Templates:
    """Templates with their words in the corpus's order of frequency."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, counts: dict[bytes, int]):
        sets = [(label, sorted(set(words_of(t.encode())), key=lambda w: (counts.get(w, 0), w))) for label, t in templates]
        self.words = sorted({w for _, s in sets for w in s})
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.labels = [label for label, _ in sets]
        self.lists = [np.array([self.ids[w] for w in s]) for _, s in sets]
        self.need = [max(1, ceil(threshold * len(s) - 1e-9)) for _, s in sets]
        self.seeds: dict[int, list[tuple[int, int]]] = {}  # word -> (template, place) within the prefixes
        for t, (words, need) in enumerate(zip(self.lists, self.need)):
            for place, w in enumerate(words[:len(words) - need + 1].tolist()):
                self.seeds.setdefault(w, []).append((t, place))
        self.first_words = frozenset(self.words[w] for w in self.seeds)

    def search(self, words: list[bytes], size: int = BLOCK_WORDS) -> dict[int, float]:
        """Template -> its best containment among the text's blocks, of those that reach the threshold."""
        if self.first_words.isdisjoint(words):
            return {}
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int32, len(words))
        at = np.flatnonzero(ids >= 0)
        found: dict[int, float] = {}
        half = size // 2
        seeds = at[np.isin(ids[at], list(self.seeds))]
        blocks = sorted({int(b) for p in seeds // half for b in (p - 1, p) if b >= 0})
        for b in blocks:
            lo, hi = np.searchsorted(at, [b * half, b * half + size])
            held = set(ids[at[lo:hi]].tolist())
            candidates: dict[int, int] = {}
            for w in held:
                for t, place in self.seeds.get(w, ()):
                    candidates[t] = min(candidates.get(t, place), place)
            for t, place in candidates.items():
                words_left = len(self.lists[t]) - place
                if len(held) < self.need[t] or words_left < self.need[t]:
                    continue
                shared = sum(1 for w in self.lists[t][place:].tolist() if w in held)
                if shared >= self.need[t]:
                    found[t] = max(found.get(t, 0.0), shared / len(self.lists[t]))
        return found


def template_counts(docs: DataFrame, templates: list[tuple[str, str]], text: str = "text") -> dict[bytes, int]:
    """How often each word of the templates stands in the corpus; as many numbers as template words."""
    vocabulary = sorted({w for _, t in templates for w in words_of(t.encode())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = {w: i for i, w in enumerate(vocabulary)}
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for t in text_bytes(batch.column(0)):
                hit = [ids[w] for w in words_of(t) if w in ids]
                total += np.bincount(hit, minlength=len(total)) if hit else 0
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["w", "n"])

    counted = docs.select(text).mapInArrow(run, "w int, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    return {vocabulary[r["w"]]: r["n"] for r in counted.collect()}


def scan_licenses(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
                  phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the text, with word and phrase counts, labels and score."""
    prepared = ship(docs.sparkSession, Templates(templates, threshold, template_counts(docs, templates, text)))
    markers = [words_of(p.encode()) for p in phrases]

    def make():
        known = shipped(prepared)

        def judge(texts: list[bytes]) -> list:
            n_words, n_base, first, last, base_labels, labels, scores = ([] for _ in range(7))
            for t in texts:
                words = words_of(t)
                present = set(words)
                own = {p: label for (p, label), m in zip(phrases.items(), markers) if present.issuperset(m)}
                places = phrase_places(words, own) if own else []
                found = known.search(words)
                base = {label for _, label in places}
                n_words.append(len(words))
                n_base.append(len(places))
                first.append(min(places)[0] if places else None)
                last.append(max(places)[0] if places else None)
                base_labels.append(",".join(sorted(base)))
                labels.append(",".join(sorted(base | {known.labels[t] for t in found})))
                scores.append(1.0 if places else max(found.values(), default=0.0))
            return [n_words, n_base, first, last, base_labels, labels, scores]

        return judge

    fields = [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    fields += [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
               T.StructField("score", T.DoubleType())]
    return add_text_columns(docs, text, fields, make, drop=(text,))
