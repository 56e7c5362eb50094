"""License scans: licence phrases, and an exact set-similarity join with licence notices.

A text block (a line) matches a notice if it holds at least ``threshold`` of the notice's
distinct words. For wrapped notices, a paragraph's words across its line ends are blocks too:
every run of as many words as the notice has, and the share of other words allowed. The notices' words are ordered by their frequency in the whole corpus,
rarest first. A block that matches must hold one word of the notice's prefix, its first
``size - needed + 1`` words; it needs enough distinct words itself; and after the first
shared word, enough words must be left in both orders. Blocks that pass are verified by
counting.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, raw_texts, table

#: Base phrases, as words, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices as their licences publish them, with labels; each is one block.
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
     " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
     " associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation"),
    ("lgpl", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Share of a notice's distinct words that a block must hold.
THRESHOLD = 0.9
#: Upper bound of the notices' distinct words; they travel to every task.
NOTICE_WORDS = 20_000

# Lower-cases A-Z and turns every other ASCII sign but digits and letters into a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """How often each word of ``vocabulary`` occurs in all texts: ``word``, ``n``; summed per batch first."""

    def convert(batch: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        for text in raw_texts(batch["text"]):
            found = words_of(text)
            if not vocabulary.isdisjoint(found):
                counts.update(w for w in found if w in vocabulary)
        return {
            "word": pa.array([w.decode() for w in counts], pa.string()),
            "n": pa.array(counts.values(), pa.int64()),
        }

    return per_batch(docs.select("text"), convert, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[bytes, ...]  # rarest first
    needed: int
    span: int  # words of a run that is compared with it

    def share(self, words: list[bytes]) -> float:
        """Largest share of its distinct words in any run of ``span`` words."""
        own, held, most = set(self.words), Counter(), 0
        hits = [(place, word) for place, word in enumerate(words) if word in own]
        begin = 0
        for place, word in hits:
            held[word] += 1
            while hits[begin][0] <= place - self.span:
                left = hits[begin][1]
                held[left] -= 1
                if not held[left]:
                    del held[left]
                begin += 1
            most = max(most, len(held))
        return most / len(own)


class PrefixIndex:
    """Inverted index of the notices' prefixes."""

    def __init__(self, notices: list[tuple[str, frozenset[bytes]]], counts: dict[bytes, int], threshold: float, lengths: list[int]):
        self.order = {w: (counts.get(w, 0), w) for _, words in notices for w in words}
        self.notices: list[Notice] = []
        self.lists: dict[bytes, list[tuple[int, int]]] = {}
        for (label, words), length in zip(notices, lengths, strict=True):
            needed = max(1, math.ceil(threshold * len(words) - 1e-9))
            ranked = tuple(sorted(words, key=self.order.__getitem__))
            for place, word in enumerate(ranked[: len(ranked) - needed + 1]):
                self.lists.setdefault(word, []).append((len(self.notices), place))
            self.notices.append(Notice(label, ranked, needed, math.ceil(length / threshold - 1e-9)))
        self.prefix_words = frozenset(self.lists)

    def matches(self, block: set[bytes]) -> list[tuple[Notice, float]]:
        """All notices that the block holds, with the share of words held."""
        shared = sorted((w for w in block if w in self.order), key=self.order.__getitem__)
        tested, found = set(), []
        for at, word in enumerate(shared):
            for number, place in self.lists.get(word, ()):
                notice = self.notices[number]
                if number in tested or len(block) < notice.needed:
                    continue
                tested.add(number)  # the first shared prefix word decides by position
                if 1 + min(len(notice.words) - place - 1, len(shared) - at - 1) < notice.needed:
                    continue
                held = sum(w in block for w in notice.words)
                if held >= notice.needed:
                    found.append((notice, held / len(notice.words)))
        return found


def phrase_places(words: list[bytes], phrases: tuple[tuple[tuple[bytes, ...], str], ...]) -> list[tuple[int, str]]:
    """Start and label of every place where a phrase's words stand consecutively."""
    found = []
    for phrase, label in phrases:
        try:
            at = words.index(phrase[-1])  # the last word of the phrases is their rarer one
            while True:
                start = at - len(phrase) + 1
                if start >= 0 and tuple(words[start : at + 1]) == phrase:
                    found.append((start, label))
                at = words.index(phrase[-1], at + 1)
        except ValueError:
            continue
    return found


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double"
)


def scan(
    docs: DataFrame,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    threshold: float = THRESHOLD,
    wrapped: bool = False,
) -> DataFrame:
    """Licence labels of every row of ``docs``.

    Reads ``doc_id`` (null and repeated ids come out as they are) and ``text`` (null:
    empty) twice: once for the frequencies of the notices' words, once for the join. Only
    those words' counts reach the driver; ``notices`` are bounded by ``NOTICE_WORDS``.
    ``score`` is 1 where a phrase stands, else the largest share of a matching notice that
    a block holds, else 0. With ``wrapped``, notices may go over line ends; paragraphs end at a
    line without words. Empty texts have no words, no labels and score 0.
    """
    sets = [(label, frozenset(words_of(text.encode()))) for label, text in notices]
    vocabulary = frozenset().union(*(words for _, words in sets))
    if len(vocabulary) > NOTICE_WORDS:
        raise ValueError(f"more than {NOTICE_WORDS} words in the notices")
    counts = {r["word"].encode(): r["n"] for r in frequencies(docs, vocabulary).collect()}
    index = PrefixIndex(sets, counts, threshold, [len(words_of(text.encode())) for _, text in notices])
    sought = tuple((tuple(words_of(p.encode())), label) for p, label in phrases)

    def convert(batch: pa.RecordBatch) -> dict:
        rows = [_scan_text(text, index, sought, wrapped) for text in raw_texts(batch["text"])]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        return {"doc_id": batch["doc_id"]} | {
            n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)
        }

    return per_batch(docs.select("doc_id", "text"), convert, SCHEMA)


LINE = re.compile(rb"[^\r\n]+")
LINE_END = re.compile(rb"\r\n|\r|\n")


def paragraphs(text: bytes) -> list[list[bytes]]:
    """Words of each run of two or more lines with words."""
    found, own, lines = [], [], 0
    for line in [*LINE_END.split(text), b""]:
        words = words_of(line)
        if words:
            own += words
            lines += 1
            continue
        if lines > 1:
            found.append(own)
        own, lines = [], 0
    return found


def _scan_text(text: bytes, index: PrefixIndex, phrases, wrapped: bool) -> tuple:
    words = words_of(text)
    places = phrase_places(words, phrases)
    matched = []
    if not index.prefix_words.isdisjoint(words):
        for line in LINE.findall(text):
            block = set(words_of(line))
            if not index.prefix_words.isdisjoint(block):
                matched += [(notice.label, share) for notice, share in index.matches(block)]
        for own in paragraphs(text) if wrapped else ():
            for notice, _ in index.matches(set(own)):
                share = notice.share(own)
                if share * len(notice.words) >= notice.needed - 1e-9:
                    matched.append((notice.label, share))
    base = {label for _, label in places}
    starts = [start for start, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {label for label, _ in matched})),
        1.0 if places else max((share for _, share in matched), default=0.0),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents."""
    return scan(table(spark, sf_dir, "documents"), wrapped=True)
