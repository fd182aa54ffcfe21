"""Licence scan with a positional rare-token index.

Templates are short public licence notices.  The index keeps, for every word of
a template, its postings (template, position) and its inverse document
frequency over all scanned documents.  A file is looked up by its licence words
of highest IDF: a key phrase is entered through its rarest word, the start
positions that word implies are intersected with those its other words imply,
rarest first, and what is left are the places of the phrase.  A template is
found where all its key phrases stand at their relative positions; it is scored
by the IDF weight of its words that stand in place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import map_batches
from queuelake.llm.words import as_bytes, span_hashes

#: Words between two key phrases of a template may shift by so many places.
SLACK = 3


class Template(NamedTuple):
    label: str
    text: str
    key_phrases: tuple[str, ...]  # each stands in the text


#: The phrases of the contract and their labels.
BASE = [
    Template("mit", "mit license", ("mit license",)),
    Template("apache", "apache license", ("apache license",)),
    Template("gpl", "general public license", ("general public license",)),
]

#: Wordings of public licence notices.
NOTICES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "obtaining a copy of this software", "without restriction")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("bsd", "released under the bsd license", ("bsd license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", ("cc by nc sa",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    Template("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
]

#: Bytes of a word once A-Z are lower case.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _hash(word: str) -> int:
    b = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(b, np.array([0]), np.array([len(b)]))[0])


class Phrase(NamedTuple):
    words: tuple[int, ...]  # numbers of the vocabulary
    at: int  # its place in the template


class Index:
    """Postings of the templates' words, and the words' IDF."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.vocabulary = sorted({w for t in templates for w in t.text.split()})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        hashes = np.array([_hash(w) for w in self.vocabulary], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.idf = np.ones(len(self.vocabulary))
        self.words = [np.array([number[w] for w in t.text.split()]) for t in templates]
        self.phrases = [[self._phrase(t.text.split(), p.split(), number) for p in t.key_phrases] for t in templates]

    @staticmethod
    def _phrase(text: list[str], phrase: list[str], number: dict[str, int]) -> Phrase:
        at = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
        return Phrase(tuple(number[w] for w in phrase), at)

    def weigh(self, documents: int, frequency: dict[str, int]) -> None:
        """IDF of the vocabulary from counts over all documents."""
        self.idf = np.array([math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1 for w in self.vocabulary])

    def postings(self, text: str | None) -> tuple[int, dict[int, np.ndarray]]:
        """Words in the text, and the places of each licence word in it."""
        data = as_bytes(text, lower=True)
        b = np.frombuffer(data, dtype=np.uint8)
        inside = np.zeros(len(b) + 2, dtype=bool)
        inside[1:-1] = _WORD[b]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[0::2], edge[1::2]
        if not len(start):
            return 0, {}
        h = span_hashes(b, start, end)
        slot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[slot] == h)
        word = self.order[slot[at]]
        by_word = np.argsort(word, kind="stable")
        word, at = word[by_word], at[by_word]
        cut = np.flatnonzero(np.diff(word)) + 1
        return len(start), {int(w[0]): p for w, p in zip(np.split(word, cut), np.split(at, cut)) if len(w)}

    def _places(self, phrase: Phrase, found: dict[int, np.ndarray]) -> np.ndarray:
        """Starts of a phrase: positions less offset, rarest word first."""
        offsets = sorted(range(len(phrase.words)), key=lambda i: -self.idf[phrase.words[i]])
        starts: np.ndarray | None = None
        for i in offsets:
            at = found.get(phrase.words[i])
            if at is None:
                return np.zeros(0, dtype=np.int64)
            starts = at - i if starts is None else np.intersect1d(starts, at - i, assume_unique=True)
            if not len(starts):
                break
        return starts[starts >= 0]

    def match(self, template: int, found: dict[int, np.ndarray]) -> tuple[np.ndarray, float]:
        """Starts of the template in a file, and the score of the best one."""
        none = np.zeros(0, dtype=np.int64), 0.0
        first, *others = self.phrases[template]
        starts = self._places(first, found) - first.at
        for phrase in others:
            there = self._places(phrase, found) - phrase.at
            if not len(there) or not len(starts):
                return none
            near = np.searchsorted(there, starts - SLACK)
            starts = starts[(near < len(there)) & (there[np.minimum(near, len(there) - 1)] <= starts + SLACK)]
        if not len(starts):
            return none
        words = self.words[template]
        weight = np.zeros(len(starts))
        for q, w in enumerate(words):
            if w in found:
                weight += self.idf[w] * np.isin(starts + q, found[int(w)])
        return starts, float(weight.max() / self.idf[words].sum())


def _frequencies(docs: DataFrame, index: Index) -> dict[str, int]:
    """Documents that hold each word of the vocabulary (a row per word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(index.vocabulary), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                _, found = index.postings(text.as_py())
                counts[list(found)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(index.vocabulary), pa.array(counts)], names=["word", "n"])

    rows = map_batches(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r.word: r.n for r in rows}


def scan_licences(docs: DataFrame, notices: list[Template] = NOTICES) -> DataFrame:
    """Licence labels of every document.

    Words are runs of bytes other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F in
    the text with A-Z lower-cased.  n_base counts all places of the base
    phrases, first_word and last_word are their least and greatest start (null
    without any); labels adds those of the notices; score is that of the best
    template, 0 without one.  A null text is empty: no words, labels "".
    Repeated rows give a row each; only doc_id and text are read; an empty
    table gives no rows.
    """
    index = Index([*BASE, *notices])
    index.weigh(docs.count(), _frequencies(docs, index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                n_words, found = index.postings(text.as_py())
                base: list[int] = []
                base_labels, labels, score = set(), set(), 0.0
                for i, t in enumerate(index.templates if found else []):
                    starts, best = index.match(i, found)
                    if len(starts):
                        labels.add(t.label)
                        if i >= len(BASE):
                            score = max(score, best)
                        else:
                            base_labels.add(t.label)
                            base += starts.tolist()
                if base:
                    score = max(score, 0.5)
                rows.append((n_words, len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(score, 1.0)))
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate([pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def brute_force_base(text: str | None) -> tuple[int, list[int], list[str]]:
    """Words, base places and base labels of a text by direct comparison."""
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for t in BASE:
        phrase = t.text.split()
        at = [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]
        places += at
        if at:
            labels.add(t.label)
    return len(words), sorted(places), sorted(labels)
