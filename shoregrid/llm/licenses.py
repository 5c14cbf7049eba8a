"""Licence notices in documents: fixed phrases, and an exact set-similarity join with licence templates.

A block is a line of a text, a paragraph (a run of lines with words; marks of comments are no words), or a window
of lines with words that is just long enough for a template that starts in its first line, however it is wrapped.
As a set of words, it matches a template if it holds at least THRESHOLD of the template's words.
Words are ordered by how many lines of the whole corpus hold them, rarest first. To match, a block must hold one of the first words of a template (prefix filter), it
must be large enough (length filter), and what can still match after the first common word must reach
the threshold (positional filter); the survivors are counted in full. Nothing that matches is lost.

Only words that occur in templates count for matches, so blocks are reduced to these in the pass that reads
the texts; templates are a fixed list, so their index is small enough for every task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready

THRESHOLD = 0.9
"""High enough that notices that differ in the licence's name alone are told apart."""

# Phrases that name a licence, and public licence notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
    ],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "agpl": ["licensed under the gnu affero general public license"],
    "bsd": [
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "cc": ["licensed under a creative commons attribution 4 0 international license", "licensed under cc by 4 0"],
    "cc-by-sa": ["licensed under a creative commons attribution sharealike 4 0 international license", "licensed under cc by sa 4 0"],
    "cc-by-nc": ["licensed under a creative commons attribution noncommercial 4 0 international license", "licensed under cc by nc 4 0"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights to this work"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_WORDS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def words(text: str) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().translate(_WORDS).split()


def phrase_places(text: str) -> tuple[int, list[int], set[str]]:
    """Number of words, the word numbers where phrases start, the labels found."""
    found = words(text)
    joined = b" " + b" ".join(found) + b" "
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        wanted = f" {phrase} ".encode()
        at, counted, word = joined.find(wanted), 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            places.append(word)
            labels.add(label)
            at = joined.find(wanted, at + 1)
    return len(found), sorted(places), labels


def templates() -> list[tuple[int, str, frozenset[bytes]]]:
    """(number, label, words) of every template."""
    pairs = [(label, text) for label, texts in TEMPLATES.items() for text in texts]
    return [(k, label, frozenset(words(text))) for k, (label, text) in enumerate(pairs)]


def needed(size: int, threshold: float = THRESHOLD) -> int:
    """How many words of a template of this size a block must hold."""
    return int(np.ceil(threshold * size - 1e-9))


def reduced(text: str, vocabulary: frozenset[bytes]) -> list[tuple[int, int, frozenset[bytes]]]:
    """(line number, number of words, words that templates have) of every line that has words."""
    data = text.encode().lower()
    found = []
    for k, line in enumerate(data.split(b"\n")):
        here = line.translate(_WORDS).split()
        if here:
            found.append((k, len(here), vocabulary.intersection(here)))
    return found


def paragraphs(numbers: list[int]) -> list[tuple[int, int]]:
    """First and last place of every run of consecutive line numbers."""
    ends = [k for k in range(1, len(numbers)) if numbers[k] != numbers[k - 1] + 1]
    return list(zip([0, *ends], [k - 1 for k in [*ends, len(numbers)]])) if numbers else []


def windows(counts: list[int], length: int, held: list[bool]) -> list[tuple[int, int]]:
    """First and last place of the windows that hold every run of `length` words, by the line in which it starts.

    A window whose first line has no word of the template is left out: the next one has all that it has.
    """
    total = np.cumsum(counts)
    ends = np.minimum(np.searchsorted(total, total + length - 1), len(counts) - 1)
    return [(k, int(ends[k])) for k in range(len(counts)) if held[k]]


def frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """(word, blocks): how many lines of the corpus hold each word of the templates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for text in frame["text"]:
                for _, _, held in reduced(text or "", vocabulary):
                    total.update(held)
        yield pd.DataFrame({"word": list(total), "blocks": list(total.values())})

    counted = docs.select("text").mapInPandas(run, "word binary, blocks long")
    return counted.groupBy("word").agg(F.sum("blocks").alias("blocks"))


def found(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of phrases, first_word and last_word are the least and greatest of them (null
    without one). `labels` adds those of matching templates. score is the greatest containment of a template
    in a block, 1 where a phrase is found. `matches` lists (label, first line, containment) of the matching
    blocks that hold no smaller one of at least the same containment. Null and empty texts have no words. Repeated rows and null ids stay. Other columns are not read.
    """
    ready(docs.sparkSession)
    listed = templates()
    vocabulary = frozenset().union(*(t for _, _, t in listed))
    # a few hundred words at most: the vocabulary of a fixed list
    common = {bytes(r.word): r.blocks for r in frequencies(docs, vocabulary).collect()}
    place = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (common.get(w, 0), w)))}
    index: dict[int, list[tuple[int, int]]] = {}
    ordered = []
    for number, _, bag in listed:
        tokens = sorted(place[w] for w in bag)
        ordered.append(np.array(tokens))
        for at, token in enumerate(tokens[: len(tokens) - needed(len(tokens), threshold) + 1]):
            index.setdefault(token, []).append((number, at))

    lengths = [len(words(text)) for texts in TEMPLATES.values() for text in texts]

    def matches(held: Iterable[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that a block matches."""
        tokens = sorted(map(place.__getitem__, held))
        seen: set[int] = set()
        out = []
        for k, token in enumerate(tokens):
            for number, at in index.get(token, ()):
                size = len(ordered[number])
                least = needed(size, threshold)
                if number in seen or len(tokens) < least:
                    continue
                seen.add(number)
                # at the first common word nothing before it is shared
                if 1 + min(size - at - 1, len(tokens) - k - 1) < least:
                    continue
                shared = len(np.intersect1d(ordered[number], tokens, assume_unique=True))
                if shared >= least:
                    out.append((number, shared / size))
        return out

    def in_blocks(lines: list[tuple[int, int, frozenset[bytes]]]) -> list[tuple[str, int, float]]:
        """(label, first line, containment) of what the blocks of a text match."""
        # what the whole text does not match, no part of it does
        wanted = [number for number, _ in matches(frozenset().union(*(held for _, _, held in lines)))]
        if not wanted:
            return []
        numbers, counts, held = [list(x) for x in zip(*lines)]
        known: dict[tuple[int, int], dict[int, float]] = {}
        for span in [*((k, k) for k in range(len(lines))), *paragraphs(numbers)]:
            known.setdefault(span, {number: 0.0 for number in wanted})
        for number in wanted:
            bag = listed[number][2]
            for span in windows(counts, lengths[number], [not bag.isdisjoint(h) for h in held]):
                known.setdefault(span, {})[number] = 0.0
        out = []
        kept: dict[int, list[tuple[int, int, float]]] = {}  # by first place: only spans that start inside are compared
        answers: dict[frozenset[bytes], list[tuple[int, float]]] = {}  # repeated notices are matched once
        for (i, j), asked in sorted(known.items(), key=lambda x: (x[0][1] - x[0][0], x[0])):
            bag = held[i] if i == j else frozenset().union(*held[i : j + 1])
            if bag not in answers:
                answers[bag] = matches(bag)
            for number, share in answers[bag]:
                if number not in asked:
                    continue
                smaller = kept.setdefault(number, [])
                inside = smaller[bisect_left(smaller, (i,)) : bisect_left(smaller, (j + 1,))]
                if not any(b <= j and share <= s for _, b, s in inside):
                    insort(smaller, (i, j, share))
                    out.append((listed[number][1], numbers[i], share))
        return out

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            n, places, base = phrase_places(text)
            hits = in_blocks(reduced(text, vocabulary))
            labels = base | {label for label, _, _ in hits}
            score = 1.0 if base else max((share for _, _, share in hits), default=0.0)
            rows.append(
                (
                    n,
                    len(places),
                    places[0] if places else None,
                    places[-1] if places else None,
                    ",".join(sorted(base)),
                    ",".join(sorted(labels)),
                    score,
                    [{"label": a, "line": b, "containment": c} for a, b, c in hits],
                )
            )
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
        return pd.DataFrame(rows, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, matches array<struct<label: string, line: int, containment: double>>"
    )
    return docs.select("doc_id", F.pandas_udf(run, schema)("text").alias("f")).select("doc_id", "f.*")
