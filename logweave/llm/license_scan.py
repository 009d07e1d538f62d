"""License scan: exact phrases, and short notices with a bounded number of edits.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z
lower-cased; a text is searched as its words joined by single blanks.

* Base phrases: places where the words of a phrase stand one after the other.
* Notices: a notice with at most ``k`` edits (``k`` is one per ``CHARS_PER_EDIT``
  characters) contains one of its k + 1 pieces unchanged (pigeonhole). One Aho-Corasick
  pass finds all pieces of all notices; a window around each piece found is left out
  when too few of the notice's trigrams stand in it for ``k`` edits; else the ``regex``
  library's bounded-error matching verifies the notice, with one more edit allowed at a
  time, and gives the span and the fewest edits.

Every text is scanned whole, in one pass per text, in a Python task over the scan's
splits: no shuffle. Defined results: null is an empty text; a text without words has
no places, no labels and score 0. Rows are scanned one by one, so repeated rows, null
ids and other columns need no care.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Openings of well-known short notices, as words, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "this work is licensed under the gnu general public license version": "gpl",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
CHARS_PER_EDIT = 12
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOUND = "array<struct<label: string, base: boolean, first_word: long, n_words: long, edits: int, score: double, text: string>>"


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 consecutive pieces of about equal length, with their offsets."""
    cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str], chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick
        import regex

        self.base = [(f" {p} ", label, len(p.split())) for p, label in base.items()]
        self.notices, self.seeds = [], ahocorasick.Automaton()
        self.patterns, self.compile, self.escape = {}, regex.compile, regex.escape
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, label) in enumerate(notices.items()):
            edits = len(notice) // chars_per_edit
            self.notices.append((notice, label, edits, Counter(notice[k : k + 3] for k in range(len(notice) - 2))))
            for at, piece in pieces(notice, edits):
                found.setdefault(piece, []).append((i, at))
        for piece, owners in found.items():
            self.seeds.add_word(piece, (len(piece), owners))
        if found:
            self.seeds.make_automaton()

    def __call__(self, text: bytes | None) -> tuple[int, list[dict]]:
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return 0, []
        joined = b" ".join(words).decode("latin-1")  # one character a byte; notices are ASCII
        out = self._exact(f" {joined} ")
        if self.notices:
            out += self._fuzzy(joined)
        return len(words), out

    def _exact(self, padded: str) -> list[dict]:
        out = []
        for phrase, label, n in self.base:
            at, word, counted = padded.find(phrase), 0, 0
            while at >= 0:
                word += padded.count(" ", counted, at)  # blanks before the phrase's first word, its own excluded
                counted = at
                out.append({"label": label, "base": True, "first_word": word, "n_words": n, "edits": 0, "score": 1.0, "text": phrase.strip()})
                at = padded.find(phrase, at + 1)
        return out

    def _fuzzy(self, joined: str) -> list[dict]:
        places = sorted({(i, end + 1 - length - at) for end, (length, owners) in self.seeds.iter(joined) for i, at in owners})
        out, last, done = [], -1, 0
        for i, start in places:
            notice, label, edits, _ = self.notices[i]
            if i != last:
                last, done = i, 0
            lo, hi = max(0, start - edits, done), min(len(joined), start + len(notice) + edits)
            if start + len(notice) // 2 < done or hi <= lo:  # found already, by another piece
                continue
            m = self._least(i, joined[lo:hi])
            if m is None:
                continue
            used, done = sum(m.fuzzy_counts), lo + m.end()
            begin = lo + m.start() + len(m.group()) - len(m.group().lstrip(" "))
            out.append({
                "label": label, "base": False, "first_word": joined.count(" ", 0, begin), "n_words": m.group().strip(" ").count(" ") + 1,
                "edits": used, "score": 1 - used / len(notice), "text": m.group().strip(" ").encode("latin-1").decode("utf-8", "replace"),
            })
        return sorted(out, key=lambda x: (x["first_word"], x["label"]))

    def _least(self, i: int, window: str):
        """The match with the fewest edits in a window, or None.

        An edit spoils three trigrams at most, so the trigrams that are missing give a
        lower bound; most windows end there. From it on, one more edit at a time is allowed.
        """
        notice, _, edits, grams = self.notices[i]
        own = Counter(window[k : k + 3] for k in range(len(window) - 2))
        missing = sum((grams - own).values())
        for k in range(-(-missing // 3), edits + 1):
            if (i, k) not in self.patterns:
                self.patterns[i, k] = self.compile(f"(?:{self.escape(notice, literal_spaces=True)}){{e<={k}}}")
            m = self.patterns[i, k].search(window)
            if m is not None:
                return m
        return None


def _scan(base: dict, notices: dict, chars_per_edit: int):
    def run(batches):
        scanner = Scanner(base, notices, chars_per_edit)
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))
        for batch in batches:
            found = [scanner(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([x for _, x in found], kind)], names=["doc_id", "n_words", "found"])

    return run


def scan_licenses(docs: DataFrame, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words and ``found``, the places with label, span in words, edits and text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_arrow(texts, _scan(dict(base), dict(notices), chars_per_edit), f"doc_id long, n_words long, found {FOUND}")


def license_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    places = scan_licenses(docs).withColumn("_base", F.filter("found", lambda x: x.base))

    def labels(places: str) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x.label))), ",")

    starts = F.transform("_base", lambda x: x.first_word)
    return places.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("_base").alias("base_labels"), labels("found").alias("labels"), F.coalesce(F.array_max(F.transform("found", lambda x: x.score)), F.lit(0.0)).alias("score"),
    )
