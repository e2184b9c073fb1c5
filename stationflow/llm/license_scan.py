"""License scan: phrases, and license texts written as templates with optional and replaceable regions.

A template is compiled into an automaton over words. Accepting means that all mandatory words follow each other as
the template has them; optional regions may be left out, replaceable ones take any words up to their bound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch

#: ASCII bytes that belong to no word turn into spaces, A-Z into small letters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
MARKUP = re.compile(r"<<(.*?)>>", re.S)
#: Words a replaceable region with an open end takes at most.
OPEN_END = 40

# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public license wordings; <<var;0-8>> takes 0 to 8 words, <<var>> any number up to OPEN_END.
TEMPLATES = {
    "mit": """<<beginOptional>>Copyright (c) <<var>><<endOptional>> Permission is hereby granted, free of charge, to any person obtaining a copy
        of <<var;1-8>> (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.""",
    "mit-notice": "<<beginOptional>>Released<<endOptional>> under the MIT License",
    "isc": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: <<var;0-1>> Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer.""",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\")<<endOptional>>",
    "gpl-notice": """<<beginOptional>>This <<var;1-4>> is<<endOptional>> licensed under the <<beginOptional>>GNU<<endOptional>> General Public License,
        <<beginOptional>>version<<endOptional>> <<var;1-1>>""",
    "gpl": """is free software: you can redistribute it and/or modify it under the terms of the GNU <<beginOptional>>Lesser<<endOptional>> General
        Public License as published by the Free Software Foundation, either version <<var;1-1>> of the License, or (at your option) any later version.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.""",
    "cc-by": "licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY <<beginOptional>>SA<<endOptional>> <<beginOptional>>NC<<endOptional>> <<beginOptional>>ND<<endOptional>> <<var;1-2>>",
    "all-rights-reserved": "all rights reserved",
}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Automaton:
    """States are numbers; ``step`` leads on by a word, ``free`` by any word, ``jump`` without one. 0 starts, ``final`` accepts."""
    step: dict[int, tuple[bytes, int]] = field(default_factory=dict)
    free: dict[int, int] = field(default_factory=dict)
    jump: dict[int, list[int]] = field(default_factory=dict)
    final: int = 0
    mandatory: int = 0

    def new(self) -> int:
        self.final += 1
        return self.final

    def closure(self, states) -> set[int]:
        out, left = set(), list(states)
        while left:
            s = left.pop()
            if s not in out:
                out.add(s)
                left += self.jump.get(s, ())
        return out

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the longest accepted run of words from ``start``, or None."""
        states, end = self.closure([0]), None
        for at in range(start, len(words) + 1):
            if self.final in states:
                end = at
            if at == len(words):
                break
            w = words[at]
            states = self.closure([t for s in states if (t := self.free.get(s)) is not None]
                                  + [e[1] for s in states if (e := self.step.get(s)) and e[0] == w])
            if not states:
                break
        return end

    def first_words(self) -> set[bytes] | None:
        """Words a match can begin with; None if it can begin with any."""
        states = self.closure([0])
        if any(s in self.free for s in states) or self.final in states:
            return None
        return {self.step[s][0] for s in states if s in self.step}


def compile_template(template: str) -> Automaton:
    """Automaton of a template. Optional regions nest; an unclosed or unopened one is an error."""
    auto, at, depth, open_regions = Automaton(), 0, 0, []
    for i, part in enumerate(MARKUP.split(template)):
        if i % 2 == 0:
            for w in words_of(part.encode()):
                nxt = auto.new()
                auto.step[at] = (w, nxt)
                at = nxt
                auto.mandatory += not depth
        elif part == "beginOptional":
            start = auto.new()
            auto.jump.setdefault(at, []).append(start)
            open_regions.append(at)
            at, depth = start, depth + 1
        elif part == "endOptional":
            if not open_regions:
                raise ValueError("a region ends that never began")
            end = auto.new()
            auto.jump.setdefault(at, []).append(end)
            auto.jump.setdefault(open_regions.pop(), []).append(end)
            at, depth = end, depth - 1
        elif part.split(";")[0] == "var":
            low, high = map(int, part.split(";")[1].split("-")) if ";" in part else (0, OPEN_END)
            stops = []
            for k in range(high + 1):
                if k >= low:
                    stops.append(at)
                if k < high:
                    nxt = auto.new()
                    auto.free[at] = nxt
                    at = nxt
            end = auto.new()
            for s in stops:
                auto.jump.setdefault(s, []).append(end)
            at = end
        else:
            raise ValueError(f"unknown markup {part!r}")
    if open_regions:
        raise ValueError("a region never ends")
    last = auto.new()
    auto.jump.setdefault(at, []).append(last)
    return auto


@cache
def compiled(templates: tuple[tuple[str, str], ...]) -> dict[bytes, list[tuple[str, Automaton]]]:
    """Automata by the words they can begin with."""
    out: dict[bytes, list[tuple[str, Automaton]]] = {}
    for label, template in templates:
        auto = compile_template(template)
        first = auto.first_words()
        if first is None:
            raise ValueError(f"{label}: a template has to begin with a word")
        for w in first:
            out.setdefault(w, []).append((label, auto))
    return out


def scan(text: bytes | None, templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]) -> dict:
    """Words, phrase places and template spans of a whole text."""
    words = words_of(text or b"")
    spans, places, base = [], [], set()
    present = set(words)
    starts = {w: autos for w, autos in compiled(templates).items() if w in present}
    heads: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases:
        need = phrase.encode().split()
        if present.issuperset(need):
            heads.setdefault(need[0], []).append((need, label))
    # a template that lacks one of its mandatory first steps dies at once, so only real candidates cost anything
    for w in starts.keys() | heads.keys():
        at = -1
        for _ in range(words.count(w)):
            at = words.index(w, at + 1)
            for need, label in heads.get(w, ()):
                if words[at:at + len(need)] == need:
                    places.append(at)
                    base.add(label)
            for label, auto in starts.get(w, ()):
                if (end := auto.match(words, at)) is not None:
                    spans.append((at, end, label))
    return {"n_words": len(words), "places": sorted(places), "base": sorted(base), "spans": sorted(spans)}


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``places`` (starts of phrases, in words), ``base_labels`` and ``spans`` of accepted templates
    (start, end, label). Null texts count as empty; every row gives one row; other columns are left behind."""
    t, p = tuple((templates or TEMPLATES).items()), tuple((phrases or PHRASES).items())
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("t"))

    def run(rows):
        found = [scan(x, t, p) for x in rows["t"]]
        return {"doc_id": rows["doc_id"], "n_words": [f["n_words"] for f in found], "places": [f["places"] for f in found], "base_labels": [f["base"] for f in found],
                "spans": [[{"first": a, "last": b, "label": l} for a, b, l in f["spans"]] for f in found]}

    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, n_words bigint, places array<bigint>, base_labels array<string>, spans array<struct<first: bigint, last: bigint, label: string>>"
    return per_batch(slim, run, schema)


def report(spans: DataFrame) -> DataFrame:
    """Counts and labels per row. The score is 1 for an accepted template, 0.5 for a phrase alone, else 0."""
    joined = F.array_join(F.array_sort(F.array_union("base_labels", F.array_distinct(F.col("spans.label")))), ",")
    return spans.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), joined.alias("labels"),
        F.when(F.size("spans") > 0, 1.0).when(F.size("places") > 0, 0.5).otherwise(0.0).alias("score"))
