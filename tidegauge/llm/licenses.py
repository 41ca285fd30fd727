"""License scans: templates with optional and replaceable regions as token automata.

Markup of a template: plain words are mandatory; ``[[ ... ]]`` may be left out (regions
may be nested); ``{{n}}`` stands for any 0 to n words. A template becomes an automaton
over words (`Automaton`): its states are places in the wording, and a set of states is
advanced word by word. A text is accepted from a word on if all mandatory words follow
exactly, whatever stands in the free regions.

Words are the runs of 0-9, A-Z, a-z and characters beyond ASCII; A-Z counts as a-z. Null
and empty texts have no words and no labels; very long texts are read whole, a word at a
time; an empty table stays empty; every row is judged on its own, so repeated rows and ties
need no rule; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import ALNUM, LOWER, arrow_map, pieces, utf8, words

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wordings, as templates.
TEMPLATES = {
    "gpl-3.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free software foundation]] "
    "[[either]] version 3 [[or at your option any later version]]",
    "gpl-2.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free software foundation]] "
    "[[either]] version 2 [[or at your option any later version]]",
    "gpl-notice": "{{12}} is free software [[you can]] redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation",
    "apache-2.0": "licensed under the apache license version 2 0 [[the license]] [[you may not use this file except in compliance with the license]]",
    "mit": "released under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
    "files the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
    "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
    "subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be "
    "included in all copies or substantial portions of the software",
    "bsd-2-clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-3-clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution [[3]] neither the name of {{16}} may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
    "the above copyright notice and this permission notice appear in all copies",
    "cc-by-4.0": "licensed under [[a]] [[creative commons]] cc by 4 0",
    "cc-by-sa-4.0": "licensed under [[a]] [[creative commons]] cc by sa 4 0",
    "cc-by-nc-4.0": "licensed under [[a]] [[creative commons]] cc by nc 4 0",
}

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Automaton:
    """A template, compiled. ``step[s]`` maps a word to the next state, ``free[s]`` are the
    states that any word leads to, ``skip[s]`` those reached without a word.
    """

    def __init__(self, template: str):
        self.step: list[dict[bytes, int]] = [{}]
        self.free: list[list[int]] = [[]]
        self.skip: list[list[int]] = [[]]
        opened: list[int] = []
        state, mandatory = 0, []
        for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template):
            if token == "[[":
                opened.append(state)
            elif token == "]]":
                self.skip[opened.pop()].append(state)
            elif token.startswith("{{"):
                first = state
                for _ in range(int(token[2:-2])):
                    new = self._state()
                    self.free[state].append(new)
                    state = new
                end = self._state()
                for s in range(first, end):
                    self.skip[s].append(end)
                state = end
            else:
                word = token.lower().encode()
                new = self._state()
                self.step[state][word] = new
                state = new
                if not opened:
                    mandatory.append(word)
        if opened or not mandatory:
            raise ValueError(f"regions must be closed and one word at least be mandatory: {template!r}")
        self.final = state
        self.mandatory = frozenset(mandatory)
        self.starts = self._closed({0})
        self.first = {w for s in self.starts for w in self.step[s]}
        self.open_start = any(self.free[s] for s in self.starts)

    def _state(self) -> int:
        self.step.append({})
        self.free.append([])
        self.skip.append([])
        return len(self.step) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def accepts(self, text: list[bytes]) -> bool:
        """Whether the wording stands somewhere among the words of ``text``: one pass, a new start at every word."""
        states: set[int] = set()
        for word in text:
            if not states and not self.open_start and word not in self.first:
                continue
            states |= self.starts
            after = {self.step[s][word] for s in states if word in self.step[s]}
            for s in states:
                after.update(self.free[s])
            states = self._closed(after)
            if self.final in states:
                return True
        return False


def _places(low: bytes, phrases: list[tuple[re.Pattern, bytes, str]]) -> list[tuple[int, str]]:
    """Byte offset and label of every place of a base phrase."""
    return [(m.start(), label) for pattern, needle, label in phrases if needle in low for m in pattern.finditer(low)]


def _scanner(templates: dict[str, str], phrases: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = {label: Automaton(t) for label, t in templates.items()}
        # The rarest-looking mandatory word of each template: a text without it isn't tried.
        needle = {label: max(a.mandatory, key=lambda w: (len(w), w)) for label, a in automata.items()}
        base = []
        for phrase, label in phrases.items():
            own = [re.escape(w.encode()) for w in phrase.split()]
            inner = rb"(?<![^\x00-\x2F\x3A-\x60\x7B-\x7F])(?=" + _GAP.join(own) + rb"(?![^\x00-\x2F\x3A-\x60\x7B-\x7F]))"
            base.append((re.compile(inner), phrase.split()[0].encode(), label))
        for batch in batches:
            for piece in pieces(batch):
                data, bounds = utf8(piece.column("text"))
                data = LOWER[data]
                starts, _, in_words = words(data, bounds, ALNUM)
                raw = data.tobytes()
                rows = []
                for i in range(piece.num_rows):
                    a, b = int(bounds[i]), int(bounds[i + 1])
                    low, own = raw[a:b], starts[in_words[i] : in_words[i + 1]]
                    places = _places(low, base)
                    at = np.searchsorted(own, np.array([p for p, _ in places], np.int64) + a)
                    tried = [x for x in automata if needle[x] in low]
                    text = _WORD.findall(low) if tried else []
                    matched = [x for x in tried if automata[x].accepts(text)]
                    plain = sorted({label for _, label in places})
                    rows.append(
                        (
                            len(own),
                            len(places),
                            int(at.min()) if len(at) else None,
                            int(at.max()) if len(at) else None,
                            plain,
                            sorted(matched),
                        )
                    )
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id")] + [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)],
                    names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "template_labels"],
                )

    return scan


_TYPES = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels`` and ``template_labels``."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, template_labels array<string>"
    return arrow_map(rows, _scanner(templates, phrases), schema)


def op10_license_templates(spark, sf_dir: str) -> DataFrame:
    """Score: 1 for an accepted template, 0.5 for a base phrase alone, 0 else."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = F.array_sort(F.array_union("base_labels", "template_labels"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("template_labels") > 0, F.lit(1.0)).when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)).alias("score"),
    )
