"""License scans: templates with optional and replaceable regions, compiled to token automata.

Templates use the markup of public license lists: ``<<beginOptional>>`` ... ``<<endOptional>>`` stands or is left out,
and ``<<var;match=A..B>>`` takes any A to B words. All other words are mandatory and must match exactly, after case and
punctuation are dropped on both sides. The scan is one pass over each row, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import arrow_batch, carried, per_batch, texts
from gridmart.llm.shingles import words_of

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Wording of public licenses and of the notices that name them, by label.
TEMPLATES = {
    "mit-notice": "<<beginOptional>>This <<var;match=1..3>> is<<endOptional>> <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>>"
    " <<beginOptional>>available<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    " (the <<var;match=1..3>>), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
    " subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>"
    " shall be included in all copies or substantial portions of the Software. The software is provided \"as is\", without warranty of any kind, express"
    " or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall"
    " <<var;match=1..12>> be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or"
    " in connection with the software or the use or other dealings in the software.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\"); you may not use <<var;match=1..4>> except in"
    " compliance with the License<<endOptional>>",
    "gpl-3.0-notice": "<<beginOptional>>This <<var;match=1..3>> is<<endOptional>> licensed under the GNU General Public License, version 3"
    " <<beginOptional>>or <<beginOptional>>(at your option)<<endOptional>> any later version<<endOptional>>",
    "gpl-notice": "This program is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation, either version <<var;match=1..2>> of the License, or (at your option) any later version",
    "bsd-2-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions"
    " and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list"
    " of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    " This software is provided by <<var;match=1..12>> \"as is\" and any express or implied warranties, including, but not limited to, the implied"
    " warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall <<var;match=1..12>> be liable for any direct,"
    " indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss"
    " of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort"
    " (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    "isc-text": "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies. The software is provided \"as is\" and"
    " <<var;match=1..8>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event"
    " shall <<var;match=1..8>> be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use,"
    " data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance"
    " of this software.",
    "cc-by-nc-4.0-notice": "<<beginOptional>>This <<var;match=1..3>> is<<endOptional>> licensed under <<beginOptional>>a<<endOptional>>"
    " <<beginOptional>>Creative Commons Attribution NonCommercial<<endOptional>> CC BY-NC 4.0",
    "all-rights-reserved": "<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;match=1..12>><<endOptional>> All rights reserved",
}

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;match=(\d+)\.\.(\d+))>>")
_ANY = None


@dataclass
class Automaton:
    """States numbered from 0; ``steps`` lists (word or any, next state), ``skips`` next states without a word."""

    steps: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    skips: list[list[int]] = field(default_factory=lambda: [[]])

    def _state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def _word(self, state: int, word: bytes | None) -> int:
        after = self._state()
        self.steps[state].append((word, after))
        return after

    @classmethod
    def compile(cls, template: str) -> Automaton:
        made, state, open_at, at = cls(), 0, [], 0
        for mark in [*_MARKUP.finditer(template), None]:
            for word in words_of(template[at : mark.start() if mark else len(template)].encode()):
                state = made._word(state, word)
            if mark is None:
                break
            at = mark.end()
            if mark[1] == "beginOptional":
                # A fresh state, so that the skip belongs to this region alone.
                fresh = made._state()
                made.skips[state].append(fresh)
                open_at.append(state := fresh)
            elif mark[1] == "endOptional":
                if not open_at:
                    raise ValueError("endOptional without a beginning")
                end = made._state()
                made.skips[state].append(end)
                made.skips[open_at.pop()].append(end)
                state = end
            else:
                least, most = int(mark[2]), int(mark[3])
                ends = []
                for i in range(most):
                    if i >= least:
                        ends.append(state)
                    state = made._word(state, _ANY)
                for end in ends:
                    made.skips[end].append(state)
        if open_at:
            raise ValueError("beginOptional without an end")
        made.accept = state
        return made

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for after in self.skips[todo.pop()]:
                if after not in states:
                    states.add(after)
                    todo.append(after)
        return states

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest match that begins at word ``at``; -1 if there is none."""
        states, best = self.closure({0}), -1
        while states:
            if self.accept in states:
                best = at
            if at >= len(words):
                break
            word = words[at]
            states = self.closure({after for s in states for w, after in self.steps[s] if w is _ANY or w == word})
            at += 1
        return best

    def openings(self, depth: int = 3) -> set[tuple[bytes | None, ...]]:
        """What the first ``depth`` words of a match can be (fewer, where a match is shorter)."""
        out, todo = set(), [((), frozenset(self.closure({0})))]
        while todo:
            prefix, states = todo.pop()
            if len(prefix) == depth or self.accept in states:
                out.add(prefix)
                continue
            following: dict[bytes | None, set[int]] = {}
            for s in states:
                for w, after in self.steps[s]:
                    following.setdefault(w, set()).add(after)
            anything = following.pop(_ANY, set())
            for w, after in following.items():
                todo.append(((*prefix, w), frozenset(self.closure(after | anything))))
            if anything:
                todo.append(((*prefix, _ANY), frozenset(self.closure(set(anything)))))
        return out


class Scanner:
    """Phrases and template openings in one search tree; automata run only where an opening stands."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.tree = ahocorasick.Automaton()
        found: dict[str, list[tuple]] = {}
        for phrase, label in phrases.items():
            words = words_of(phrase.encode())
            found.setdefault(self._key(words), []).append(("phrase", label, len(words)))
        for label, template in templates.items():
            automaton = Automaton.compile(template)
            keys = set()
            for opening in automaton.openings():
                fixed = opening[: opening.index(_ANY)] if _ANY in opening else opening
                if not fixed:
                    raise ValueError(f"{label}: a template must begin with a word")
                keys.add(self._key(list(fixed)))
            # Of two openings one of which begins the other, the shorter finds both.
            for key in keys:
                if not any(other != key and key.startswith(other) for other in keys):
                    found.setdefault(key, []).append(("template", label, automaton))
        for key, actions in found.items():
            self.tree.add_word(key, (key, actions))
        self.tree.make_automaton()

    @staticmethod
    def _key(words: list[bytes]) -> str:
        return " " + b" ".join(words).decode("latin-1") + " "

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words, and (first word, end, label) of phrases and of accepted templates."""
        words = words_of(text)
        joined = " " + b" ".join(words).decode("latin-1") + " "
        base, own = [], []
        passed, counted = 0, 0
        for end, (key, actions) in sorted(((e, v) for e, v in self.tree.iter(joined)), key=lambda x: x[0] - len(x[1][0])):
            start = end - len(key) + 1
            counted += joined.count(" ", passed, start)
            passed = start
            for kind, label, what in actions:
                if kind == "phrase":
                    base.append((counted, counted + what, label))
                elif (stop := what.match(words, counted)) > counted:
                    own.append((counted, stop, label))
        return len(words), base, own


def read_templates(spark: SparkSession, path: str) -> dict[str, str]:
    """Templates of a folder of markup files, one each, named by their file's name without its ending."""
    label = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    return {r.label: r.value for r in spark.read.text(path, wholetext=True).select(label.alias("label"), "value").collect()}


RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "matches", "score")


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``docs`` with what their whole texts say about licenses.

    Columns added: n_words, n_base (places of phrases), first_word and last_word (their least and greatest start, or
    null), base_labels, labels (phrases' and templates', distinct, sorted, joined by commas), matches (structs of start,
    end and label, of phrases and templates, in order) and score (share of the words inside a match; 0 without words).

    ``templates`` may come from ``read_templates``. A template's mandatory words all have to stand: a text that leaves out a
    closing disclaimer is not that license. Texts are read whole, however long. Words are runs of letters and digits, A-Z lower-cased. A null text is empty and matches nothing. Rows are scanned one by
    one, so repeated rows and null ids change nothing. Input columns named like a result are replaced. An empty table
    gives an empty one.
    """
    passed = carried(docs, *RESULTS)
    read = docs.select(*passed)
    match = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: dict[str, list] = {name: [] for name in RESULTS}
            for text in texts(batch):
                n, base, own = scanner.scan(text)
                starts = [s for s, _, _ in base]
                found = sorted({*base, *own})
                inside, reached = 0, 0
                for start, end, _ in found:
                    inside += max(0, end - max(start, reached))
                    reached = max(reached, end)
                values = (
                    n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for *_, x in base})),
                    ",".join(sorted({x for *_, x in found})), [{"start": s, "end": e, "label": x} for s, e, x in found], inside / n if n else 0.0,
                )
                for name, value in zip(RESULTS, values):
                    out[name].append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [match, pa.float64()]
            return arrow_batch(**{c: batch.column(c) for c in passed}, **{k: pa.array(out[k], t) for k, t in zip(RESULTS, kinds)})

        yield from per_batch(one)(batches)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    added = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "matches array<struct<start:long,end:long,label:string>>, score double"
    )
    return read.mapInArrow(scan, f"{fields}, {added}")
