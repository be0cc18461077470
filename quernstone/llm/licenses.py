"""License scans by conditional compression.

Texts are read whole, as words; what stands between words (line breaks, comment marks) does not count, so a notice may be wrapped over lines. Around each cue lies a candidate block, as many words to both sides as the longest
template can take; blocks that touch are one, read in windows that overlap by that many words. A block, in lower case, is compressed alone and with each template as a zstandard raw dictionary, and templates are ranked by the bytes they save.
Down that ranking, to its end if need be, templates are confirmed by wording: the template's words are aligned with the block's best place by edit distance, and the differences are listed. At most ALLOWED of the template's words may differ, and the place itself has to get smaller by the template.
What stands around a place compresses too, so the ranking is made again between the first template confirmed and those confirmed at places that overlap its own: the one that saves most bytes of its place is taken (then: with the least share of differences, then the first name).
Its words go, and what is left on both sides of it is ranked again until nothing is confirmed.

Nulls and ties: a null or empty text has no block. Each word belongs to one notice at most. Repeated rows and a null doc_id are scanned like any other. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Notices in common use, as short statements; a scan may be given others.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": "Released under CC0 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
}
CUE = re.compile(r"licen[cs]|released[\W_]+under|public[\W_]+domain|redistribution|free[\W_]+software|permission[\W_]+(?:is[\W_]+hereby|to[\W_]+use)", re.I)
#: The same for the scan's filter.
CUE_SQL = r"(?i)licen[cs]|released[\W_]+under|public[\W_]+domain|redistribution|free[\W_]+software|permission[\W_]+(is[\W_]+hereby|to[\W_]+use)"
WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")
#: A line break with the comment marks around it.
BREAK = re.compile(r"\s*[\r\n][\s*#/;%>|!\-]*")
ALLOWED, WINDOW = 0.15, 256


def aligned(template: list[str], block: list[str]) -> tuple[int, int, int, list[str]]:
    """Fewest differences between the template and any stretch of the block: (number, first word, end, differences)."""
    n = len(block)
    rows = [[0] * (n + 1)]
    for i, t in enumerate(template, 1):
        above, row = rows[-1], [i]
        for j in range(1, n + 1):
            row.append(min(above[j - 1] + (t != block[j - 1]), above[j] + 1, row[-1] + 1))
        rows.append(row)
    end = min(range(n + 1), key=lambda j: (rows[-1][j], j))
    i, j, found = len(template), end, []
    while i:
        if j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            if template[i - 1] != block[j - 1]:
                found.append(f"{template[i - 1]}->{block[j - 1]}")
            i, j = i - 1, j - 1
        elif rows[i][j] == rows[i - 1][j] + 1:
            found.append(f"-{template[i - 1]}")
            i -= 1
        else:
            found.append(f"+{block[j - 1]}")
            j -= 1
    return rows[-1][end], j, end, found[::-1]


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, allowed: float = ALLOWED):
        self.allowed = allowed
        self.words = {k: WORD.findall(templates[k].lower()) for k in sorted(templates)}
        self.counts = {k: Counter(w) for k, w in self.words.items()}
        self.reach = max((len(w) + int(allowed * len(w)) for w in self.words.values()), default=0)
        self.alone = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self.given = {k: zstandard.ZstdCompressor(level=19, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k, t in templates.items()}
        self.known: dict[str, list[str]] = {}

    def saved(self, text: str, names) -> dict[str, int]:
        """Bytes that each template saves of a text."""
        data = BREAK.sub(" ", text.lower()).encode("utf-8", "replace")
        alone = len(self.alone.compress(data))
        return {k: alone - len(self.given[k].compress(data)) for k in names}

    def rank(self, block: str) -> list[str]:
        """All templates, those that save most bytes of the block first."""
        if block not in self.known:
            if len(self.known) > 1_000:
                self.known.clear()
            saved = self.saved(block, self.words)
            self.known[block] = sorted(saved, key=lambda k: (-saved[k], k))
        return self.known[block]

    def wording(self, name: str, words: list[str], s: int, e: int):
        """(differences, first word, end, the differences) of the template's best place in words[s:e], or None if too many differ."""
        most, there = self.allowed * len(self.words[name]), Counter(words[s:e])
        # a word of the template that the stretch lacks is a difference
        if sum(max(0, n - there[w]) for w, n in self.counts[name].items()) > most:
            return None
        n, a, b, found = aligned(self.words[name], words[s:e])
        return (n, s + a, s + b, found) if n <= most and b > a else None

    def best(self, text: str, marks: list[tuple[int, int]], words: list[str]):
        """(name, saved, differences, number, words of the template, matched stretch, first word, end) of a notice, or None."""

        def notice(name, n, a, b, found):
            place = text[marks[a][0] : marks[b - 1][1]]
            saved = self.saved(place, [name])[name]
            return (name, saved, found, n, len(self.words[name]), place, a, b) if saved > 0 else None

        for name in self.rank(text[marks[0][0] : marks[-1][1]]) if words else ():
            at = self.wording(name, words, 0, len(words))
            if first := at and notice(name, *at):
                break
        else:
            return None
        (a, b), rivals = first[6:], [first]
        for name in self.words:
            far = len(self.words[name]) + int(self.allowed * len(self.words[name]))
            s, e = max(0, a - far), min(len(words), b + far)
            while name != first[0] and (at := self.wording(name, words, s, e)):
                if at[1] < b and at[2] > a:
                    rivals += filter(None, [notice(name, *at)])
                    break
                s, e = (at[2], e) if at[2] <= a else (s, at[1])
        return min(rivals, key=lambda x: (-x[1], x[3] / x[4], x[0]))

    def confirm(self, block: str):
        """One notice of a block, as best() gives it, or None."""
        marks = [m.span() for m in WORD.finditer(block)]
        return self.best(block, marks, [block[a:b].lower() for a, b in marks])

    def every(self, text: str, marks: list[tuple[int, int]], words: list[str | None]):
        """best() of the words, of what is left on both sides, and so on; a masked word is None."""
        todo, at = [], 0
        for open_, stretch in groupby(words, lambda w: w is not None):
            n = len(list(stretch))
            todo += [(at, at + n)] * open_
            at += n
        while todo:
            s, e = todo.pop()
            if got := self.best(text, marks[s:e], words[s:e]):
                a, b = s + got[6], s + got[7]
                yield (*got[:6], a, b)
                todo += [(s, a), (b, e)]

    def notices(self, text: str):
        """(first character, notice) of each notice, by place."""
        cues = [m.start() for m in CUE.finditer(text)]
        if not cues:
            return []
        marks = [m.span() for m in WORD.finditer(text)]
        ends = [b for _, b in marks]
        spans: list[list[int]] = []
        for at in cues:
            k = bisect_right(ends, at)
            a, b = max(0, k - self.reach), min(len(marks), k + self.reach)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        out, width = [], max(WINDOW, 2 * self.reach)
        for first, end in spans:
            words: list[str | None] = [text[a:b].lower() for a, b in marks[first:end]]
            s = 0
            while s < len(words):
                e = min(len(words), s + width)
                upto = e if e == len(words) else e - self.reach  # what begins after it is the next window's
                for got in list(self.every(text, marks[first + s : first + e], words[s:e])):
                    a, b = got[6:]
                    if s + a < upto:
                        words[s + a : s + b] = [None] * (b - a)
                        out.append((marks[first + s + a][0], got))
                s = upto
        return sorted(out)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, allowed: float = ALLOWED) -> DataFrame:
    """One row a notice: doc_id, start (code points before it), license, saved_bytes, n_diff, n_words, differences, matched."""
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "start", "license", "saved_bytes", "n_diff", "n_words", "differences", "matched"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        scanner = Scanner(templates, allowed)
        for b in batches:
            out = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                for at, (name, saved, found, n, words, matched, *_) in scanner.notices(text):
                    out.append((doc_id, at, name, saved, n, words, " ".join(found), matched))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(F.col("text").rlike(CUE_SQL))
    return rows.mapInArrow(run, "doc_id long, start long, license string, saved_bytes long, n_diff long, n_words long, differences string, matched string")
