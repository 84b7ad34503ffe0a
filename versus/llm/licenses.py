"""Licence scan by conditional compression.

A candidate block is a line that contains a word of licence language, with twice as many words
around it as the longest template has, whatever the line ends between them; blocks that meet are
one. The words of a part of a block are compressed by zstandard alone and with each template as a raw
dictionary. The template's words in alphabetical order, with no wording left, make a second dictionary
that measures the noise: a template is a candidate only if it saves something, and no less than that. Candidates are taken
by falling savings, and the first that is confirmed wins, or the one with the smallest share of
differences of those that save nearly as much (``NEAR`` bytes).

Exact wording differences confirm a candidate, and they are the result: words of the template that
are missing, words of the block that are added. At most ``MAX_MISSING`` of its words may be missing,
and no more words may be added than it has, unless all lines from the first to the last word found
hold licence language. What stands around it does not count against it. A confirmed notice's words
are taken out, and what remains on both sides is ranked again until nothing is confirmed, so any
number of notices are found, also of one template. ``saved`` is what the template saves of the part
it was found in, as a share of the part's own compressed size.

Null text counts as empty. Documents without a candidate have no matches; each row is looked at
on its own, whole; further columns are ignored.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from versus.llm.common import table

MAX_MISSING = 0.2
NEAR = 8  # bytes by which savings of confirmed templates count as equal
PART_WORDS = 512  # a longer block is scanned in parts that overlap by half

# Short notices of well-known licences.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "public-domain": "This work is dedicated to the public domain.",
}
_SIGNAL = re.compile(
    r"licen[cs]|copyright|\(c\)|permission|redistribut|warrant|rights\W+reserved|public\W+domain", re.I
)
_WORD = re.compile(r"\w+(?:[.'-]\w+)*")


class Words:
    """The words of a text in lower case, the line of each, the lines that hold a word of licence
    language, and the candidate blocks as ranges of words."""

    def __init__(self, text: str, reach: int):
        self.words: list[str] = []
        self.blocks: list[tuple[int, int]] = []
        signals = [(m.start(), m.end()) for m in _SIGNAL.finditer(text)]
        if not signals:
            return
        found = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
        self.words = [w for _, _, w in found]
        self.starts = [a for a, _, _ in found]
        self.ends = [b for _, b, _ in found]
        ends = [m.start() for m in re.finditer("\n", text)]
        self.lines = np.searchsorted(ends, self.starts).tolist()
        self.signal = {
            line for a, b in signals for line in range(bisect_left(ends, a), bisect_left(ends, b - 1) + 1)
        }
        for line in sorted(self.signal):
            low = max(0, bisect_left(self.lines, line) - reach)
            high = min(len(found), bisect_left(self.lines, line + 1) + reach)
            if self.blocks and low <= self.blocks[-1][1]:
                self.blocks[-1] = (self.blocks[-1][0], high)
            elif low < high:
                self.blocks.append((low, high))

    def all_signal(self, first: int, last: int) -> bool:
        """Whether all lines from the first to the last word hold licence language."""
        return all(i in self.signal for i in range(self.lines[first], self.lines[last - 1] + 1))


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import zstandard

        def compressor(**dictionary):
            return zstandard.ZstdCompressor(
                level=6, write_checksum=False, write_content_size=False, write_dict_id=False, **dictionary
            )

        self.alone = compressor()
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.given = {
            name: compressor(dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=raw))
            for name, text in sorted(templates.items())
        }
        self.words = {name: _WORD.findall(text.lower()) for name, text in templates.items()}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        def given(words: list[str]):
            data = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=raw)
            return compressor(dict_data=data)

        self.given_words = {name: given(words) for name, words in self.words.items() if words}
        self.noise = {name: given(sorted(words)) for name, words in self.words.items() if words}
        self.reach = 2 * max(map(len, self.words.values()), default=0)

    def rank(self, block: str) -> list[tuple[str, float]]:
        """Templates by the share of the block's compressed size that they save."""
        data = block.encode()
        own = len(self.alone.compress(data))
        saved = {name: 1 - len(c.compress(data)) / own for name, c in self.given.items()}
        return sorted(saved.items(), key=lambda x: (-x[1], x[0]))

    def candidates(self, words: list[str]) -> list[tuple[int, str]]:
        """(bytes saved, template), most first, of the templates that save something, and no less
        of the text than their words in alphabetical order do. They are tried on the whole range
        and on windows of four times their length, each of which any notice fits in whole."""
        out = []
        count = Counter(words)
        for name, given in self.given_words.items():
            if not self._enough(name, count):
                continue
            size, gains = max(24, 4 * len(self.words[name])), []
            for at in [None, *range(0, len(words) - size // 2, size // 2)]:
                part = words if at is None else words[at : at + size]
                if at is None or self._enough(name, Counter(part)):
                    text = " ".join(part).encode()
                    alone = len(self.alone.compress(text))
                    gain = alone - len(given.compress(text))
                    if gain >= max(1, alone - len(self.noise[name].compress(text))):
                        gains.append(gain)
            if gains:
                out.append((max(gains), name))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def _enough(self, name: str, count: Counter) -> bool:
        """Whether so many of the template's words are there that it may be confirmed."""
        held = sum(min(k, count[w]) for w, k in self.counts[name].items())
        return len(self.words[name]) - held <= MAX_MISSING * len(self.words[name])

    def differences(self, name: str, words: list[str]) -> tuple[list[str], list[str], int, int]:
        """Words of the template missing in the block, words added between those found, and the
        range of the block's words from the first to the last found."""
        wanted = self.words[name]
        match = difflib.SequenceMatcher(None, wanted, words, autojunk=False)
        equal = [c for c in match.get_opcodes() if c[0] == "equal"]
        if not equal:
            return wanted, [], 0, 0
        first, last = equal[0][3], equal[-1][4]
        missing, added = [], []
        for op, a, b, c, d in match.get_opcodes():
            if op != "equal":
                missing += wanted[a:b]
                added += words[max(c, first) : min(d, last)]
        return missing, added, first, last

    def nearest(self, name: str, words: list[str]) -> tuple[int, int]:
        """The range of words with the fewest differences to the template, the latest start of
        equal ones; a missing word counts as two added ones."""
        held = np.array(words)
        base = len(words) + 1
        # cost * base + distance of the start from the end, for each end in the block
        row = base - 1 - np.arange(base)
        step = np.arange(base) * base
        for word in self.words[name]:
            new = row + 2 * base
            new[1:] = np.where(held == word, np.minimum(new[1:], row[:-1]), new[1:])
            row = np.minimum.accumulate(new - step) + step
        end = int(row.argmin())
        return int(base - 1 - row[end] % base), end

    def best(self, text: Words, low: int, high: int) -> tuple | None:
        """The confirmed winner of the ranking of a range of words."""
        words = text.words[low:high]
        hits: list[tuple] = []
        least = 0
        for gain, name in self.candidates(words):
            if hits and gain < least:
                break
            wanted = len(self.words[name])
            for a, b in (self.nearest(name, words), (0, len(words))):
                missing, added, c, d = self.differences(name, words[a:b])
                c, d = low + a + c, low + a + d
                if len(missing) <= MAX_MISSING * wanted and c < d and (
                    len(added) <= wanted or text.all_signal(c, d)
                ):
                    wrong = len(missing) + len(added)
                    least = least if hits else gain - NEAR
                    hits.append((wrong / wanted, -wanted, name, c, d, missing, added))
                    break
        return min(hits, default=None)

    def look(self, text: str) -> tuple[int, list[tuple]]:
        """The number of blocks and the matches of a text."""
        held = Words(text, self.reach)
        found, size = [], max(PART_WORDS, 2 * self.reach)
        for low, high in held.blocks:
            hits = []
            for at in range(low, max(low + 1, high - size // 2), size // 2):
                part = (at, min(high, at + size))
                ranges, own = [part], []
                while ranges:
                    a, b = ranges.pop()
                    hit = self.best(held, a, b) if a < b else None
                    if hit:
                        own.append(hit)
                        ranges += [(a, hit[3]), (hit[4], b)]
                if own:
                    saved = dict(self.rank(text[held.starts[part[0]] : held.ends[part[1] - 1]]))
                    hits += [(*h, saved[h[2]]) for h in own]
            # where templates claim the same words, the one that differs least has them
            taken: list[tuple[int, int]] = []  # sorted; no two overlap
            for _, _, name, c, d, missing, added, share in sorted(hits):
                i = bisect_left(taken, (c, d))
                if (i == 0 or taken[i - 1][1] <= c) and (i == len(taken) or d <= taken[i][0]):
                    taken.insert(i, (c, d))
                    found.append((c, (name, held.lines[c], held.lines[d - 1], share, missing, added)))
        return len(held.blocks), [h for _, h in sorted(found, key=lambda h: (h[1][1], h[0]))]

    def scan(self, text: str) -> list[tuple]:
        """(template, first line, last line, share saved, missing, added), a row per match."""
        return self.look(text)[1]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_blocks and matches (array of template, first_line, last_line, saved, missing,
    added) of every row. No shuffle."""
    templates = templates or TEMPLATES
    fields = ("license", "first_line", "last_line", "saved", "missing", "added")
    kind = pa.list_(
        pa.struct(list(zip(fields, [pa.string(), pa.int64(), pa.int64(), pa.float64(),
                                    pa.list_(pa.string()), pa.list_(pa.string())], strict=True)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            n, found = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                number, hits = scanner.look(text)
                n.append(number)
                found.append([dict(zip(fields, h, strict=True)) for h in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(found, kind)],
                names=["doc_id", "n_blocks", "matches"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_blocks long, matches array<struct<license string, first_line long, "
        "last_line long, saved double, missing array<string>, added array<string>>>",
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: candidate blocks, matches, and the matches as text."""
    return scan_licenses(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_blocks",
        "cast(size(matches) as bigint) n_matches",
        "array_join(transform(matches, m -> concat_ws(':', m.license, m.first_line, m.last_line, "
        "size(m.missing), size(m.added))), ',') matches",
    )
