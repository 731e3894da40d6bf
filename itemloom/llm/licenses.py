"""License notices by conditional compression.

Every notice holds a cue, and so does its template. Around a cue in a text, the windows of a template's length in which one of the
template's cues falls on it are compressed with the template as a raw dictionary. The sizes this saves rank all templates and windows;
from the largest on they are compared word by word, and the first one whose differences are allowed is found there.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import islice

from pyspark.sql import DataFrame

from .common import batchwise

# fixed values: usual notices of common licenses, by SPDX identifier
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights"),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: one of these is in every notice; between the words of a cue may stand what stands between words elsewhere, line breaks too
CUE = re.compile(
    r"licen[sc]|spdx|creative commons|<cc0>|<cc by>|permission (?:is hereby|to use)|redistribution and use|public domain|free software"
    r"|waived all copyright".replace(" ", "[^a-z0-9]+").replace("<", "(?<![a-z0-9])").replace(">", "(?![a-z0-9])")
)
TOKEN = re.compile(r"[a-z0-9]+")
#: a word that must never differ, besides numbers
TELLING = frozenset("no non not nc nd sa by lesser affero sharealike noncommercial noderivatives clause".split())
MATCH = "array<struct<license:string,start:bigint,end:bigint,reduction:double,missing:array<string>,extra:array<string>>>"


@dataclass(frozen=True)
class Template:
    license: str
    words: tuple[str, ...]
    raw: bytes
    #: words that may be missing, and words that may be extra
    most: int
    #: places of the words in which a cue begins
    cues: tuple[int, ...]


def templates(table: dict[str, Sequence[str]] = TEMPLATES, slack: float = 0.1) -> list[Template]:
    out = []
    for name, texts in table.items():
        for text in texts:
            tokens = list(TOKEN.finditer(text.lower()))
            words = tuple(t.group() for t in tokens)
            cues = {sum(t.end() <= cue.start() for t in tokens) for cue in CUE.finditer(text.lower())}
            out.append(Template(name, words, " ".join(words).encode(), int(slack * len(words)), tuple(sorted(cues))))
    return out


class Scanner:
    """Finds notices in texts; ``ratio`` is the least reduction of a winner, ``slack`` the share of words that may differ."""

    def __init__(self, table: dict[str, Sequence[str]] = TEMPLATES, ratio: float = 0.3, slack: float = 0.1):
        import zstandard

        self.templates = templates(table, slack)
        raw = zstandard.DICT_TYPE_RAWCONTENT
        plain = {"level": 3, "write_checksum": False, "write_content_size": False}
        self.plain = zstandard.ZstdCompressor(**plain)
        # a template twice over, as its end can then be told from its start; dictionaries of a few bytes are not used by the library
        dictionaries = [zstandard.ZstdCompressionDict(t.raw + b" " + t.raw, dict_type=raw) for t in self.templates]
        self.given = [zstandard.ZstdCompressor(dict_data=d, **plain) for d in dictionaries]
        self.ratio = ratio
        #: words before and after the start of a cue that a notice around it can have
        self.reach = max((len(t.words) + t.most for t in self.templates), default=0)

    def differences(self, words: Sequence[str], template: Template) -> tuple[int, int, list[str], list[str]] | None:
        """First and last matched word, template words that are missing and words that are extra between them."""
        blocks = [b for b in SequenceMatcher(None, words, template.words, autojunk=False).get_matching_blocks() if b.size]
        if not blocks:
            return None
        first, last = blocks[0].a, blocks[-1].a + blocks[-1].size
        ours, theirs = {i for b in blocks for i in range(b.a, b.a + b.size)}, {i for b in blocks for i in range(b.b, b.b + b.size)}
        extra = [words[i] for i in range(first, last) if i not in ours]
        missing = [w for i, w in enumerate(template.words) if i not in theirs]
        return first, last, missing, extra

    def saved(self, at: int, words: Sequence[str]) -> tuple[int, float]:
        """Bytes that a template saves as a dictionary, and their share."""
        part = " ".join(words).encode()
        plain = len(self.plain.compress(part))
        saved = plain - len(self.given[at].compress(part))
        return saved, saved / plain

    def ranked(self, words: Sequence[str], cue: int) -> list[tuple[int, int, int]]:
        """Windows that a template saves at least ``ratio`` of, by what it saves, most first: ``-bytes``, template and first word."""
        out = []
        for at, template in enumerate(self.templates):
            for place in template.cues:
                start = max(0, cue - place)
                saved, share = self.saved(at, words[start : start + len(template.words)])
                if share >= self.ratio:
                    out.append((-saved, at, start))
        return sorted(out)

    def best(self, words: Sequence[str], cue: int) -> tuple | None:
        """The confirmed winner around a cue (the place of its word): template, reduction, first and last word, and what differs."""
        for _, at, start in self.ranked(words, cue):
            template = self.templates[at]
            low = max(0, start - template.most)
            differs = self.differences(words[low : start + len(template.words) + template.most], template)
            if differs and self.confirmed(template, *differs[2:]):
                first, last = low + differs[0], low + differs[1]
                return template, self.saved(at, words[first:last])[1], first, last, *differs[2:]
        return None

    def confirmed(self, template: Template, missing: list[str], extra: list[str]) -> bool:
        most = template.most
        return len(missing) <= most and len(extra) <= most and not any(w in TELLING or w.isdigit() for w in (*missing, *extra))

    def block(self, folded: str, cue: int, floor: int) -> tuple[list[tuple[str, int, int]], int]:
        """Words with their places, from a template's length before the cue, but not before ``floor``, to one after it; and which is the cue."""
        while cue > floor and TOKEN.match(folded[cue - 1]):
            cue -= 1
        before: list[re.Match] = []
        size = 16 * self.reach
        while len(before) < self.reach:
            start = max(floor, cue - size)
            before = list(TOKEN.finditer(folded, start, cue))
            if start == floor:
                break
            before = before[1:]  # the first one may be the end of a longer word
            size *= 2
        after = islice(TOKEN.finditer(folded, cue), self.reach)
        before = before[-self.reach :]
        return [(m.group(), m.start(), m.end()) for m in (*before, *after)], len(before)

    def scan(self, text: str) -> tuple[int, list[dict]]:
        """Candidate blocks looked at, and the confirmed notices with their places (characters, end exclusive)."""
        folded = text.lower()
        if len(folded) != len(text):  # some letters grow when lowered; places must stay
            folded = "".join([c if len(c.lower()) != 1 else c.lower() for c in text])
        blocks, out, upto = 0, [], 0
        for cue in CUE.finditer(folded):
            if cue.start() < upto:
                continue
            blocks += 1
            tokens, place = self.block(folded, cue.start(), upto)
            found = self.best([t[0] for t in tokens], place)
            if found is None:
                continue
            template, reduction, first, last, missing, extra = found
            upto = tokens[last - 1][2]
            own = {"license": template.license, "start": tokens[first][1], "end": upto, "reduction": reduction}
            out.append(own | {"missing": missing, "extra": extra})
        return blocks, out


def scanned(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, **how) -> DataFrame:
    """``n_blocks`` (candidates), ``n_licenses``, ``licenses`` (sorted identifiers) and ``notices`` of every whole text.

    A notice has the license, its place in code points, the share of bytes that its template saves, and the words that are missing or
    extra. A null or empty text has no blocks. Repeated rows get the same findings, an empty table gives no rows, and columns named like
    the new ones are replaced.
    """

    def make():
        scanner = Scanner(**how)

        def run(texts):
            found = [scanner.scan(t or "") for t in texts]
            names = [sorted({n["license"] for n in notices}) for _, notices in found]
            return [[b for b, _ in found], [len(n) for n in names], names, [n for _, n in found]]

        return run

    return batchwise(docs, [text], f"n_blocks bigint, n_licenses bigint, licenses array<string>, notices {MATCH}", make, keep)
