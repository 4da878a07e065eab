"""License scans by conditional compression.

A text's sentences that hold a word licenses use make candidate blocks. Where a block
has enough of a template's words in order, the words matched are compressed alone and
with the template as a raw zstandard dictionary; the more the template says what they
say, the more the size falls. Matches of too small a reduction are left out, the rest
ranked by exact wording: words of the template that are there, less those missing,
changed or put in. The best match takes its range of words, then the best of those
that don't overlap it, and what lies between is scanned again until nothing is found.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .license_bodies import BODIES

# Notices that the licenses, or the bodies that keep them, ask for or are known by.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
        "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
        "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.0": [
        "This work is licensed under the GNU Library General Public License, version 2.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "EPL-1.0": [
        "Licensed under the Eclipse Public License, Version 1.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, Version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom '
        "the Software is furnished to do so, all subject to the following:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. Released under CC0 1.0 Universal."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
}
#: Words that make a sentence a candidate.
HINT = r"(?i)licen[cs]e|licensing|copyright|\(c\) ?\d{4}|spdx|gnu |creative commons|\bcc0\b|\bcc by|permission|redistribut|free software|warrant|apache|mozilla|unencumbered"
#: Sentences without a hint that may stand inside a block.
GAP = 1
#: A winner's least reduction, and the least share of the template's words that the block has in order.
REDUCTION, COVERAGE = 0.15, 0.85
#: Words of text that a match may stretch over, for each word of the template: about what REDUCTION lets through.
SPREAD = 7
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?!\s|$)[^.!?\n]*)*(?:[.!?]+|\n|$)")
_WORD = re.compile(r"[0-9A-Za-z]+(?:[.\-][0-9A-Za-z]+)*")


def blocks(text: str) -> list[tuple[int, int]]:
    """(begin, end) of candidate blocks: runs of sentences with a hint."""
    out: list[list[int]] = []
    hint, gap = re.compile(HINT), GAP + 1
    for m in _SENTENCE.finditer(text):
        if m.end() == m.start():
            continue
        if hint.search(m.group()):
            if out and gap <= GAP:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            gap = 0
        else:
            gap += 1
    return [(a, z) for a, z in out]


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Scanner:
    def __init__(self, templates: dict[str, list[str]] | None = None):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.templates = []
        known = [(name, i, t) for name, texts in (templates or TEMPLATES).items() for i, t in enumerate(texts)]
        #: Templates before this number are looked for in blocks, the full texts after them in whole texts.
        self.notices = len(known)
        if templates is None:
            known += [(name, len(TEMPLATES.get(name, [])), t) for name, t in BODIES.items()]
        self.counted = [Counter(words(t)) for _, _, t in known]
        self.shortest = min((c.total() for c in self.counted[self.notices :]), default=0)
        for name, i, t in known:
            raw = zstandard.ZstdCompressionDict(" ".join(t.split()).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, i, words(t), zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)))

    def reduction(self, part: str, template: int) -> float:
        """Share of the part's compressed size that goes with the template."""
        data = " ".join(part.split()).encode("utf-8", "replace")
        return 1 - len(self.templates[template][3].compress(data)) / len(self.plain.compress(data))

    def ranges(self, have: list[str], low: int, high: int, template: int) -> list[tuple[int, int, int]]:
        """(begin, end, words in order) of places in have[low:high] that cover enough of the template; they may overlap."""
        want, counted = self.templates[template][2], self.counted[template]
        least = COVERAGE * len(want)
        # Words put in beyond this make the reduction too small. Chunks overlap by it.
        span = SPREAD * len(want) + 20
        todo = [(i, min(i + 2 * span, high)) for i in range(low, max(low + 1, high - span), span)]
        matcher, out = difflib.SequenceMatcher(None, [], want, autojunk=False), []
        while todo:
            a, z = todo.pop()
            if sum((counted & Counter(have[a:z])).values()) < least:
                continue
            matcher.set_seq1(have[a:z])
            same = [m for m in matcher.get_matching_blocks() if m.size]
            anchor, total = max(same, key=lambda m: m.size), sum(m.size for m in same)
            if total < least:
                begin, end = anchor.a, anchor.a + anchor.size
            else:
                # Words far from the rest that the coverage doesn't need are not the notice's.
                while len(same) > 1 and total - same[0].size >= least and same[1].a - same[0].a > same[1].b - same[0].b + same[0].size:
                    total -= same.pop(0).size
                while len(same) > 1 and total - same[-1].size >= least and same[-1].a - same[-2].a > same[-1].b - same[-2].b + same[-1].size:
                    total -= same.pop().size
                begin, end = same[0].a, same[-1].a + same[-1].size
                out.append((a + begin, a + end, total))
            todo += [(a, a + begin), (a + end, z)]
        return out

    def scan(self, text: str) -> list[dict]:
        """All confirmed matches of which no two overlap, in the order of the text."""
        out = self.matches(text, 0, len(text), range(self.notices, len(self.templates))) if len(text) >= COVERAGE * 2 * self.shortest > 0 else []
        taken = sorted((x["begin"], x["end"]) for x in out)
        for a, z in blocks(text):
            # What full texts leave of the block.
            inside = [(x, y) for x, y in taken if x < z and a < y]
            for low, high in zip([a, *[y for _, y in inside]], [*[x for x, _ in inside], z], strict=True):
                if low < high:
                    out += self.matches(text, low, high, range(self.notices))
        return sorted(out, key=lambda x: x["begin"])

    def matches(self, text: str, a: int, z: int, templates: range) -> list[dict]:
        at = [(a + m.start(), a + m.end()) for m in _WORD.finditer(text[a:z])]
        have = [text[x:y].lower() for x, y in at]
        counted = Counter(have)
        likely = [i for i in templates if sum((self.counted[i] & counted).values()) >= COVERAGE * len(self.templates[i][2])]
        free = [(0, len(have))] if likely else []
        out: list[dict] = []
        while free:
            found = []
            for low, high in free:
                for i in likely:
                    want = self.templates[i][2]
                    for begin, end, total in self.ranges(have, low, high, i):
                        reduction = self.reduction(text[at[begin][0] : at[end - 1][1]], i)
                        if reduction < REDUCTION:
                            continue
                        codes = [c for c in difflib.SequenceMatcher(None, want, have[begin:end], autojunk=False).get_opcodes() if c[0] != "equal"]
                        changes = [f"-{' '.join(want[c[1] : c[2]])} +{' '.join(have[begin + c[3] : begin + c[4]])}" for c in codes]
                        # Most words confirmed less words changed, the longer template, the greater reduction.
                        key = (total - sum(max(c[2] - c[1], c[4] - c[3]) for c in codes), len(want), reduction, -i)
                        found.append((key, begin, end, i, reduction, total / len(want), changes))
            taken: list[tuple[int, int]] = []
            for _, begin, end, i, reduction, coverage, changes in sorted(found, key=lambda x: (x[0], -x[1]), reverse=True):
                if all(end <= x or y <= begin for x, y in taken):
                    taken.append((begin, end))
                    out.append({"begin": at[begin][0], "end": at[end - 1][1], "license": self.templates[i][0], "wording": self.templates[i][1],
                                "reduction": reduction, "coverage": coverage, "changes": changes})
            # What a better match cut off may hold a match still.
            rest = []
            for low, high in free:
                own = sorted(t for t in taken if low <= t[0] < high)
                if own:
                    ends = [low, *[e for _, e in own]]
                    rest += [(e, b) for e, b in zip(ends, [*[b for b, _ in own], high], strict=True) if b > e]
            free = rest
        return out


SHAPE = "begin long, end long, license string, wording int, reduction double, coverage double, changes array<string>"


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, begin, end, license, wording, reduction, coverage, changes): a row per confirmed match in each whole text.

    begin and end count characters. Texts that are null, empty or without a hint
    give no rows; the hint is looked for in Spark, so only the rest reach Python.
    Repeated rows give their rows again.
    """
    schema = T.StructType([docs.schema[key], *T._parse_datatype_string(SHAPE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string())]
        for b in batches:
            at, found = [], []
            for i, v in enumerate(b.column(1)):
                hits = scanner.scan(v.as_py())
                at += [i] * len(hits)
                found += hits
            arrays = [pa.array([x[n] for x in found], k) for n, k in zip(schema.names[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *arrays], names=schema.names)

    return docs.select(key, text).where(F.col(text).rlike(HINT)).mapInArrow(run, schema)
