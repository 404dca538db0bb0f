"""License notices by conditional compression.

A block of text that may be a license notice is compressed twice: plainly, and
with a license template as raw zstandard dictionary. The template that saves
most explains the block best. The winners are confirmed by an exact comparison
of wording: which words of the template are missing, changed or added.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick, texts_of

#: License notices by identifier. Several wordings of one license stand side by side.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)

#: The identifier line of every license above; GNU ones also with the ending that says that no other version is meant.
SPDX = "SPDX-License-Identifier: "
TEMPLATES += tuple(
    (name, SPDX + name + ending)
    for name in dict.fromkeys(n for n, _ in TEMPLATES if n != "Proprietary")
    for ending in (("", "-only") if "GPL" in name and "later" not in name else ("",))
)
#: What follows an identifier that goes on: another license then, or any later version.
GOES_ON = re.compile(r"\+|[-.]?[A-Za-z0-9]")

# Words that tell licenses of one family apart.
DECISIVE = frozenset({"lesser", "affero", "noncommercial", "nc", "sharealike", "sa", "noderivatives", "noderivs", "nd"})

# Words of which a block needs one to be a candidate.
KEYWORDS = re.compile(r"licen[sc]|copyright|\(c\)|©|rights reserved|public domain|permission|redistribut|warrant|spdx|creative commons|\bcc[ -]by|\bcc0", re.IGNORECASE)

#: Share of the block's own compressed size that a template must save, share of template words found in
#: order, and words added to or changed in the block for each of the template's.
LEAST_SAVED, LEAST_SAME, MOST_OTHER = 0.25, 0.85, 0.25
#: Words in a row that a text shares with a template where a notice is sought; no template is shorter.
ANCHOR = 3
#: Templates whose wording is compared, best savings first.
COMPARED = 5
LEVEL = 9

WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*", re.UNICODE)


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    start: int
    end: int
    saved: float
    same: float
    exact: bool
    missing: tuple[str, ...]
    added: tuple[str, ...]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _spaced(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


class Templates:
    """Compressors with each template as raw dictionary; one per worker."""

    def __init__(self, templates=TEMPLATES):
        self.templates = templates
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = []
        for _, text in templates:
            raw = _spaced(text)
            held = zstandard.ZstdCompressionDict(raw + b" " * max(0, 8 - len(raw)), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False))
        self.words = [words(text) for _, text in templates]
        self.spdx = [text.startswith(SPDX) for _, text in templates]
        # Where each run of ANCHOR words stands in the templates.
        self.anchors: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for i, own in enumerate(self.words):
            for k in range(len(own) - ANCHOR + 1):
                self.anchors.setdefault(tuple(own[k : k + ANCHOR]), []).append((i, k))
        self.match = lru_cache(maxsize=20_000)(self._match)

    def savings(self, block: str) -> list[float]:
        """Per template: share of the block's compressed size that the template saves."""
        raw = _spaced(block)
        alone = len(self.plain.compress(raw))
        # An identifier line saves nothing that counts in a block without its first word: all its words must be there.
        marked = b"spdx" in raw
        return [(alone - len(c.compress(raw))) / alone if marked or not spdx else 0.0 for c, spdx in zip(self.given, self.spdx)]

    def _match(self, block: str) -> tuple | None:
        """(template, saved, same, exact, missing, added) of the best confirmed template."""
        saved = self.savings(block)
        own = words(block)
        best = None
        order = sorted(range(len(saved)), key=lambda i: (-saved[i], i))
        for place, i in enumerate(order):
            if saved[i] < LEAST_SAVED or (place >= COMPARED and best is not None):
                break
            want = self.words[i]
            steps = SequenceMatcher(None, want, own, autojunk=False).get_opcodes()
            missing = tuple(w for op, a, b, _, _ in steps if op in ("delete", "replace") for w in want[a:b])
            added = tuple(w for op, _, _, a, b in steps if op in ("insert", "replace") for w in own[a:b])
            same = 1 - len(missing) / len(want)
            # A changed version, family or clause makes another license.
            if same < LEAST_SAME or len(added) > MOST_OTHER * len(want) or any(w[0].isdigit() or w in DECISIVE for w in (*missing, *added)):
                continue
            found = (i, saved[i], same, not missing and not added, missing, added)
            if best is None or (found[2], -len(added), found[1]) > (best[2], -len(best[5]), best[1]):
                best = found
        return best

    def aligned_blocks(self, text: str) -> list[tuple[int, int]]:
        """Start and end of the words that stand as in a template, over any lines, blank ones too.

        Every run of ``ANCHOR`` words shared with a template says where the
        template would begin; places nearer than the words that may be added
        or missing belong to one notice.
        """
        spots = list(WORD.finditer(text))
        own = [m[0].lower() for m in spots]
        begins: dict[int, list[tuple[int, int, int]]] = {}
        for at in range(len(own) - ANCHOR + 1):
            for i, k in self.anchors.get(tuple(own[at : at + ANCHOR]), ()):
                begins.setdefault(i, []).append((at - k, at, k))
        out: dict[tuple[int, int], None] = {}
        for i, seen in begins.items():
            want = len(self.words[i])
            seen.sort()
            cuts = [0, *[x for x in range(1, len(seen)) if seen[x][0] - seen[x - 1][0] > max(1, MOST_OTHER * want)], len(seen)]
            for a, b in zip(cuts, cuts[1:]):
                group = sorted((at, k) for _, at, k in seen[a:b])
                (first, before), (last, k) = group[0], group[-1]
                low, high = max(0, first - before), min(len(own), last + want - k)
                # Words at the edges may be missing, too: also the block of what was seen alone.
                for x, y in {(low, high), (first, last + ANCHOR)}:
                    if y - x <= (1 + MOST_OTHER) * want:
                        out[spots[x].start(), spots[y - 1].end()] = None
        return list(out)

    def scan(self, text: str) -> list[Match]:
        """Confirmed notices of all candidate blocks (lines, sentences, runs of lines, words that stand as in a template) of a text."""
        if not KEYWORDS.search(text):
            return []
        out: list[Match] = []
        for start, end in dict.fromkeys([*candidate_blocks(text), *self.aligned_blocks(text)]):
            found = self.match(text[start:end])
            if found:
                i, saved, same, exact, missing, added = found
                if self.spdx[i] and (not exact or GOES_ON.match(text, [m.end() for m in WORD.finditer(text, start, end)][-1])):
                    continue
                out.append(Match(self.templates[i][0], i, start, end, saved, same, exact, missing, added))
        # Of overlapping blocks the one whose wording differs least stands for the notice.
        kept: list[Match] = []
        for m in sorted(out, key=lambda m: (len(m.missing) + len(m.added), m.start - m.end, m.start)):
            if all(m.end <= o.start or o.end <= m.start for o in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: m.start)


def candidate_blocks(text: str) -> list[tuple[int, int]]:
    """Start and end of lines with a keyword, of their sentences, and of paragraphs of several lines with one."""
    out: dict[tuple[int, int], None] = {}
    for para in re.finditer(r"(?:[^\n]*\S[^\n]*(?:\n|\Z))+", text):
        lines = [m for m in re.finditer(r"[^\n]*\S[^\n]*", para[0])]
        hits = [m for m in lines if KEYWORDS.search(m[0])]
        if not hits:
            continue
        for m in hits:
            low = para.start() + m.start()
            if len(m[0]) <= LONGEST_BLOCK:
                out[low, low + len(m[0])] = None
            # Sentences of the line: a stop before a blank and a capital.
            cuts = [0, *[x.end() for x in re.finditer(r"[.!?](?=\s+[A-ZÀ-Þ(])", m[0])], len(m[0])]
            if len(cuts) > 2:
                for a, b in zip(cuts, cuts[1:]):
                    part = m[0][a:b]
                    if KEYWORDS.search(part) and len(part.strip()) <= LONGEST_BLOCK:
                        a += len(part) - len(part.lstrip())
                        out[low + a, low + b] = None
        if len(lines) > 1:
            # Runs of lines around a hit, as long as a notice can be.
            for k, m in enumerate(lines):
                if m in hits:
                    a = k
                    size = len(m[0])
                    b = k + 1
                    while b < len(lines) and size + len(lines[b][0]) <= LONGEST_BLOCK and b - a < MOST_LINES:
                        size += len(lines[b][0])
                        b += 1
                        out[para.start() + lines[a].start(), para.start() + lines[b - 1].end()] = None
    return list(out)


#: No template is longer: blocks beyond this many characters are looked at by sentence and line only.
LONGEST_BLOCK = 2 * max(len(t) for _, t in TEMPLATES)
#: Lines over which one notice may be broken.
MOST_LINES = 12

_held: list[Templates] = []


def find_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_notices, licenses (distinct, sorted), best (license that saves most), notices.

    A notice has license, start and end in code points, saved, same (share of
    the template's words found in order), exact, and the words missing and
    added. Null and empty texts have none; every row gets a row. Equal savings
    go to the template listed first. Whole texts are read: a block is a line,
    a sentence of a line, an identifier line (word for word; one with ``+`` or
    of a license not listed is none), up to ``MOST_LINES`` lines, or the words that stand as
    in a template, over any number of lines and blank lines.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    notice = T.StructType(
        [T.StructField("license", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("saved", T.DoubleType()),
         T.StructField("same", T.DoubleType()), T.StructField("exact", T.BooleanType()), T.StructField("missing", T.ArrayType(T.StringType())), T.StructField("added", T.ArrayType(T.StringType()))]
    )
    schema = T.StructType([rows.schema["doc_id"], T.StructField("notices", T.ArrayType(notice))])
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()), ("same", pa.float64()), ("exact", pa.bool_()), ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string()))]))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not _held:
            _held.append(Templates())
        found = [
            [{"license": m.license, "start": m.start, "end": m.end, "saved": m.saved, "same": m.same, "exact": m.exact, "missing": list(m.missing), "added": list(m.added)} for m in _held[0].scan(t)]
            for t in texts_of(batch)
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=schema.names)

    found = mapped(rows, step, schema)
    top = F.sort_array(F.transform("notices", lambda n: F.struct((-n["saved"]).alias("s"), n["license"].alias("l"))))
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["license"]))).alias("licenses"),
        F.get(top, F.lit(0))["l"].alias("best"),
        "notices",
    )
