"""Licence scans by sentence rules.

A text is cut into fragments at sentence ends and line ends. Words of a fragment
are normalised (lower case, runs of other characters than letters and digits are
one gap). From the start of every fragment, known licence sentences are matched
word by word, over as many fragments as they take (lines wrap, and some sentences
hold colons); the longest gives the identifier that ends where a fragment ends, or
before a mark (comma, bracket, dash and the like) that begins a further clause. A sentence may hold slots, which take one to ``SLOT_WORDS`` words each
(names of holders). An SPDX tag counts as a sentence that names its licences. The
sequence of identifiers of a text is then matched against the rules, in their
order: the first rule whose identifiers follow one another at a place gives a
licence, and matching goes on behind it. Copyright notices may stand between the
sentences of a rule. A known sentence that no rule takes is reported as
``part:identifier``.

Defined cases: a null text, or one without known sentences, has no licences;
repeated sentences are found each time; ties between rules go to the earlier
one; texts are read whole; only the named columns are read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, read_documents

#: Stands in a sentence for a name, and the words it may have.
SLOT, SLOT_WORDS = "<>", 12

# Sentences of published licences and of common licence notices.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL <> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "mit-name": "Released under the MIT License",
    "mit-name-2": "Licensed under the MIT License",
    "mit-name-3": "This project is licensed under the terms of the MIT license",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-name": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-liability": "IN NO EVENT SHALL <> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY <> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "bsd-name-3": "Licensed under the BSD 3-Clause License",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "apache-name": "Licensed under the Apache License, Version 2.0",
    "gpl2-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl2-only-2": "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation",
    "gpl3-only": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3",
    "gpl3-only-2": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
    "lgpl21-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl21-only": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 2.1 as published by the Free Software Foundation",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "agpl-see": "See the GNU Affero General Public License for more details",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program",
    "lgpl-copy": "You should have received a copy of the GNU Lesser General Public License along with this library",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-name": "This work is licensed under the GNU General Public License, version 2",
    "mpl-grant": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "epl1-grant": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "epl2-grant": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "epl2-grant-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
    "bsl-name": "Distributed under the Boost Software License, Version 1.0",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-name": "Licensed under CC BY 4.0",
    "cc-by-sa-name": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-name": "Licensed under CC BY-NC 4.0",
    "cc0-name": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "public-domain": "This work is in the public domain",
    "reserved": "All rights reserved",
}
#: A sentence that begins so is a copyright notice.
NOTICE = "copyright"

# Licences by the identifiers of their sentences, longer rules first.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("Apache-2.0", ["apache-grant", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-grant", "apache-copy"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is", "bsd-liability"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("GPL-2.0-only", ["gpl2-only", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("GPL-2.0-only", ["gpl2-only-2", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("GPL-3.0-only", ["gpl3-only", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("GPL-3.0-only", ["gpl3-only-2", "gpl-warranty", "gpl-see", "gpl-copy"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "lgpl-warranty", "lgpl-see", "lgpl-copy"]),
    ("LGPL-3.0-or-later", ["lgpl3-later", "lgpl-warranty", "lgpl-see", "lgpl-copy"]),
    ("AGPL-3.0-or-later", ["agpl3-later", "gpl-warranty", "agpl-see", "agpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-see"]),
    ("GPL-2.0-only", ["gpl2-only", "gpl-warranty", "gpl-see"]),
    ("GPL-2.0-only", ["gpl2-only-2", "gpl-warranty", "gpl-see"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "lgpl-warranty", "lgpl-see"]),
    ("LGPL-2.1-only", ["lgpl21-only", "lgpl-warranty", "lgpl-see"]),
    ("Zlib", ["zlib-as-is", "zlib-liability", "zlib-grant"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("0BSD", ["0bsd-grant", "isc-as-is"]),
    ("MPL-2.0", ["mpl-grant", "mpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("GPL-2.0-only", ["gpl2-only-2"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("GPL-3.0-only", ["gpl3-only-2"]),
    ("LGPL-2.1-or-later", ["lgpl21-later"]),
    ("LGPL-2.1-only", ["lgpl21-only"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("MPL-2.0", ["mpl-grant"]),
    ("EPL-1.0", ["epl1-grant"]),
    ("EPL-2.0", ["epl2-grant"]),
    ("EPL-2.0", ["epl2-grant-2"]),
    ("BSL-1.0", ["bsl-name"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-name-2"]),
    ("MIT", ["mit-name-3"]),
    ("BSD-3-Clause", ["bsd-name-3"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-name"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("Unlicense", ["unlicense"]),
    ("public-domain", ["public-domain"]),
    ("all-rights-reserved", ["reserved"]),
]

#: Every known sentence has one of these in lower case; a text without any is not cut.
ANCHORS = ["licen", "copyright", "permission", "redistribut", "warrant", "software", "mpl", "domain", "reserved", "liable"]

_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"[.!?;:]+(?=\s|$)|\n")
#: Between two words: a further clause begins.
_CLAUSE = re.compile(r"[,;:()\[\]{}\u2013\u2014]| -+ ")
_END = ("end",)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def fragments(text: str) -> list[tuple[int, int]]:
    """(start, end) of every stretch between breaks."""
    ends = [(m.start(), m.end()) for m in _BREAK.finditer(text)]
    starts = [0, *[e for _, e in ends]]
    return [(a, b) for a, b in zip(starts, [*[s for s, _ in ends], len(text)]) if a < b]


def _trie() -> dict:
    root: dict = {}
    for name, sentence in SENTENCES.items():
        node = root
        for part in re.split(f"({SLOT})", sentence):
            for w in [_SLOT] if part == SLOT else words(part):
                node = node.setdefault(w, {})
        node[_END] = name
    return root


_SLOT = ("slot",)
TRIE = _trie()

_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+(?:[ \t]+(?:OR|AND|WITH)[ \t]+[A-Za-z0-9.+-]+)*)\)?")
#: Identifier of an SPDX tag: this and what the tag says.
SPDX = "spdx:"


def _steps(states: list[tuple[dict, int]], w: str) -> list[tuple[dict, int]]:
    """Trie places after a word; a place in a slot (with its words so far) stays in it, or leaves it by the next known word."""
    out = []
    for node, held in states:
        if w in node:
            out.append((node[w], 0))
        if held and held < SLOT_WORDS:
            out.append((node, held + 1))
        if _SLOT in node:
            out.append((node[_SLOT], 1))
    return out


def sentences(text: str) -> list[tuple[str, int, int]]:
    """(identifier, start, end) of the known sentences of a text, in order."""
    low = text.lower()
    if not any(a in low for a in ANCHORS):
        return []
    cut = fragments(text)
    spoken = [[(m[0].lower(), m.start() + a, m.end() + a) for m in _WORD.finditer(text[a:b])] for a, b in cut]
    tags = [(SPDX + " ".join(m[1].split()), m.start(), m.end()) for m in _TAG.finditer(text)]
    out, k, t = [], 0, 0
    while k < len(cut):
        first = spoken[k]
        if t < len(tags) and tags[t][1] < cut[k][1]:  # a tag begins in this fragment
            out.append(tags[t])
            while k < len(cut) and cut[k][0] < tags[t][2]:
                k += 1
            t += 1
            continue
        if not first or (first[0][0] not in TRIE and first[0][0] != NOTICE):
            k += 1
            continue
        states, best, at = [(TRIE, 0)], None, k
        # known sentences may hold inner breaks (semicolons, "v. 2.0"): the trie alone ends the walk
        while at < len(cut) and states:
            for i, (w, _, end) in enumerate(spoken[at]):
                states = _steps(states, w)
                after = text[end : spoken[at][i + 1][1]] if i + 1 < len(spoken[at]) else None
                for node, _ in states:
                    if _END in node and (after is None or _CLAUSE.search(after)):
                        best = (node[_END], at, end)
                if not states:
                    break
            at += 1
        if best:
            out.append((best[0], first[0][1], best[2]))
            k = best[1] + 1
        else:
            if first[0][0] == NOTICE:
                out.append((NOTICE, first[0][1], first[-1][2]))
            k += 1
    return out


def licences(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(licence, start, end) by the first rule that fits at each place of the sequence."""
    core = [s for s in found if s[0] != NOTICE]
    out, k = [], 0
    while k < len(core):
        if core[k][0].startswith(SPDX):
            out.append((core[k][0].removeprefix(SPDX), *core[k][1:]))
            k += 1
            continue
        for licence, rule in RULES:
            if [s[0] for s in core[k : k + len(rule)]] == rule:
                out.append((licence, core[k][1], core[k + len(rule) - 1][2]))
                k += len(rule)
                break
        else:
            out.append((f"part:{core[k][0]}", *core[k][1:]))
            k += 1
    return out


_FOUND = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with the arrays ``sentences`` and ``licences`` of (name, start, end) in code points."""

    def make():
        def apply(batch):
            both = [[], []]
            for t in batch.column(text).to_pylist():
                known = sentences(t or "")
                both[0].append(known)
                both[1].append(licences(known))
            return [pa.array([[{"name": n, "start": a, "end": b} for n, a, b in x] for x in side], _FOUND) for side in both]

        return apply

    kind = "array<struct<name:string,start:bigint,end:bigint>>"
    return map_batches(df, make, f"sentences {kind}, licences {kind}", keep, text)


def op4_licence_rules(spark, sf_dir: str) -> DataFrame:
    """Per document: its known licence sentences and its licences with their places."""
    found = scan(read_documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join(F.transform("sentences", lambda s: s["name"]), ",").alias("sentence_ids"),
        F.array_join(F.transform("licences", lambda s: s["name"]), ",").alias("licences"),
        F.array_join(F.transform("licences", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",").alias("spans"),
    )
