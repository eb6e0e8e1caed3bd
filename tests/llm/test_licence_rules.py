import random
import re

from cohortlens.llm import licence_rules as lic

from .small import odd_documents, save


#: What stands in the slots of sentences.
HOLDER = "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"


def spoken(name):
    return lic.SENTENCES[name].replace(lic.SLOT, HOLDER)


def text_of(*names):
    return "\n".join(f"{spoken(n)}." for n in names)


def test_every_known_sentence_is_found_also_wrapped():
    for name in lic.SENTENCES:
        sentence = spoken(name)
        assert any(a in sentence.lower() for a in lic.ANCHORS), name
        words = sentence.split()
        wrapped = "\n".join(" ".join(words[i : i + 6]) for i in range(0, len(words), 6))
        for shown in (sentence, wrapped, sentence.upper(), sentence.replace('"', "'")):
            found = lic.sentences(f"Some text before.\n{shown}.\nAnd after.")
            assert [f[0] for f in found] == [name]


def test_rules_match_sequences_in_order():
    full = text_of("mit-grant", "mit-notice", "mit-as-is", "mit-liability")
    assert [x[0] for x in lic.licences(lic.sentences("Copyright (c) 2020 Someone\n\n" + full))] == ["MIT"]
    short = text_of("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")
    assert [x[0] for x in lic.licences(lic.sentences(short))] == ["BSD-2-Clause"]
    long = text_of("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")
    assert [x[0] for x in lic.licences(lic.sentences(long))] == ["BSD-3-Clause"]
    lone = lic.licences(lic.sentences(text_of("bsd-source")))
    assert [x[0] for x in lone] == ["part:bsd-source"]
    two = lic.licences(lic.sentences(text_of("apache-name", "mit-name", "apache-name")))
    assert [x[0] for x in two] == ["Apache-2.0", "MIT", "Apache-2.0"]


def test_sentence_inside_another_is_not_taken():
    assert lic.sentences("We said it was released under the MIT License.") == []
    assert lic.sentences("Released under the MIT License of old.") == []


def test_query(spark, tmp_path):
    rows = odd_documents() + [(60, "Ab cd.\nReleased under the MIT License.\nXy z.", "en", "a"), (60, "All rights reserved.", "en", "a")]
    out = lic.op4_licence_rules(spark, save(spark, tmp_path, rows)).collect()
    assert len(out) == len(rows)
    marked = sorted((r.licences, r.spans) for r in out if r.doc_id == 60)
    text = rows[-2][1]
    at = re.search("Released.*License", text)
    assert marked == [("MIT", f"MIT:{at.start()}:{at.end()}"), ("all-rights-reserved", "all-rights-reserved:0:19")]
    assert all(r.n_sentences == 0 and r.licences == "" for r in out if r.doc_id != 60)


def brute(text):
    """Each sentence as a pattern, tried at the first word of every fragment; the longest that ends a fragment or stands before a clause."""
    gap, out, done = r"[\W_]+", [], -1
    tags = [(m.start(), m.end(), "spdx:" + " ".join(m[1].split())) for m in lic._TAG.finditer(text)]
    ends = {b for _, b in lic.fragments(text)}
    for a, b in lic.fragments(text):
        first = re.search(r"[^\W_]+", text[a:b])
        tag = next((t for t in tags if a <= t[0] < b), None)
        if tag and a >= done:
            out.append((tag[2], tag[0], tag[1]))
            done = tag[1]
            continue
        if not first or a < done:
            continue
        at, best = a + first.start(), None
        for name, sentence in lic.SENTENCES.items():
            parts = [gap.join(map(re.escape, lic.words(p))) for p in sentence.split(lic.SLOT)]
            slot = rf"{gap}[^\W_]+(?:{gap}[^\W_]+){{0,{lic.SLOT_WORDS - 1}}}?{gap}"
            m = re.match(rf"{slot.join(parts)}(?![^\W_])", text[at:].lower())
            if m:
                end = at + m.end()
                after = re.match(r"[\W_]*", text[end:])[0]
                last = any(end <= e <= end + len(after) for e in ends)
                if (last or lic._CLAUSE.search(after)) and (best is None or end > best[2]):
                    best = (name, at, end)
        if best:
            out.append(best)
            done = max(e for _, e in lic.fragments(text) if _ < best[2])
        elif first[0].lower() == lic.NOTICE:
            words = [m for m in re.finditer(r"[^\W_]+", text[a:b])]
            out.append((lic.NOTICE, at, a + words[-1].end()))
    return out


def test_against_patterns():
    rng = random.Random(8)
    names = list(lic.SENTENCES)
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = lic.SENTENCES[rng.choice(names)].replace(lic.SLOT, rng.choice(["ACME, Inc.", "the authors", "Jo and others OR THEIR HEIRS"]).replace(".", ""))
            kind = rng.random()
            if kind < 0.15:
                line += rng.choice([" and more", ", with a clause after it", " (see LICENSE)", " of old", " - or later"])
            elif kind < 0.25:
                line = " ".join(line.split()[: rng.randint(1, 12)])
            elif kind < 0.35:
                words = line.split()
                words.insert(rng.randrange(len(words)), "other")
                line = " ".join(words)
            elif kind < 0.45:
                line = rng.choice(["Copyright (c) 2020 Jo", "SPDX-License-Identifier: MIT OR Apache-2.0", "Plain words here", "see: licence"])
            lines.append(line)
        text = rng.choice(["\n", ". ", ".\n\n"]).join(lines)
        assert lic.sentences(text) == brute(text), text


#: Notices as projects write them, put together from published licence texts and not from the known sentences.
NOTICES = [
    ("MIT", """MIT License\n\nCopyright (c) 2019 Example Org\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL\nEXAMPLE ORG BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE\nSOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n3. Neither the name of Example Labs Inc nor the names of its contributors may be used to endorse or promote products derived\n   from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY EXAMPLE LABS "AS IS" AND ANY EXPRESS OR IMPLIED\nWARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE\nCOPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL\nDAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS)."""),
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\nLesser General Public License for more details."),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0, which is available at a well-known place"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)"),
    ("MIT OR Apache-2.0", "// SPDX-License-Identifier: MIT OR Apache-2.0\nfn main() {}"),
    ("GPL-2.0-only WITH Linux-syscall-note", "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) */"),
    ("MIT", "Licensed under the MIT License, see LICENSE for details"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (see NOTICE)"),
]


def test_recall_on_notices():
    found = [(wanted, [x[0] for x in lic.licences(lic.sentences(text))]) for wanted, text in NOTICES]
    assert sum(wanted in got for wanted, got in found) == len(NOTICES), [f for f in found if f[0] not in f[1]]
    assert all(got == [wanted] for wanted, got in found), found


def test_empty_table(spark, tmp_path):
    assert lic.op4_licence_rules(spark, save(spark, tmp_path, [])).count() == 0
