"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import spelling
from .small import odd_documents, save

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def got(spark, folder):
    rows = spelling.op13_spelling_variants(spark, folder).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def misspelt(rng: random.Random, n_docs: int):
    """Documents of words from a small alphabet, with one-edit changes, runs of equal letters and letters beyond ASCII."""
    bases = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 10))) for _ in range(12)] + ["aaaaaaaa", "aaaabaaaa", "ÀÉÿ×÷ßabc", "Überraschung"]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(60):
            w = rng.choice(bases[: rng.randint(1, len(bases))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abz") + w[at:], w[:at] + rng.choice("abz") + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1"]).join(words), "en", "a"))
    return rows


def test_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = misspelt(rng, 60) + [(None, "wordwithoutid wordwithoutid wordwithoutit wordwithoutit", "en", "a"), (3, rng.choice(misspelt(rng, 1))[1], "en", "b")]
    rows += [(i, "chainword " * 10, "en", "a") for i in range(100, 140)] + [(i, "chainwerd " * 8, "en", "a") for i in range(140, 143)] + [(143, "chbinwerd chbinwerd", "en", "a")]
    expected = brute(rows)
    found = got(spark, save(spark, tmp_path, rows))
    assert found == expected
    assert sum(v[0] is not None for v in found.values()) > 20
    assert any(v[1] not in (w, v[0]) for w, v in found.items()), "no chain of two forms in the fixture"


def test_odd_documents(spark, tmp_path):
    rows = [(i if i < 1000 else None, *r) for i, *r in odd_documents()] + [(77, "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5000 + " " + "x" * 5001, "en", "a")]
    assert got(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_empty_tables(spark, tmp_path):
    assert got(spark, save(spark, tmp_path, [])) == {}
    assert got(spark, save(spark, tmp_path / "none", [(1, None, "en", "a"), (2, "short words only", "en", "a")])) == {}


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_scan_finds_each_pair_once(blocks):
    rng = random.Random(blocks)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(300)})
    seen = Counter()
    for m in (7, 8, 9):
        for block, (before, after) in enumerate(spelling.blocks_of(m, blocks)):
            turned = sorted((w[:before] + (w[-after:] if after else "") + w[before : len(w) - after], w) for w in words if len(w) in (m, m + 1))
            if not turned:
                continue
            length = np.array([len(w) for _, w in turned])
            letters = np.frombuffer("".join(t for t, _ in turned).encode("latin-1"), np.uint8)
            for _, _, left, right in spelling.near_in_list(letters, length, m, block, blocks):
                seen.update(zip(spelling._texts(left), spelling._texts(right)))
    expected = {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}
    assert {tuple(sorted(p, key=lambda w: (len(w), w))) for p in seen} == expected
    assert set(seen.values()) == {1} and len(seen) == len(expected)


def test_long_lists_are_scanned_in_pieces(spark, tmp_path, monkeypatch):
    rows = misspelt(random.Random(8), 30)
    monkeypatch.setattr(spelling, "STATES", 5)
    words = sorted(brute(rows))
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long").coalesce(1)
    pairs = {(r.word, r.near) for r in spelling.near_words(frame).collect()}
    assert pairs == {(a, b) for a in words for b in words if one_edit(a, b)}
