import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa

from cohortlens.llm import pii_crf as pii

from .small import odd_documents, prose, save

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    d = lambda s: re.sub("[^0-9]", "", s)
    ok = lambda s: sum(int(c) if k % 2 == 0 else (int(c) * 2) % 10 + int(c) * 2 // 10 for k, c in enumerate(s[::-1])) % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d(m[0])) <= 19 and ok(d(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(d(m[0])) <= 15]


def planted(rng):
    pieces = ["a.b%c@x-y.co.uk", "@@a@b.c@d.e.f", "x@y", "1.2.3.4.5", "300.1.1.1", "10.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é@é.com b@c.d", "00000000000000000000.1.1.1"]
    words = prose(rng, 30).split()
    for p in rng.sample(pieces, rng.randint(1, 6)):
        words.insert(rng.randrange(len(words)), p)
    return " ".join(words)


def test_base_spans_match_the_patterns():
    rng = random.Random(6)
    texts = [planted(rng) for _ in range(300)] + ["".join(rng.choice("a1.@+- ()") for _ in range(60)) for _ in range(600)]
    for t in texts:
        assert [(pii.BASE_KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == brute(t), t


def test_messages_are_exact_on_a_chain():
    rng = np.random.default_rng(1)
    k, n = len(pii.LABELS), 4
    field = pii.Field(np.zeros((pii.FEATURES, k)), rng.normal(size=(k, k)), np.diag(rng.random(k)))
    unary = rng.normal(size=(n, k))
    chain = np.array([(i, i + 1) for i in range(n - 1)])
    p = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(sum(unary[i, c] for i, c in enumerate(path)) + sum(field.chain[a, b] for a, b in zip(path, path[1:])))
        for i, c in enumerate(path):
            p[i, c] += w
    p /= p.sum(1, keepdims=True)
    assert np.allclose(pii.beliefs(unary, chain, np.zeros((0, 2), int), field, rounds=60), p, atol=1e-6)
    # a skip edge pulls equal words together
    pulled = pii.beliefs(np.array([[0.0, 3, 0, 0, 0, 0], [0.2, 0, 0, 0, 0, 0]]), np.zeros((0, 2), int), np.array([[0, 1]]), pii.Field(field.unary, field.chain, 3 * np.eye(k)))
    assert pulled[1].argmax() == 1


def test_query_keeps_base_spans_and_adds_secrets(spark, tmp_path):
    rng = random.Random(8)
    rows = odd_documents()
    for i in range(100, 220):
        text = planted(rng)
        if i % 3 == 0:
            key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            text += f' token = "{key}" ' + prose(rng, 5)
        rows.append((i, text, "en", "a"))
    rows.append((100, rows[-1][1], "en", "a"))
    out = pii.op5_pii_crf(spark, save(spark, tmp_path, rows)).collect()
    assert len(out) == len(rows)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t or "")
    secrets = 0
    for r in out:
        matching = [t for t in texts[r.doc_id] if hashlib.sha256(",".join("%s:%d:%d" % s for s in brute(t)).encode()).hexdigest() == r.base_sha256]
        assert matching
        base = [":".join(map(str, s)) for s in brute(matching[0])]
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in pii.BASE_KINDS]
        assert [pii.KINDS.index(s.split(":")[0]) for s in spans] == sorted(pii.KINDS.index(s.split(":")[0]) for s in spans)
        secrets += r.spans.count("secret:")
    assert secrets >= 38


def test_redact_masks_and_keeps_columns(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd now", 15, "x"), (2, None, None, "y"), (3, "clean", 5, "z")], "doc_id long, text string, n_chars int, label string")
    out = pii.redact(df, None)
    assert out.dtypes == df.dtypes
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, "mail [EMAIL] now", 16), (2, None, None), (3, "clean", 5)]
    assert pii.redact(df.drop("n_chars"), None).columns == ["doc_id", "text", "label"]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "no digits here")], "doc_id long, text string")
    assert pii.learn(df) is None
    assert pii.find_spans(pa.array(["x@y.zz 12", None, ""]), None)[1] == [[(0, 0, 6)], [], []]
    assert pii.detect(df.limit(0), None).count() == 0


def test_long_runs_of_digits():
    """An address whose last part is 5,000 zeros and a 1, and a text of a million digits: quick, and no error."""
    import time

    text = "1.2.3." + "0" * 5000 + "1"
    assert pii.base_spans(text) == [(1, 0, len(text))]
    for long in ("7" * 1_000_000, "7" * 300_000 + ".1.2", "+" + "7" * 1_000_000, "1.2." + "3" * 500_000, "+1" + "(" * 500_000):
        began = time.perf_counter()
        pii.find_spans(pa.array([long]), None)
        assert time.perf_counter() - began < 5


def test_addresses_match_the_pattern_on_random_strings():
    rng = random.Random(17)
    for _ in range(4000):
        t = "".join(rng.choice("12.0é ٣") for _ in range(rng.randint(0, 24)))
        assert [m.span() for m in pii._IP.finditer(t)] == [m.span() for m in IP.finditer(t)], t


def test_words_that_teach_come_from_the_whole_document():
    rng = random.Random(5)
    words = [f"{rng.randrange(10**9):09d}" for _ in range(2000)]
    words[1500] = words[10] = words[1990] = "555-123-4567"
    g = pii.graph_of(pa.array([" ".join(words), "only 12 and 34"]))
    own = pii.taught(g, 0)
    assert 30 < len(own) < 130 and own.max() > 1500
    assert len(pii.taught(g, 1)) == 2
    repeated = [k for k, w in enumerate(words) if w == "555-123-4567"]
    chosen = set(own.tolist())
    assert len({k in chosen for k in repeated}) == 1, "a word's repetitions are chosen together"


def test_recall_of_added_spans(spark):
    """Learned where numbers stand in full, the field finds those that stand in full once and bare elsewhere, by its own spans."""
    rng = random.Random(23)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    number = lambda: (f"({digits(3)})", f"{digits(3)}-{digits(4)}")
    rows = []
    for i in range(400):
        area, rest = number()
        rows.append((i, f"{prose(rng, 12)} call +1 {area} {rest} {prose(rng, 8)} or +1 {area} {rest} {prose(rng, 5)}"))
    rows += [(1000 + i, f"{prose(rng, 20)} page {rng.randint(1, 99)} of {rng.randint(100, 999)} {prose(rng, 20)}") for i in range(400)]
    field = pii.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    texts, bare = [], []
    for _ in range(200):
        area, rest = number()
        texts.append(f"{prose(rng, 12)} call +1 {area} {rest} {prose(rng, 8)} {rest} {prose(rng, 5)}")
        bare.append((texts[-1].rindex(rest), texts[-1].rindex(rest) + len(rest)))
    pages = [f"{prose(rng, 20)} page {rng.randint(1, 99)} of {rng.randint(100, 999)}" for _ in range(200)]
    base, spans = pii.find_spans(pa.array(texts + pages), field)
    own = [set(s) - set(b) for b, s in zip(base, spans)]
    found = sum(any(a <= x and b >= y for _, a, b in s) for s, (x, y) in zip(own, bare))
    assert found / len(bare) > 0.9
    assert not any(own[200:]), "page numbers are left alone"
