"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

The patterns give the base spans (email, ip, card, phone). The field then labels
the words that could carry such data (those with a digit, ``@`` or ``+``); every
other word is outside and cuts the graph. Neighbouring words share a chain
potential; a word and the next one in its document with the same or a similar
string (same characters, or same last seven digits) share a skip potential, so a
number that is plain in one place helps where it is bare. Messages pass in rounds
over all edges of a batch at once (the graph has loops); a word takes the label
of its largest belief. Words of a label that no base span touches become added
spans; neighbours with one label form one span.

Weights are learned by pseudo-likelihood on at most ``SAMPLE`` documents (the
first by a hash of id and text among those with a digit or ``@``; equal rows count
once), labelled by the base spans and by quoted keys behind an equals sign (kind
``secret``). Of a document with more than ``SAMPLE_WORDS`` labelled words about so
many teach: words are chosen by a hash over the whole document, a word with all its
repetitions (runs of ``SAMPLE_WORDS`` of them) together, so that distant skip pairs
stay whole. Features that the patterns look at are hidden at random in copies of
the sample, so that neighbours and repetitions get weight.

Defined cases: a null text has no spans; spans are in code points, end
exclusive, ordered by kind as in ``KINDS`` and start; base spans always stay and
added ones never touch them; with no sample nothing is added; repeated rows are
labelled alike; texts are read whole; only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, read_documents, row_key, slices
from .words import read_texts

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
LABELS = ["outside", *KINDS]
#: Documents that the weights are learned from, at most, and words of each, about.
SAMPLE, SAMPLE_WORDS = 3_000, 64
ROUNDS, DAMPING = 10, 0.5
#: Belief from which a word becomes part of an added span.
SURE = 0.9

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match begins where a run of digits does and takes runs whole: no part can give back a digit to the next.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost non-overlapping matches, found from each @ sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


# ---------------------------------------------------------------- words and features

_EDGE = "\"'.,;:()<>[]{}!?|*#$%&"
_IPV4 = re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")
_LOCAL7 = re.compile(r"[0-9]{3}-[0-9]{4}")
_AREA = re.compile(r"\([0-9]{3}\)")
_KEY = re.compile(r"token|secret|passw|passwd|pwd|apikey|api_key|bearer|credential", re.I)
_CALL = re.compile(r"phone|tel|call|fax|mobile", re.I)
#: Features that the base patterns decide by; hidden at random while learning.
_PLAIN = [1, 2, 3, 11, 15, 20]
FEATURES = 28


def features(word: str, before: str, before2: str, near_before: bool, near_after: bool) -> int:
    """Feature bits of a word, given the two words before it and whether its neighbours are labelled too."""
    bare = word.strip(_EDGE)
    n = len(_digits(word))
    letters = any(c.isalpha() for c in bare)
    quoted = len(word) > 2 and word[0] in "\"'"
    on = [
        True,
        "@" in word and "." in word.partition("@")[2],
        _IPV4.fullmatch(bare) is not None,
        word[0] == "+",
        "(" in word or ")" in word,
        "-" in bare,
        1 <= n <= 3,
        4 <= n <= 6,
        7 <= n <= 8,
        9 <= n <= 12,
        13 <= n <= 15,
        16 <= n <= 19,
        n >= 20,
        not letters,
        letters,
        len(bare) >= 24 and all(c in "0123456789abcdefABCDEF" for c in bare) and letters,
        len(bare) >= 20 and letters and n > 2 and "@" not in bare,
        quoted,
        before[-1:] in ("=", ":") or "=" in word,
        bool(_KEY.search(before) or _KEY.search(before2)),
        13 <= n <= 19 and luhn(_digits(word)),
        "." in bare,
        near_before,
        near_after,
        bool(_CALL.search(before)),
        len(bare) >= 12,
        _AREA.search(word) is not None,
        _LOCAL7.search(word) is not None,
    ]
    return sum(1 << k for k, x in enumerate(on) if x)


def skip_key(word: str) -> str | None:
    """Words with one key share a skip potential."""
    bare = word.strip(_EDGE).lower()
    digits = _digits(bare)
    if len(digits) >= 7 and not any(c.isalpha() for c in bare):
        return digits[-7:]
    return bare if len(bare) >= 4 else None


@dataclass
class Graph:
    """Words that get a label, in several texts."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    x: np.ndarray  # words x FEATURES
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs with one key
    base: list[list[tuple[int, int, int]]]  # of each text
    label: np.ndarray  # by the base spans and the rule for secrets
    unit: np.ndarray  # hash of what a word is chosen with, out of 2**32


_ACTIVE = np.isin(np.arange(256), np.frombuffer(b"0123456789@+", np.uint8))


def graph_of(column: pa.Array) -> Graph:
    t = read_texts(column)
    n = len(t.count)
    hits = np.zeros(len(t.raw) + 1, np.int64)
    np.cumsum(_ACTIVE[t.raw], out=hits[1:])
    active = np.flatnonzero(hits[t.end] > hits[t.start])
    text = np.searchsorted(t.first, active, side="right") - 1
    base = [[] for _ in range(n)]
    for i in np.unique(text).tolist():
        base[i] = base_spans(t.raw[t.at[i] : t.at[i + 1]].tobytes().decode())
    chars = np.zeros(len(t.raw) + 1, np.int64)
    np.cumsum((t.raw & 0xC0) != 0x80, out=chars[1:])
    start, end = chars[t.start[active]] - chars[t.at[text]], chars[t.end[active]] - chars[t.at[text]]

    def word(k: int, of: int) -> str:
        inside = t.first[of] <= k < t.first[of + 1]
        return t.raw[t.start[k] : t.end[k]].tobytes().decode() if inside else ""

    bits, label, skip, last = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64), [], {}
    unit, times = np.zeros(len(active), np.int64), {}
    joined = (np.diff(active) == 1) & (np.diff(text) == 0)
    spans_at = {i: sorted((a, b, k) for k, a, b in base[i]) for i in set(text.tolist())}
    for k, (w, i) in enumerate(zip(active.tolist(), text.tolist())):
        own = word(w, i)
        before, before2 = word(w - 1, i), word(w - 2, i)
        bits[k] = features(own, before, before2, k > 0 and bool(joined[k - 1]), k < len(joined) and bool(joined[k]))
        for a, b, kind in spans_at[i]:
            if a >= end[k]:
                break
            if b > start[k]:
                label[k] = kind + 1
        if not label[k] and bits[k] >> 16 & 1 and bits[k] >> 18 & 1 and bits[k] >> 19 & 1:
            label[k] = LABELS.index("secret")
        key = skip_key(own)
        name = (i, own if key is None else key)
        times[name] = times.get(name, -1) + 1
        unit[k] = zlib.crc32(f"{times[name] // SAMPLE_WORDS}:{name[1]}".encode())
        if key is not None:
            if (i, key) in last:
                skip.append((last[i, key], k))
            last[i, key] = k
    x = ((bits[:, None] >> np.arange(FEATURES)) & 1).astype(float)
    near = np.flatnonzero(joined)
    chain = np.stack([near, near + 1], axis=1)
    return Graph(text, start, end, x, chain, np.array(skip, np.int64).reshape(-1, 2), base, label, unit)


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # labels x labels, agreement on the diagonal


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(x, label, chain, skip, steps: int = 400, ridge: float = 0.5) -> Field | None:
    """Weights of largest pseudo-likelihood."""
    k = len(LABELS)
    if not len(label):
        return None
    rng = np.random.default_rng(11)
    copies, n = 4, len(label)
    xs = np.concatenate([x] * copies)
    hide = rng.random((len(xs), len(_PLAIN))) < 0.4
    hide[:n] = False
    xs[:, _PLAIN] *= ~hide
    y = np.eye(k)[np.tile(label, copies)]
    chain = np.concatenate([chain + c * n for c in range(copies)])
    skip = np.concatenate([skip + c * n for c in range(copies)])
    w, a, b = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, a, b)]
    for step in range(1, steps + 1):
        z = xs @ w
        np.add.at(z, chain[:, 1], y[chain[:, 0]] @ a)
        np.add.at(z, chain[:, 0], y[chain[:, 1]] @ a.T)
        np.add.at(z, skip[:, 1], y[skip[:, 0]] * b)
        np.add.at(z, skip[:, 0], y[skip[:, 1]] * b)
        r = y - _softmax(z)
        grads = (
            xs.T @ r - ridge * w,
            y[chain[:, 0]].T @ r[chain[:, 1]] + r[chain[:, 0]].T @ y[chain[:, 1]] - ridge * a,
            (y[skip[:, 0]] * r[skip[:, 1]] + y[skip[:, 1]] * r[skip[:, 0]]).sum(0) - ridge * b,
        )
        for p, g, (m, v) in zip((w, a, b), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(w, a, np.diag(np.maximum(b, 0)))


def beliefs(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every word after loopy message passing."""
    n, k = unary.shape
    src = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    dst = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    m = len(src)
    if not m:
        return _softmax(unary)
    c, s = len(chain), len(skip)
    back = np.concatenate([np.arange(c, 2 * c), np.arange(c), 2 * c + np.arange(s, 2 * s), 2 * c + np.arange(s)])
    pair = np.concatenate([np.repeat(p[None], e, axis=0) for p, e in ((field.chain, c), (field.chain.T, c), (field.skip, 2 * s))])
    told = np.zeros((m, k))
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, dst, told)
        out = (total[src] - told[back])[:, :, None] + pair
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        told = DAMPING * told + (1 - DAMPING) * new
    total = unary.copy()
    np.add.at(total, dst, told)
    return _softmax(total)


def added_spans(g: Graph, field: Field | None, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans of the field that no base span touches, by text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in g.base]
    if field is None or not len(g.text):
        return out
    p = beliefs(g.x @ field.unary, g.chain, g.skip, field)
    label = np.where(p.max(1) >= SURE, p.argmax(1), 0)
    follows = np.zeros(len(label), bool)
    follows[g.chain[:, 1]] = True
    runs: list[list[int]] = []
    for k in np.flatnonzero(label).tolist():
        i, a, b, kind = int(g.text[k]), int(g.start[k]), int(g.end[k]), int(label[k]) - 1
        word = texts[i][a:b]
        a, b = a + len(word) - len(word.lstrip(_EDGE)), b - len(word) + len(word.rstrip(_EDGE))
        if a >= b or any(x < b and y > a for _, x, y in g.base[i]):
            continue
        if runs and follows[k] and runs[-1][0] == i and runs[-1][3] == kind and runs[-1][4] == k - 1:
            runs[-1][2], runs[-1][4] = b, k
        else:
            runs.append([i, a, b, kind, k])
    for i, a, b, kind, _ in runs:
        out[i].append((kind, a, b))
    return out


def taught(g: Graph, text: int) -> np.ndarray:
    """The words of a text that teach: all, or about ``SAMPLE_WORDS`` by the hash of what they are chosen with."""
    own = np.flatnonzero(g.text == text)
    return own[g.unit[own] * len(own) < SAMPLE_WORDS << 32]


def learn(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Field | None:
    """Weights from at most ``sample`` documents; feature bits and labels of their words come to the driver."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    key, key2 = row_key("doc_id", "text")
    named = named.select("doc_id", "text", key.alias("key"), key2.alias("key2"))
    chosen = named.select("key", "key2").distinct().orderBy("key", "key2").limit(sample)
    # two numbers for each of at most ``sample`` rows; of equal rows one stays, whatever their number
    rows = named.join(F.broadcast(chosen), ["key", "key2"]).dropDuplicates(["key", "key2"])

    def extract(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                g = graph_of(part.column("text"))
                keys = part.column("key").to_pylist()
                for i in np.unique(g.text).tolist():
                    own = taught(g, i)
                    place = np.full(len(g.text), -1)
                    place[own] = np.arange(len(own))
                    inside = lambda e: place[e[(place[e] >= 0).all(1)]].ravel().tolist()
                    bits = (g.x[own].astype(np.int64) << np.arange(FEATURES)).sum(1)
                    yield pa.RecordBatch.from_pylist(
                        [{"key": keys[i], "bits": bits.tolist(), "label": g.label[own].tolist(), "chain": inside(g.chain), "skip": inside(g.skip)}],
                        pa.schema([("key", pa.int64())] + [(c, pa.list_(pa.int64())) for c in ("bits", "label", "chain", "skip")]),
                    )

    schema = "key bigint, bits array<bigint>, label array<bigint>, chain array<bigint>, skip array<bigint>"
    found = rows.select("key", "text").mapInArrow(extract, schema).toArrow().to_pylist()
    found.sort(key=lambda r: (r["key"], r["bits"]))
    bits, label, chain, skip = [], [], [], []
    for r in found:
        low = len(bits)
        chain += [e + low for e in r["chain"]]
        skip += [e + low for e in r["skip"]]
        bits += r["bits"]
        label += r["label"]
    x = ((np.array(bits, np.int64)[:, None] >> np.arange(FEATURES)) & 1).astype(float)
    return fit(x, np.array(label, np.int64), np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2))


def find_spans(column: pa.Array, field: Field | None) -> tuple[list, list]:
    """Base spans and all spans, (kind, start, end), of every text."""
    g = graph_of(column)
    texts = [t or "" for t in column.to_pylist()]
    return g.base, [sorted(b + a) for b, a in zip(g.base, added_spans(g, field, texts))]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPAN_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"


def detect(df: DataFrame, field: Field | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with the arrays ``base_spans`` and ``all_spans``."""

    def make():
        def apply(batch):
            both = find_spans(batch.column(text), field)
            return [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s] for s in side], _SPAN) for side in both]

        return apply

    return map_batches(df, make, f"base_spans {_SPAN_SQL}, all_spans {_SPAN_SQL}", keep, text)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(df: DataFrame, field: Field | None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``df`` with personal data in ``text`` masked, and ``n_chars`` (where there is one) set to the new length."""
    order = df.columns
    rest = [c for c in order if c not in (text, n_chars)]

    def make():
        def apply(batch):
            column = batch.column(text)
            _, spans = find_spans(column, field)
            new = [None if t is None else masked(t, s) if s else t for t, s in zip(column.to_pylist(), spans)]
            return [pa.array(new, pa.string()), pa.array([None if t is None else len(t) for t in new], pa.int64())]

        return apply

    out = map_batches(df, make, f"`{text}` string, `{n_chars}` bigint", rest, text)
    return out.select(*[F.col(f"`{c}`").cast(df.schema[c].dataType).alias(c) for c in order])


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long")


def _base_columns() -> list[F.Column]:
    counts = [_count("base_spans", kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return [*counts, F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256")]


def op5_pii_crf_base(spark, sf_dir: str) -> DataFrame:
    """Per document: the base spans alone, which SQL can express."""
    return detect(read_documents(spark, sf_dir, "doc_id", "text"), None).select("doc_id", *_base_columns())


def op5_pii_crf(spark, sf_dir: str) -> DataFrame:
    """Per document: base spans by kind and their digest, and all spans."""
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    return detect(docs, learn(docs)).select("doc_id", *_base_columns(), _listed(F.col("all_spans")).alias("spans"))
