"""Secret scans: three base patterns, and a character convolutional network for what they miss.

Base findings are the leftmost non-overlapping matches of each kind (assign, access, hex); the
network only adds spans, of kind ``neural``, that overlap no base span.  Its candidates are all
runs of 16 or more token characters with a letter and a digit, or with letters of both cases and a capital
after the first character, scored with 24 characters around them; long
candidates are scored in parts and the highest counts.  It is trained in numpy on labelled
findings (text, start, end, label; by default a built-in set made by rule), its scores are
calibrated on held-out findings, and each shape of candidate has the highest threshold that keeps
the asked recall there.  Base findings carry a calibrated score too.

Positions are code points, ends exclusive.  Nulls and empty texts give no finding, an empty table
no rows; texts of any length are taken whole, and repeated rows get the same findings.  Kept columns
named ``findings`` or ``masked`` give way to the result's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import by_bytes, map_arrow, text_bytes, with_text

# The three base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "neural")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CONTEXT, BODY = 24, 48
RECALL = 0.98
SHAPES = ("hex", "upper", "mixed")

_TOKEN, _DIGIT, _CAPITAL = (np.zeros(256, bool) for _ in range(3))
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_DIGIT[48:58] = True
_CAPITAL[65:91] = True


def base(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def candidates(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if any(c.isalpha() for c in s) and (any("0" <= c <= "9" for c in s) or s[1:].lower() != s[1:] and s.upper() != s):
            out.append((m.start(), m.end()))
    return out


def suspects(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows in which any pattern or candidate can occur, by a few passes over the bytes."""
    n = len(bounds) - 1
    flag = np.zeros(n, bool)
    if not len(raw):
        return flag
    token = _TOKEN[raw]
    edge = np.flatnonzero(np.diff(token.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    long = end - start >= 16
    start, end = start[long], end[long]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw], dtype=np.int32)])
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[raw], dtype=np.int32)])
    good = (digits[end] > digits[start]) | (capitals[end] > capitals[start + 1]) | (end - start >= 32)
    hits = [start[good], end[good] - 1, np.flatnonzero((raw == 0x3A) | (raw == 0x3D))]
    data, at, keys = raw.tobytes(), 0, []
    while (at := data.find(b"AKIA", at)) >= 0:
        keys.append(at)
        at += 4
    # A run can reach over the ends of rows: all rows from its first to its last are looked at.
    lo, hi = np.searchsorted(bounds, hits[0], "right") - 1, np.searchsorted(bounds, hits[1], "right") - 1
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi + 1, -1)
    flag |= np.cumsum(steps)[:-1] > 0
    for h in (hits[2], np.array(keys, np.int64)):
        flag[np.searchsorted(bounds, h, "right") - 1] = True
    return flag


# --- network ---------------------------------------------------------------------------------

_CLASSES = np.full(128, 39, np.int64)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _CLASSES[ord(_c)] = 1 + _i
    _CLASSES[ord(_c.upper())] = 40 + _i
_CLASSES[48:58] = 27
for _i, _c in enumerate(" \n\"'=:/+_-."):
    _CLASSES[ord(_c)] = 28 + _i
_SYMBOLS, _LENGTH = 66, BODY + 2 * CONTEXT


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Symbol numbers of the candidate's parts with their context; 0 fills up."""
    out = []
    for a in range(start, end, BODY):
        b = min(a + BODY, end)
        if out and b - a < 16:
            break
        row = np.zeros(_LENGTH, np.int64)
        for lo, hi, to in ((max(0, a - CONTEXT), a, CONTEXT - min(CONTEXT, a)), (a, b, CONTEXT), (b, min(len(text), b + CONTEXT), CONTEXT + BODY)):
            codes = np.frombuffer(text[lo:hi].encode("utf-32-le"), "<u4")
            row[to : to + hi - lo] = np.where(codes < 128, _CLASSES[np.minimum(codes, 127)], 39)
        out.append(row)
    return out


class Network:
    """Embedding, a convolution over characters, max and mean over three places, a hidden layer and a logit."""

    EMBED, FILTERS, WIDTH, HIDDEN = 12, 24, 5, 24
    PARTS = ((0, CONTEXT), (CONTEXT, CONTEXT + BODY), (CONTEXT + BODY, _LENGTH))

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        e, f, k, h = self.EMBED, self.FILTERS, self.WIDTH, self.HIDDEN
        self.p = {"emb": r.normal(0, 0.3, (_SYMBOLS, e)), "w1": r.normal(0, (2 / (k * e)) ** 0.5, (k * e, f)), "b1": np.zeros(f), "w2": r.normal(0, (1 / (3 * f)) ** 0.5, (6 * f, h)), "b2": np.zeros(h), "w3": r.normal(0, h**-0.5, h), "b3": np.zeros(1)}
        self.p["emb"][0] = 0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        p, pad = self.p, self.WIDTH // 2
        e = np.pad(p["emb"][x], ((0, 0), (pad, pad), (0, 0)))
        cols = np.concatenate([e[:, j : j + _LENGTH] for j in range(self.WIDTH)], 2)
        c = np.maximum(cols @ p["w1"] + p["b1"], 0)
        top = [c[:, a:b].argmax(1) + a for a, b in self.PARTS]
        pooled = np.concatenate([np.take_along_axis(c, t[:, None], 1)[:, 0] for t in top] + [c[:, a:b].mean(1) for a, b in self.PARTS], 1)
        h = np.maximum(pooled @ p["w2"] + p["b2"], 0)
        return h @ p["w3"] + p["b3"], (x, cols, c, top, pooled, h)

    def backward(self, state: tuple, g: np.ndarray) -> dict[str, np.ndarray]:
        x, cols, c, top, pooled, h = state
        p, f, pad = self.p, self.FILTERS, self.WIDTH // 2
        out = {"w3": h.T @ g, "b3": g.sum(keepdims=True)}
        gh = np.outer(g, p["w3"]) * (h > 0)
        out |= {"w2": pooled.T @ gh, "b2": gh.sum(0)}
        gp = gh @ p["w2"].T
        gc = np.zeros_like(c)
        for i, (a, b) in enumerate(self.PARTS):
            np.put_along_axis(gc, top[i][:, None], gp[:, None, i * f : (i + 1) * f], 1)
        for i, (a, b) in enumerate(self.PARTS):
            gc[:, a:b] += gp[:, None, (3 + i) * f : (4 + i) * f] / (b - a)
        gc *= c > 0
        flat = gc.reshape(-1, f)
        out |= {"w1": cols.reshape(len(flat), -1).T @ flat, "b1": flat.sum(0)}
        gcols = gc @ p["w1"].T
        ge = np.zeros((len(x), _LENGTH + 2 * pad, self.EMBED))
        for j in range(self.WIDTH):
            ge[:, j : j + _LENGTH] += gcols[:, :, j * self.EMBED : (j + 1) * self.EMBED]
        emb = np.zeros_like(p["emb"])
        np.add.at(emb, x.ravel(), ge[:, pad : pad + _LENGTH].reshape(-1, self.EMBED))
        emb[0] = 0
        return out | {"emb": emb}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 3e-3, seed: int = 11) -> None:
        r, t = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                part, t = order[i : i + batch], t + 1
                z, state = self.forward(x[part])
                for k, g in self.backward(state, (1 / (1 + np.exp(-z)) - y[part]) / len(part)).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)


def shape(value: str) -> str:
    if re.fullmatch(r"[0-9a-fA-F=+/_-]+", value):
        return "hex"
    return "upper" if value == value.upper() else "mixed"


@dataclass
class Model:
    """The network with its calibration (logit -> a * logit + b) and a threshold for each shape."""

    net: Network
    a: float
    b: float
    thresholds: dict[str, float]

    def scores(self, text: str, spans: Sequence[tuple[int, int]]) -> list[float]:
        """A calibrated probability for each span: the highest of its parts."""
        if not spans:
            return []
        rows = [windows(text, s, e) for s, e in spans]
        at = np.cumsum([0, *map(len, rows)])
        flat = [r for w in rows for r in w]
        z = np.concatenate([self.net.forward(np.stack(flat[i : i + 256]))[0] for i in range(0, len(flat), 256)])
        top = np.maximum.reduceat(z, at[:-1])
        return (1 / (1 + np.exp(-np.clip(self.a * top + self.b, -30, 30)))).tolist()


Finding = tuple[str, int, int, int]


def learn(findings: Sequence[Finding], recall: float = RECALL, seed: int = 5) -> Model:
    """Train on 3/4 of the labelled findings; calibrate and set thresholds on the rest."""
    r = np.random.default_rng(seed)
    order = r.permutation(len(findings))
    cut = len(findings) * 3 // 4
    x, y = [], []
    for i in order[:cut]:
        text, s, e, label = findings[i]
        for w in windows(text, s, e):
            x.append(w)
            y.append(label)
    net = Network()
    net.train(np.stack(x), np.array(y, float))
    held = [findings[i] for i in order[cut:]]
    z = np.array([max(net.forward(np.stack(windows(t, s, e)))[0]) for t, s, e, _ in held])
    label = np.array([f[3] for f in held], float)
    a, b = 1.0, 0.0
    for _ in range(500):  # Platt scaling by gradient steps on the held-out findings
        g = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - label
        a, b = a - 0.02 * ((g * z).mean() + 1e-3 * a), b - 0.02 * g.mean()
    p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    shapes = np.array([shape(t[s:e]) for t, s, e, _ in held])
    limits = {}
    for k in SHAPES:
        own = np.sort(p[(shapes == k) & (label == 1)])
        limits[k] = float(own[int(np.floor((1 - recall) * len(own)))]) if len(own) else 0.5
    return Model(net, a, b, limits)


def built_in_findings(n: int = 6000, seed: int = 3) -> list[Finding]:
    """Labelled findings made by rule: credentials of many formats, and look-alikes, in prose and code."""
    r = np.random.default_rng(seed)

    def chars(alphabet: str, k: int) -> str:
        return "".join(alphabet[i] for i in r.integers(0, len(alphabet), k))

    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexa, alnum = dig + "abcdef", low + up + dig
    syllables = "an en in on the re ti or es st ed at he nd th ea ou ing ion ent der die und sch ich lo ra co que el la eau ment tion".split()  # fixed value

    def syllable() -> str:
        if r.random() < 0.4:
            return syllables[int(r.integers(0, len(syllables)))]
        return chars("bcdfghjklmnprstvwz", 1) + chars("aeiou", 1) + (chars("lmnrst", 1) if r.random() < 0.6 else "")

    def word() -> str:
        return "".join(syllable() for _ in range(int(r.integers(1, 4))))

    def prose(k: int) -> str:
        return " ".join(word() for _ in range(k))

    def mark() -> str:
        """A prefix of one or two parts, as issuers put before their tokens."""
        return "".join(chars(low, int(r.integers(2, 7))) + "-_"[int(r.integers(0, 2))] for _ in range(int(r.integers(1, 3))))

    good = [
        lambda: chars(hexa, int(r.choice([24, 32, 40, 64]))), lambda: chars(hexa, 40).upper(), lambda: chars(alnum + "+/", 40), lambda: "ghp_" + chars(alnum, 36), lambda: "xoxb-" + chars(dig, 12) + "-" + chars(alnum, 24),
        lambda: "sk_live_" + chars(alnum, 24), lambda: "AIza" + chars(alnum + "-_", 35), lambda: "eyJ" + chars(alnum, int(r.integers(20, 120))), lambda: chars(alnum, int(r.integers(20, 44))), lambda: "AKIA" + chars(up + dig, 16), lambda: chars(up + dig, int(r.integers(20, 36))), lambda: chars(alnum + "+/", 43) + "=",
        # any prefix, any alphabet: formats that nobody listed
        lambda: mark() + chars(alnum, int(r.integers(18, 60))), lambda: mark() + chars(alnum + "-_", int(r.integers(18, 60))), lambda: mark() + chars(low + up, int(r.integers(18, 44))), lambda: mark() + chars(hexa, int(r.choice([24, 32, 40]))),
    ]
    bad = [
        lambda: "-".join(word() for _ in range(4)) + "-" + chars(dig, 4), lambda: f"20{chars(dig, 2)}-0{chars('123456789', 1)}-1{chars(dig, 1)}T{chars(dig, 2)}-{chars(dig, 2)}", lambda: "INV-20" + chars(dig, 2) + "-" + chars(dig, 8), lambda: word() + "_" + word() + "_" + word() + chars(dig, 2), lambda: "/".join([word(), word(), word(), "v" + chars(dig, 1)]),
        lambda: chars(low, 1) * 12 + chars(dig, 1) * 8, lambda: word().capitalize() + word().capitalize() + word().capitalize() + "Test" + chars(dig, 2), lambda: "=" * 14 + chars(dig, 2) + "a", lambda: "ISBN-978-" + chars(dig, 9), lambda: "build-" + chars(dig, 4) + "-release-" + chars(dig, 2), lambda: "".join(word() for _ in range(5)) + chars(dig, 1), lambda: "page_" + chars(dig, 3) + "_of_" + chars(dig, 4) + "_draft",
        lambda: word() + "+" + word() + "=" + word() + chars(dig, 2) + "-" + word(),
        lambda: "_".join(word().upper() for _ in range(4)) + "_" + chars(up, 1) + chars(dig, 1), lambda: "-".join(word().upper() for _ in range(3)) + "-" + chars(dig, 3), lambda: "-".join(chars(hexa, k) for k in (8, 4, 4, 4, 12)), lambda: "/".join(word().capitalize() for _ in range(4)), lambda: "".join(word().capitalize() for _ in range(5)), lambda: "_".join(word().capitalize() for _ in range(4)) + chars(dig, 2), lambda: "-".join(word().capitalize() for _ in range(4)), lambda: word() + "".join(word().capitalize() for _ in range(4)),
    ]
    before = ["key", "bearer", "auth =", "credential:", "private key", "pwd is", "access", "token", "apikey:", ""]  # fixed value
    after_bad = ["file", "see", "order", "path", "version", "id", "page", ""]  # fixed value
    out: list[Finding] = []
    for i in range(n):
        label = i % 2
        value = (good if label else bad)[int(r.integers(0, len(good if label else bad)))]()
        if len(value) < 16 or not candidates(value):
            value += chars(dig, max(16 - len(value), 2))
        cue = (before if label else after_bad)[int(r.integers(0, len(before if label else after_bad)))] if r.random() < 0.5 else ""
        quote = '"' if r.random() < 0.3 else ""
        head = prose(int(r.integers(0, 8))) + " " + cue + " " + quote
        out.append((head + value + quote + " " + prose(int(r.integers(0, 8))), len(head), len(head) + len(value), label))
    return out


_DEFAULT: list[Model] = []


def default_model() -> Model:
    """The model of the built-in findings, trained once in a process."""
    if not _DEFAULT:
        _DEFAULT.append(learn(built_in_findings()))
    return _DEFAULT[0]


# --- scan ------------------------------------------------------------------------------------


def apart(spans: list[tuple[int, int]], others: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, in order, that overlap none of the others; both are swept once."""
    others, out, i, reach = sorted(others), [], 0, 0
    for s, e in spans:
        while i < len(others) and others[i][0] < e:
            reach = max(reach, others[i][1])
            i += 1
        if reach <= s:
            out.append((s, e))
    return out


def find(text: str, model: Model) -> list[dict]:
    """All findings of a text by start, then kind as listed."""
    own = base(text)
    more = apart(candidates(text), [(s, e) for _, s, e in own])
    scores = model.scores(text, [(s, e) for _, s, e in own] + more)
    out = [{"kind": k, "start": s, "end": e, "score": p} for (k, s, e), p in zip(own, scores, strict=False)]
    out += [{"kind": "neural", "start": s, "end": e, "score": p} for (s, e), p in zip(more, scores[len(own) :], strict=True) if p >= model.thresholds[shape(text[s:e])]]
    return sorted(out, key=lambda f: (f["start"], KINDS.index(f["kind"])))


FINDINGS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def scan(df: DataFrame, model: Model | None = None, keep: tuple[str | Column, ...] = ("doc_id",), text: str = "text", mask: str | None = None) -> DataFrame:
    """``keep`` columns and ``findings``; with ``mask`` also ``masked``, the text with every finding replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model or default_model())
    inner = with_text(df, text, keep, "findings", *["masked"] * (mask is not None))
    names = inner.columns[1:]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            masked: dict[int, str] = {}
            for a, b in by_bytes(bounds):
                for i in (a + np.flatnonzero(suspects(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))).tolist():
                    value = batch.column(0)[i].as_py() or ""
                    found[i] = find(value, m)
                    if mask is not None and found[i]:
                        masked[i] = _masked(value, found[i], mask)
            columns = [*batch.columns[1:], pa.array(found, kind)]
            if mask is not None:
                texts = batch.column(0)
                if masked:
                    texts = pa.array([masked.get(i, v) for i, v in enumerate(texts.to_pylist())], pa.string())
                columns.append(texts)
            yield pa.RecordBatch.from_arrays(columns, [*names, "findings", *["masked"] * (mask is not None)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[1:])
    return map_arrow(inner, work, f"{schema}, findings {FINDINGS}" + ", masked string" * (mask is not None))


def _masked(text: str, found: list[dict], mask: str) -> str:
    """Overlapping findings are replaced as one."""
    out, at, end = [], 0, -1
    for f in found:
        if f["start"] >= end:
            out += [text[at : f["start"]] if f["start"] > at else "", mask]
        end = max(end, f["end"])
        at = end
    return "".join([*out, text[at:]])
