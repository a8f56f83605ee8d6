"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions, trained in numpy."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare

KINDS = ("email", "ip", "card", "phone")
_EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Only the start of a run of digits can begin a match, so looking behind changes no result; possessive runs save retries.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A window of the model, the step between windows, and how far from a digit or @ the model still looks: no kind is without one.
WINDOW, STEP, REACH = 64, 32, 24
#: Documents to train on, about; windows, batches drawn from them, width of a direction, width of the character vectors.
TRAIN_DOCS, TRAIN_WINDOWS, STEPS, HIDDEN, EMBED = 3_000, 2_048, 240, 16, 12
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_SPECIAL = "@.+-() _%:,/\n"
_HINT = re.compile(r"[0-9@]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """From each @ back over the characters of a local part, not past the match before; time stays in proportion."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL_DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
            last = found.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start. A match that fails its test is dropped and not tried again."""
    out = list(emails(text))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def classes(text: str) -> np.ndarray:
    """A small number for each character: its digit group, letter case, or the special character it is; 0 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _CLASS[np.minimum(codes, 128)]


_CLASS = np.full(129, 1, np.int64)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 2, 3, 4
for _i, _c in enumerate(_SPECIAL):
    _CLASS[ord(_c)] = 5 + _i
N_CLASSES = 5 + len(_SPECIAL)


def windows(n: int, hints: list[tuple[int, int]]) -> list[int]:
    """Starts of overlapping windows over everything within reach of a digit or @, in a text of n characters."""
    out: list[int] = []
    for a, b in hints:
        a, b = max(0, a - REACH), min(n, b + REACH)
        at = out[-1] + STEP if out and out[-1] + WINDOW > a else a
        while (not out or out[-1] + WINDOW < b) and at < n:
            out.append(at)
            at += STEP
    return out


@dataclass
class Model:
    """Weights by name: `embed`, `w_f`, `u_f`, `b_f`, `w_b`, `u_b`, `b_b` (two LSTMs), `out`, `bias`, `trans`."""

    p: dict[str, np.ndarray]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.p, x)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(p: dict[str, np.ndarray], d: str, e: np.ndarray):
    """Hidden states of one direction over e (batch, time, width), and what its gradient needs."""
    n, t, _ = e.shape
    order = range(t) if d == "f" else range(t - 1, -1, -1)
    size = p[f"u_{d}"].shape[0]
    h, c = np.zeros((n, size)), np.zeros((n, size))
    inputs, hs, kept = e @ p[f"w_{d}"] + p[f"b_{d}"], np.zeros((n, t, size)), {}
    for i in order:
        z = inputs[:, i] + h @ p[f"u_{d}"]
        gates = _sigmoid(z[:, :3 * size])
        g = np.tanh(z[:, 3 * size:])
        new = gates[:, size:2 * size] * c + gates[:, :size] * g
        kept[i] = (gates, g, c, np.tanh(new), h)
        c, h = new, gates[:, 2 * size:] * np.tanh(new)
        hs[:, i] = h
    return hs, kept


def _forward(p: dict[str, np.ndarray], x: np.ndarray):
    e = p["embed"][x]
    f, kept_f = _lstm(p, "f", e)
    b, kept_b = _lstm(p, "b", e)
    h = np.concatenate([f, b], 2)
    return h @ p["out"] + p["bias"], (e, h, kept_f, kept_b)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def _crf(trans: np.ndarray, s: np.ndarray, y: np.ndarray):
    """Mean loss of the tag paths y under scores s, and its gradients for s and the transitions."""
    n, t, k = s.shape
    alpha, beta = np.zeros_like(s), np.zeros_like(s)
    alpha[:, 0] = s[:, 0]
    for i in range(1, t):
        alpha[:, i] = s[:, i] + _lse(alpha[:, i - 1, :, None] + trans, 1)
    for i in range(t - 2, -1, -1):
        beta[:, i] = _lse(trans + (s[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
    z = _lse(alpha[:, -1], 1)
    grad = np.exp(alpha + beta - z[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + trans + (s[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum((0, 1))
    rows, steps = np.arange(n)[:, None], np.arange(t)[None]
    score = s[rows, steps, y].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
    np.add.at(grad, (rows, steps, y), -1)
    np.add.at(pairs, (y[:, :-1], y[:, 1:]), -1)
    return float((z - score).mean()), grad / n, pairs / n


def _lstm_back(p: dict[str, np.ndarray], d: str, e: np.ndarray, kept: dict, dh_all: np.ndarray, grads: dict) -> np.ndarray:
    n, t, _ = e.shape
    size = p[f"u_{d}"].shape[0]
    order = range(t - 1, -1, -1) if d == "f" else range(t)
    dh, dc, dz_all = np.zeros((n, size)), np.zeros((n, size)), np.zeros((n, t, 4 * size))
    du = np.zeros_like(p[f"u_{d}"])
    for i in order:
        gates, g, c, tanh_new, before = kept[i]
        dh = dh + dh_all[:, i]
        i_, f_, o_ = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
        dc = dc + dh * o_ * (1 - tanh_new ** 2)
        dz = np.concatenate([dc * g * i_ * (1 - i_), dc * c * f_ * (1 - f_), dh * tanh_new * o_ * (1 - o_), dc * i_ * (1 - g ** 2)], 1)
        dz_all[:, i] = dz
        du += before.T @ dz
        dh, dc = dz @ p[f"u_{d}"].T, dc * f_
    flat = dz_all.reshape(-1, 4 * size)
    grads[f"u_{d}"], grads[f"w_{d}"], grads[f"b_{d}"] = du, e.reshape(len(flat), -1).T @ flat, flat.sum(0)
    return dz_all @ p[f"w_{d}"].T


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, hidden: int = HIDDEN, embed: int = EMBED, seed: int = 7, batch: int = 64,
          rate: float = 0.02) -> Model:
    """Fit class windows x to tag windows y (both windows * WINDOW) with Adam. Without windows, all is O."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"embed": rng.normal(0, 0.5, (N_CLASSES, embed)), "out": draw(2 * hidden, len(TAGS)), "bias": np.zeros(len(TAGS)), "trans": np.zeros((len(TAGS), len(TAGS)))}
    for d in "fb":
        p |= {f"w_{d}": draw(embed, 4 * hidden), f"u_{d}": draw(hidden, 4 * hidden), f"b_{d}": np.repeat([0.0, 1.0, 0.0, 0.0], hidden)}
    if not len(x):
        p["bias"][0] = 10.0
        return Model(p)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        take = rng.integers(0, len(x), batch)
        s, (e, h, kept_f, kept_b) = _forward(p, x[take])
        _, ds, dtrans = _crf(p["trans"], s, y[take])
        grads = {"trans": dtrans, "bias": ds.sum((0, 1)), "out": h.reshape(-1, 2 * hidden).T @ ds.reshape(-1, len(TAGS))}
        dh = ds @ p["out"].T
        de = _lstm_back(p, "f", e, kept_f, dh[:, :, :hidden], grads) + _lstm_back(p, "b", e, kept_b, dh[:, :, hidden:], grads)
        grads["embed"] = np.zeros_like(p["embed"])
        np.add.at(grads["embed"], x[take], de)
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] = p[k] - rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(p)


def viterbi(trans: np.ndarray, s: np.ndarray) -> np.ndarray:
    back = np.zeros(s.shape, np.int64)
    best = s[0]
    for i in range(1, len(s)):
        all_ = best[:, None] + trans
        back[i] = all_.argmax(0)
        best = all_.max(0) + s[i]
    path = np.zeros(len(s), np.int64)
    path[-1] = int(best.argmax())
    for i in range(len(s) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def tagged(path: np.ndarray, offset: int) -> Iterator[Span]:
    start, kind = None, None
    for i, tag in enumerate([*path.tolist(), 0]):
        inside = tag > 0 and (tag - 1) // 2 == kind and tag % 2 == 0
        if start is not None and not inside:
            yield KINDS[kind], offset + start, offset + i
            start = None
        if tag > 0 and not inside:
            start, kind = i, (tag - 1) // 2


def model_spans(model: Model, texts: list[str]) -> list[list[Span]]:
    """What the model finds in each text. Scores of overlapping windows are averaged, weighted towards window centres, and each
    stretch of touching windows is decoded once as a whole."""
    known, starts, owner = [classes(t) for t in texts], [], []
    for i, t in enumerate(texts):
        for at in windows(len(t), [m.span() for m in _HINT.finditer(t)]):
            starts.append(at)
            owner.append(i)
    out: list[list[Span]] = [[] for _ in texts]
    weight = np.minimum(np.arange(WINDOW) + 1, np.arange(WINDOW, 0, -1)).astype(float)
    scores = []
    for at in range(0, len(starts), 256):
        x = np.zeros((len(starts[at:at + 256]), WINDOW), np.int64)
        for j, (i, a) in enumerate(zip(owner[at:at + 256], starts[at:at + 256])):
            piece = known[i][a:a + WINDOW]
            x[j, :len(piece)] = piece
        scores.append(model.emissions(x).astype(np.float32))
    scores = np.concatenate(scores) if scores else np.zeros((0, WINDOW, len(TAGS)), np.float32)
    a = 0
    while a < len(starts):
        b = a + 1
        while b < len(starts) and owner[b] == owner[a] and starts[b] < starts[b - 1] + WINDOW:
            b += 1
        base, end = starts[a], min(starts[b - 1] + WINDOW, len(known[owner[a]]))
        total, weights = np.zeros((end - base, len(TAGS))), np.zeros((end - base, 1))
        for j in range(a, b):
            n = min(WINDOW, end - starts[j])
            total[starts[j] - base:starts[j] - base + n] += scores[j, :n] * weight[:n, None]
            weights[starts[j] - base:starts[j] - base + n] += weight[:n, None]
        out[owner[a]] += tagged(viterbi(model.p["trans"], total / weights), base)
        a = b
    return out


def training_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = TRAIN_DOCS, n_windows: int = TRAIN_WINDOWS):
    """(x, y) from about `most` documents that have a digit or @, labelled by the base patterns: of all windows of these documents
    the `n_windows` least by hash. Both numbers are parameters that bound the sample; documents that repeat a window weigh it more."""
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text).where(F.col(text).rlike("[0-9@]"))
    rate = int(min(1.0, most / max(1, rows.count())) * (1 << 20)) + 1
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("train"), key), F.lit(1 << 20)) < rate).select(F.col(text).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for value in batch.column(0):
                t = value.as_py().decode("utf-8", "replace")
                known, tags = classes(t), np.zeros(len(t) + WINDOW, np.uint8)
                for kind, a, b in base_spans(t):
                    tags[a:b], tags[a] = 2 + 2 * KINDS.index(kind), 1 + 2 * KINDS.index(kind)
                for at in windows(len(t), [m.span() for m in _HINT.finditer(t)]):
                    xs.append(np.pad(known[at:at + WINDOW], (0, max(0, at + WINDOW - len(t)))).astype(np.uint8).tobytes())
                    ys.append(tags[at:at + WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    found = drawn.mapInArrow(run, "x binary, y binary").orderBy(F.xxhash64("x", "y"), "x", "y").limit(n_windows).collect()
    array = lambda c: np.frombuffer(b"".join(bytes(r[c]) for r in found), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    return array("x"), array("y")


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone, base_spans, model_spans (arrays of kind, start, end; code points, end exclusive).

    Base spans go by kind as listed, then start. A span of the model is added where it touches no base span and has a digit or @.
    Null texts count as empty. Rows are judged one by one: repeated rows and null keys stay; an empty table gives an empty
    result; other columns are not looked at.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text)
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(v.as_py() or b"").decode("utf-8", "replace") for v in batch.column(1)]
            base = [base_spans(t) if _HINT.search(t) else [] for t in texts]
            more = []
            for t, fixed, spans in zip(texts, base, model_spans(shared.value, texts)):
                taken = sorted((a, b) for _, a, b in fixed)
                reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
                free = lambda a, b: not (i := bisect.bisect_left(taken, (b,))) or reach[i - 1] <= a
                more.append([s for s in spans if free(s[1], s[2]) and _HINT.search(t, s[1], s[2])])
            counts = [[sum(s[0] == k for s in b) for b in base] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(map(as_rows, base), kind), pa.array(map(as_rows, more), kind)],
                [key, *[f"n_{k}" for k in KINDS], "base_spans", "model_spans"])

    spans = "array<struct<kind:string,start:int,end:int>>"
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS)
    return rows.select(key, F.col(text).cast("binary")).mapInArrow(run, f"{schema}, base_spans {spans}, model_spans {spans}")
