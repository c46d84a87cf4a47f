"""Personal data: exact patterns, and a character tagger for what they miss.

Patterns find e-mail addresses, IPv4 addresses, card numbers and telephone numbers, leftmost and
non-overlapping by kind; a match that fails its kind's check is dropped. They are anchored so that
no text makes them take more than linear time.

A bidirectional LSTM over characters with a CRF on top is trained in numpy on labelled spans: the
checked matches of a bounded sample of texts, and rewritten forms of them (two spans side by side, a
number without its country code, other separators). Texts are read in overlapping windows. Each
window gives every character the posterior probability of its tags; where windows overlap, these are
averaged, weighted by the distance from the window's edge, and one Viterbi pass over the whole
stretch picks the spans. A tagger's span is added if it is sure enough, passes its kind's check
and overlaps no span of the patterns, which always stay.

A span holds a digit or an @, and its letters stand in tokens with one; only windows about such
tokens can hold a span, and only those are read. That is exact: all others decode to nothing.

Null texts count as empty. Null ids, repeated rows, very long texts and empty tables are ordinary;
a sample without any match trains no tagger, and the patterns stand alone. Further columns are
not read. Offsets count code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import written

KINDS = ("email", "ip", "card", "phone")
SIGNAL = re.compile("[0-9@]")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: a match inside a run of digits would have started at the run's first digit
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile("[0-9]+")
_ADDRESS = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind: int, found: str) -> bool:
    """The check of a kind, for any way of writing it."""
    if kind == 0:
        return _ADDRESS.fullmatch(re.sub(r"\s+", "", found)) is not None
    numbers = _NUMBER.findall(found)
    if kind == 1:
        return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n) <= 255 for n in numbers)
    digits = "".join(numbers)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[Span]:
    """The leftmost start of a match is the first character of the run before its @."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and _LOCAL.match(text, start - 1):
                start -= 1
        if start < at:
            yield start, 0, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """Spans that pass their check, and those that fail it."""
    good, bad = [], []
    if SIGNAL.search(text):
        found = list(_emails(text))
        for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
        for span in found:
            (good if span[1] == 0 or passes(span[1], text[span[0]:span[2]]) else bad).append(span)
    return sorted(good), bad


# ------------------------------------------------------------------ windows

#: 0 is padding; digits share one number, letters lose their case, non-ASCII characters share one
_IDS = np.array([1 if chr(c).isspace() else 2 if chr(c).isdigit() else c - 29 if 32 < c < 127 else 3 for c in range(128)], np.int16)
_IDS[65:91] = _IDS[97:123]
N_IDS = 99
_OTHER = 98
#: white space beyond ASCII reads as a space
_WIDE = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def symbols(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character numbers, where white space is, where a digit or an @ is."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = np.where(points < 128, _IDS[np.minimum(points, 127)], _OTHER).astype(np.int16)
    ids[np.isin(points, _WIDE)] = 1
    return ids, ids == 1, (ids == 2) | (points == 64)


def stretches(space: np.ndarray, signal: np.ndarray, beside: int) -> list[tuple[int, int]]:
    """Tokens with a digit or an @, and `beside` characters to either side, merged where they touch."""
    token = np.cumsum(space)
    held = np.zeros(int(token[-1]) + 1 if len(token) else 1, bool)
    held[token[signal]] = True
    marks = np.flatnonzero(held[token] & ~space)
    if not len(marks):
        return []
    breaks = np.flatnonzero(np.diff(marks) > 2 * beside)
    first, last = marks[np.concatenate([[0], breaks + 1])], marks[np.concatenate([breaks, [len(marks) - 1]])]
    return [(max(0, int(a) - beside), min(len(token), int(b) + 1 + beside)) for a, b in zip(first, last, strict=True)]


def windows(low: int, high: int, size: int) -> list[tuple[int, int]]:
    """Overlapping windows over a stretch, each but the last half a window on."""
    starts = range(low, max(low + 1, high - size // 2), size // 2)
    return [(s, min(high, s + size)) for s in starts]


# ------------------------------------------------------------------ the tagger

N_TAGS = 1 + 2 * len(KINDS)  # outside; first and further characters of each kind
_TAG = np.arange(N_TAGS)
#: a further character follows the first or a further one of its own kind
_ALLOWED = ~((_TAG > 0) & (_TAG % 2 == 0))[None, :] | (_TAG[:, None] == _TAG[None, :]) | (_TAG[:, None] + 1 == _TAG[None, :]) & (_TAG % 2 == 0)[None, :]
_START = (_TAG == 0) | (_TAG % 2 == 1)


class Tagger:
    """Bidirectional LSTM with a CRF; every array is float32 and lies in `p`."""

    def __init__(self, embed: int = 12, hidden: int = 20, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"embed": draw(N_IDS, embed) * np.float32(3), "out": draw(2 * hidden, N_TAGS), "bias": np.zeros(N_TAGS, np.float32),
                  "trans": np.zeros((N_TAGS, N_TAGS), np.float32), "start": np.zeros(N_TAGS, np.float32)}
        for way in "fb":
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p |= {f"x{way}": draw(embed, 4 * hidden), f"h{way}": draw(hidden, 4 * hidden), f"c{way}": bias}

    def _run(self, x: np.ndarray, way: str) -> tuple:
        """x: (steps, batch, embed); gates, cells and outputs of every step."""
        steps, batch, _ = x.shape
        n, w = self.hidden, self.p[f"h{way}"]
        gates = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        cells, out = np.zeros((steps + 1, batch, n), np.float32), np.zeros((steps + 1, batch, n), np.float32)
        for t in range(steps):
            z = gates[t]
            z += out[t] @ w
            z[:, :3 * n] = 1 / (1 + np.exp(-z[:, :3 * n]))
            np.tanh(z[:, 3 * n:], out=z[:, 3 * n:])
            cells[t + 1] = z[:, n:2 * n] * cells[t] + z[:, :n] * z[:, 3 * n:]
            out[t + 1] = z[:, 2 * n:3 * n] * np.tanh(cells[t + 1])
        return gates, cells, out

    def _back(self, x: np.ndarray, way: str, gates: np.ndarray, cells: np.ndarray, out: np.ndarray, d_out: np.ndarray, grad: dict) -> np.ndarray:
        n, w = self.hidden, self.p[f"h{way}"]
        d_gates = np.empty_like(gates)
        d_h, d_c = np.zeros_like(out[0]), np.zeros_like(out[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g = (gates[t][:, k * n:(k + 1) * n] for k in range(4))
            c = np.tanh(cells[t + 1])
            d_h = d_h + d_out[t]
            d_c = d_c + d_h * o * (1 - c * c)
            d_gates[t] = np.hstack([d_c * g * i * (1 - i), d_c * cells[t] * f * (1 - f), d_h * c * o * (1 - o), d_c * i * (1 - g * g)])
            d_h, d_c = d_gates[t] @ w.T, d_c * f
        flat = d_gates.reshape(-1, 4 * n)
        grad[f"x{way}"] = x.reshape(len(flat), -1).T @ flat
        grad[f"h{way}"] = out[:-1].reshape(len(flat), n).T @ flat
        grad[f"c{way}"] = flat.sum(axis=0)
        return d_gates @ self.p[f"x{way}"].T

    def _score(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """ids: (steps, batch); the score of every tag at every character."""
        x = self.p["embed"][ids]
        fore, back = self._run(x, "f"), self._run(x[::-1], "b")
        both = np.concatenate([fore[2][1:], back[2][1:][::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (x, fore, back, both)

    def _chain(self, score: np.ndarray, valid: np.ndarray) -> tuple:
        """Posteriors of the tags, forward and backward terms, their scales, step weights and ways."""
        ways = np.where(_ALLOWED, np.exp(self.p["trans"]), 0).astype(np.float32)
        weight = np.exp(score - score.max(axis=2, keepdims=True))
        fore, back = np.empty_like(score), np.ones_like(score)
        scale = np.ones(score.shape[:2] + (1,), np.float32)
        now = np.where(_START, np.exp(self.p["start"]), 0).astype(np.float32) * weight[0]
        scale[0] = now.sum(axis=1, keepdims=True)
        fore[0] = now / scale[0]
        for t in range(1, len(score)):
            now = (fore[t - 1] @ ways) * weight[t]
            scale[t] = np.where(valid[t][:, None], now.sum(axis=1, keepdims=True), 1)
            fore[t] = np.where(valid[t][:, None], now / scale[t], fore[t - 1])
        for t in range(len(score) - 2, -1, -1):
            back[t] = np.where(valid[t + 1][:, None], ((back[t + 1] * weight[t + 1]) @ ways.T) / scale[t + 1], 1)
        post = fore * back
        return post / post.sum(axis=2, keepdims=True), fore, back, scale, weight, ways

    def posteriors(self, ids: np.ndarray, valid: np.ndarray) -> np.ndarray:
        return self._chain(self._score(ids)[0], valid)[0]

    def gradient(self, ids: np.ndarray, tags: np.ndarray, valid: np.ndarray) -> dict:
        """Of the CRF's negative log-likelihood per window."""
        score, (x, fore, back, both) = self._score(ids)
        post, alpha, beta, scale, weight, ways = self._chain(score, valid)
        batch = ids.shape[1]
        d_score = (post - np.eye(N_TAGS, dtype=np.float32)[tags]) * valid[:, :, None] / batch
        grad = {"bias": d_score.sum(axis=(0, 1)), "start": d_score[0].sum(axis=0),
                "out": both.reshape(-1, both.shape[2]).T @ d_score.reshape(-1, N_TAGS)}
        later = beta[1:] * weight[1:] / scale[1:] * valid[1:, :, None]
        steps = np.zeros((N_TAGS, N_TAGS), np.float32)
        np.add.at(steps, (tags[:-1][valid[1:]], tags[1:][valid[1:]]), 1)
        grad["trans"] = (alpha[:-1].reshape(-1, N_TAGS).T @ later.reshape(-1, N_TAGS) * ways - steps) / batch * _ALLOWED
        d_both = d_score @ self.p["out"].T
        n = self.hidden
        d_x = self._back(x, "f", *fore, d_both[:, :, :n], grad)
        d_x = d_x + self._back(x[::-1], "b", *back, d_both[::-1, :, n:], grad)[::-1]
        grad["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grad["embed"], ids, d_x)
        return grad

    def fit(self, ids: np.ndarray, tags: np.ndarray, valid: np.ndarray, *, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 2) -> Tagger:
        """Adam over shuffled batches. ids, tags, valid: (windows, steps)."""
        rng = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        n = total = 0
        total = epochs * -(-len(ids) // batch)
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(ids)), -(-len(ids) // batch)):
                grad = self.gradient(ids[at].T, tags[at].T, valid[at].T)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                n += 1
                step = rate * (1 - n / (total + 1)) * np.sqrt(1 - 0.999**n) / (1 - 0.9**n)
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.p[k] = (self.p[k] - step * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
        return self


# ------------------------------------------------------------------ training windows

def labelled(text: str, size: int, beside: int) -> Iterator[tuple[int, str, list[int]]]:
    """(kind of the first span or -1, characters, tags) of the windows that the patterns label for
    sure: no span is cut, none overlaps another, and no long number fails its check there."""
    good, bad = matches(text)
    tags, unsure = np.zeros(len(text) + 1, np.int8), np.zeros(len(text) + 1, bool)
    done = 0
    for start, kind, end in good:  # what starts first is the span; a telephone number may hold a card number
        if start >= done:
            tags[start], tags[start + 1:end] = 2 * kind + 1, 2 * kind + 2
            done = end
        elif kind != 2:
            unsure[start:end] = True
    for start, _, end in bad:
        if sum(c.isdigit() for c in text[start:end]) >= 9:
            unsure[start:end] = True
    for low, high in stretches(*symbols(text)[1:], beside):
        for a, b in windows(low, high, size):
            own = tags[a:b]
            cut = any(t > 0 and t % 2 == 0 for t in (own[0], tags[b]))
            if not cut and not unsure[a:b].any():
                first = own[own > 0][:1].tolist()
                yield (first[0] - 1) // 2 if first else -1, text[a:b], own.tolist()


def _rewritten(kind: int, found: str, rng: np.random.Generator) -> str:
    """Another way to write a span."""
    digits = "".join(_NUMBER.findall(found))
    way = int(rng.integers(3))
    if kind == 0:
        at = found.index("@")
        return (found[:at] + " @ " + found[at + 1:], found[:at // 2] + "é" + found[at // 2 + 1:], found[:at] + "@ " + found[at + 1:])[way]
    if kind == 1:
        return (found.replace(".", "[.]"), found.replace(".", " . "), found.replace(".", "(.)"))[way]
    if kind == 2:
        return (".", "  ", "/")[way].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    rest = digits[-10:]
    return (f"({rest[:3]}) {rest[3:6]}-{rest[6:]}", f"{rest[:3]}-{rest[3:6]}-{rest[6:]}", f"00{digits[:-10] or '1'} {rest[:3]} {rest[3:6]} {rest[6:]}")[way]


def examples(rows: list[tuple[int, str, list[int]]], size: int, seed: int = 3) -> list[tuple[str, list[int]]]:
    """The labelled windows, and others made of them: a span rewritten, two spans side by side."""
    rng = np.random.default_rng(seed)
    out = [(chars, tags) for _, chars, tags in rows]
    parts = []
    for kind, chars, tags in rows:
        if kind >= 0:
            start = next(i for i, t in enumerate(tags) if t)
            end = start + 1
            while end < len(tags) and tags[end] == 2 * kind + 2:
                end += 1
            if not any(tags[end:]):
                parts.append((kind, chars[:start], chars[start:end], chars[end:]))
    mark = lambda kind, n: [2 * kind + 1] + [2 * kind + 2] * (n - 1) if n else []
    for kind, before, found, after in parts:
        other = parts[int(rng.integers(len(parts)))]
        again = _rewritten(kind, found, rng)
        gap = (" ", " ", "\n", ", ", "  ")[int(rng.integers(5))]
        pair = found + gap + other[2]
        for middle, tags in ((again, mark(kind, len(again))),
                             (pair, mark(kind, len(found)) + [0] * len(gap) + mark(other[0], len(other[2])))):
            left = before[max(0, len(before) - max(0, size - len(middle)) // 2):]
            right = after[:max(0, size - len(left) - len(middle))]
            if len(middle) <= size:
                out.append((left + middle + right, [0] * len(left) + tags + [0] * len(right)))
    return out


def trained(rows: list[tuple[int, str, list[int]]], size: int, **options) -> Tagger:
    made = examples(rows, size)
    ids, tags = np.zeros((len(made), size), np.int16), np.zeros((len(made), size), np.int64)
    valid = np.zeros((len(made), size), bool)
    for i, (chars, own) in enumerate(made):
        ids[i, :len(chars)] = symbols(chars)[0]
        tags[i, :len(own)] = own
        valid[i, :len(own)] = True
    return Tagger().fit(ids, tags, valid, **options)


def fit(docs: DataFrame, text_col: str = "text", *, fit_rows: int = 4000, per_kind: int = 300, others: int = 600, size: int = 96,
        beside: int = 24, epochs: int = 14) -> Tagger | None:
    """A tagger trained in one task on at most `per_kind` windows of each kind and `others` without a
    span, from about `fit_rows` texts with a digit or an @, by hash; None if no span is labelled."""
    text = F.col(text_col).alias("text")
    able = docs.select(text).filter(F.col("text").rlike(SIGNAL.pattern)).withColumn("h", F.xxhash64("text"))
    share = min(1.0, fit_rows / max(1, able.count()))
    sample = able.filter(F.pmod("h", F.lit(1_000_003)) < int(share * 1_000_003) + 1).dropDuplicates(["h"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for t in batch.column(0).to_pylist() for x in labelled(t, size, beside)]
            kind, chars, tags = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(chars, pa.string()), pa.array(tags, pa.list_(pa.int32()))],
                                             names=["kind", "chars", "tags"])

    own = sample.select("text").mapInArrow(cut, "kind int, chars string, tags array<int>").dropDuplicates(["chars"])
    order = F.row_number().over(W.partitionBy("kind").orderBy(F.xxhash64("chars"), "chars"))
    # the plain bound lets tasks drop what cannot be among the first before the rows of a kind meet
    first = own.withColumn("n", order).filter(F.col("n") <= max(per_kind, others))
    chosen = written(first.filter(F.col("n") <= F.when(F.col("kind") < 0, others).otherwise(per_kind)), "personal-windows")
    if chosen.filter("kind >= 0").isEmpty():
        return None

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["kind", "n"])
        given = [(int(k), c, [int(t) for t in own]) for k, c, own in zip(rows["kind"], rows["chars"], rows["tags"], strict=True)]
        return pd.DataFrame({"p": [pickle.dumps(trained(given, size, epochs=epochs).p)]})

    # a bounded table, so one task holds it
    model = Tagger()
    model.p = pickle.loads(chosen.groupBy().applyInPandas(train, "p binary").first().p)
    return model


# ------------------------------------------------------------------ decoding

def best_paths(posts: list[np.ndarray]) -> list[np.ndarray]:
    """The likeliest tags of each stretch (steps, tags), by Viterbi over many stretches at once."""
    order, out = sorted(range(len(posts)), key=lambda i: len(posts[i])), [np.zeros(0, int)] * len(posts)
    ways = np.where(_ALLOWED, 0, -np.inf).astype(np.float32)
    while order:
        longest = len(posts[order[-1]])
        take = max(1, min(len(order), 1 << 8, (1 << 20) // max(1, longest)))
        group, order = order[-take:], order[:-take]
        score = np.full((longest, take, N_TAGS), -np.inf, np.float32)
        score[:, :, 0] = 0  # beyond a stretch's end all is outside
        for j, i in enumerate(group):
            score[:len(posts[i]), j] = np.log(posts[i] + 1e-9)
        came = np.zeros((longest, take, N_TAGS), np.int8)
        now = np.where(_START, score[0], -np.inf)
        for t in range(1, longest):
            step = now[:, :, None] + ways
            came[t] = step.argmax(axis=1)
            now = np.take_along_axis(step, came[t][:, None, :].astype(np.int64), axis=1)[:, 0] + score[t]
        tag = now.argmax(axis=1)
        paths = np.empty((longest, take), np.int8)
        for t in range(longest - 1, -1, -1):
            paths[t] = tag
            tag = came[t][np.arange(take), tag]
        for j, i in enumerate(group):
            out[i] = paths[:len(posts[i]), j]
    return out


def tagged(model: Tagger, texts: list[str], *, size: int = 96, beside: int = 24, sure: float = 0.8, batch: int = 256) -> list[list[Span]]:
    """The tagger's spans in each text that are `sure` on average and pass their check."""
    pieces, todo, lengths = [], [], []  # stretches (text, low, high), windows (stretch, from, to)
    ids = []
    for i, text in enumerate(texts):
        own, space, signal = symbols(text)
        ids.append(own)
        for low, high in stretches(space, signal, beside):
            todo += [(len(pieces), a, b) for a, b in windows(low, high, size)]
            pieces.append((i, low, high))
    total = [np.zeros((high - low, N_TAGS), np.float32) for _, low, high in pieces]
    share = [np.zeros((high - low, 1), np.float32) for _, low, high in pieces]
    todo.sort(key=lambda w: w[2] - w[1])
    for at in range(0, len(todo), batch):
        group = todo[at:at + batch]
        steps = max(b - a for _, a, b in group)
        read, valid = np.zeros((steps, len(group)), np.int16), np.zeros((steps, len(group)), bool)
        for j, (piece, a, b) in enumerate(group):
            read[:b - a, j] = ids[pieces[piece][0]][a:b]
            valid[:b - a, j] = True
        post = model.posteriors(read, valid)
        for j, (piece, a, b) in enumerate(group):
            low = pieces[piece][1]
            weight = np.minimum(np.arange(1, b - a + 1), np.arange(b - a, 0, -1)).astype(np.float32)[:, None]
            total[piece][a - low:b - low] += post[:b - a, j] * weight
            share[piece][a - low:b - low] += weight
    posts = [t / s for t, s in zip(total, share, strict=True)]
    out: list[list[Span]] = [[] for _ in texts]
    for (i, low, _), post, path in zip(pieces, posts, best_paths(posts), strict=True):
        starts = np.flatnonzero(path % 2 == 1)
        for s in starts.tolist():
            kind, e = int(path[s]) // 2, s + 1
            while e < len(path) and path[e] == path[s] + 1:
                e += 1
            if post[np.arange(s, e), path[s:e]].mean() >= sure and passes(kind, texts[i][low + s:low + e]):
                out[i].append((low + s, kind, low + e))
    return out


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame, model: Tagger | None, *, size: int = 96, beside: int = 24, sure: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCHEMA for every row: the patterns' counts and digest, all spans, the number of added ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [matches(t)[0] for t in texts]
            added = tagged(model, texts, size=size, beside=beside, sure=sure) if model else [[] for _ in texts]
            columns: list[list] = [[] for _ in range(7)]
            for text, own, extra in zip(texts, base, added, strict=True):
                if own and extra:
                    covered = np.zeros(len(text), bool)
                    for s, _, e in own:
                        covered[s:e] = True
                    extra = [x for x in extra if not covered[x[0]:x[2]].any()]
                for k in range(4):
                    columns[k].append(sum(s[1] == k for s in own))
                columns[4].append(hashlib.sha256(_listed(own).encode()).hexdigest())
                columns[5].append(_listed(own + extra))
                columns[6].append(len(extra))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()),
                                              pa.array(columns[5], pa.string()), pa.array(columns[6], pa.int64())],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    text = F.col(text_col)  # a text without a digit and an @ need not leave the JVM
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(text.rlike(SIGNAL.pattern), text).alias("text")).mapInArrow(run, SCHEMA)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`find` with a tagger fitted on `docs`; `options` go to `fit`."""
    return find(docs, fit(docs, text_col, **options), id_col=id_col, text_col=text_col)
