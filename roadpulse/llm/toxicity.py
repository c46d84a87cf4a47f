"""Toxicity by a misspelling-tolerant lexicon and the context of its hits.

The lexicon is learned from labelled rows: words, and stems with many endings, that occur in
toxic texts and hardly in others (hits), or at least more often than not (hints). It is kept as a trie; a Levenshtein automaton runs over the trie
(states: trie node and edits so far) and is made deterministic as words demand, so a word leaves
at its first impossible letter. Every hit is looked at in a window of words: between quotation
marks it counts as a quotation, otherwise as abuse, the more so with further hits near by. A
logistic model over these counts gives the score.

Labels are read from training rows only, `fit_rows` of them at most, taken by a hash of the id.
Without labels of both kinds the score is 0.5 for a hit and 0 without. A null text is an empty
one, scored like any text without hits; null ids count as not held out (and no label can meet
them); repeated rows are scored alike; texts are read whole; further columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import written

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, exact int, misspelled int, quoted int, spans array<struct<first:int,edits:int,quoted:boolean>>"
#: the words learn_terms counts
_TOKEN = re.compile(r"[^\W_]+")
_QUOTE = re.compile("[\"“”«»„]")
#: figures of a text that the logistic model weighs
FIGURES = ("any hit", "hits", "misspelled", "misspelled only", "quoted", "quoted only", "density", "hints", "hints per 100 words", "misspelled hints")
#: edits of a term that only hints: HINT for none allowed, HINT - n for n allowed
HINT = -1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Automaton:
    """Deterministic on demand: a set of (trie node, edits) with one more letter read."""

    def __init__(self, terms: dict[str, int]):
        """terms: word or stem* -> edits allowed (0 and more)."""
        self.child: list[dict[str, int]] = [{}]
        self.limit: list[int] = [-1]  # edits allowed below this node
        self.end: list[int] = [-1]  # edits allowed for a word that ends here
        self.stem: list[int] = [-1]
        for term, edits in sorted(terms.items()):
            at = 0
            self.limit[0] = max(self.limit[0], edits)
            for c in term.rstrip("*"):
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    for table in (self.limit, self.end, self.stem):
                        table.append(-1)
                at = self.child[at][c]
                self.limit[at] = max(self.limit[at], edits)
            kind = self.stem if term.endswith("*") else self.end
            kind[at] = max(kind[at], edits)
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state(self._close({0: 0}))

    def _close(self, reach: dict[int, int]) -> dict[int, int]:
        """With letters of the term left out at the price of an edit each."""
        todo = list(reach)
        while todo:
            node = todo.pop()
            edits = reach[node] + 1
            for child in self.child[node].values():
                if edits <= self.limit[child] and edits < reach.get(child, 99):
                    reach[child] = edits
                    todo.append(child)
        return reach

    def _state(self, reach: dict[int, int]) -> int:
        key = tuple(sorted(reach.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            word = min((e for n, e in key if e <= self.end[n]), default=None)
            stem = min((e for n, e in key if e <= self.stem[n]), default=None)
            self.states.append((key, word, stem))
        return self.number[key]

    def _move(self, state: int, letter: str) -> int:
        reach: dict[int, int] = {}
        for node, edits in self.states[state][0]:
            if letter in self.child[node]:
                child = self.child[node][letter]
                reach[child] = min(edits, reach.get(child, 99))
            if edits < self.limit[node]:  # a letter too many
                reach[node] = min(edits + 1, reach.get(node, 99))
            for child in self.child[node].values():  # another letter
                if edits < self.limit[child]:
                    reach[child] = min(edits + 1, reach.get(child, 99))
        return self._state(self._close(reach))

    def edits(self, word: str) -> int:
        """Fewest edits by which the word is a term, or begins with a stem; -1: it is none."""
        state, best = self.start, 99
        for letter in word:
            key = (state, letter)
            if key not in self.moves:
                self.moves[key] = self._move(state, letter)
            state = self.moves[key]
            reach, _, stem = self.states[state]
            if stem is not None:
                best = min(best, stem)
            if not reach or best == 0:
                break
        else:
            if self.states[state][1] is not None:
                best = min(best, self.states[state][1])
        return best if best < 99 else -1


class Scanner:
    """Hits of a text, with a verdict kept per distinct word, in about `keep` bytes."""

    def __init__(self, terms: dict[str, int], window: int = 12, keep: int = 160 << 20):
        self.automaton = Automaton({t: k for t, k in terms.items() if k > HINT})
        self.hints = Automaton({t: HINT - k for t, k in terms.items() if k <= HINT})
        self.window, self.keep, self.known, self.held = window, keep, {}, 0

    def _verdict(self, word: str) -> int:
        """Edits of a hit, -1 for neither, -2 for a hint, -3 for a misspelled one."""
        edits = self.automaton.edits(word)
        if edits < 0 and (hint := self.hints.edits(word)) >= 0:
            return -3 if hint else -2
        return edits

    def _verdicts(self, raw: str) -> tuple[tuple[tuple[int, int], ...], int, int]:
        """(place in it, edits) of every hit, the numbers of exact and of misspelled hints of what
        stands between two spaces."""
        own = [(m.start(), self._verdict(m[0])) for m in _TOKEN.finditer(raw)]
        return tuple(x for x in own if x[1] >= 0), sum(e == -2 for _, e in own), sum(e == -3 for _, e in own)

    def hits(self, text: str) -> list[tuple[int, int, bool, int]]:
        """(word number, edits, quoted, other hits in the window) of every hit."""
        return self.scan(text)[0]

    def scan(self, text: str) -> tuple[list[tuple[int, int, bool, int]], tuple[int, int], int]:
        """hits(text), the numbers of exact and of misspelled hints, the number of words. Words are
        numbered, and windows measured, by white space."""
        found, known, hints, odd = [], self.known, 0, 0
        split = text.lower().split()
        if self.held > self.keep:
            known.clear()
            self.held = 0
        for at, raw in enumerate(split):
            verdicts = known.get(raw)
            if verdicts is None:
                verdicts = known[raw] = self._verdicts(raw)
                self.held += 4 * len(raw) + 250
            own, exact, misspelled = verdicts
            found += [(at, place, edits) for place, edits in own]
            hints += exact
            odd += misspelled
        if not found:
            return [], (hints, odd), len(split)
        marks = [(i, m.start()) for i, raw in enumerate(split) for m in _QUOTE.finditer(raw)] if _QUOTE.search(text) else []
        out = []
        for at, place, edits in found:
            # a mark before and one behind within the window
            here = bisect_left(marks, (at, place))
            quoted = 0 < here < len(marks) and at - marks[here - 1][0] <= self.window and marks[here][0] - at <= self.window
            near = bisect_left(found, (at + self.window + 1,)) - bisect_left(found, (at - self.window,))
            out.append((at, edits, quoted, near - 1))
        return out, (hints, odd), len(split)

    def figures(self, hits: list, hints: tuple[int, int], n_words: int) -> list[float]:
        exact, misspelled = hints
        hinted = [float(np.log1p(exact)), float(np.log1p(100 * exact / max(n_words, 20))), float(np.log1p(misspelled))]
        if not hits:
            return [0.0] * (len(FIGURES) - len(hinted)) + hinted
        odd, quoted = sum(h[1] > 0 for h in hits), sum(h[2] for h in hits)
        return [1.0, float(np.log1p(len(hits))), float(np.log1p(odd)), float(odd == len(hits)), float(np.log1p(quoted)),
                float(quoted == len(hits)), float(np.log1p(max(h[3] for h in hits))), *hinted]


def edits_allowed(term: str) -> int:
    """By length; a stem counts its letters, its endings are free."""
    n = len(term.rstrip("*"))
    return 0 if n < 5 else 1 if n < 9 else 2


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """y, text of at most about `fit_rows` labelled rows outside the held-out fifth."""
    own = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .filter(F.col("y").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    share = min(1.0, fit_rows / max(1, own.count()))
    own = own.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < int(share * 1_000_003))
    # the ids number `fit_rows` or so: small enough to go to all tasks, and the texts are written once
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL").join(F.broadcast(own), "id")
    return written(rows.select("y", "text").distinct(), "toxicity-sample")  # copies would count one text's words often


def learn_terms(rows: DataFrame, *, least: int = 8, share: float = 0.01, purity: float = 0.9, hint: float = 0.5, endings: int = 4) -> dict[str, int]:
    """Words and stems of toxic texts: in `least` of them and `share` of them at least, of all texts
    that hold them a `purity` toxic (hits) or a `hint` (hints); a stem has `endings` at least. Returns term -> edits
    allowed, HINT and less for hints. All such terms: as each lies in `share` of the sample's toxic texts, they
    are at most 1 / `share` times the distinct words and stems of a mean toxic text."""
    least = max(least, share * (rows.agg(F.sum("y")).first()[0] or 0))
    each = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")))
    counted = (rows.select("y", each.alias("w")).filter("length(w) >= 3").groupBy("w")
               .agg(F.sum("y").alias("hits"), F.sum(1 - F.col("y")).alias("rest")))
    stems = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(4), F.lit(6)), lambda n: F.substring("w", F.lit(1), n))))
    ways = counted.select("w", "hits", "rest", stems.alias("s")).filter("length(s) < length(w)")
    pure = (F.col("hits") >= least) & (F.col("hits") >= hint * (F.col("hits") + F.col("rest")))
    sure = (F.col("hits") >= purity * (F.col("hits") + F.col("rest"))).alias("sure")
    single = counted.filter(pure).select(F.col("w").alias("term"), "hits", sure)
    joint = (ways.groupBy("s").agg(F.sum("hits").alias("hits"), F.sum("rest").alias("rest"), F.count("*").alias("n"))
             .filter(pure & (F.col("n") >= endings)).select(F.concat("s", F.lit("*")).alias("term"), "hits", sure))
    found = single.unionByName(joint).orderBy(F.desc("sure"), F.desc("hits"), F.length("term"), "term").collect()
    # words and longer stems that a stem covers stay: they allow more edits than it does
    chosen: dict[str, int] = {}
    for r in found:  # sure ones first
        edits = edits_allowed(r.term)
        chosen.setdefault(r.term, edits if r.sure else HINT - edits)
    return chosen


def fit_weights(figures: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic weights, the constant last, by Newton's method."""
    x = np.hstack([figures, np.ones((len(figures), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, terms: dict[str, int] | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """SCHEMA for every row. `terms` (word or stem* -> edits allowed) replaces the learned lexicon."""
    rows = training_rows(docs, labels, fit_rows, id_col, text_col, label_col)
    terms = learn_terms(rows) if terms is None else terms

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(terms)
        for batch in batches:
            got = [scan.figures(*scan.scan(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.float64()))], names=["y", "x"])

    # equal figures are counted together: the driver gets at most `fit_rows` short rows
    seen = rows.mapInArrow(measure, "y int, x array<double>").groupBy("x", "y").agg(F.count("*").alias("n")).orderBy("x", "y").collect()
    if len({r.y for r in seen}) == 2:
        repeats = [r.n for r in seen]
        weights = fit_weights(np.repeat(np.array([r.x for r in seen]), repeats, axis=0), np.repeat([float(r.y) for r in seen], repeats))
    else:
        weights = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(terms)
        for batch in batches:
            seen = [scan.scan(t or "") for t in batch.column(2).to_pylist()]
            hits = [s[0] for s in seen]
            x = np.array([scan.figures(*s) for s in seen]).reshape(len(hits), len(FIGURES))
            p = x[:, 0] * 0.5 if weights is None else 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            count = lambda test: pa.array([sum(map(test, h)) for h in hits], pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)),
                count(lambda h: h[1] == 0), count(lambda h: h[1] > 0), count(lambda h: h[2]),
                pa.array([[{"first": h[0], "edits": h[1], "quoted": h[2]} for h in own] for own in hits],
                         pa.list_(pa.struct([("first", pa.int32()), ("edits", pa.int32()), ("quoted", pa.bool_())])))],
                names=["doc_id", "held_out", "score", "predicted", "exact", "misspelled", "quoted", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
