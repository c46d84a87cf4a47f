"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are split where no vocabulary piece can reach across (before a run of space marks and
around line feeds, where the vocabulary has no piece over them). The distinct words of a batch lie
in one flat array of symbols. In each round a segmented minimum finds the best pair rank of every
word; the leftmost pairs of that rank merge in all words at once, and the array is compacted;
words without a pair leave. Where a merge could make a pair that ranks no later than itself, only
the word's first pair merges in that round, as the one-by-one order demands. Symbols that are no
piece become byte pieces.

A null text is an empty one: the begin and end ids alone, decoded to an empty text. Texts of
any length, repeated rows and null ids are ordinary; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NONE = np.int64(1 << 40)


class PieceBpe:
    """The vocabulary of a model file (BPE, byte fallback, identity normaliser, a leading space
    mark) as merge tables. The model library only reads the file."""

    def __init__(self, path: str, keep: int = 160 << 20):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in range(n)]
        self.byte = np.zeros(256, np.int64)
        self.out: list[bytes] = []  # what an id decodes to
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.out.append(bytes([value]))
            elif model.is_control(i):
                self.out.append(b"")
            elif model.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.out.append(piece.replace(MARK, " ").encode())
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.silent = np.array([model.is_control(i) for i in range(n)])
        self.marked = np.array([normal[i] and pieces[i].startswith(MARK) for i in range(n)])
        symbol = {piece: i for i, piece in enumerate(pieces) if normal[i]}
        inside = set()
        for piece in [p for p in symbol if len(p) > 1]:
            inside.update(piece)
        for char in sorted(inside - symbol.keys()):  # a character that only occurs inside pieces
            symbol[char] = len(symbol) + n
        self.width = max(symbol.values()) + 1
        scores = np.array([model.get_score(i) for i in range(n)], np.float32)
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.tolist()), reverse=True))}
        pairs = [(symbol[p[:k]] * self.width + symbol[p[k:]], i, rank_of[float(scores[i])])
                 for p, i in symbol.items() if len(p) > 1 for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        pairs.sort()
        self.key, self.merged, self.rank = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        # ranks after whose merge a pair may come up that must not wait, or that several pieces share
        ranks = len(rank_of)
        owner, self.risky = np.full(self.width, ranks, np.int64), np.zeros(ranks + 1, bool)
        owner[self.merged] = self.rank
        for part in (self.key // self.width, self.key % self.width):
            early = self.rank <= owner[part]
            self.risky[owner[part][early & (owner[part] < ranks)]] = True
        of_rank: dict[int, set[int]] = {}
        for i, r in zip(self.merged.tolist(), self.rank.tolist(), strict=True):
            of_rank.setdefault(r, set()).add(i)
        self.risky[[r for r, own in of_rank.items() if len(own) > 1]] = True
        chars = sorted((ord(p), i) for p, i in symbol.items() if len(p) == 1)
        self.chars, self.char_symbol = (np.array(c, np.int64) for c in zip(*chars, strict=True))
        self.n = n
        self.line = "\n" not in inside
        self.words = re.compile(rf"{MARK}+[^{MARK}\n]*|\n+|[^{MARK}\n]+" if self.line else rf"{MARK}+[^{MARK}]*|[^{MARK}]+")
        if any(MARK in p.lstrip(MARK) for p in symbol):
            raise ValueError("a piece holds a space mark after other characters: words cannot be told apart")
        self.known: dict[str, bytes] = {}
        self.held = 0  # bytes of them, about
        self.keep = keep

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair (_NONE: no piece)."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], _NONE), self.merged[at]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, all words together by merge rounds."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        sym = np.where(self.chars[at] == points, self.char_symbol[at], -1 - points)  # negative: a code point outside
        rank, merged = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], merged[:-1] = self._pairs(sym[:-1], sym[1:])
            rank[:-1][word[:-1] != word[1:]] = _NONE
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(sym)))
            alive = np.repeat(least < _NONE, lengths)
            if not alive.all():
                done_sym.append(sym[~alive])
                done_word.append(word[~alive])
                sym, word, rank, merged = sym[alive], word[alive], rank[alive], merged[alive]
                lengths, least = lengths[least < _NONE], least[least < _NONE]
                if not len(sym):
                    break
            best = np.repeat(least, lengths)
            hit = np.flatnonzero(rank == best)
            # pairs of one rank that overlap form runs: every second pair merges, leftmost first
            fresh = np.concatenate([[True], np.diff(hit) != 1])
            run_at = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            first = np.concatenate([[True], word[hit][1:] != word[hit][:-1]])
            take = hit[np.where(self.risky[best[hit]], first, (np.arange(len(hit)) - run_at) % 2 == 0)]
            sym[take] = merged[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
            new = moved[take]
            touched = np.unique(np.concatenate([new, new[new > 0] - 1]))
            rank[touched] = _NONE
            touched = touched[touched < len(sym) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], merged[touched] = self._pairs(sym[touched], sym[touched + 1])
        sym, word = np.concatenate([*done_sym, []]).astype(np.int64), np.concatenate([*done_word, []]).astype(np.int64)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        if ((sym < 0) | (sym >= self.n)).any():
            return [self._with_bytes(sym[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return [sym[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _with_bytes(self, sym: np.ndarray) -> np.ndarray:
        if not ((sym < 0) | (sym >= self.n)).any():
            return sym
        if not hasattr(self, "_char_of"):
            self._char_of = dict(zip(self.char_symbol.tolist(), self.chars.tolist(), strict=True))
        out: list[int] = []
        for s in sym.tolist():
            if 0 <= s < self.n:
                out.append(s)
            else:
                out.extend(self.byte[list(chr(-1 - s if s < 0 else self._char_of[s]).encode())].tolist())
        return np.array(out, np.int64)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts between the begin and end ids (little-endian unsigned 32 bits)."""
        if self.held > self.keep:
            self.known.clear()
            self.held = 0
        split = [self.words.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = [w for w in {w for own in split for w in own} if w not in self.known]
        self.held += 5 * sum(map(len, new)) + 150 * len(new)
        for word, ids in zip(new, self.encode_words(new), strict=True):
            self.known[word] = ids.astype("<u4").tobytes()
        head, tail = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        return [np.frombuffer(b"".join([head, *map(self.known.__getitem__, own), tail]), "<u4") for own in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of `ids`: control ids are silent, the leading space mark goes, runs of byte
        pieces are read as UTF-8, a replacement character for every byte that is none."""
        spoken = ids[~self.silent[ids]]
        raw = b"".join(map(self.out.__getitem__, spoken.tolist()))
        if len(spoken) and self.marked[spoken[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return "".join(_lenient(raw))


def _lenient(raw: bytes) -> Iterator[str]:
    at = 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                yield raw[at:at + size].decode()
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


def code(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", rows: int = 256) -> DataFrame:
    """Digests of the ids of every text and of the text they decode to (SCHEMA)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PieceBpe(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                ids = bpe.encode_batch([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
