"""Order-preserving packing of token streams into sequences by dynamic programming.

Documents are dealt out by ranges of their id and each range is one stream of token ids, every
document closed by an end id. Windows of at most `seq_len` ids are cut from the stream in order.
A cut costs nothing at a document's end, `sentence_cost` at a sentence's end and `inner_cost`
inside a sentence longer than `gap` ids (there a cut may fall every `gap` ids); a window costs
its padding up to `seq_len`, none if its length is a power of two. The cheapest cuts come from

    f[j] = penalty[j] + open_cost + min over i of f[i] + padding(p[j] - p[i])

where the padded branch is a sliding-window minimum of f[i] + p[i] kept in a monotone queue, and
the power-of-two branch looks up the few positions that far back. A stream is solved in blocks
of about `block_tokens`; the last two windows of a block are taken into the next one, so
memory is bounded. What is left at a stream's end is cut into powers of two where that is cheaper
than padding.

A null text is an empty one (its end id alone); null and repeated doc_ids are ordinary documents;
very long texts span as many sequences as needed; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")
_SENTENCE_END = np.uint32(1 << 31)  # flag on the last id of a sentence
_PLAIN = np.uint32((1 << 31) - 1)
#: Latin letters that are composed as they are and have one small letter each (so no dotted capital I)
_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+")
_SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE, _BEYOND = range(6)
_BLANK = b" \t\n\v\f\r"
#: kind of each byte of UTF-8; what is not ASCII is _BEYOND
_KIND = bytes([_SPACE if c in _BLANK else _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _QUOTE if c == ord("'") else _SIGN
               for c in range(128)] + [_BEYOND] * 128)
_SMALL = bytes(range(256)).lower()
_STOPS = np.frombuffer(b".!?", np.uint8)


def _places() -> bytes:
    """By 6 * kind before + kind behind, 1: a piece begins, 0: it goes on, 2: no piece. No match of the splitting
    pattern spans a place where one begins, and no mark is composed across it. A sign and a quote may go together, a
    quote and letters ('s), and anything beyond ASCII with what is beside it."""
    begins = np.zeros((6, 6), np.uint8)
    begins[_SPACE], begins[:, _DIGIT], begins[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = 1, 1, 1
    begins[_LETTER, [_SIGN, _QUOTE]], begins[_SIGN, _LETTER], begins[:, _SPACE] = 1, 1, 2
    return begins.tobytes().ljust(256, b"\0")


_PLACES = _places()


def _wide_letters(data: np.ndarray) -> np.ndarray:
    """Where U+00C0 to U+00FF begin in UTF-8, without the two signs among them."""
    lead = np.flatnonzero(data == 0xC3)
    second = data[lead + 1]
    return lead[(second != 0x97) & (second != 0xB7)]


def pieces(data: bytes) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Runs of letters, runs of signs and single digits of `data` (UTF-8 that begins with white space), as far as they
    can be told apart by their bytes; where each begins; which ones end a sentence. Letters up to U+00FF are made small,
    unless the piece holds characters behind that, as those may compose with capital letters in another way."""
    kind = np.frombuffer(bytearray(data.translate(_KIND)), np.uint8)
    lead = _wide_letters(np.frombuffer(data, np.uint8))
    kind[lead] = kind[lead + 1] = _LETTER
    places = b"\2" + (6 * kind[:-1] + kind[1:]).tobytes().translate(_PLACES)
    at = np.flatnonzero(np.frombuffer(places, np.uint8) == 1)
    low = np.frombuffer(bytearray(data.translate(_SMALL, _BLANK)), np.uint8)
    lead = _wide_letters(low)
    low[lead[low[lead + 1] < 0x9F] + 1] |= 0x20
    offsets = np.append(np.flatnonzero(np.frombuffer(places.translate(None, b"\2"), np.uint8)), len(low))
    far = np.flatnonzero(low >= 0xC4)
    if len(far):
        mixed = np.zeros(len(at), bool)
        mixed[np.searchsorted(offsets, far, "right") - 1] = True
        low = np.where(np.repeat(mixed, np.diff(offsets)), np.frombuffer(data.translate(None, _BLANK), np.uint8), low)
    found = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(low))
    last_of_word = np.append(kind[at[1:] - 1] == _SPACE, True)[:len(at)]
    return found, at, last_of_word & np.isin(low[offsets[1:] - 1], _STOPS)


class WordTokens:
    """Token ids of a text by a public tokenizer that never joins what white space separates, nor
    letters, digits and signs, so each distinct piece is encoded once and kept (about `keep` bytes
    of them a worker)."""

    def __init__(self, path: str, keep: int = 280 << 20, run: int = 2000, mark: str = "<|endoftext|>"):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.known, self.held, self.keep, self.run = Tokenizer.from_file(path), {}, 0, keep, run
        self.mark, self.mark_id = mark, self.tokenizer.token_to_id(mark)
        # for runs of small Latin letters, which neither the normaliser nor the splitting pattern touches
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.letters.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def looked_up(self, distinct: list[str]) -> list[bytes]:
        """Ids of each piece, learnt if it is new. Letters are encoded once, whatever their case."""
        if self.held > self.keep:
            self.known.clear()
            self.held = 0
        known = self.known
        found = list(map(known.get, distinct))
        new = [k for k, ids in enumerate(found) if ids is None]
        small, other = {}, []
        for k in new:
            piece = distinct[k]
            if piece.isalpha() and (piece.isascii() or _LATIN.fullmatch(piece)):
                small[piece] = piece.lower()
            else:
                other.append(piece)
        self.held += 5 * sum(map(len, small)) + 5 * sum(map(len, other)) + 250 * len(new)  # a piece and its ids
        self.encode_letters([core for core in set(small.values()) if core not in known])
        self.encode(other)
        known.update([(piece, known[core]) for piece, core in small.items() if piece != core])
        for k in new:
            found[k] = known[distinct[k]]
        return found

    def encode_letters(self, new: list[str]) -> None:
        """Ids of runs of small Latin letters; a token that closes a run ends the word."""
        for low in range(0, len(new), self.run):
            part = new[low:low + self.run]
            ids = np.array(self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def encode(self, new: list[str]) -> None:
        """Ids of pieces, many in one string with a special token between."""
        for low in range(0, len(new), self.run):
            part = new[low:low + self.run]
            got = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0]
            ids = np.array([*got.ids, self.mark_id], "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark_id)).tolist()
            self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends, strict=False)], strict=True))

    def flagged(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the last one of a sentence carries a flag."""
        special = {k for k, t in enumerate(texts) if "<|" in t}  # may hold a special token
        raw = [b"" if k in special else t.encode() for k, t in enumerate(texts)]
        found, at, stops = pieces(b"\n" + b"\n".join(raw) + b"\n")
        coded = found.dictionary_encode()
        kept = self.looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        which, sizes = coded.indices.to_numpy(), np.fromiter(map(len, kept), np.int64, len(kept)) // 4
        size = sizes[which]
        ends = np.cumsum(size)
        ids = np.frombuffer(b"".join(kept), "<u4")[np.arange(size.sum()) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends + size, size)]
        ids[ends[stops] - 1] |= _SENTENCE_END
        upto = np.searchsorted(at, np.cumsum([len(r) + 1 for r in raw]))  # pieces before each text's end
        out = np.split(ids, np.append(0, ends)[upto][:-1])[:len(texts)]
        for k in special:
            out[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, "<u4")
        return out


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One for all tasks of a Python worker."""
    return WordTokens(path)


def cut_positions(flagged: np.ndarray, doc_ends: np.ndarray, *, last: bool, seq_len: int, sentence_cost: float,
                  inner_cost: float, open_cost: float, gap: int, least_power: int) -> list[int]:
    """Ends of the windows of one block. `doc_ends`: ascending positions, the last is the block's end."""
    n = len(flagged)
    kind = np.zeros(n + 1, np.int8)  # 1: inside a sentence, 2: a sentence's end, 3: a document's end
    kind[np.flatnonzero(flagged & _SENTENCE_END) + 1] = 2
    kind[doc_ends] = 3
    edges = np.concatenate([[0], np.flatnonzero(kind)])
    wide = np.flatnonzero(np.diff(edges) > gap)
    if len(wide):
        kind[np.concatenate([np.arange(a + gap, b, gap) for a, b in zip(edges[wide], edges[wide + 1], strict=True)])] = 1
    at = np.flatnonzero(kind)
    penalty = np.array([0.0, inner_cost, sentence_cost, 0.0])[kind[at]]
    at = np.concatenate([[0], at])
    penalty = (np.concatenate([[0.0], penalty]) + open_cost).tolist()
    exact: dict[int, list[int]] = {}
    power = least_power
    while power < seq_len:
        back = np.searchsorted(at, at - power)
        for j in np.flatnonzero((at >= power) & (at[np.minimum(back, len(at) - 1)] == at - power)).tolist():
            exact.setdefault(j, []).append(int(back[j]))
        power *= 2
    p = at.tolist()
    cost, came = [0.0] * len(p), [0] * len(p)
    queue: deque[int] = deque([0])  # f[i] + p[i] ascends from its head
    key = [0.0] * len(p)
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0]] < here - seq_len:
            queue.popleft()
        i = queue[0]
        best, back = key[i] + seq_len - here, i
        for i in exact.get(j, ()):
            if cost[i] < best:
                best, back = cost[i], i
        best += penalty[j]
        cost[j], came[j], key[j] = best, back, best + here
        while queue and key[queue[-1]] >= key[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(p) - 1
    while j:
        cuts.append(p[j])
        j = came[j]
    cuts.reverse()
    if last and cuts:
        begin = cuts[-2] if len(cuts) > 1 else 0
        rest = n - begin
        if (rest.bit_count() - 1) * (inner_cost + open_cost) < seq_len - rest:
            cuts.pop()
            while rest:
                piece = 1 << (rest.bit_length() - 1)
                begin, rest = begin + piece, rest - piece
                cuts.append(begin)
    return cuts


def pack(docs: DataFrame, tokens: Callable[[], object], *, end_id: int, seq_len: int = 4096, block_tokens: int = 1 << 19,
         sentence_cost: float = 2.0, inner_cost: float = 16.0, open_cost: float = 8.0, gap: int = 64,
         least_power: int = 512, id_col: str = "doc_id", text_col: str = "text", part_chars: int = 4 << 20) -> DataFrame:
    """One row per piece of a document (SCHEMA). `tokens()` gives an object such as
    WordTokens, whose flagged(texts) are arrays of ids; it gets texts of about `part_chars` at once."""
    rule = dict(seq_len=seq_len, sentence_cost=sentence_cost, inner_cost=inner_cost, open_cost=open_cost, gap=gap, least_power=least_power)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, serial = tokens(), TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # (doc_id, doc_tokens, start, flagged ids) not yet put into a window
        size = 0

        def solve(last: bool) -> pa.RecordBatch | None:
            nonlocal held, size, serial
            if not size:
                return None
            flagged = np.concatenate([h[3] for h in held])
            ids = flagged & _PLAIN
            ends = np.cumsum([len(h[3]) for h in held])
            cuts = cut_positions(flagged, ends, last=last, **rule)
            keep = cuts if last else cuts[:-2]
            if not keep:
                return None
            out, k, begin, done = [], 0, 0, 0
            for cut in keep:
                while begin < cut:
                    doc_id, total, start, own = held[k]
                    upto = min(cut, int(ends[k]))
                    doc_at = int(ends[k]) - len(own)
                    out.append((doc_id, start + begin - doc_at, upto - begin, zlib.crc32(ids[begin:upto].astype("<u4").tobytes()),
                                total, serial, begin - done, cut - done))
                    begin = upto
                    k += upto == ends[k]
                done, serial = cut, serial + 1
            rest = []
            if k < len(held):
                doc_id, total, start, own = held[k]
                used = begin - (int(ends[k]) - len(own))
                rest = [(doc_id, total, start + used, own[used:]), *held[k + 1:]]
            held, size = rest, size - done
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            parts = np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // part_chars)) + 1
            for low, high in zip([0, *parts.tolist()], [*parts.tolist(), len(texts)], strict=True):
                for doc_id, own in zip(names[low:high], made.flagged(texts[low:high]), strict=True):
                    own = np.append(own, np.uint32(end_id))
                    held.append((doc_id, len(own), 0, own))
                    size += len(own)
                    if size >= block_tokens and (got := solve(False)) is not None:
                        yield got
        if (got := solve(True)) is not None:
            yield got

    text = F.col(text_col)
    # the row number lets ranges cut through rows that share an id and a text
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    return (rows.repartitionByRange("doc_id", F.xxhash64("text"), "row").sortWithinPartitions("doc_id")
            .select("doc_id", "text").mapInArrow(run, SCHEMA))
