"""Plain one-machine versions that the operators are held against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_figures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def cut_lines(docs, min_lines=2):
    """(doc_id, text) in id order -> {doc_id: (kept text, lines removed)}; no blank lines inside."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines, gone = (text or "").split("\n"), set()
        for i in range(len(lines) - min_lines + 1):
            run = tuple(lines[i:i + min_lines])
            if all(words(x) for x in run):
                if run in seen:
                    gone.update(range(i, i + min_lines))
                seen.add(run)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


def fingerprint(text, size=3):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < size else [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)]
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def near_groups(prints, radius=2):
    """{doc_id: fingerprint} -> {doc_id: smallest doc_id reachable}."""
    ids = sorted(prints)
    value = np.array([prints[i] for i in ids], np.uint64)
    group = {i: i for i in ids}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(value[k] ^ value[k + 1:]) <= radius):
            a, b = find(ids[k]), find(ids[k + 1 + int(j)])
            group[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def cut_passages(docs, length=50):
    """(doc_id, text) -> {doc_id: (words, kept mask)}."""
    first, split = {}, {i: words(t) for i, t in docs}
    for i in sorted(split):
        for at in range(len(split[i]) - length + 1):
            first.setdefault(tuple(split[i][at:at + length]), i)
    out = {}
    for i, w in split.items():
        keep = [True] * len(w)
        for at in range(len(w) - length + 1):
            if first[tuple(w[at:at + length])] < i:
                keep[at:at + length] = [False] * length
        out[i] = (w, keep)
    return out


def layout_without(text, keep):
    """The kept words in their own layout, pieces joined by a line feed."""
    spans, pieces, begin = [m.span() for m in WORD.finditer(text)], [], None
    for k, (a, b) in enumerate(spans):
        if keep[k]:
            begin = a if begin is None else begin
            end = b
        elif begin is not None:
            pieces.append(text[begin:end])
            begin = None
    if begin is not None:
        pieces.append(text[begin:end])
    return "\n".join(pieces)


def vote_model(codes, rules, start, least, rounds=12, trust=20.0):
    """Posteriors of vote patterns by expectation-maximisation, one row per text."""
    votes = np.array([[code // 3**i % 3 - 1 for i in range(rules)] for code in codes])
    good, right, bad = start["good"], np.full(rules, start["right_good"]), np.full(rules, start["right_bad"])

    def posterior():
        odds = math.log(good / (1 - good)) + np.where(votes == 1, np.log(right / (1 - bad)), np.where(votes == -1, np.log((1 - right) / bad), 0)).sum(1)
        return 1 / (1 + np.exp(-odds))

    clip = lambda hits, of, begin: np.clip((hits + trust * begin) / (of + trust), least, 1 - least)
    for _ in range(rounds):
        p = posterior()
        column = p[:, None]
        right, bad, good = (clip(((votes == 1) * column).sum(0), ((votes != 0) * column).sum(0), start["right_good"]),
                            clip(((votes == -1) * (1 - column)).sum(0), ((votes != 0) * (1 - column)).sum(0), start["right_bad"]),
                            clip(p.sum(), len(p), start["good"]))
    return posterior()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]
