"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import zstandard

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_duplicates(rows: list[tuple]) -> list[tuple]:
    """(id, text) rows to sorted (id, size, component) rows, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def repeats(texts: list[str | None], length: int = 200) -> list[tuple]:
    """(bytes, removed, runs, digest of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[s : s + length] for raw in raws for s in range(len(raw) - length + 1))
    found = []
    for raw in raws:
        cover = [False] * len(raw)
        for s in range(len(raw) - length + 1):
            if seen[raw[s : s + length]] > 1:
                cover[s : s + length] = [True] * length
        runs = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(b for b, c in zip(raw, cover, strict=True) if not c)
        found.append((len(raw), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return found


def base_rules(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = text.split("\n")
    doubles = sum(bool(WORDS.search(line)) and line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubles, len(repeated), failed


def compression_verdict(text: str | None) -> tuple:
    """Full chunks of 2048 bytes, those out of their band, and whether base rules and bands let the text pass."""
    raw = (text or "").encode()

    def ratio(piece: bytes) -> float:
        return len(piece) / len(zstandard.compress(piece, 3)) if piece else 0.0

    full = [raw[2048 * i : 2048 * (i + 1)] for i in range(len(raw) // 2048)]
    odd = len([c for c in full if ratio(c) < 1.2 or ratio(c) > 3.4])
    if len(raw) <= 200:
        low, high = 0.0, 2.2
    elif len(raw) <= 1000:
        low, high = 1.05, 2.8
    elif len(raw) <= 4000:
        low, high = 1.25, 3.4
    else:
        low, high = 1.4, 4.5
    banded = low <= ratio(raw) <= high and not 10 * odd > 3 * len(full)
    return len(full), odd, banded and not base_rules(text)[-1]
