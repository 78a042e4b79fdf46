"""The operators once more, the plain way, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def byte_repeats(rows, width=100):
    """n_bytes, n_removed, n_spans, digest by doc_id."""
    seen, found = {}, {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if seen.setdefault(data[p : p + width], (doc, p)) != (doc, p):
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        found[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def word_repeats(rows, width=20):
    """n_words, n_removed, digest by doc_id."""
    seen, found = {}, {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = WORDS.findall(text or "")
        gone = [0] * len(words)
        for p in range(len(words) - width + 1):
            if seen.setdefault(tuple(words[p : p + width]), (doc, p)) != (doc, p):
                gone[p : p + width] = [1] * width
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(item)
    sizes, found = {len(w) for w in windows}, []
    for doc, text in rows:
        words, hit, ids = ALNUM.findall(lower(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = windows.get(tuple(words[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    ids |= own
        ids.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        found.append((doc, len(words), len(hit), len(ids), digest, bad))
    return found


def passages(text, items):
    """Spans of hit words, and the items met, of one text."""
    words, spans, ids = ALNUM.findall(lower(text)), [], set()
    for item, own in items:
        held = ALNUM.findall(lower(own))
        size = min(13, len(held))
        own = {tuple(held[i : i + size]) for i in range(len(held) - size + 1 if held else 0)}
        hits = [(i, i + size) for i in range(len(words) - size + 1) if own and tuple(words[i : i + size]) in own]
        spans += hits
        ids |= {item} if hits else set()
    return spans, ids


def merged(spans):
    """Sorted spans without overlap."""
    found = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def simhash(text, digest, width=3):
    words = WORDS.findall(lower(text))
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [digest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def token_counts(rows, train):
    return Counter(w for doc, text in rows if train(doc) for w in [*WORDS.findall(lower(text)), None])
