"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash

SPACE = "\x20\x09-\x0d"


def components(nodes, linked):
    """{node: smallest node reachable} over all pairs."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(f"[^{SPACE}]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows):
    """{id: (hex fingerprint, component)} of (id, text) rows with different ids."""
    prints = {i: fingerprint(t) for i, t in rows}
    part = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    return {i: (f"{prints[i]:016x}", part[i]) for i in prints}


def without_later_runs(rows, min_words):
    """{id: text} of (id, text) rows: a line goes if a run of at least ``min_words`` words around it is found earlier."""
    texts = sorted((i, t.split("\n")) for i, t in rows)
    places = defaultdict(list)
    for d, lines in texts:
        for at, line in enumerate(lines):
            places[line.strip()].append((d, at))
    of, gone = dict(texts), defaultdict(set)
    for d, lines in texts:
        for at, line in enumerate(lines):
            for e, start in places[line.strip()]:
                if (e, start) >= (d, at):
                    break
                n = 0
                while at + n < len(lines) and start + n < len(of[e]) and lines[at + n].strip() == of[e][start + n].strip():
                    n += 1
                if sum(len(x.encode().split()) for x in lines[at : at + n]) >= min_words:
                    gone[d] |= set(range(at, at + n))
    return {d: "\n".join(x for at, x in enumerate(lines) if at not in gone[d]) for d, lines in texts}


def rule_counts(text):
    words = re.findall(f"[^{SPACE}]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(f"[^{SPACE}]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)
