"""Plain Python versions of the corpus operators, row by row and pair by pair."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# SimHash -------------------------------------------------------------------

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows):
    """[(id, text)] -> [(id, fingerprint, component id)]"""
    return [x[:3] for x in _groups(rows)]


def kept_ids(rows):
    """The smallest id of every group."""
    return sorted({group: component for _, _, component, group in _groups(rows)}.values())


def _groups(rows):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[find(i)] = min(key, best.get(find(i), key))
    return [(key, f"{fps[i]:016x}", best.get(find(i)), find(i)) for i, (key, _) in enumerate(rows)]


# Lines ---------------------------------------------------------------------

def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOW)


def dedup_lines(rows):
    holders = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 20:
                holders[line_key(line)].add(key)
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(line_key(line), set())
            top = max((i for i in ids if i is not None), default=None)
            if len(ids) < 3 or key == top:
                kept.append(line)
        out.append((key, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


# Decontamination -----------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(rows, items, window=13):
    windows = defaultdict(set)
    for key, text in items:
        own = words(text)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            windows[tuple(own[k:k + n])].add("" if key is None else str(key))
    lengths = {len(w) for w in windows}
    out = []
    for key, text in rows:
        own, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(own) - n + 1):
                ids = windows.get(tuple(own[k:k + n]))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((key, len(own), len(hit), len(found), sha(",".join(sorted(found))),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return out


# Personal data -------------------------------------------------------------

def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def personal_data(text):
    """[(start, kind index, end)] of the base rules"""
    return sorted((m.start(), i, m.end()) for i, (_, pattern, good) in enumerate(PII)
                  for m in re.finditer(pattern, text or "") if good(m.group()))


def spelled(spans):
    return ",".join(f"{PII[k][0]}:{s}:{e}" for s, k, e in sorted(spans))


# Top-k ---------------------------------------------------------------------

def top_k(rows, k, asks):
    import math

    good = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if asks(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


# Pfair ---------------------------------------------------------------------

def worst_deviation(slots_by_source, parts, period):
    """The largest distance, over all prefixes of a period, of a source from its share, in blocks."""
    worst = Fraction(0)
    for source, slots in slots_by_source.items():
        had = 0
        taken = set(slots)
        for t in range(period + 1):
            worst = max(worst, abs(Fraction(t * parts[source], period) - had))
            had += t in taken
    return worst


def crc(text):
    return zlib.crc32((text or "").encode())
