"""Plain versions of the operators, written for clarity, that the tests compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def repetition(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, chars in duplicated n-grams by n."""
    found = words(text)
    n, chars = len(found), sum(map(len, found))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    lines = [x for x in (text or "").split("\n") if words(x)]

    def inside(length):
        grams = [tuple(found[i : i + length]) for i in range(n - length + 1)]
        count = Counter(grams)
        return {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + length)}

    repeated = len(inside(5))
    failed = n < 10 or 100 * repeated > 20 * n
    shares = {k: sum(len(found[j]) for j in inside(k)) for k in range(5, 11)}
    dup, seen = 0, set()
    for line in lines:
        if line in seen:
            dup += sum(map(len, words(line)))
        seen.add(line)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, failed, shares, dup


def kept(text):
    """The verdict on a text, by the published shares of characters in duplicated n-grams and in repeated lines."""
    *_, failed, shares, dup = found = repetition(text)
    most = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
    return not failed and 100 * dup <= 20 * found[1] and all(100 * c <= most[k] * found[1] for k, c in shares.items())


def contamination(text, items, window=10):
    """n_words, n_hit, n_items, digest of the items' names. items: (id, text) pairs."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    found = re.findall(pattern, ascii_lower(text))
    hit, names = set(), set()
    at = {}
    for length in {min(window, len(re.findall(pattern, ascii_lower(t)))) for _, t in items} - {0}:
        at[length] = {}
        for i in range(len(found) - length + 1):
            at[length].setdefault(tuple(found[i : i + length]), []).append(i)
    for name, item in items:
        ws = re.findall(pattern, ascii_lower(item))
        length = min(window, len(ws))
        for i in range(len(ws) - length + 1 if ws else 0):
            for start in at[length].get(tuple(ws[i : i + length]), ()):
                hit.update(range(start, start + length))
                names.add("" if name is None else str(name))
    return len(found), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def fingerprint(text):
    import xxhash

    ws = words(ascii_lower(text))
    grams = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, near):
    """The smallest position reachable from each position."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def repeats(texts, length=400):
    """n_bytes, n_removed, n_spans and the kept bytes of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        found.append((len(d), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), kept))
    return found
