"""Byte-pair steps on single words: symbols are characters, a word is a string of them."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable

_FIRST_SURROGATE, _SURROGATES = 0xD800, 0x800
_SHORT = 64
_PLACE = 40


def symbol(index: int) -> str:
    return chr(index if index < _FIRST_SURROGATE else index + _SURROGATES)


def order(pair: str, count: int) -> tuple:
    """Most frequent first; among equals the pair whose newer symbol is older, then the lower pair."""
    return -count, max(pair), pair


def hot_segments(word: str, hot: set[str]) -> list[str]:
    """The longest parts of a word in which all neighbours form a hot pair."""
    found, start = [], 0
    for i in range(1, len(word) + 1):
        if i == len(word) or word[i - 1 : i + 1] not in hot:
            if i - start > 1:
                found.append(word[start:i])
            start = i
    return found


def next_merges(segments: Iterable[tuple[str, int]], limit: tuple | None, first: int, most: int) -> list[str]:
    """The merges that one-by-one merging of the whole corpus makes next, found on its hot segments.

    Hot are the first pairs in `order`; `limit` is the place of the first other pair. Counts of old pairs only fall, so
    no other old pair comes before the limit later. A pair that holds a new symbol stands, wherever it occurs, across one
    and the same old pair, and comes behind that one. So all pairs before the limit have all their occurrences inside
    segments. `first` numbers the first new symbol."""
    words, weights = [], []
    counts: dict[str, int] = defaultdict(int)
    where: dict[str, set[int]] = defaultdict(set)
    for at, (word, n) in enumerate(segments):
        words.append(word)
        weights.append(n)
        for pair in map("".join, zip(word, word[1:])):
            counts[pair] += n
            where[pair].add(at)
    heap = [order(pair, n) for pair, n in counts.items()]
    heapq.heapify(heap)
    taken: list[str] = []
    while heap and len(taken) < most:
        negative, _, pair = heapq.heappop(heap)
        count = counts[pair]
        if count != -negative:
            continue  # an entry with the right count was pushed when the count changed
        if count <= 0 or (limit is not None and order(pair, count) >= limit):
            break
        new = symbol(first + len(taken))
        taken.append(pair)
        changed = set()
        for at in where.pop(pair):
            old, n = words[at], weights[at]
            merged = old.replace(pair, new)
            if merged == old:
                continue
            words[at] = merged
            for p in map("".join, zip(old, old[1:])):
                counts[p] -= n
                changed.add(p)
            for p in map("".join, zip(merged, merged[1:])):
                counts[p] += n
                where[p].add(at)
                changed.add(p)
        for p in changed:
            if counts[p] > 0:
                heapq.heappush(heap, order(p, counts[p]))
    return taken


def merge_symbols(word: str, merges: dict[str, tuple[int, str]]) -> str:
    """A word after merges in their order; `merges` gives each pair its place in the order and its new symbol."""
    if len(word) > _SHORT:
        for pair, (_, new) in merges.items():
            word = word.replace(pair, new)
        return word
    while True:
        best = min((merges[p][0], p) for p in pairs) if (pairs := [p for p in map("".join, zip(word, word[1:])) if p in merges]) else None
        if best is None:
            return word
        word = word.replace(best[1], merges[best[1]][1])


def _encode_short(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts, get, none = [raw[i : i + 1] for i in range(len(raw))], ranks.get, 1 << _PLACE
    near = [get(raw[i : i + 2], none) for i in range(len(raw) - 1)]
    while near and (rank := min(near)) != none:
        i = near.index(rank)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del near[i]
        if i < len(near):
            near[i] = get(parts[i] + parts[i + 1], none)
        if i:
            near[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def encode_word(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours with the lowest rank, leftmost first, until no neighbours form a token. In a long word
    neighbours are linked and candidates wait in a heap, so n bytes take n log n steps."""
    n = len(raw)
    if n <= _SHORT:
        return _encode_short(raw, ranks)
    parts: list[bytes | None] = [raw[i : i + 1] for i in range(n)]
    get = ranks.get
    heap = [(rank << _PLACE) + i for i in range(n - 1) if (rank := get(raw[i : i + 2])) is not None]
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    low = (1 << _PLACE) - 1
    while heap:
        entry = heapq.heappop(heap)
        i = entry & low
        left = parts[i]
        j = after[i]
        if left is None or j == n or get(left + parts[j]) != entry >> _PLACE:
            continue  # a neighbour changed meanwhile
        left += parts[j]
        parts[i], parts[j] = left, None
        j = after[j]
        after[i] = j
        if j < n:
            before[j] = i
            if (rank := get(left + parts[j])) is not None:
                heapq.heappush(heap, (rank << _PLACE) + i)
        j = before[i]
        if j >= 0 and (rank := get(parts[j] + left)) is not None:
            heapq.heappush(heap, (rank << _PLACE) + j)
    return [ranks[p] for p in parts if p is not None]
