"""External induced suffix sorting with common-prefix values.

Suffixes are sorted by induction: the sorted left-most S suffixes induce the L suffixes in one pass over the
characters upwards, these induce the S suffixes in one pass downwards. The passes run on a radix queue, a priority
queue whose tuples (suffix, common prefix with the one before) leave by character and, within it, in the order they
came; its blocks go to disk when they outgrow `memory`. Blocks are handled whole by numpy: successors are dealt to
their queues by a stable sort on the preceding character, and the common prefix of neighbours that land in one queue
is one more than a range minimum over the block. The order of the left-most S suffixes comes from naming their
substrings (sorted by the same induction) and sorting the string of names, recursively; a string of names that fits
`base_case` is sorted by prefix doubling.

Comparisons stop at `limit` characters: suffixes that agree on so many stand side by side in any order, with the
common prefix value `limit` (at most 255). The text takes one byte a character in memory; all that is several times
larger, the tuples, is in the queues.
"""

from __future__ import annotations

import os
import uuid

import numpy as np


class RadixQueue:
    """Blocks of (position, common prefix) by key; the largest keys' blocks go to files when memory is used up."""

    def __init__(self, folder: str | None, memory: int):
        self.folder, self.memory, self.held, self.blocks = folder, memory, 0, {}
        self.spilled = 0

    def push(self, key: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.blocks.setdefault(key, []).append((position, prefix))
        self.held += position.nbytes + prefix.nbytes
        if self.held > self.memory and self.folder:
            self._spill()

    def _spill(self) -> None:
        for parts in self.blocks.values():
            here = [k for k, p in enumerate(parts) if not isinstance(p, str)]
            if not here:
                continue
            # only whole tails are joined, so that the order of blocks stays as it is
            first = here[0]
            name = os.path.join(self.folder, f"{uuid.uuid4().hex}.npz")
            np.savez(name, p=np.concatenate([p for p, _ in parts[first:]]), c=np.concatenate([c for _, c in parts[first:]]))
            parts[first:] = [name]
            self.spilled += 1
        self.held = 0

    def pop(self, key: int, most: int = 1 << 18):
        """The next tuples of a key, or None: a stored block, or the blocks in memory up to about `most` tuples."""
        parts = self.blocks.get(key)
        if not parts:
            return None
        if isinstance(parts[0], str):
            name = parts.pop(0)
            with np.load(name) as stored:
                out = stored["p"], stored["c"]
            os.remove(name)
            return out
        n = size = 0
        while n < len(parts) and not isinstance(parts[n], str) and (n == 0 or size < most):
            size += len(parts[n][0])
            n += 1
        taken, parts[:n] = parts[:n], []
        self.held -= sum(p.nbytes + c.nbytes for p, c in taken)
        return taken[0] if n == 1 else (np.concatenate([p for p, _ in taken]), np.concatenate([c for _, c in taken]))

    def pop_last(self, key: int):
        """The last block of a key, or None."""
        parts = self.blocks.get(key)
        if not parts:
            return None
        parts.append(parts.pop())
        self.blocks[key] = [parts.pop()]
        try:
            return self.pop(key)
        finally:
            self.blocks[key] = parts


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S type of each suffix, positions of left-most S suffixes); the end counts as smaller than any character."""
    n = len(text)
    small = np.zeros(n, bool)
    if n > 1:
        differ = np.flatnonzero(text[1:] != text[:-1]).astype(np.int32 if n < 2**31 else np.int64)
        # each position takes the answer of the next change; after the last one the end makes it L
        spans = np.diff(differ, prepend=differ.dtype.type(-1))
        known = np.repeat(text[differ + 1] > text[differ], spans)
        small[: len(known)] = known
    return small, np.flatnonzero(small[1:] & ~small[:-1]) + 1


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]) for each pair, ends included."""
    if not len(low):
        return np.empty(0, values.dtype)
    levels, table = np.frexp((high - low + 1).astype(np.float64))[1] - 1, values
    out = np.empty(len(low), values.dtype)
    for level in range(int(levels.max()) + 1):
        if level:
            step = 1 << (level - 1)
            table = np.minimum(table[: len(table) - step], table[step:])
        k = np.flatnonzero(levels == level)
        if len(k):
            out[k] = np.minimum(table[low[k]], table[high[k] - (1 << level) + 1])
    return out


def _run(text: np.ndarray, at: int, limit: int) -> int:
    """How often the character at a place repeats from there on."""
    part = text[at : at + limit]
    stop = np.flatnonzero(part != part[0])
    return int(stop[0]) if len(stop) else len(part)


class _Dealer:
    """Deals the predecessors of a block to the queues, with the common prefixes they have there."""

    def __init__(self, text, small, want_small: bool, queue: RadixQueue, symbols: int, limit: int):
        self.text, self.small, self.want, self.queue, self.limit = text, small, want_small, queue, limit
        self.carry = np.full(symbols, limit, np.uint8)
        self.used = np.zeros(symbols, bool)

    def __call__(self, position: np.ndarray, prefix: np.ndarray) -> None:
        has = position > 0
        before = position - 1
        pick = np.flatnonzero(has & (self.small[before] == self.want))
        least = prefix.min()
        if not len(pick):
            np.minimum(self.carry, least, out=self.carry)
            return
        char = self.text[before[pick]]
        order = np.argsort(char, kind="stable")
        pick, char = pick[order], char[order]
        starts = np.r_[True, char[1:] != char[:-1]]
        low = np.zeros(len(pick), np.int64)
        low[1:] = pick[:-1] + 1
        low[starts] = 0
        value = range_minima(prefix, low, pick)
        first = np.flatnonzero(starts)
        keys = char[first]
        value[first] = np.minimum(value[first], self.carry[keys])
        value = np.minimum(value, self.limit - 1) + 1
        value[first[~self.used[keys]]] = 0
        self.used[keys] = True
        np.minimum(self.carry, least, out=self.carry)
        ends = np.r_[first[1:], len(pick)]
        last = pick[ends - 1]
        tail = np.full(len(last), self.limit, np.uint8)
        some = last + 1 < len(prefix)
        tail[some] = range_minima(prefix, last[some] + 1, np.full(int(some.sum()), len(prefix) - 1))
        self.carry[keys] = tail
        goes = before[pick]
        for k, a, b in zip(keys.tolist(), first.tolist(), ends.tolist()):
            self.queue.push(k, goes[a:b], value[a:b].astype(np.uint8))


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, prefixes: np.ndarray, limit: int, folder: str | None, memory: int):
    """All suffixes in descending order as blocks (position, common prefix with the next larger one before it).

    seeds: left-most S suffixes in ascending order, prefixes: common prefix of each with the one before.
    """
    symbols = int(text.max(initial=0)) + 1
    up, held = RadixQueue(folder, memory), RadixQueue(folder, memory)
    deal = _Dealer(text, small, False, up, symbols, limit)
    edges = np.searchsorted(text[seeds], np.arange(symbols + 1))
    if len(text):
        # the suffix of the last character follows the empty one
        end = len(text) - 1
        up.push(int(text[end]), np.array([end]), np.zeros(1, np.uint8))
        deal.used[text[end]] = True
        deal.carry[text[end]] = 0
    present = np.flatnonzero(np.bincount(text, minlength=symbols)) if len(text) else []
    for char in present:
        char, last = int(char), -1
        while (block := up.pop(char)) is not None:
            deal(*block)
            held.push(char, *block)
            last = int(block[0][-1])
        a, b = int(edges[char]), int(edges[char + 1])
        if a < b:
            own = prefixes[a:b].copy()
            own[0] = 0 if last < 0 else min(limit, _run(text, last, limit), _run(text, int(seeds[a]), limit))
            deal(seeds[a:b], own)
    down = RadixQueue(folder, memory)
    deal = _Dealer(text, small, True, down, symbols, limit)
    for char in present[::-1]:
        char, last = int(char), -1
        while (block := down.pop(char)) is not None:
            deal(*block)
            yield block
            last = int(block[0][-1])
        above = None
        while (block := held.pop_last(char)) is not None:
            # downwards, each suffix carries the common prefix with the one above it
            position, rising = block[0][::-1], block[1]
            prefix = np.empty(len(position), np.uint8)
            prefix[1:] = rising[:0:-1]
            if above is not None:
                prefix[0] = above
            else:
                prefix[0] = 0 if last < 0 else min(limit, _run(text, last, limit), _run(text, int(position[0]), limit))
            above = rising[0]
            deal(position, prefix)
            yield position, prefix


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, counted up to limit characters, by comparing the text itself."""
    limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape)
    out, n = np.zeros(len(a), np.int64), len(text)
    if text.dtype != np.uint8:
        live = np.flatnonzero(limit > 0)
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            inside = np.maximum(x, y) < n
            same = np.zeros(len(live), bool)
            same[inside] = text[x[inside]] == text[y[inside]]
            live = live[same]
            out[live] += 1
            live = live[out[live] < limit[live]]
        return out
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded.data, 0, (1,))
    live = np.flatnonzero((limit > 0) & (np.maximum(a, b) < n))
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        differ = words[x] ^ words[y]
        step = np.full(len(live), 8, np.int64)
        odd = np.flatnonzero(differ)
        lowest = differ[odd] & (~differ[odd] + np.uint64(1))
        step[odd] = (np.frexp(lowest.astype(np.float64))[1] - 1) >> 3
        out[live] += np.minimum(step, n - np.maximum(x, y))
        live = live[(step == 8) & (out[live] < limit[live]) & (np.maximum(a[live], b[live]) + out[live] < n)]
    return np.minimum(out, limit)


def _order(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by first, then second; marks of places in that order whose pair differs from the one before)."""
    n = len(first)
    bits = max(1, int(n + 1).bit_length())
    if 3 * bits <= 64:  # pair and place fit one word: sort the words themselves
        shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        words = (first.astype(np.uint64) << shift | second.astype(np.uint64)) << shift | np.arange(n, dtype=np.uint64)
        words.sort()
        order, pair = (words & mask).astype(np.int64), words >> shift
    else:
        pair = first * (n + 2) + second
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
    return order, np.r_[True, pair[1:] != pair[:-1]]


def double_prefixes(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names (0 to n - 1) by their first `depth` names, ranks doubling their reach."""
    n = len(names)
    rank, reach = names + 1, 1
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - reach)] = rank[reach:]
        order, new = _order(rank, following)
        reach *= 2
        if reach >= depth or new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)


def sorted_seeds(text: np.ndarray, small: np.ndarray, lms: np.ndarray, limit: int, folder: str | None, memory: int, base_case: int) -> np.ndarray:
    """Left-most S suffixes in ascending order (of their first `limit` characters)."""
    if len(lms) < 2:
        return lms
    by_char = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    blocks = [p[is_lms[p]] for p, _ in induce(text, small, by_char, np.zeros(len(lms), np.uint8), 1, folder, memory)]
    order = np.concatenate(blocks)[::-1]
    rank = np.searchsorted(lms, order)
    end = np.r_[lms[1:] + 1, len(text)]  # a substring reaches the next left-most S suffix, included
    size = (end - lms)[rank]
    shared = common_prefixes(text, order[:-1], order[1:], np.minimum(size[:-1], size[1:]))
    same = (size[:-1] == size[1:]) & (shared == size[1:])
    same &= (order[1:] != lms[-1]) & (order[:-1] != lms[-1])
    name = np.cumsum(np.r_[0, ~same])
    if name[-1] + 1 == len(lms):
        return order
    names = np.empty(len(lms), np.int64)
    names[rank] = name
    if len(names) <= base_case:
        # as many names as may be needed for `limit` characters
        return lms[double_prefixes(names, int((np.searchsorted(lms, lms + limit) - np.arange(len(lms))).max()) + 1)]
    inner_small, inner = classify(names)
    seeds = sorted_seeds(names, inner_small, inner, limit, folder, memory, base_case)
    parts = [p for p, _ in induce(names, inner_small, seeds, np.zeros(len(seeds), np.uint8), 1, folder, memory)]
    return lms[np.concatenate(parts)[::-1]]


def suffixes_descending(text: np.ndarray, limit: int, folder: str | None = None, memory: int = 1 << 28, base_case: int = 1 << 24):
    """Blocks (position, common prefix with the suffix before in this order), all suffixes in descending order."""
    small, lms = classify(text)
    seeds = sorted_seeds(text, small, lms, limit, folder, memory, base_case)
    prefixes = np.zeros(len(seeds), np.uint8)
    prefixes[1:] = common_prefixes(text, seeds[:-1], seeds[1:], limit)
    yield from induce(text, small, seeds, prefixes, limit, folder, memory)


def repeated_positions(text: np.ndarray, limit: int, **options) -> np.ndarray:
    """Marks the positions whose first `limit` characters start at another position as well."""
    found, last = np.zeros(len(text), bool), -1
    for position, prefix in suffixes_descending(text, limit, **options):
        hit = prefix >= limit
        found[position[hit]] = True
        above = np.flatnonzero(hit)
        found[position[above[above > 0] - 1]] = True
        if len(hit) and hit[0] and last >= 0:
            found[last] = True
        last = int(position[-1])
    return found
