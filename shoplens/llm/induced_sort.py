"""Suffix sorting of one shard by induced sorting, with queues that spill to disk.

The order of the leftmost S-type suffixes is found by sorting the substrings between them, and by the same
procedure over their names where names repeat. From it the L-type suffixes are induced in ascending order and
from these the S-type ones in descending order. Induction runs block by block of first symbols: what a block
induces for later blocks waits in a queue whose oldest content is on disk; inside a block as many entries are
taken at once as no new entry can precede.
"""

import tempfile

import numpy as np

HELD = 1 << 22  # positions of all queues that stay in memory


class BlockQueue:
    """One first-in-first-out queue of positions for each block; contents beyond HELD positions go to one file."""

    def __init__(self, blocks, held=HELD):
        self.parts, self.size, self.held, self.file = [[] for _ in range(blocks)], 0, held, None

    def push(self, block, positions):
        if len(positions):
            self.parts[block].append(positions)
            self.size += len(positions)
            if self.size > self.held:
                self._spill()

    def _spill(self):
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if not isinstance(part, tuple):
                    at = self.file.tell()
                    self.file.write(part.tobytes())
                    parts[i] = (at, len(part))
        self.size = 0

    def take(self, block):
        out = []
        for part in self.parts[block]:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(8 * part[1]), np.int64)
            else:
                self.size -= len(part)
            out.append(part)
        self.parts[block] = []
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def close(self):
        if self.file is not None:
            self.file.close()


def _blocks(symbols, sigma):
    """Block of each symbol: a frequent symbol is a block of its own, rare neighbours share one."""
    counts = np.bincount(symbols, minlength=sigma)
    target = max(1, 4 * int(np.sqrt(len(symbols))))
    return np.maximum.accumulate((np.cumsum(counts) - counts) // target) if sigma > 512 else np.arange(sigma)


def _stable_order(keys):
    """Stable order of small keys; those of a narrow range are sorted in linear time."""
    low = keys.min()
    return np.argsort((keys - low).astype(np.uint16) if keys.max() - low < 65536 else keys, kind="stable")


def _induce(symbols, sigma, seeds, wanted, held):
    """All positions in `wanted` in ascending order of their suffixes, induced from the ordered `seeds`.

    Entries of one symbol come first if induced, then seeds; a seed or an induced entry at i induces i - 1.
    """
    block_of = _blocks(symbols, sigma)
    block_of = np.unique(block_of, return_inverse=True)[1]
    blocks = int(block_of[-1]) + 1
    last = np.searchsorted(block_of, np.arange(blocks), "right") - 1  # the largest symbol of each block
    queue, out = BlockQueue(blocks, held), []
    seed_blocks = block_of[symbols[seeds]]
    ends = np.searchsorted(seed_blocks, np.arange(blocks), "right")
    begin = 0
    for block in range(blocks):
        pending, own = queue.take(block), seeds[begin:ends[block]]
        begin = ends[block]
        if not len(pending) and not len(own):
            continue
        entries = np.concatenate([pending, own])
        keys = symbols[entries] * 2 + np.repeat([0, 1], [len(pending), len(own)])
        while len(entries):
            order = _stable_order(keys)
            entries, keys = entries[order], keys[order]
            before = entries - 1
            fine = (before >= 0) & wanted[before]
            heads = np.where(fine, symbols[before], sigma)
            inside = np.where(heads <= last[block], heads * 2, 2 * sigma + 2)
            least = np.minimum.accumulate(inside)
            late = np.flatnonzero(keys[1:] > least[:-1])
            stop = int(late[0]) + 1 if len(late) else len(entries)
            done = entries[:stop]
            out.append(done[keys[:stop] % 2 == 0])
            new = before[:stop][fine[:stop]]
            places = block_of[symbols[new]]
            here = places == block
            entries = np.concatenate([entries[stop:], new[here]])
            keys = np.concatenate([keys[stop:], symbols[new[here]] * 2])
            new, places = new[~here], places[~here]
            if len(new):
                order = _stable_order(places)
                new, places = new[order], places[order]
                cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
                for a, b in zip(cuts, np.r_[cuts[1:], len(new)]):
                    queue.push(int(places[a]), new[a:b])
    queue.close()
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _names(symbols, sigma, falls, places):
    """Dense ranks of the substrings between neighbouring `places`, both ends included, in their sorting order."""
    typed = symbols * 2 + ~falls  # a symbol that is followed by smaller ones sorts first
    bits = int(2 * sigma).bit_length()
    per = 62 // bits
    lengths = np.diff(np.r_[places, places[-1]]) + 1
    names, at = np.zeros(len(places), np.int64), 0
    active = np.arange(len(places))
    while len(active):
        word = np.zeros(len(active), np.int64)
        for i in range(at, at + per):
            offset = places[active] + i
            here = i < lengths[active]
            word = (word << bits) | np.where(here, typed[np.minimum(offset, len(typed) - 1)] + 1, 0)
        extra = np.zeros(len(places), np.int64)
        extra[active] = np.unique(word, return_inverse=True)[1] + 1
        names = np.unique(names * (len(places) + 2) + extra, return_inverse=True)[1]
        at += per
        active = active[lengths[active] > at]
    return names


def suffix_array(symbols, sigma, held=HELD):
    """Positions in the order of their suffixes. `symbols`: int64 from 0 to sigma - 1, the last one the only 0."""
    n = len(symbols)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(np.diff(symbols))
    next_change = np.where(step != 0, np.arange(n - 1), n)
    next_change = np.minimum.accumulate(next_change[::-1])[::-1]
    falls = np.r_[step[np.minimum(next_change, n - 2)] < 0, False]  # L-type; the end is S-type
    left = np.flatnonzero(np.r_[False, falls[:-1] & ~falls[1:]])  # leftmost S-type
    names = _names(symbols, sigma, falls, left)
    count = int(names.max()) + 1
    if count == len(left):
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_array(names, count, held)
    ascending = _induce(symbols, sigma, left[order], falls, held)
    mirrored = sigma - 1 - symbols
    descending = _induce(mirrored, sigma, ascending[::-1], ~falls, held)
    both = np.concatenate([ascending, [n - 1], descending[::-1]])
    return both[np.argsort(symbols[both] * 2 + ~falls[both], kind="stable")]
