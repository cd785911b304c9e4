"""Burrows-Wheeler transform of a collection of byte strings, and the classes
of suffixes that share their first ``depth`` bytes.

The classes come from threshold-bounded interval expansion: common-prefix
lengths of neighbouring suffixes are derived by increasing value, breadth
first.  Level 0 cuts the sorted suffixes where first bytes differ; level l + 1
extends backwards over the transform: two neighbours that start with the same
byte share l + 1 bytes unless a cut of level l lies between the suffixes that
follow that byte.  After ``depth`` levels the rows without a cut share at
least ``depth`` bytes with the row before them; longer prefixes are never
computed.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Places of joined strings at most: two ranks and a place share a 64-bit key.
MAX_PLACES = (1 << 21) - 1


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def suffix_order(codes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of all suffixes; ``codes`` > 0, and 0 at string ends, ``left`` the
    codes left until the end of the own string.  Prefix doubling on keys that
    end in the place, so equal suffixes stand in order of place."""
    n = len(codes)
    if n > MAX_PLACES:
        raise ValueError(f"{n} places; at most {MAX_PLACES} fit the keys")
    place_bits, code_bits = _bits(n), _bits(int(codes.max(initial=0)))
    place = np.arange(n, dtype=U64)
    mask = U64((1 << place_bits) - 1)
    step = max(1, (64 - place_bits) // code_bits)
    padded = np.concatenate([codes.astype(U64), np.zeros(step, U64)])
    key = np.zeros(n, U64)
    for d in range(step):
        key <<= U64(code_bits)
        key |= np.where(d < left, padded[d : d + n], U64(0))
    longest = int(left.max(initial=0))
    rank_bits = U64(place_bits)
    while True:
        key <<= rank_bits
        key |= place
        key.sort()
        order = (key & mask).astype(np.int64)
        key >>= rank_bits
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        if step >= longest or new.all():
            return order
        rank = np.empty(n, U64)
        rank[order] = np.cumsum(new).astype(U64)
        after = np.zeros(n, U64)
        after[:-step] = rank[step:]
        key = ((rank - U64(1)) << rank_bits) | np.where(step < left, after, U64(0))
        step *= 2


def prefix_classes(joined: np.ndarray, first: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """For the places of the joined strings (bytes, each string followed by
    one end byte of any value; ``first`` and ``lengths`` say where they are)
    the class of each place: equal where at least ``depth`` bytes from there
    on are equal and lie within the strings, -1 where fewer bytes are left."""
    n = len(joined)
    ends = first + lengths
    # the bytes in use, numbered from 1; 0 marks the ends
    used = np.zeros(256, bool)
    used[joined] = True
    codes = np.cumsum(used)[joined].astype(np.int64)
    codes[ends] = 0
    left = np.repeat(ends, lengths + 1) - np.arange(n)
    order = suffix_order(codes, left)
    # the transform: the code before each sorted suffix; its stable sort leads back to the row of the suffix one byte on
    before = codes[order - 1].astype(U64)
    place_bits = U64(_bits(n))
    follow = np.sort((before << place_bits) | np.arange(n, dtype=U64))
    follow = (follow & U64((1 << int(place_bits)) - 1)).astype(np.int32)
    head = codes[order]
    cut = np.ones(n, bool)
    cut[1:] = (head[1:] != head[:-1]) | (head[1:] == 0)
    new = np.flatnonzero(cut)
    # a row whose follower stands right after its neighbour's depends on that one row; the others on a range of rows
    beside = np.zeros(n, bool)
    beside[1:] = ~cut[1:] & (follow[1:] == follow[:-1] + 1)
    by_follower = np.zeros(n, np.int32)
    by_follower[follow] = np.arange(n, dtype=np.int32)
    far = np.flatnonzero(~cut & ~beside)
    low, high = follow[far - 1], follow[far]
    for _ in range(depth - 1):
        if not len(new):
            break
        near = by_follower[new]
        near = near[beside[near] & ~cut[near]]
        upto = np.cumsum(cut, dtype=np.int32)
        parted = upto[high] != upto[low]
        new = np.concatenate([near, far[parted]])
        cut[new] = True
        far, low, high = far[~parted], low[~parted], high[~parted]
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(cut) - 1
    group[left < depth] = -1
    return group
