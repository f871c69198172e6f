"""Suffix arrays by induced sorting, and permuted common prefixes.

`suffix_array` classifies suffixes into smaller (S) and larger (L) than their right neighbour,
sorts the substrings between leftmost S suffixes by inducing, names them, sorts the string of
names by itself where two names are equal, and induces the whole array from that order.

Inducing reads the array from one end and puts the left neighbour of what it reads further on, so
slots as far as the nearest one still to be filled are final. They are read as one step of numpy
calls, which serves bytes and large alphabets of names alike.

`permuted_lcp` compares texts only at irreducible places; at any other the common prefix with
the next smaller suffix is one shorter than at the place before.

Arrays of one shard; nothing here knows Spark.
"""

from __future__ import annotations

import numpy as np

STEP = 1 << 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of `text` (numbers from 0) in order; an end of text is smaller than
    any number."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _s_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if not len(lms):
        return _induce(text, small, lms)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    array = _induce(text, small, lms)
    order = array[is_lms[array]]
    names, count = _names(text, order, lms)
    if count < len(lms):
        order = lms[_sorted_names(names)]
    return _induce(text, small, order)


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The suffix array of `names`. A name that stands alone decides every comparison, so what
    follows it is left out of the string to sort, but for the next repeated name."""
    alone = np.bincount(names)[names] == 1
    kept = ~alone
    kept[1:] |= ~alone[:-1]
    places = np.flatnonzero(kept)
    there = np.unique(names[places], return_inverse=True)[1].astype(np.int32)
    order = places[suffix_array(there)]
    mixed = np.concatenate([order[~alone[order]], np.flatnonzero(alone)])
    return mixed[np.argsort(names[mixed], kind="stable")]


def _s_types(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the next: decided where a run of equal
    numbers ends; the last run meets the end, which is smaller."""
    differs = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(differs, len(text) - 1)
    up = np.append(text[differs] < text[differs + 1], False)
    return np.repeat(up, np.diff(np.append(-1, ends)))


def _ranked(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by number, the different numbers, how often each comes, and, in that order,
    each item's group and rank within it."""
    order = numbers.argsort(kind="stable")
    sorted_ = numbers[order]
    edge = np.ones(len(numbers), dtype=bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=edge[1:])
    first = edge.nonzero()[0]
    group = edge.cumsum() - 1
    return order, sorted_[first], group, np.arange(len(numbers)) - first[group]


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array from the leftmost S places in `lms`, correct as far as their order is."""
    n = len(text)
    sizes = np.bincount(text)
    ends = np.cumsum(sizes)
    array = np.full(n, -1, dtype=np.int32)
    if len(lms):
        order, kinds, group, rank = _ranked(text[lms])
        seeds = (ends[kinds] - np.bincount(group))[group] + rank
        array[seeds] = lms[order]

    head = ends - sizes
    array[head[text[-1]]] = n - 1  # the empty suffix, smaller than all, induces the last place
    head[text[-1]] += 1
    at, step = 0, STEP
    while at < n:
        stop = min(at + step, n)
        slots = array[at:stop]
        read = (slots > 0).nonzero()[0]
        before = slots[read] - 1
        larger = ~small[before]
        before = before[larger]
        if len(before):
            numbers = text[before]
            nearest = int(head[numbers].min())
            if nearest < stop:  # slots from there on are not final
                stop = nearest
                now = np.count_nonzero(read[larger] < stop - at)
                before, numbers = before[:now], numbers[:now]
            if len(before):
                order, kinds, group, rank = _ranked(numbers)
                array[head[kinds][group] + rank] = before[order]
                head[kinds] += np.bincount(group)
        step, at = min(max(2 * (stop - at), 256), STEP), stop

    if len(lms):
        array[seeds] = -1
    tail = ends
    at, step = n, STEP  # slots from `at` on are read
    while at > 0:
        stop = max(at - step, 0)
        slots = array[stop:at][::-1]
        read = (slots > 0).nonzero()[0]
        before = slots[read] - 1
        smaller = small[before]
        before = before[smaller]
        if len(before):
            numbers = text[before]
            nearest = int(tail[numbers].max())
            if nearest > stop:
                stop = nearest
                now = np.count_nonzero(read[smaller] < at - stop)
                before, numbers = before[:now], numbers[:now]
            if len(before):
                order, kinds, group, rank = _ranked(numbers)
                array[tail[kinds][group] - 1 - rank] = before[order]
                tail[kinds] -= np.bincount(group)
        step, at = min(max(2 * (at - stop), 256), STEP), stop
    return array


def _names(text: np.ndarray, order: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for every leftmost S substring, in text order, equal for equal ones and growing
    with their order; how many there are. `order` has the places sorted by substring."""
    after = np.append(lms[1:], len(text) - 1)
    at = np.searchsorted(lms, order)
    length = (after - lms + 1)[at]
    last = at == len(lms) - 1  # reaches the end of the text, like no other
    same = (length[1:] == length[:-1]) & ~last[1:] & ~last[:-1]
    left = np.flatnonzero(same)
    a, b, size = order[left], order[left + 1], length[left]
    offset = 0
    while len(left):
        differ = text[a + offset] != text[b + offset]
        same[left[differ]] = False
        offset += 1
        go = ~differ & (size > offset)
        left, a, b, size = left[go], a[go], b[go], size[go]
    number = np.cumsum(np.append(0, ~same))
    names = np.empty(len(lms), dtype=np.int32)
    names[at] = number
    return names, int(number[-1]) + 1


def permuted_lcp(text: np.ndarray, array: np.ndarray, breaks: np.ndarray, limit: int) -> np.ndarray:
    """For each place, how many bytes its suffix shares with the next smaller one, in text order.
    Compared are at most `limit` bytes from a place, and every place of `breaks` is compared, so a
    value is exact below `limit` less the distance to the last break."""
    n = len(text)
    before = np.full(n, -1, dtype=np.int32)  # the next smaller suffix of each place
    before[array[1:]] = array[:-1]
    place = np.arange(n, dtype=np.int32)
    fresh = (before < 1) | (place < 1)
    fresh |= text[np.maximum(place - 1, 0)] != text[np.maximum(before - 1, 0)]
    fresh[breaks] = True
    i = np.flatnonzero(fresh & (before >= 0)).astype(np.int32)
    j, at, depth = before[i], i.copy(), 0
    shared = np.zeros(n, dtype=np.int32)
    padded = np.concatenate([text, np.zeros(limit + 8, dtype=text.dtype)])
    end = n - np.maximum(i, j)  # the shorter of two suffixes ends both
    while len(i) and depth < limit:
        go = (padded[i + depth] == padded[j + depth]) & (end > depth)
        shared[at[~go]] = depth
        i, j, at, end = i[go], j[go], at[go], end[go]
        depth += 1
    shared[at] = depth
    source = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(shared[source] - (place - source), 0)
