"""Sampled SentencePiece segmentations without replacement, and decoding.

A text is a lattice: every vocabulary piece that matches at a place is an edge, with a weight from
its rank in the vocabulary; characters without a piece become their bytes. The distribution over
whole segmentations is the product of edge probabilities, found by a backward pass. Gumbel top-k by
perturbed A-star search: the best perturbed value of a set of segmentations is known from the set's
probability alone, so the search samples one segmentation, splits the rest of its set by the first
token that differs, gives each part the perturbed maximum that its probability and the value above
it imply, and goes on with the part whose value is largest. The first k are distinct and are
exactly the k largest of all perturbed segmentations; the next value is the threshold from which
the inclusion scores follow.

All randomness is a hash of seed, row key, rank and place, so results depend on neither batches nor
tasks. Lattices are built once per different word (a word never shares a piece with the next one),
words of one ending share its states, and all are kept up to a bounded number of states: about 80
bytes each and 120 a word, so some 70 MB a task beside the words of one batch. Endings are told
apart by 64-bit hashes; `restored` would show a clash. Vocabulary pieces that run over the end of a word, if a
vocabulary has any, are not used.

Defined results: a null or empty text has one segmentation without pieces; a text with fewer than
k segmentations gives all of them, with inclusion probability 1; rows with one key and text give
equal samples; an empty table gives no rows. Only the key and the text are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TOP = 2
SEED = 17
MARK = "▁"
MARK_BYTES = MARK.encode()
STATES = 600_000  # kept between batches
LEARN_CHARS = 60_000  # words whose lattices are built together
STEP = 0x5851F42D4C957F2D
BATCH_CHARS = 400_000  # texts that are sampled together
RESULT = "doc_id long, rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double, restored boolean"


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[int, float]]  # text -> id, log weight
    byte_ids: list[int]
    byte_weight: float
    content: list[bytes]  # of every id
    longest: int


def load(path: str = MODEL) -> Vocabulary:
    """A vocabulary with weights by rank (Zipf): 1 / (1 + rank). Read on the driver and sent along."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, content, byte_ids = {}, [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            content.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            content.append(b"")
        else:
            content.append(piece.replace(MARK, " ").encode())
            if MARK not in piece.lstrip(MARK):
                pieces[piece] = (i, -float(np.log1p(-model.get_score(i))))
    worst = min(w for _, w in pieces.values())
    total = np.log(sum(np.exp(w) for _, w in pieces.values()) + 256 * np.exp(worst))
    return Vocabulary(
        {p: (i, w - total) for p, (i, w) in pieces.items()}, byte_ids, float(worst - total), content, max(map(len, pieces)))


def cut(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, each with the blank that encoding puts before it, cut where no piece can run across:
    the different words (in UTF-8, with the blanks before them), which of them come one after the other, and
    how many each text has. A line feed or a piece's mark is a word, as are blanks that end a line."""
    raw = [f" {t}".encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    data = b"".join(raw)
    code = np.frombuffer(data, np.uint8)
    if not len(code):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    blank, alone = code == 32, code == 10
    begins = np.empty(len(code) + 1, bool)
    begins[:-1], begins[-1] = alone, True
    begins[1:] |= alone
    begins[1:-1] |= blank[1:] & ~blank[:-1]
    if MARK_BYTES in data:
        marks = np.array([m.start() for m in re.finditer(MARK_BYTES, data)])
        begins[marks] = begins[marks + len(MARK_BYTES)] = True
    begins[0] = True
    begins[ends] = True
    places = np.flatnonzero(begins)
    found = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)])
    found = found.dictionary_encode()
    words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    return words, found.indices.to_numpy(), np.diff(np.searchsorted(places, ends), prepend=0)


def decode(ids, vocabulary: Vocabulary) -> str:
    out = b"".join(map(vocabulary.content.__getitem__, ids))
    return out[1:].decode("utf-8", "replace") if out[:1] == b" " else out.decode("utf-8", "replace")


def _longer(array: np.ndarray, size: int, used: int) -> np.ndarray:
    """The first `used` entries in an array with room for `size` and a quarter more."""
    new = np.empty(size + size // 4, array.dtype)
    new[:used] = array[:used]
    return new


class Contents:
    """The bytes of all ids in one array."""

    def __init__(self, vocabulary: Vocabulary):
        self.array = pa.array(vocabulary.content, pa.binary())

    def spell(self, ids: np.ndarray) -> bytes:
        taken = self.array.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int32)
        return taken.buffers()[2].to_pybytes()[: ends[len(ids)]] if len(ids) else b""


class Beginnings:
    """The hashes of all beginnings of pieces that have one length, with id (or -1) and weight, found
    by their upper bits in a table at most a quarter full."""

    def __init__(self, found: dict[int, tuple[int, float]]):
        self.keys = np.array([*found, 0], np.uint64)  # a hash that is not there meets the last one
        self.ids = np.array([i for i, _ in found.values()], np.int32)
        self.weights = np.array([w for _, w in found.values()])
        bits = max(len(found), 1).bit_length() + 2
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        for i, slot in enumerate(self._slot(self.keys[:-1]).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.slots[slot] = i

    def _slot(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `h` are there, and the places of those."""
        slot = self._slot(h)
        place = self.slots[slot]
        hit = (self.keys[place] == h) & (place >= 0)
        other = np.flatnonzero(~hit & (place >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            place[other] = self.slots[slot[other]]
            there = place[other] >= 0
            hit[other] = there & (self.keys[place[other]] == h[other])
            other = other[there & ~hit[other]]
        return hit, place[hit]


class Lattices:
    """The lattices of all words seen so far, as flat arrays over states and edges. A state is a
    place in a word, known by the rest of the word; its edges run from the longest piece to the shortest."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # for every length the hashes of all beginnings of pieces, with id (or -1) and weight
        beginnings: list[dict[int, tuple[int, float]]] = [{} for _ in range(vocabulary.longest + 1)]
        for piece, (i, weight) in vocabulary.pieces.items():
            h = 0
            for n, c in enumerate(piece, 1):
                h = (h * STEP + ord(c) + 1) % (1 << 64)
                beginnings[n].setdefault(h, (-1, 0.0))
            beginnings[len(piece)][h] = (i, weight)
        self.tables = [Beginnings(found) for found in beginnings]
        self.clear()

    def clear(self):
        self.roots: dict[bytes, int] = {}
        self.wide: list[list[int]] = []  # ids of edges that stand for several pieces
        self.n = self.edges = 0
        self.first = np.zeros(1 << 10, np.int32)  # first edge of every state, one more at the end
        self.after = np.zeros(1 << 10)  # log weight of all ways from every state to the end of its word
        self.endings, self.ending = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, their states
        self.cum, self.logp = np.zeros(1 << 10), np.zeros(1 << 10)
        self.next, self.piece = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int32)

    def learn(self, units: list[bytes]) -> np.ndarray:
        """Add the lattices of words that are not known yet, many together; gives their roots."""
        sizes = np.cumsum(list(map(len, units)))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // LEARN_CHARS)) + 1).tolist(), len(units)]
        return np.concatenate([self._learn(units[a:b], np.diff(sizes[a:b], prepend=sizes[a - 1] if a else 0)) for a, b in zip(cuts[:-1], cuts[1:])])

    def _learn(self, units: list[bytes], lengths: np.ndarray) -> np.ndarray:
        raw = b"".join(units)
        text = raw.decode("utf-8", "surrogatepass")
        if len(text) < len(raw):
            # a character has one byte that continues no other
            begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            lengths = np.add.reduceat(begins, np.cumsum(lengths) - lengths, dtype=np.int64)
        points = np.frombuffer(text.replace(" ", MARK).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        points[np.cumsum(lengths)[np.array([u == MARK_BYTES for u in units])] - 1] = 1 << 21  # a sign of the text, not a blank
        stops = np.cumsum(lengths)
        begin = stops - lengths
        left = np.repeat(stops, lengths) - np.arange(len(points))
        state, fresh = self._states(points, stops, lengths, left)
        if len(fresh):
            self._edges(text, points, left, state, fresh)
        roots = state[begin]
        self.roots.update(zip(units, roots.tolist()))
        return roots

    def _states(self, points, stops, lengths, left):
        """The state of every place, and a place for each new one, the nearest to an end first."""
        with np.errstate(over="ignore"):
            power = np.repeat(np.array([[STEP], [pow(STEP, -1, 1 << 64)]], np.uint64), len(points), axis=1)
            power[:, 0] = 1
            power = np.multiply.accumulate(power, axis=1)
            terms = (points + np.uint64(1)) * power[0]
            sums = np.cumsum(terms)
            rest = (np.repeat(sums[stops - 1], lengths) - sums + terms) * power[1]
            rest = _mix(rest + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hashes, one, which = np.unique(rest, return_index=True, return_inverse=True)
        number, at = np.full(len(hashes), -1, np.int64), np.searchsorted(self.endings, hashes)
        if len(self.endings):
            place = np.minimum(at, len(self.endings) - 1)
            number = np.where(self.endings[place] == hashes, self.ending[place], number)
        new = np.flatnonzero(number < 0)
        fresh = one[new]
        distance = left[fresh]
        # short numbers are sorted by their digits
        short = len(fresh) and distance.max() < 1 << 16
        order = np.argsort(distance.astype(np.uint16) if short else distance, kind="stable")
        number[new[order]] = np.arange(self.n, self.n + len(new))
        self.endings = np.insert(self.endings, at[new], hashes[new])
        self.ending = np.insert(self.ending, at[new], number[new].astype(np.int32))
        return number[which], fresh[order]

    def _edges(self, text: str, points, left, state, fresh) -> None:
        """The edges of the new states, which begin at the places `fresh`."""
        vocabulary, n = self.vocabulary, len(fresh)
        found = []
        at, h = fresh, np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for size in range(1, vocabulary.longest + 1):
                h = h * np.uint64(STEP) + points[at + size - 1] + np.uint64(1)
                table = self.tables[size]
                hit, place = table.find(h)
                at, h = at[hit], h[hit]
                whole = table.ids[place] >= 0
                found.append((at[whole], size, table.ids[place[whole]], table.weights[place[whole]]))
                on = left[at] > size
                at, h = at[on], h[on]
                if not len(at):
                    break
        single = np.zeros(len(points), bool)
        single[found[0][0]] = True
        spelled, ids, weights = fresh[~single[fresh]], [], []
        for i in spelled.tolist():
            raw = [vocabulary.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass")]
            if len(raw) > 1:
                self.wide.append(raw)
            ids.append(raw[0] if len(raw) == 1 else -len(self.wide))
            weights.append(len(raw) * vocabulary.byte_weight)
        found.append((spelled, 1, np.array(ids, np.int32), np.array(weights, np.float64)))
        found.sort(key=lambda f: -f[1])
        # a state has at most one edge of a size, and those of one size are placed together
        places = [state[f[0]] - self.n for f in found]
        counts = np.zeros(n, np.int64)
        for at in places:
            counts[at] += 1
        stop = np.cumsum(counts)
        start = stop - counts
        free = start.copy()
        piece, weight, follow = np.empty(stop[-1], np.int32), np.empty(stop[-1]), np.empty(stop[-1], np.int64)
        for (at, size, ids, weights), states in zip(found, places):
            edge = free[states]
            free[states] = edge + 1
            piece[edge], weight[edge] = ids, weights
            last = left[at] == size
            follow[edge] = np.where(last, -1, state[np.where(last, 0, at + size)])
        # backward pass: log weight of all ways to the end, the nearest states first
        if self.n + n > len(self.after):
            self.after = _longer(self.after, self.n + n, self.n)
        after = self.after[self.n : self.n + n]
        whole = np.empty(len(weight))
        bounds = np.flatnonzero(np.diff(left[fresh], prepend=0, append=0)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            e, f = start[a], stop[b - 1]
            value = weight[e:f] + np.where(follow[e:f] < 0, 0.0, self.after[follow[e:f]])
            begin = start[a:b] - e
            top = np.maximum.reduceat(value, begin)
            after[a:b] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts[a:b])), begin))
            whole[e:f] = value
        logp = np.minimum(whole - np.repeat(after, counts), 0.0)
        p = np.exp(logp)
        total = np.cumsum(p)
        inside = total - np.repeat(total[start] - p[start], counts)
        inside[stop - 1] = 1.0
        self._append(inside, logp, follow, piece, stop)
        self.n += n

    def _append(self, cum, logp, follow, piece, stop):
        m = self.edges + len(cum)
        if m > len(self.cum):
            for name in ("cum", "logp", "next", "piece"):
                setattr(self, name, _longer(getattr(self, name), m, self.edges))
        if self.n + len(stop) + 1 > len(self.first):
            self.first = _longer(self.first, self.n + len(stop) + 1, self.n + 1)
        for array, new in ((self.cum, cum), (self.logp, logp), (self.next, follow), (self.piece, piece)):
            array[self.edges : m] = new
        self.first[self.n + 1 : self.n + 1 + len(stop)] = stop + self.edges
        self.edges = m

    def choose(self, states: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state by its probability."""
        edge = self.first[states]
        open_ = np.flatnonzero(u >= self.cum[edge])
        while len(open_):
            edge[open_] += 1
            open_ = open_[u[open_] >= self.cum[edge[open_]]]
        return edge

    def ids(self, edges: np.ndarray) -> np.ndarray:
        got = self.piece[edges]
        if (got >= 0).all():
            return got.astype(np.int32)
        return np.array([i for p in got.tolist() for i in ([p] if p >= 0 else self.wide[-p - 1])], np.int32)


# --- hashed randomness ------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(*parts) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.uint64(0x9E3779B97F4A7C15)
        for part in parts:
            x = _mix(x ^ (np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """A hash as a number in (0, 1)."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def uniform(*parts) -> np.ndarray:
    return unit(hashed(*parts))


def gumbel(*parts) -> np.ndarray:
    return -np.log(-np.log(uniform(*parts)))


def truncated(location, ceiling, noise):
    """The maximum of a set with log probability `location`, given that it lies below `ceiling`."""
    return -np.logaddexp(-ceiling, -(location + noise))


def log_inclusion(log_prob: float, threshold: float) -> float:
    """log of 1 - exp(-exp(log_prob - threshold))."""
    gap = log_prob - threshold
    if gap > 700:
        return 0.0
    return gap if gap < -30 else float(np.log(-np.expm1(-np.exp(gap))))


# --- the search -------------------------------------------------------------------------------

@dataclass
class Path:
    edges: np.ndarray
    words: np.ndarray  # place of each edge's word in the batch
    before: np.ndarray  # log probability of the edges before each one
    value: float  # perturbed log probability

    @property
    def log_prob(self) -> float:
        return float(self.before[-1])


class Search:
    """The searches of several texts, step by step together."""

    def __init__(self, lattices: Lattices, texts: list[str], keys: np.ndarray, k: int, seed: int):
        self.lattices, self.k = lattices, k
        words, which, sizes = cut(texts)
        roots = np.fromiter(map(lattices.roots.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(roots < 0)
        if len(new):
            roots[new] = lattices.learn(list(map(words.__getitem__, new.tolist())))
        self.roots = roots[which]
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.keys = hashed(seed, keys.astype(np.int64))

    def descend(self, words: np.ndarray, states: np.ndarray, rank: int):
        """Sample from `states` to the end of their words: (edges, words) in text order."""
        lattices = self.lattices
        owner = self.owner[words]
        word = hashed(self.keys[owner], (words - self.starts[owner]) * 8 + rank)
        taken, slot = [], np.arange(len(words))
        count = np.zeros(len(words), np.int64)
        step = 0
        while len(slot):
            edge = lattices.choose(states, unit(_mix(word[slot] + np.uint64(step))))
            taken.append((slot, edge))
            count[slot] += 1
            states = lattices.next[edge]
            on = states >= 0
            slot, states = slot[on], states[on]
            step += 1
        offset = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for step, (slot, edge) in enumerate(taken):
            edges[offset[slot] + step] = edge
        return edges, np.repeat(words, count)

    def run(self) -> list[tuple[list[Path], float]]:
        """(paths, threshold) of every text."""
        n = len(self.keys)
        values = gumbel(self.keys, 1 << 40)
        paths: list[list[Path]] = [[] for _ in range(n)]
        open_: list[list] = [[] for _ in range(n)]  # (value, path, token, excluded edges)
        # first: everything from the roots; later: a fixed head, one new edge, then the rest
        heads: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0)] * n
        words, states = np.arange(len(self.roots)), self.roots
        active = list(range(n))
        for rank in range(1, self.k + 1):
            edges, at = self.descend(words, states, rank)
            owner = self.owner[at]
            logp = self.lattices.logp[edges]
            cut = np.searchsorted(owner, np.arange(n + 1))
            total = np.concatenate([[0.0], np.cumsum(logp)])
            head = np.array([h[2] for h in heads])
            count = np.diff(cut)
            before = total[:-1] - np.repeat(total[cut[:-1]], count) + np.repeat(head, count)
            with np.errstate(divide="ignore"):
                rest = before + np.log(np.maximum(-np.expm1(np.minimum(logp, 0.0)), 0.0))
                place = np.arange(len(edges)) - np.repeat(cut[:-1] - np.array([len(h[0]) for h in heads]), count)
                noise = gumbel(np.repeat(self.keys, count), place * 8 + rank, 1 << 41)
                part = rest + noise  # below one ceiling the order stays
            for d in active:
                a, b = cut[d], cut[d + 1]
                end = float(total[b] - total[a] + heads[d][2])
                path = Path(np.concatenate([heads[d][0], edges[a:b]]), np.concatenate([heads[d][1], at[a:b]]),
                            np.concatenate([heads[d][3] if len(heads[d]) > 3 else np.zeros(0), before[a:b], [end]]), float(values[d]))
                paths[d].append(path)
                mine, shift = part[a:b].copy(), len(heads[d][0])
                for _ in range(min(self.k + 1 - rank, b - a)):
                    i = int(mine.argmax())
                    if mine[i] == -np.inf:
                        break
                    reached = float(truncated(mine[i], path.value, 0.0))
                    open_[d].append((reached, len(paths[d]) - 1, shift + i, frozenset([int(path.edges[shift + i])])))
                    mine[i] = -np.inf
            if rank == self.k:
                break
            heads = [(np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0)] * n
            words_, states_ = [], []
            active = [d for d in active if open_[d]]
            chosen = [max(open_[d]) for d in active]
            keys, token = self.keys[active], np.array([best[2] for best in chosen], np.int64) * 8 + rank + 1
            drawn, noise = uniform(keys, token, 1 << 42).tolist(), gumbel(keys, token, 1 << 43).tolist()
            for d, best, u, noise_ in zip(active, chosen, drawn, noise):
                open_[d].remove(best)
                values[d] = best[0]
                heads[d], begin = self._turn(paths[d][best[1]], best, open_[d], u, noise_)
                word = int(heads[d][1][-1])
                if begin >= 0:
                    words_.append(np.array([word]))
                    states_.append(np.array([begin]))
                words_.append(np.arange(word + 1, self.ends[d]))
                states_.append(self.roots[word + 1 : self.ends[d]])
            if not active:
                break
            words = np.concatenate(words_).astype(np.int64)
            states = np.concatenate(states_).astype(np.int64)
        return [(p, max(o)[0] if o else -np.inf) for p, o in zip(paths, open_)]

    def _turn(self, path: Path, best, rest: list, u: float, noise: float):
        """Leave `path` at a token by an edge that is not excluded, drawn by `u`; what still is not
        taken there stays open, with `noise`. The new head (edges, words, log probability, before) and the next state."""
        value, which, token, excluded = best
        lattices = self.lattices
        word = path.words[token]
        # where the token before it ends, or the word begins
        state = int(lattices.next[path.edges[token - 1]] if token and path.words[token - 1] == word else self.roots[word])
        left = np.array([e for e in range(lattices.first[state], lattices.first[state + 1]) if e not in excluded])
        p = np.exp(lattices.logp[left])
        new = int(left[min(int(np.searchsorted(np.cumsum(p) / p.sum(), u, side="right")), len(left) - 1)])
        mass = float(p.sum() - np.exp(lattices.logp[new]))
        if len(left) > 1 and mass > 0:
            again = float(truncated(path.before[token] + np.log(mass), value, noise))
            rest.append((again, which, token, excluded | {new}))
        head = (
            np.append(path.edges[:token], new), path.words[: token + 1], float(path.before[token] + lattices.logp[new]),
            path.before[: token + 1],
        )
        return head, int(lattices.next[new])


def sample(texts: list[str | None], keys: np.ndarray, lattices: Lattices, k: int = TOP, seed: int = SEED):
    """For every text its [(ids, log probability, perturbed value, log inclusion)], best first."""
    search = Search(lattices, [t or "" for t in texts], keys, k, seed)
    for paths, threshold in search.run():
        yield [(lattices.ids(p.edges), p.log_prob, p.value, log_inclusion(p.log_prob, threshold)) for p in paths]


def encode(documents: DataFrame, vocabulary: Vocabulary | str = MODEL, k: int = TOP, seed: int = SEED) -> DataFrame:
    """(doc_id, rank, ids, log_prob, perturbed, log_inclusion, restored): up to k segmentations of
    every text. `restored` says that decoding the ids gives the text again."""
    vocabulary = load(vocabulary) if isinstance(vocabulary, str) else vocabulary
    schema = pa.schema([
        ("doc_id", pa.int64()), ("rank", pa.int32()), ("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()),
        ("perturbed", pa.float64()), ("log_inclusion", pa.float64()), ("restored", pa.bool_()),
    ])

    lattices, contents = Lattices(vocabulary), Contents(vocabulary)
    # the tables are worked out once; a task needs no dictionary of pieces beside them
    lattices.vocabulary = bare = replace(vocabulary, pieces={})

    def rows(batches):
        lattices.clear()

        def flush(keys, texts):
            if lattices.n > STATES:
                lattices.clear()
            # a null id is keyed like -1
            found = sample(texts, np.array([-1 if key is None else key for key in keys], np.int64), lattices, k, seed)
            out, offsets, values = [], [0], []
            for key, text, samples in zip(keys, texts, found):
                given = f" {text}".encode() if text else b""
                for rank, (ids, log_prob, value, inclusion) in enumerate(samples, 1):
                    restored = contents.spell(ids) == given or decode(ids.tolist(), bare) == (text or "")
                    out.append((key, rank, log_prob, value, inclusion, restored))
                    values.append(ids)
                    offsets.append(offsets[-1] + len(ids))
            columns = list(zip(*out))
            flat = pa.array(np.concatenate(values)) if values else pa.array([], pa.int32())
            arrays = [
                pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                *[pa.array(c, t) for c, t in zip(columns[2:], (pa.float64(), pa.float64(), pa.float64(), pa.bool_()))],
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                texts.append(text.as_py())
                size += len(texts[-1] or "") + 50
                if size >= BATCH_CHARS:
                    yield flush(keys, texts)
                    keys, texts, size = [], [], 0
        if keys:
            yield flush(keys, texts)

    return documents.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(rows, RESULT)


def decoded(ids: str | Column, vocabulary: Vocabulary | str = MODEL) -> Column:
    """The texts of a column of ids; null for null."""
    vocabulary = load(vocabulary) if isinstance(vocabulary, str) else vocabulary

    @F.pandas_udf("string")
    def texts(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else decode(r, vocabulary) for r in rows], dtype=object)

    return texts(ids)
