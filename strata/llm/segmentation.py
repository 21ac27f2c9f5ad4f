"""Sampled SentencePiece segmentations: the k best of a perturbed lattice, all distinct.

Every way to spell a text in pieces has a probability (the product of its pieces' weights,
normalised over the lattice) and a perturbed score: its log and Gumbel noise.  The search opens, best
first (A*), groups of segmentations that begin alike, each by the exact score of the best one in it.
To open a group is to draw that segmentation, piece by piece; what is left of the group falls apart into
one smaller group for each step of it (the same beginning, another piece there), whose best
score is Gumbel noise below that of the whole.  So complete segmentations come in falling order,
which is a sample without replacement.  As every open group stands for one segmentation of exactly
its score, the k + 1 best are all that is kept.  A segmentation's inclusion score is the chance that
its perturbed score passes the (k + 1)-th one; it is 1 where all are emitted.

No piece goes on between two characters that stand together in none, so a text falls apart there into words, whose
lattices are apart.  The new words of a group of texts are built together, place by place from their ends, in arrays,
and held for the groups after; the texts are searched in step, and all their draws of one length are one array.  A
character outside the vocabulary is spelled in bytes.  Every number drawn is SplitMix64 of the row's seed at a count
of its own, so a row's samples do not depend on its neighbours.

Defined results: a NULL or empty text gives no rows; rows of equal key and text give
equal samples each; a text with fewer than k segmentations gives them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

MODEL, SAMPLES, SHARPNESS, SEED = "piece_bpe_32k.model", 4, 1.0, 17
SPACE_MARK = "▁"
GROUP_CHARS = 200_000  # of texts searched in step; a longer text goes alone
BLOCK = 8192  # pieces decoded at a time
HELD_EDGES = 4_000_000  # of words held for the groups after; beyond that they are built anew
# No noise is above LEAST_FALL: where a beginning's log mass is lower by that than a group's best score, no
# smaller group that begins so is better.  Noise is drawn for log masses down to -NEAR first.
LEAST_FALL, NEAR = 37.0, 60.0
_SLOT_BITS = 20
_HASH = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "key string, rank int, n_pieces long, log_prob double, inclusion double, ids array<int>, decoded string"


class Lattice:
    """Pieces of one model with weights: the log of a falling function of their rank."""

    def __init__(self, name: str, sharpness: float):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.normalise = model.normalize
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        kinds = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        ids = [i for i in range(len(self.pieces)) if not any(kind(i) for kind in kinds)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.spelled = [p.encode() for p in self.pieces]
        for b, i in self.byte_ids.items():
            self.spelled[i] = bytes([b])
        by_score = sorted(ids, key=lambda i: -model.get_score(i))
        weights = {self.pieces[i]: (i, -sharpness * math.log(r + 2)) for r, i in enumerate(by_score)}
        self.of_byte = -sharpness * math.log(len(ids) + 2)
        self._beginnings(weights)
        self._pairs(weights)
        self.held = _Held(self)
        # Bytes of every piece as they are decoded.
        spelled = [s.replace(SPACE_MARK.encode(), b" ") for s in self.spelled]
        self.text = np.frombuffer(b"".join(spelled), np.uint8)
        self.text_length = np.fromiter(map(len, spelled), np.int64)
        self.text_start = np.cumsum(self.text_length) - self.text_length

    def _beginnings(self, weights: dict[str, tuple[int, float]]) -> None:
        """Numbers the beginnings of pieces (0: the empty one) and hashes (beginning, character) to the longer one."""
        states = {"": 0}
        for piece in weights:
            for n in range(1, len(piece) + 1):
                states.setdefault(piece[:n], len(states))
        chars = sorted({c for p in weights for c in p})
        self.kinds = len(chars) + 1
        self.kind = np.zeros(0x110000, np.int32)  # of a character; 0: in no piece
        self.kind[[ord(c) for c in chars]] = np.arange(1, self.kinds)
        self.piece = np.full(len(states) + 1, -1, np.int64)  # the last: of no beginning
        self.weight = np.zeros(len(states) + 1)
        for piece, (i, weight) in weights.items():
            self.piece[states[piece]], self.weight[states[piece]] = i, weight
        longer = [(states[p[:-1]], ord(p[-1]), s) for p, s in states.items() if p]
        before, char, state = np.array(longer, np.int64).reshape(-1, 3).T
        keys = before * self.kinds + self.kind[char]
        self.slot_key = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.slot_state = np.full(1 << _SLOT_BITS, -1, np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_key[slots] < 0)
            taken, which = np.unique(slots[free], return_index=True)
            self.slot_key[taken], self.slot_state[taken] = keys[free[which]], state[free[which]]
            left = np.ones(len(keys), bool)
            left[free[which]] = False
            keys, state, slots = keys[left], state[left], (slots[left] + 1) % len(self.slot_key)

    def _pairs(self, pieces: Iterable[str]) -> None:
        """Marks the kinds of two characters that follow each other in a piece."""
        self.together = np.zeros(self.kinds * self.kinds, bool)
        pairs = {p[n : n + 2] for p in pieces for n in range(len(p) - 1)}
        before, after = np.array([(ord(a), ord(b)) for a, b in pairs], np.int64).reshape(-1, 2).T
        self.together[self.kind[before].astype(np.int64) * self.kinds + self.kind[after]] = True

    def word_starts(self, code: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where words begin in texts that stand one after the other, each from its ``begin``."""
        kind = self.kind.take(code)
        starts = np.empty(len(code), bool)
        np.logical_not(self.together.take(kind[:-1].astype(np.int64) * self.kinds + kind[1:]), out=starts[1:])
        starts[begin] = True
        return np.flatnonzero(starts)

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _HASH) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def longer(self, states: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The beginnings one character longer, -1 where there is none."""
        keys = states * self.kinds + kinds
        slots = self._slots(keys)
        held = self.slot_key[slots]
        found = np.where(held == keys, self.slot_state[slots], -1)
        at = np.flatnonzero((held != keys) & (held >= 0))
        while len(at):
            slots[at] = (slots[at] + 1) % len(self.slot_key)
            held = self.slot_key[slots[at]]
            hit = held == keys[at]
            found[at[hit]] = self.slot_state[slots[at[hit]]]
            at = at[~hit & (held >= 0)]
        return found

    def word(self, word: str) -> tuple:
        """The lattice of one word as nested places: log of the weight of all ways to spell what is left, its
        length, and the edges (next place, ids, conditional probability, that of the other edges)."""
        made, places = _Words(self, [_codes([word]).tobytes()]), {0: (0.0, 0, ())}
        for n in range(1, len(word) + 1):
            edges = range(made.first[n], made.first[n + 1])
            found = ((places[made.next[e]], tuple(self.ids(made.id[e : e + 1])[0].tolist()), made.chance[e], made.others[e]) for e in edges)
            places[n] = (float(made.mass[n]), n, tuple(found))
        return places[len(word)]

    def ids(self, edge_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of edges in their order, characters outside the vocabulary in bytes, and how many each has."""
        many = np.ones(len(edge_ids), np.int64)
        odd = np.flatnonzero(edge_ids >= len(self.pieces))
        if not len(odd):
            return edge_ids, many
        chars, which = np.unique(edge_ids[odd] - len(self.pieces), return_inverse=True)
        spelled = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in chars.tolist()]
        length = np.fromiter(map(len, spelled), np.int64)
        many[odd] = length[which]
        out = np.repeat(edge_ids, many)
        at = np.repeat((np.cumsum(many) - many)[odd], many[odd])
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many[odd]) - many[odd], many[odd])
        out[at + nth] = np.concatenate(spelled)[np.repeat((np.cumsum(length) - length)[which], many[odd]) + nth]
        return out, many

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of segmentations that stand one after the other in ``ids``, each from its ``first``, and where each
        ends; the mark put in front of each is taken off."""
        start, length = self.text_start.take(ids), self.text_length.take(ids)
        start[first] += 1
        length[first] -= 1
        ends = np.cumsum(length)
        shift, text = start - (ends - length), np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        begin = 0
        for i in range(0, len(ids), BLOCK):  # small arrays stay in the processor's caches
            end = int(ends[min(i + BLOCK, len(ids)) - 1])
            at = np.repeat(shift[i : i + BLOCK], length[i : i + BLOCK])
            at += np.arange(begin, end)
            text[begin:end] = self.text.take(at)
            begin = end
        last = np.append(first[1:], len(ids)) - 1
        return text, ends[last]

    def sample(self, text: str, k: int, seed: int) -> list[tuple[list[int], float, float]]:
        """Up to k (ids, log probability, inclusion score), highest perturbed score first."""
        marked = self.normalise(text)
        if not marked:
            return []
        found = _search(self, [marked], [seed], k)[0]
        return [(self.ids(edge_ids)[0].tolist(), mass, chance) for edge_ids, mass, chance in found]


def _codes(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class _Words:
    """Lattices of distinct words, in UTF-32, in arrays.  A place has a word, by falling length, and a distance from
    its end; places are numbered by distance, then word, so those of one distance follow each other.  Place 0 is the
    end of every word.  The edges of a place lie from ``first`` of the place to that of the next one."""

    def __init__(self, model: Lattice, words: Sequence[bytes]):
        length = np.fromiter(map(len, words), np.int64, len(words)) // 4
        order = np.argsort(-length, kind="stable")
        code = np.frombuffer(b"".join(words), np.uint32).astype(np.int64)
        kind, end = model.kind[code].astype(np.int64), np.cumsum(length)[order]
        longest = int(length[order[0]])
        at_distance = np.bincount(length, minlength=longest + 1)[::-1].cumsum()[::-1]
        at_distance[0] = 1
        base = np.append(0, np.cumsum(at_distance))
        places = int(base[-1])
        place = np.arange(1, places)
        distance = np.repeat(np.arange(1, longest + 1), at_distance[1:])
        word = place - base[distance]
        at = self.at = end[word] - distance  # of all places but 0, in the words one behind the other
        self.start = np.cumsum(length) - length
        state, made, n = model.longer(np.zeros(len(at), np.int64), kind[at]), [], 1
        while len(place):
            ids, weight = model.piece[state], model.weight[state]
            known = ids >= 0
            if n == 1 and not known.all():
                odd = np.flatnonzero(~known)
                char = code[at[odd]]
                ids[odd] = len(model.pieces) + char
                weight[odd] = model.of_byte * (1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF))
                known[:] = True
            ahead = distance[known] - n
            onward = np.where(ahead > 0, base[ahead] + word[known], 0)
            made.append((place[known], onward, ids[known].astype(np.int32), weight[known], np.full(len(onward), n, np.int8)))
            more = np.flatnonzero((state >= 0) & (distance > n))
            state = model.longer(state[more], kind[at[more] + n])
            more, state = more[state >= 0], state[state >= 0]
            place, distance, word, at, n = place[more], distance[more], word[more], at[more], n + 1
        place, onward, ids, weight, span = (np.concatenate(column) for column in zip(*reversed(made)))
        by_place = np.argsort(place, kind="stable")
        place, self.next, self.id, weight, self.span = (c[by_place] for c in (place, onward, ids, weight, span))
        many = np.bincount(place, minlength=places)
        self.first = np.append(0, np.cumsum(many))

        self.mass = np.zeros(places)
        share, total = np.empty(len(weight)), np.ones(places)
        for d in range(1, longest + 1):
            a, b = base[d], base[d + 1]
            i, j = self.first[a], self.first[b]
            log = weight[i:j] + self.mass[self.next[i:j]]
            parts = self.first[a:b] - i
            top = np.maximum.reduceat(log, parts)
            share[i:j] = np.exp(log - np.repeat(top, many[a:b]))
            total[a:b] = np.add.reduceat(share[i:j], parts)
            self.mass[a:b] = top + np.log(total[a:b])
        whole = total[place]
        others = whole - share
        most = others < 1e-3 * whole  # without the digits lost; at most one edge of a place
        rest = np.add.reduceat(np.where(most, 0.0, share), self.first[1:-1])
        others[most] = rest[place[most] - 1]
        self.chance, self.others = share / whole, others / whole
        self.pass_by = self.chance.copy()  # draws from here on go on to the next edge
        self.pass_by[self.first[2:] - 1] = math.inf


class _Held(dict):
    """Numbers of the words held, in UTF-32, and their lattices: edges of places of one word stand together, a place is
    its first edge, and ``ahead`` is 256 times the next place, 0 at the end of a word, and the characters to there."""

    columns = {"ahead": np.int64, "id": np.int32} | dict.fromkeys(("chance", "others", "pass_by"), np.float64)

    def __init__(self, model: Lattice):
        super().__init__()
        self.model, self.ahead = model, ()
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.new, self.edges, self.places = [], 1, 1
        if not HELD_EDGES <= len(self.ahead) <= 2 * HELD_EDGES:
            for column, kind in self.columns.items():
                setattr(self, column, np.empty(HELD_EDGES * 5 // 4 + 1, kind))
            self.start, self.first = np.empty(HELD_EDGES // 16, np.int64), np.empty(HELD_EDGES // 2 + 1, np.int64)
        self.first[0] = 1  # of the places in their order, and the end of the last

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number

    def _put(self, column: str, used: int, values: np.ndarray) -> None:
        array = getattr(self, column)
        if used + len(values) > len(array):
            array = np.concatenate([array[:used], np.empty(max(used, len(values)), array.dtype)])
            setattr(self, column, array)
        array[used : used + len(values)] = values

    def starts(self, code: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The places where words begin that stand one after the other, each from its ``begin``."""
        if self.edges > HELD_EDGES:
            self._empty()
        parted = np.full(len(code) + len(begin), 0xFFFFFFFF, np.uint32)  # of no character
        words = np.zeros(len(code), np.int64)
        words[begin] = 1
        parted[np.arange(len(code)) + np.cumsum(words)] = code
        parts = parted[1:].tobytes().split(b"\xff\xff\xff\xff")
        held = len(self)
        try:
            numbers = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
            if self.new:
                self._add(_Words(self.model, self.new), held)
                self.new = []
        except BaseException:
            self._empty()
            raise
        return self.start.take(numbers)

    def _add(self, made: _Words, held: int) -> None:
        many = np.empty(len(made.at), np.int64)
        many[made.at] = np.diff(made.first[1:])
        first = np.cumsum(many)
        self._put("first", self.places, first + self.edges)
        first += self.edges - many
        self._put("start", held, first[made.start])
        place = np.append(0, first[made.at])  # by the number it has in ``made``
        edge = np.arange(len(made.next)) + np.repeat(place[1:] - made.first[1:-1] - self.edges, np.diff(made.first[1:]))
        made.ahead = place[made.next] * 256 + made.span
        for column in self.columns:
            values = getattr(made, column)
            ordered = np.empty_like(values)
            ordered[edge] = values
            self._put(column, self.edges, ordered)
        self.edges += len(edge)
        self.places += len(many)

    def drawn(self, place: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """One edge of every place by its chance."""
        edge = place.copy()
        by = self.pass_by.take(edge)
        at = np.flatnonzero(draw >= by)
        left, by = draw.take(at), by.take(at)
        on = edge.take(at)
        while len(at):
            left = left - by
            on += 1
            edge[at] = on
            by = self.pass_by.take(on)
            more = np.flatnonzero(left >= by)
            at, on, left, by = at.take(more), on.take(more), left.take(more), by.take(more)
        return edge

    def drawn_but(self, barred: Sequence[tuple[int, ...]], draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the place of each tuple of edges another edge by its chance among them, and the chance of those left."""
        rows = np.arange(len(barred))
        place = np.searchsorted(self.first[: self.places], [edges[0] for edges in barred], "right") - 1
        first, many = self.first[place], self.first[place + 1] - self.first[place]
        nth = np.arange(many.max())
        chance = self.chance[np.minimum(first[:, None] + nth, self.edges - 1)]
        chance[nth >= many[:, None]] = 0.0
        of = np.repeat(rows, [len(edges) for edges in barred])
        chance[of, np.array([e for edges in barred for e in edges]) - first[of]] = 0.0
        bounds = np.cumsum(chance, axis=1)
        last = len(nth) - 1 - np.argmax(chance[:, ::-1] > 0, axis=1)
        i = np.minimum((bounds <= (draw * bounds[:, -1])[:, None]).sum(axis=1), last)
        chance[rows, i] = 0.0
        return first + i, np.cumsum(chance, axis=1)[:, -1]  # in order, so that no row's width changes another's sum


def _uniform(z: np.ndarray) -> np.ndarray:
    """What SplitMix64 makes of these states, as numbers between 0 and 1, neither included."""
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    z >>= np.uint64(12)
    made = z.astype(np.float64)
    made += 0.5
    made *= 2.0**-52
    return made


def _gumbel(uniform: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform))


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers from each begin to its end, the range of each, and where ranges begin."""
    many = end - begin
    starts = np.cumsum(many) - many
    of = np.repeat(np.arange(len(many)), many)
    return np.arange(len(of)) + (begin - starts)[of], of, starts


def _search(model: Lattice, texts: Sequence[str], seeds: Sequence[int], k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each normalised text, not empty, up to k (ids of its edges, log probability, inclusion score)."""
    code, held, every = _codes(texts), model.held, len(texts)
    chars = np.fromiter(map(len, texts), np.int64, every)
    begin = np.append(0, np.cumsum(chars))
    word_at = model.word_starts(code, begin[:-1])
    word_place = held.starts(code, word_at)
    words = np.searchsorted(word_at, begin)
    count = (np.arange(begin[-1]) - np.repeat(begin[:-1], chars) + 1).astype(np.uint64)
    state = np.repeat(np.array(seeds, np.uint64), chars) + count * _HASH

    def uniform(lane: int, at: np.ndarray) -> np.ndarray:
        """A number for characters of the texts; lanes lie 2**32 counts apart."""
        z = state.take(at)
        z += np.uint64((lane << 32) * int(_HASH) % 2**64)
        return _uniform(z)

    # Open groups of each text, best first: falling score (infinite: no group), the sample that begins so, where it is
    # left, the edge not to be taken there, and those before it that are not to be either.
    scores = -_gumbel(uniform(0, begin[:-1]))[:, None]
    likes, ats_left, barred = np.zeros((every, 1), np.int64), begin[:-1, None], np.full((every, 1), -1)
    more = np.full((every, 1), None)
    taken, done, limits = [], [[] for _ in texts], np.full(every, -math.inf)
    for n in range(k + 1):
        live = np.flatnonzero(scores[:, 0] < math.inf) if scores.shape[1] else np.zeros(0, np.int64)
        if n == k or not len(live):
            limits[live] = -scores[live, 0]
            break
        best, like, left_at, bar, bars = (c[live, 0] for c in (scores, likes, ats_left, barred, more))
        edge_at = np.full(int(begin[-1]), -1, np.int64)  # the edge that begins at a character
        split = np.flatnonzero(bar >= 0)
        at, place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        from_word, left = words[live], np.zeros(0)
        if len(split):
            split_at = left_at[split]
            for a, b, i in zip(begin[live[split]].tolist(), split_at.tolist(), like[split].tolist()):
                edge_at[a:b] = taken[i][a:b]
            not_these = [(e, *(others or ())) for e, others in zip(bar[split].tolist(), bars[split])]
            step, left = held.drawn_but(not_these, uniform(2 * n + 1, split_at))
            edge_at[split_at] = step
            ahead = held.ahead[step]
            at, place = split_at + (ahead & 255), ahead >> 8
            from_word[split] = np.searchsorted(word_at, split_at, "right")
        fresh = _ranges(from_word, words[live + 1])[0]
        at, place = np.append(word_at[fresh], at), np.append(word_place[fresh], place)
        while True:
            on = np.flatnonzero(place)
            if not len(on):
                break
            if len(on) < len(place):
                at, place = at.take(on), place.take(on)
            edge = held.drawn(place, uniform(2 * n + 1, at))
            edge_at[at] = edge
            ahead = held.ahead.take(edge)
            at, place = at + (ahead & 255), ahead >> 8
        taken.append(edge_at)

        ats = np.flatnonzero(edge_at >= 0)
        steps, cuts = edge_at.take(ats), np.searchsorted(ats, begin)
        log_chance, before = np.log(held.chance.take(steps)), np.zeros(len(steps))
        a, b = cuts[live], cuts[live + 1]
        for i, j in zip(a.tolist(), b.tolist()):
            np.add.accumulate(log_chance[i : j - 1], out=before[i + 1 : j])
        ids = held.id.take(steps)
        for text, i, j, mass in zip(live.tolist(), a.tolist(), b.tolist(), (before[b - 1] + log_chance[b - 1]).tolist()):
            done[text].append((ids[i:j], mass))
        first = a.copy()
        first[split] = np.searchsorted(ats, left_at[split])
        near = np.maximum(first, a + np.add.reduceat((before > -NEAR).astype(np.int64), a))
        room = k - n
        left_of = np.full(len(live), -1.0)
        left_of[split] = left

        def falls(which: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
            """Of the smaller groups the noise less the log mass: the larger it is, the lower the best score.  The
            least of each text, their steps, texts and ranks, and whether there are as many as there is room for."""
            chosen, of, starts = _ranges(first[which], end)
            noise = _gumbel(uniform(2 * n + 2, ats[chosen]))
            others = held.others[steps[chosen]]
            firsts = starts[(left_of[which] >= 0) & (end > first[which])]
            others[firsts] = left_of[which[of[firsts]]]
            with np.errstate(divide="ignore"):  # no other edge: -inf
                fall = -noise - before[chosen] - np.log(others)
            # Where parts of a text have their least, no score above as many of these as there is room for is kept.
            many, parts = end - first[which], 8 * room
            begins = starts[:, None] + many[:, None] * np.arange(parts) // parts
            least = np.minimum.reduceat(np.append(fall, math.inf), begins.ravel()).reshape(-1, parts)
            bound = np.partition(least, room - 1, axis=1)[:, room - 1]
            bound[many < parts] = math.inf
            low = np.flatnonzero(fall <= bound[of])
            order = low[np.lexsort((fall[low], of[low]))]
            of = of[order]
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            order, of, rank = (c[rank < room] for c in (order, of, rank))
            fall = fall[order]
            full = np.bincount(of[(rank == room - 1) & (fall <= NEAR - LEAST_FALL)], minlength=len(which)) > 0
            return fall, chosen[order], which[of], rank, full

        fall, chosen, of, rank, full = falls(np.arange(len(live)), near)
        short = (near < b) & ~full
        if short.any():
            least = falls(np.flatnonzero(short), b[short])
            kept = ~short[of]
            fall, chosen, of, rank = (np.append(c[kept], d) for c, d in zip((fall, chosen, of, rank), least))
        held_up = np.flatnonzero(fall < math.inf)
        fall, chosen, of, rank = (c[held_up] for c in (fall, chosen, of, rank))
        new = live[of], rank
        falling = np.full((every, room), math.inf)
        # Its best score, given that the best of all has the score of this one.
        falling[new] = np.logaddexp(best[of], fall)
        left_there, barred_there, more_there = np.zeros((every, room), np.int64), np.full((every, room), -1), np.full((every, room), None)
        left_there[new], barred_there[new] = ats[chosen], steps[chosen]
        for i in np.flatnonzero((chosen == first[of]) & (bar[of] >= 0)).tolist():
            more_there[new[0][i], rank[i]] = (int(bar[of[i]]), *(bars[of[i]] or ()))
        scores = np.append(scores[:, 1:], falling, axis=1)
        order = np.argsort(scores, axis=1, kind="stable")[:, :room]
        scores = np.take_along_axis(scores, order, axis=1)
        pairs = ((likes, np.full((every, room), n)), (ats_left, left_there), (barred, barred_there), (more, more_there))
        likes, ats_left, barred, more = (np.take_along_axis(np.append(c[:, 1:], d, axis=1), order, axis=1) for c, d in pairs)
    return [
        [(ids, mass, _passes(mass - limit)) for ids, mass in samples] for samples, limit in zip(done, limits.tolist())
    ]


def _passes(margin: float) -> float:
    """Chance that a Gumbel score of this margin passes the limit."""
    return 1.0 if margin > 700 else -math.expm1(-math.exp(margin))


@lru_cache(maxsize=4)
def lattice(name: str = MODEL, sharpness: float = SHARPNESS) -> Lattice:
    return Lattice(name, sharpness)


def row_seed(key: str, seed: int = SEED) -> int:
    return xxhash.xxh64_intdigest(key.encode(), seed)


def _groups(model: Lattice, batch: pa.RecordBatch) -> Iterator[list[tuple[str, str]]]:
    """Rows (key, marked text) that have a text, about ``GROUP_CHARS`` characters at a time."""
    group, chars = [], 0
    for start in range(0, batch.num_rows, 500):
        part = batch.slice(start, 500)
        for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            marked = model.normalise(text)
            if not marked:
                continue
            if group and chars + len(marked) > GROUP_CHARS:
                yield group
                group, chars = [], 0
            group.append((key, marked))
            chars += len(marked)
    if group:
        yield group


def _rows(model: Lattice, group: list[tuple[str, str]], k: int, seed: int) -> pa.RecordBatch:
    keys, texts = zip(*group)
    found = _search(model, texts, [row_seed(key, seed) for key in keys], k)
    samples = [sample for of_text in found for sample in of_text]
    ids, many = model.ids(np.concatenate([edge_ids for edge_ids, _, _ in samples]))
    edges = np.cumsum([len(edge_ids) for edge_ids, _, _ in samples])
    ends = np.cumsum(many)[edges - 1]
    first = np.append(0, ends[:-1])
    text, text_ends = model.decode(ids, first)
    offsets, text_offsets = (pa.array(np.append(0, e).astype(np.int32)) for e in (ends, text_ends))
    columns = [
        pa.array([key for key, of_text in zip(keys, found) for _ in of_text], pa.string()),
        pa.array([rank for of_text in found for rank in range(len(of_text))], pa.int32()),
        pa.array(np.diff(np.append(0, ends)), pa.int64()),
        pa.array([mass for _, mass, _ in samples], pa.float64()),
        pa.array([chance for _, _, chance in samples], pa.float64()),
        pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
        pa.StringArray.from_buffers(len(samples), text_offsets.buffers()[1], pa.py_buffer(text)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(",")])


def _sampled(name: str, sharpness: float, k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(name, sharpness)
        for batch in batches:
            for group in _groups(model, batch):
                yield _rows(model, group, k, seed)

    return run


def sampled_segmentations(
    rows: DataFrame,
    keys: list[str],
    text: str = "text",
    k: int = SAMPLES,
    name: str = MODEL,
    sharpness: float = SHARPNESS,
    seed: int = SEED,
) -> DataFrame:
    """Up to k rows per row: ``key`` (the key columns as JSON), ``rank``, ``n_pieces``,
    ``log_prob``, ``inclusion``, ``ids``, and the text they decode to."""
    key = F.to_json(F.array(*(F.col(c).cast("string") for c in keys)))
    return rows.select(key.alias("key"), text_or_empty(text).alias("text")).mapInArrow(
        _sampled(name, sharpness, k, seed), SCHEMA
    )
