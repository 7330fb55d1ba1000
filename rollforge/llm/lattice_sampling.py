"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement.

A text becomes the model's symbols (spaces to U+2581, one put in front) and is cut before each run of U+2581 that
follows something else; no piece of the model crosses such a cut, so the lattice of the text is the chain of its
chunks' lattices. Each lattice node has the exact probability of each arc given the node (backward sums), so
the weight of everything behind a node is known: a perfect heuristic.

The search keeps disjoint sets of segmentations in a heap, by the largest perturbed log-probability in each (a Gumbel
variate of the set's log-mass). Popping a set emits its best member, drawn from the set's distribution;
the rest of the set is cut up by the first arc that differs, and each part gets its own Gumbel variate, truncated at the popped value.
So the k segmentations that come out are distinct and are an exact sample without replacement, in the order of their perturbed
scores. With the next value in the heap as threshold t, a segmentation of log-probability p has the inclusion
score 1 - exp(-exp(p - t)).

A model of type BPE holds merge ranks and no probabilities. Its pieces then get the log-probabilities of a
Zipf-Mandelbrot law of their rank. Every random number is a hash of seed, row key, sample and place.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import hold, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_G = np.uint64(0x9E3779B97F4A7C15)
_ONE = (1 << 31) - 1
#: Chunks of more characters get their lattice one by one.
LONG = 48
#: Arcs that are kept from batch to batch (28 bytes each), room for a batch's own, and characters in a batch.
KEEP_ARCS, SPARE_ARCS, BATCH_CHARS = 3_000_000, 1 << 20, 800_000
#: Hashes of words that aren't kept, a byte each (a power of 2).
MET = 1 << 23


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + _G
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: int, at) -> np.ndarray:
    """In (0, 1), by a seed and places."""
    x = _mix(np.asarray(at, np.uint64) * _G + np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _uniform_one(seed: int, at: int) -> float:
    """_uniform of a single place."""
    x = (at * 0x9E3779B97F4A7C15 + seed + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (((x ^ (x >> 31)) >> 11) + 0.5) / (1 << 53)


def _longer(x: np.ndarray, n: int) -> np.ndarray:
    out = np.empty((n, *x.shape[1:]), x.dtype)
    out[: len(x)] = x
    return out


class Model:
    """Pieces and log-probabilities of a SentencePiece model."""

    def __init__(self, proto: bytes, *, flatten: float = 1.0, shift: float = 2.7):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.texts = [p.replace(SPACE, " ") for p in self.pieces]
        for b, i in self.byte.items():
            self.texts[i] = chr(b) if b < 128 else chr(0xDC00 + b)  # as surrogateescape has it
        self.text_of = np.array(self.texts, object)
        scores = np.array([sp.get_score(i) for i in range(n)])
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if len(normal) > 1 and np.median(np.diff(np.sort(scores[normal]))) == 1:  # ranks: BPE
            rank = np.empty(len(normal))
            rank[np.argsort(-scores[normal], kind="stable")] = np.arange(len(normal))
            weight = 1 / (rank + shift)
            logp = np.log(weight / weight.sum())
        else:
            logp = scores[normal]
        self.logp = np.full(n, float(logp.min()) - 1)
        self.logp[normal] = logp * flatten
        self.floor = float(self.logp.min())
        self.weight = np.exp(self.logp)
        self.ids = {self.pieces[i]: i for i in normal}
        self.longest = max(map(len, self.ids))
        # Hash table of the pieces: sorted hashes of lengths 1 to `longest`, and a small filter before it.
        self.base = np.uint64(0xD1B54A32D192ED03)
        held = [(self.hash_of(p), i) for p, i in self.ids.items() if len(p) <= self.longest]
        held.sort()
        self.hashes = np.array([h for h, _ in held], np.uint64)
        self.hash_ids = np.array([i for _, i in held], np.int32)
        # Where each range of 2 ** 47 hashes begins, and a last one above all, so that a hash is found in a step or two.
        self.begin = np.searchsorted(self.hashes, np.arange(1 << 17, dtype=np.uint64) << np.uint64(47)).astype(np.int32)
        self.bounded = np.append(self.hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
        # What may begin a piece (1), or be one (2): most substrings are ruled out here.
        self.filter = np.zeros(1 << 21, np.uint8)
        begin = {p[:i] for p in self.ids if len(p) <= self.longest for i in range(1, len(p))}
        self.filter[np.array([self.hash_of(p) for p in begin], np.uint64) >> np.uint64(43)] = 1
        self.filter[self.hashes >> np.uint64(43)] |= 2

    def hash_of(self, piece: str) -> int:
        codes = _mix(np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64))
        powers = np.cumprod(np.full(len(codes), self.base), dtype=np.uint64) * np.uint64(pow(int(self.base), -1, 1 << 64))
        return int((codes * powers).sum(dtype=np.uint64)) & 0xFFFFFFFFFFFFFFFF

    def place(self, h: np.ndarray) -> np.ndarray:
        """Places of the first hashes that aren't below h."""
        k = self.begin[h >> np.uint64(47)]
        low = np.flatnonzero(self.bounded[k] < h)
        while len(low):
            k[low] += 1
            low = low[self.bounded[k[low]] < h[low]]
        return k

    def fallback(self, char: str) -> list[int]:
        got = [self.byte.get(b) for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in got else got

    def symbols(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def decode(self, ids) -> str:
        """The text of ids (an array or a list): pieces joined, bytes put together, U+2581 to spaces, without the one in front."""
        text = "".join(self.text_of[ids if isinstance(ids, np.ndarray) else np.array(ids, np.int64)].tolist())
        if not text.isascii():
            try:
                text.encode()
            except UnicodeEncodeError:  # bytes
                text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def encode(self, text: str) -> list[int]:
        """The model's own segmentation."""
        return self.processor.encode(text)


class Lattices:
    """The lattices of chunks: a node for each character, its arcs in order of length.

    first[node]: its first arc. Of an arc: cut, the upper end of its share of 2 ** 31 - 1; target, a node or -1 at the
    chunk's end; piece; logp given the node, and rest, the logarithm of what the node's other arcs have. Pieces from the vocabulary's size on stand for characters by their bytes."""

    def __init__(self, model: Model):
        self.model = model
        self.start: dict[str, int] = {}
        self.nodes = self.arcs = 0
        self.first = np.empty(1 << 21, np.int32)
        n = KEEP_ARCS + SPARE_ARCS
        self._own(np.empty((n, 2), np.int32), np.empty(n, np.int32), np.empty(n, np.complex128))
        self.other: dict[str, int] = {}
        self.others: list[list[int]] = []
        self.extra: dict[str, int] = {}  # words of this batch alone, once KEEP_ARCS have been held
        self.into = self.start
        self.kept = (0, 0)  # nodes and arcs of start's words, once KEEP_ARCS have been held
        self.used = np.zeros(len(self.first), bool)  # first nodes of words that came again in a later batch
        self.met: np.ndarray | None = None  # by hash, words that were forgotten or never kept

    def _own(self, steps: np.ndarray, piece: np.ndarray, logs: np.ndarray) -> None:
        """What is read together lies together: cut and target in steps, logp and rest in logs."""
        self.steps, self.piece, self.logs = steps, piece, logs
        self.cut, self.target, self.logp, self.rest = steps[:, 0], steps[:, 1], logs.real, logs.imag

    def _room(self, nodes: int, arcs: int) -> None:
        if self.nodes + nodes > len(self.first):
            self.first = _longer(self.first, max(2 * len(self.first), self.nodes + nodes))
            if self.met is None:
                self.used = np.append(self.used, np.zeros(len(self.first) - len(self.used), bool))
        if self.arcs + arcs > len(self.cut):
            n = max(len(self.cut) * 3 // 2, self.arcs + arcs)
            self._own(*(_longer(x, n) for x in (self.steps, self.piece, self.logs)))

    def _append(self, counts, cut, target, piece, logp) -> None:
        n, m = len(counts), len(cut)
        self._room(n, m)
        self.first[self.nodes : self.nodes + n] = self.arcs + np.cumsum(counts) - counts
        with np.errstate(divide="ignore"):
            rest = np.log(-np.expm1(np.minimum(logp, 0.0)))
        for own, new in ((self.cut, cut), (self.target, target), (self.piece, piece), (self.logp, logp), (self.rest, rest)):
            own[self.arcs : self.arcs + m] = new
        self.nodes += n
        self.arcs += m

    def settle(self) -> None:
        """Forget, after a batch, what isn't kept. All words are, until they fill KEEP_ARCS; then those that came in one batch only go, and their room is for words that come again."""
        if self.met is None:
            if self.arcs <= KEEP_ARCS:
                return
            self.met, self.into = np.zeros(MET, bool), self.extra
            self._forget()
        self.extra.clear()
        self.nodes, self.arcs = self.kept
        if len(self.cut) > 2 * KEEP_ARCS:
            n = KEEP_ARCS + SPARE_ARCS
            self._own(*(x[:n].copy() for x in (self.steps, self.piece, self.logs)))

    def _forget(self) -> None:
        """Keep the words that came again, up to KEEP_ARCS, and move their nodes and arcs together."""
        words = list(self.start)
        begin = np.fromiter(self.start.values(), np.int64, len(words))  # ascending: words are added in order
        first = np.append(self.first[: self.nodes], np.int32(self.arcs))
        n_nodes = np.diff(np.append(begin, self.nodes))
        n_arcs = np.diff(first[np.append(begin, self.nodes)])
        stay = self.used[begin]
        stay &= np.cumsum(np.where(stay, n_arcs, 0)) <= KEEP_ARCS
        node_shift = np.cumsum(np.where(stay, 0, n_nodes))
        arc_shift = np.cumsum(np.where(stay, 0, n_arcs))
        at = np.repeat(stay, n_nodes)
        moved = self.first[: self.nodes][at] - np.repeat(arc_shift[stay], n_nodes[stay]).astype(np.int32)
        self.first[: len(moved)] = moved
        arcs, size = 0, 1 << 18
        at, shift = np.repeat(stay, n_arcs), np.repeat(node_shift.astype(np.int32), n_arcs)
        for lo in range(0, self.arcs, size):  # piece by piece, so that no second table is held
            hi = min(lo + size, self.arcs)
            held = at[lo:hi]
            to = slice(arcs, arcs + int(held.sum()))
            for x in (self.steps, self.piece, self.logs):
                x[to] = x[lo:hi][held]
            target = self.target[to]
            target[target >= 0] -= shift[lo:hi][held][target >= 0]
            arcs = to.stop
        self.kept = (len(moved), arcs)
        gone = [w for w, s in zip(words, stay.tolist(), strict=True) if not s]
        self._again(gone)
        self.start.clear()
        self.start.update(zip([w for w, s in zip(words, stay.tolist(), strict=True) if s], (begin - node_shift)[stay].tolist(), strict=True))

    def _again(self, words: list[str]) -> np.ndarray:
        """Which words were met before (a few that weren't seem so); all are from now on."""
        at = np.fromiter(map(hash, words), np.int64, len(words)) & (MET - 1)
        before = self.met[at]
        self.met[at] = True
        return before

    def _fallback(self, char: str) -> int:
        if char not in self.other:
            ids = self.model.fallback(char)
            if len(ids) == 1:
                self.other[char] = ids[0]
            else:
                self.other[char] = len(self.model.pieces) + len(self.others)
                self.others.append(ids)
        return self.other[char]

    def starts(self, words: list[str]) -> np.ndarray:
        """First nodes of the chunks U+2581 + word; unknown ones are added."""
        get = self.start
        out = np.fromiter(map(get.get, words, repeat(-1)), np.int64, len(words))
        if self.met is None:
            self.used[out[out >= 0]] = True
        missing = np.flatnonzero(out < 0).tolist()
        if not missing:
            return out
        lost = [words[i] for i in missing]
        new = [w for w in dict.fromkeys(lost) if w not in self.into]
        if self.met is not None and not self.extra and self.arcs < KEEP_ARCS:
            again = self._again(new).tolist()
            self.into = self.start
            self._add_all([w for w, a in zip(new, again, strict=True) if a])
            self.into, self.kept = self.extra, (self.nodes, self.arcs)
            new = [w for w, a in zip(new, again, strict=True) if not a]
        self._add_all(new)
        out[missing] = [self.into[w] if w in self.into else self.start[w] for w in lost]
        return out

    def _add_all(self, words: list[str]) -> None:
        short = [w for w in words if len(w) <= LONG]
        for i in range(0, len(short), 1024):
            self._add(short[i : i + 1024])
        for w in words:
            if len(w) > LONG:
                self._add_long(w)

    def _add(self, words: list[str]) -> None:
        model, width = self.model, min(self.model.longest, max(map(len, words)) + 1)
        text = SPACE + SPACE.join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, sizes = len(codes), np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(n)  # characters to the chunk's end
        powers = np.cumprod(np.full(n, model.base), dtype=np.uint64)
        inverse = np.cumprod(np.full(n, np.uint64(pow(int(model.base), -1, 1 << 64))), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(codes.astype(np.uint64)) * powers, dtype=np.uint64)])
        piece = np.full((n, width), -1, np.int32)
        weight = np.zeros((n, width))
        at = np.arange(n)
        for size in range(1, width + 1):
            at = at[left[at] >= size]
            h = (sums[at + size] - sums[at]) * inverse[at]
            seen = model.filter[h >> np.uint64(43)]
            near = seen >= 2
            p, h = at[near], h[near]
            at = at[(seen & 1).astype(bool)]
            k = np.minimum(model.place(h), len(model.hashes) - 1)
            same = model.hashes[k] == h
            p, got = p[same], model.hash_ids[k[same]]
            piece[p, size - 1] = got
            weight[p, size - 1] = model.weight[got]
        for p in np.flatnonzero(piece[:, 0] < 0):
            piece[p, 0] = self._fallback(text[p])
            weight[p, 0] = math.exp(model.floor)
        rows, cols = np.nonzero(piece >= 0)
        own = weight[rows, cols]
        counts = np.bincount(rows, minlength=n)
        ahead = np.cumsum(counts) - counts
        # Backward sums over arcs, by the distance to the chunk's end; mass[slot], with a slot of 1 behind each chunk.
        slot = np.arange(n) + np.repeat(np.arange(len(words)), sizes)
        mass = np.ones(n + len(words) + width + 1)
        goal = slot[rows] + cols + 1
        near = left.astype(np.uint8)
        order, by = np.argsort(near, kind="stable"), np.argsort(near[rows], kind="stable")
        own_by, goal_by, nodes = own[by], goal[by], slot[order]
        begin = np.cumsum(counts[order]) - counts[order]
        begin = np.append(begin, len(rows))
        bounds = np.searchsorted(near[order], np.arange(1, int(left.max()) + 2)).tolist()
        for a, b in zip(bounds, bounds[1:]):
            lo, hi = begin[a], begin[b]
            mass[nodes[a:b]] = np.add.reduceat(own_by[lo:hi] * mass[goal_by[lo:hi]], begin[a:b] - lo)
        share = own * mass[goal] / mass[slot[rows]]
        rank = np.arange(len(rows)) - ahead[rows]
        total = share.copy()
        for r in range(1, int(rank.max()) + 1):  # sums within each node, the same in any batch
            at = np.flatnonzero(rank == r)
            total[at] += total[at - 1]
        cut = np.minimum((total * _ONE).astype(np.int64), _ONE)
        cut[ahead + counts - 1] = _ONE
        target = np.where(cols + 1 < left[rows], self.nodes + rows + cols + 1, -1)
        first = self.nodes
        self._append(counts, cut, target, piece[rows, cols], np.log(share))
        for w, s in zip(words, (ends - sizes + first).tolist(), strict=True):
            self.into[w] = s

    def _add_long(self, key: str) -> None:
        word = SPACE + key
        model, n = self.model, len(word)
        arcs: list[list[tuple[int, int, float]]] = []
        for i in range(n):
            own = [(s, p, float(model.logp[p])) for s in range(1, min(model.longest, n - i) + 1) if (p := model.ids.get(word[i : i + s])) is not None]
            if not own or own[0][0] > 1:
                own.insert(0, (1, self._fallback(word[i]), model.floor))
            arcs.append(own)
        mass = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            terms = [w + mass[i + s] for s, _, w in arcs[i]]
            top = max(terms)
            mass[i] = top + math.log(sum(math.exp(t - top) for t in terms))
        counts, cut, target, piece, logp = [], [], [], [], []
        for i, own in enumerate(arcs):
            total = 0.0
            for s, p, w in own:
                lp = w + mass[i + s] - mass[i]
                total += math.exp(lp)
                cut.append(min(int(total * _ONE), _ONE))
                target.append(self.nodes + i + s if i + s < n else -1)
                piece.append(p)
                logp.append(lp)
            cut[-1] = _ONE
            counts.append(len(own))
        self.into[key] = self.nodes
        self._append(np.array(counts), np.array(cut), np.array(target), np.array(piece), np.array(logp))

    def walk(self, at: np.ndarray, start: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each node of at to its chunk's end: all arcs, in order, and how many each has. start: the chunks' first nodes; keys: their hashes."""
        at, active, steps = at.copy(), np.arange(len(at)), []
        counts = np.zeros(len(at), np.int64)
        while len(active):
            node = at[active]
            u = (_mix(keys[active] + (node - start[active]).astype(np.uint64) * _G) >> np.uint64(33)).astype(np.int64)
            np.minimum(u, _ONE - 1, out=u)
            arc = self.first[node].astype(np.int64)
            more = np.flatnonzero(self.cut[arc] <= u)
            while len(more):
                arc[more] += 1
                more = more[self.cut[arc[more]] <= u[more]]
            steps.append((active, arc))
            counts[active] += 1
            to = self.target[arc]
            at[active] = to
            active = active[to >= 0]
        offset = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        for k, (who, arc) in enumerate(steps):
            out[offset[who] + k] = arc
        return out, counts


def chunks(model: Model, text: str) -> list[str]:
    """The text's chunks, each without the U+2581 that it begins with."""
    words = text.split(" ") if text else []
    if "" in words or SPACE in text:
        words = [c[1:] for c in _CHUNK.findall(model.symbols(text))]
    return words


class _Search:
    """The state of one document's search."""

    __slots__ = ("base", "chunks", "counts", "found", "heap", "key", "logs", "paths", "todo")

    def __init__(self, key: int, chunks: np.ndarray, base: int):
        self.key, self.chunks, self.base = key, chunks, base
        self.found: list[tuple[float, float]] = []  # perturbed, log-probability
        self.paths: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []  # of each path's arcs
        self.counts: list[np.ndarray] = []
        self.heap: list = []


def _cut_up(search: _Search, lattices: Lattices, j0: int, prefix: float, excluded: tuple, top: float, k: int) -> None:
    """Put the parts of the set that the newest path leaves into the heap. The set: paths that share arcs before j0 and avoid `excluded` there."""
    r = len(search.paths)
    path = search.paths[-1]
    tail = path[j0:]
    if not len(tail):
        return
    want = k + 1 - r + 1
    seed = search.key ^ (r * 0x2545F4914F6CDD1D)

    logs = search.logs[-1][j0:]
    a, before, best = 0, prefix, []
    while a < len(tail):
        lp = logs[a : a + 512].real
        cum = before + np.cumsum(lp)
        ahead = np.concatenate([[before], cum[:-1]])
        phi = ahead + logs[a : a + 512].imag
        if a == 0 and excluded:
            gone = sum(math.exp(lattices.logp[x]) for x in excluded) + math.exp(lp[0])
            others = 1 - gone if 1 - gone > 1e-9 else lattices_rest(lattices, tail[0], (*excluded, int(tail[0])))
            phi[0] = before + (math.log(others) if others > 0 else -math.inf)
        u = _uniform(seed, np.arange(j0 + a, j0 + a + len(lp)))
        with np.errstate(divide="ignore"):
            g = phi - np.log(np.exp(np.minimum(phi - top, 700)) - np.log(u))
        g[phi == -np.inf] = -np.inf
        keep = np.argpartition(g, len(g) - want)[-want:] if len(g) > want else range(len(g))
        best += [(-float(g[i]), r - 1, j0 + a + int(i), float(ahead[i]), excluded if a + i == 0 else ()) for i in keep if g[i] > -np.inf]
        best = heapq.nsmallest(want, best)
        a, before = a + 512, float(cum[-1])
        # 37: more than the largest Gumbel variate of a 53-bit uniform number; what follows can't come before what is held.
        if len(best) == want and before + 37 < -best[-1][0]:
            break
    for x in best:
        heapq.heappush(search.heap, x)


def lattices_rest(lattices: Lattices, arc: int, gone: tuple) -> float:
    """The mass of the other arcs of arc's node."""
    node = int(np.searchsorted(lattices.first[: lattices.nodes], np.int32(arc), "right")) - 1
    end = lattices.first[node + 1] if node + 1 < lattices.nodes else lattices.arcs
    return float(sum(math.exp(lattices.logp[x]) for x in range(int(lattices.first[node]), int(end)) if x not in gone))


def _other_arc(lattices: Lattices, arc: int, gone: set, u: float) -> int | None:
    """An arc of arc's node that isn't gone, by the others' shares."""
    node = int(np.searchsorted(lattices.first[: lattices.nodes], np.int32(arc), "right")) - 1
    end = int(lattices.first[node + 1]) if node + 1 < lattices.nodes else lattices.arcs
    left = [x for x in range(int(lattices.first[node]), end) if x not in gone]
    if not left:
        return None
    shares = np.exp(lattices.logp[left])
    return left[min(int(np.searchsorted(np.cumsum(shares), u * shares.sum(), "right")), len(left) - 1)]


def sample_batch(lattices: Lattices, texts: list[str], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k distinct segmentations: (ids, log-probability, perturbed score, inclusion score), by perturbed score."""
    model = lattices.model
    words, bounds = [], [0]
    for t in texts:
        words += chunks(model, t)
        bounds.append(len(words))
    starts = lattices.starts(words)
    del words
    searches = [_Search(key, starts[a:b], a) for key, a, b in zip(keys, bounds[:-1], bounds[1:], strict=True)]
    place = np.arange(len(starts)) - np.repeat(np.array(bounds[:-1]), np.diff(bounds))
    seeds = np.repeat(np.array([x & 0xFFFFFFFFFFFFFFFF for x in keys], np.uint64), np.diff(bounds))
    hashed = lambda r, sel: _mix(_mix(seeds[sel] + np.uint64((r + 1) * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF)) + place[sel].astype(np.uint64))
    every = np.arange(len(starts))
    arcs, counts = lattices.walk(starts, starts, hashed(0, every))
    logs = lattices.logs[arcs]
    ends = np.concatenate([[0], np.cumsum(counts)])
    for s, a, b in zip(searches, bounds[:-1], bounds[1:], strict=True):
        s.paths.append(arcs[ends[a] : ends[b]])
        s.logs.append(logs[ends[a] : ends[b]])
        s.counts.append(counts[a:b])
        top = -math.log(-math.log(_uniform_one(s.key, 1 << 40)))
        s.found.append((top, float(s.logs[0].real.sum())))
        _cut_up(s, lattices, 0, 0.0, (), top, k)
    for r in range(1, k):
        todo = []
        for i, s in enumerate(searches):
            while s.heap and len(s.found) == r:
                g, parent, j, before, excluded = heapq.heappop(s.heap)
                old = s.paths[parent]
                gone = {*excluded, int(old[j])}
                arc = _other_arc(lattices, int(old[j]), gone, _uniform_one(s.key ^ (r * 0x9E6C63D0876A9A47), j))
                if arc is None:
                    continue
                chunk = int(np.searchsorted(np.cumsum(s.counts[parent]), j, "right"))
                todo.append((i, -g, parent, j, before, tuple(sorted(gone)), arc, chunk))
                break
        if not todo:
            break
        sel, at = [], []
        for i, _, _, _, _, _, arc, chunk in todo:
            s = searches[i]
            n = len(s.chunks)
            to = int(lattices.target[arc])
            a = s.base + chunk + (to < 0)
            sel.append(np.arange(a, s.base + n))
            nodes = starts[a : s.base + n].copy()
            if to >= 0:
                nodes[0] = to
            at.append(nodes)
        sel, at = np.concatenate(sel), np.concatenate(at)
        arcs, counts = lattices.walk(at, starts[sel], hashed(r, sel))
        logs = lattices.logs[arcs]
        ends = np.concatenate([[0], np.cumsum(counts)])
        used = 0
        for i, g, parent, j, before, gone, arc, chunk in todo:
            s = searches[i]
            to = int(lattices.target[arc])
            n = len(s.chunks) - chunk - (to < 0)
            old, old_counts = s.paths[parent], s.counts[parent]
            new = slice(ends[used], ends[used + n])
            path = np.concatenate([old[:j], [arc], arcs[new]])
            s.logs.append(np.concatenate([s.logs[parent][:j], lattices.logs[arc : arc + 1], logs[new]]))
            head = j - int(old_counts[:chunk].sum()) + 1  # arcs of the chunk up to the new one
            own = counts[used : used + n].copy()
            if to >= 0:
                own[0] += head
                own = np.concatenate([old_counts[:chunk], own])
            else:
                own = np.concatenate([old_counts[:chunk], [head], own])
            used += n
            s.paths.append(path)
            s.counts.append(own)
            s.found.append((g, float(s.logs[-1].real.sum())))
            _cut_up(s, lattices, j, before, tuple(x for x in gone), g, k)
    out = []
    size = len(model.pieces)
    for s in searches:
        t = -s.heap[0][0] if s.heap else -math.inf
        rows = []
        for path, (g, lp) in zip(s.paths, s.found, strict=True):
            ids = lattices.piece[path]
            if len(ids) and ids.max() >= size:
                ids = np.concatenate([[x] if x < size else lattices.others[x - size] for x in ids.tolist()]).astype(np.int32)
            rows.append((ids, lp, g, 1.0 if t == -math.inf else -math.expm1(-math.exp(min(700.0, lp - t)))))
        out.append(rows)
    return out


def row_key(seed: int, doc_id) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{doc_id}".encode(), digest_size=8).digest(), "big")


_LOADED: dict[int, Lattices] = {}


def load(proto: bytes) -> Lattices:
    key = hash(proto)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Lattices(Model(proto))
    return _LOADED[key]


SCHEMA = "doc_id bigint, sample int, ids array<int>, n_pieces int, log_prob double, perturbed double, inclusion double, round_trip boolean"


def sample(docs: DataFrame, *, k: int = 2, seed: int = 11, model: str = MODEL) -> DataFrame:
    """Up to k rows for each row of docs (doc_id, text): distinct segmentations in the order of their perturbed scores (sample 1, 2, ...).

    inclusion is the probability that the sample would hold the segmentation, given the threshold. round_trip: whether ids
    decode to the text (texts that hold U+2581 don't). A text with fewer than k segmentations gives them all; null and
    empty texts have one, without pieces; repeated rows give repeated results. model: a file that the driver reads."""
    ship(docs.sparkSession)
    with open(model, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        hold("lattices", _LOADED.clear)
        lattices = load(held.value)
        for batch in batches:
            ids, texts, chars = [], [], 0
            for part in slices([batch], 64):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids.append(doc_id)
                    texts.append(text or "")
                    chars += len(texts[-1])
                    if chars >= BATCH_CHARS or len(texts) >= 2000:
                        yield _batch(lattices, ids, texts, k, seed)
                        ids, texts, chars = [], [], 0
            if ids:
                yield _batch(lattices, ids, texts, k, seed)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, SCHEMA)


def encode(docs: DataFrame, *, into: str = "ids", model: str = MODEL) -> DataFrame:
    """docs with a column of the ids of the model's own segmentation of text. Null texts have null, empty ones no ids; all rows and other columns stay (one named `into` is replaced)."""
    return _mapped(docs, "text", into, "array<int>", model, lambda m, texts: [None if t is None else m.encode(t) for t in texts])


def decode(df: DataFrame, *, ids: str = "ids", into: str = "text", model: str = MODEL) -> DataFrame:
    """df with a column of the text that each row's ids stand for. Null ids, and ids that the model hasn't, give null; all rows and other columns stay (one named `into` is replaced)."""

    def texts(m: Model, rows):
        n = len(m.pieces)
        return [None if x is None or any(i is None or not 0 <= i < n for i in x) else m.decode(x) for x in rows]

    return _mapped(df, ids, into, "string", model, texts)


def _mapped(df: DataFrame, source: str, into: str, kind: str, model: str, convert) -> DataFrame:
    ship(df.sparkSession)
    with open(model, "rb") as f:
        held = df.sparkSession.sparkContext.broadcast(f.read())
    out = df.withColumn(into, F.lit(None).cast(kind)) if into != source else df
    at, names, schema = df.columns.index(source), out.columns, out.schema

    def run(batches):
        hold("lattices", _LOADED.clear)
        m = load(held.value).model
        for batch in slices(batches):
            columns = list(batch.columns)
            columns[names.index(into)] = pa.array(convert(m, batch.column(at).to_pylist()), pa.list_(pa.int32()) if kind == "array<int>" else pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return out.mapInArrow(run, schema)


def _batch(lattices: Lattices, doc_ids, texts, k, seed) -> pa.RecordBatch:
    got = sample_batch(lattices, texts, [row_key(seed, d) for d in doc_ids], k)
    lattices.settle()
    decode = lattices.model.decode
    rows = [(d, r + 1, ids, lp, g, q) for d, found in zip(doc_ids, got, strict=True) for r, (ids, lp, g, q) in enumerate(found)]
    back = [decode(ids) == text for text, found in zip(texts, got, strict=True) for ids, *_ in found]
    flat = np.concatenate([x[2] for x in rows]) if rows else np.empty(0, np.int32)
    sizes = np.array([len(x[2]) for x in rows], np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.astype(np.int32)))
    columns = [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int32()), lists, pa.array(sizes, pa.int32()), *(pa.array([x[i] for x in rows], pa.float64()) for i in (3, 4, 5)), pa.array(back, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.replace("array<int>", "x").split(", ")])
