"""Document log-likelihood under a gated recurrent language model with a class-factored softmax."""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, released, written
from .words import SPACES, word_hashes

FOLDS, HELD_OUT = 10, 0
#: Added to every count.
SMOOTH = 0.1
#: The commonest words, which have classes of their own kinds and whose counts go to every worker: 16 bytes each.
TOP = 1 << 17
#: Classes: the commonest words each alone, the end, clusters by context, words too rare to place, all other words.
ALONE, CLUSTERS = 32, 60
CLASSES = ALONE + CLUSTERS + 3
#: Commonest words of a cluster among which the state chooses; the cluster's other words share one more slot by their counts.
NAMED = 64
#: A token's code: its class times CODE, plus its slot in a cluster counted from 1, or 0 where its class has no slots.
CODE = 128
HIDDEN = 24
#: Texts from which the network's first weights come, before it learns from all, and tokens taken from each, from a place drawn by chance.
SAMPLE, SPAN = 1000, 8192
EPOCHS, LANES, WINDOW, RATE = 2, 64, 24, 0.01
#: When all texts are learned from: texts side by side, the rate, and tokens through which the state is carried at most.
SHARD_LANES, SHARD_RATE, STRETCH = 256, 0.003, 2048
#: Commonest words that count as context, directions of a context's sum, words whose sums are sent on together.
MARKS, DIMS, SUMS = 2000, 48, 128
#: Sums of weights are added up in so many groups of partitions.
SLOTS = 16
#: Texts scored side by side, in steps of so many positions; characters, and tokens, taken up at once, more only where one text has more.
WIDE, STEPS, BYTES, TOKENS = 512, 32, 12 << 20, 2 << 20
#: States whose softmax is worked out at once, so that it stays in a core's cache.
ROWS = 2048
#: Of these, rows whose products are added up by one call: more take longer each.
PRODUCT = 256
#: Tokens counted before they are sent on.
CHUNK = 1 << 22
#: Hash that stands for the end of a text.
END = np.uint64(1)


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of every word and end, each text's in order; A-Z count as a-z."""
    owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for owner, h in word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts], SPACES):
        owners.append(owner)
        found.append(h)
    n = len(texts)
    owner, h = np.concatenate([*owners, np.arange(n)]), np.concatenate([*found, np.full(n, END)])
    order = np.argsort(owner, kind="stable")
    return owner[order], h[order]


def parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BYTES characters together."""
    start, size = 0, 0
    for n, t in enumerate(texts):
        size += len(t or "")
        if size >= BYTES:
            yield start, n + 1
            start, size = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, c): how often every word, and the end, occurs in all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out() -> pd.DataFrame:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "c": c})

        for batch in batches:
            texts = list(batch["t"])
            for a, b in parts(texts):
                held.append(token_hashes(texts[a:b])[1])
                size += len(held[-1])
                if size >= CHUNK:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.select(F.col(text_col).alias("t")).mapInPandas(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def least_common(counts: DataFrame) -> int:
    """The smallest count by which a word is among the commonest, so that at most TOP are.

    From a histogram over 64 classes of counts for each doubling: some thousand rows at most reach the driver, and then the
    commonest words alone, whatever the number of words and partitions.
    """
    step = 64.0
    table = counts.groupBy(F.floor(F.log2("c") * step).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, None
    for b, n in sorted(((r["bin"], r["n"]) for r in table), reverse=True):
        total += n
        if total > TOP:
            break
        least = b
    return (1 << 62) if least is None else math.ceil(2 ** (least / step) - 1e-9)


class Vocabulary:
    """The commonest words by rank: the most common one is 0."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.lexsort((hashes, -counts.astype(np.int64)))
        self.counts = counts[order].astype(np.float64)
        by_hash = np.argsort(hashes[order])
        self.hashes, self.place = hashes[order][by_hash], by_hash.astype(np.int32)
        end = np.flatnonzero(hashes[order] == END)
        self.end = int(end[0]) if len(end) else -1
        # Hashes are spread evenly, so their first bits lead to a few words each.
        self.bits = max(1, len(hashes).bit_length() + 2)
        self.first = np.searchsorted(self.hashes, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.most = int(np.diff(np.r_[self.first, len(hashes)]).max(initial=0))

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """The rank of each hash, -1 where it isn't among the commonest."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.hashes):
            return out
        at, left = self.first[h >> np.uint64(64 - self.bits)], np.arange(len(h))
        for _ in range(self.most):
            near = np.minimum(at, len(self.hashes) - 1)
            hit = self.hashes[near] == h
            out[left[hit]] = self.place[near[hit]]
            # Most are found at once; only the others go on.
            rest = np.flatnonzero(~hit)
            left, h, at = left[rest], h[rest], at[rest] + 1
        return out


class RecurrentModel:
    """P(word | what came before) = P(class | state) * P(word | class, state); the state reads the classes of the words so far.

    Both factors are softmaxes over the state. In a cluster the second chooses among its NAMED commonest words and one
    slot for all its others, which share that slot by their smoothed counts, as do the words of classes too wide for a
    softmax of their own. So a text's score is its unigram score plus what the state knows better than overall shares.
    Words are ranks, and -1 is any word beyond the commonest. counts: of the commonest words, by rank. end: the rank of a text's end.
    """

    def __init__(self, counts: np.ndarray, end: int, tokens: int, distinct: int, seed: int = 5):
        self.tokens, self.distinct, self.end = tokens, distinct, end
        self.total = tokens + SMOOTH * (distinct + 1)
        self.counts = counts
        self.known = bool(len(counts))
        self.classes, self.slots = np.full(len(counts), ALONE + CLUSTERS + 1, np.int16), np.zeros(len(counts), np.int16)
        self.classes[:ALONE] = np.arange(min(ALONE, len(counts)))
        if end >= 0:
            self.classes[end] = ALONE
        rng = np.random.default_rng(seed)
        s = 1 / math.sqrt(HIDDEN)
        f = np.float32
        self.wx = (rng.normal(0, s, (CLASSES + 1, 3 * HIDDEN))).astype(f)
        self.wh = (rng.normal(0, s, (HIDDEN, 3 * HIDDEN))).astype(f)
        # Of the two softmaxes; the last row, for a state's last place that is always 1, is the bias.
        self.wo = np.zeros((HIDDEN + 1, CLASSES), f)
        self.wi = np.zeros((CLUSTERS, HIDDEN + 1, NAMED + 1), f)
        self._shares()

    def _shares(self) -> None:
        mass = np.bincount(self.classes, self.counts + SMOOTH, CLASSES)
        mass[CLASSES - 1] = (self.tokens - self.counts.sum()) + SMOOTH * (self.distinct - len(self.counts) + 1)
        self.log_share = np.log(np.maximum(mass, 1e-300) / self.total)
        # Slots of the clusters' words, commonest first, and the slots' shares of their clusters.
        cluster = self.classes.astype(np.int64) - ALONE - 1
        own = np.flatnonzero((cluster >= 0) & (cluster < CLUSTERS))
        own = own[np.argsort(cluster[own], kind="stable")]
        place = np.arange(len(own)) - np.searchsorted(cluster[own], cluster[own])
        self.slots[:] = 0
        self.slots[own] = np.minimum(place, NAMED) + 1
        inner = np.zeros((CLUSTERS, NAMED + 1))
        np.add.at(inner, (cluster[own], np.minimum(place, NAMED)), self.counts[own] + SMOOTH)
        self.log_inner = np.log(np.maximum(inner, 1e-300) / np.maximum(mass[ALONE + 1 : ALONE + 1 + CLUSTERS, None], 1e-300))
        #: By rank; the last one, at -1, is that of all other words.
        self.codes = np.r_[self.classes * np.int16(CODE) + self.slots, np.int16((CLASSES - 1) * CODE)]

    def fit(self, texts: list[np.ndarray]) -> None:
        """Learns classes and weights from the token ranks of some texts."""
        if not texts or not self.known:
            return
        sums = self.no_contexts()
        self.add_contexts(np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts), sums)
        self.place(sums)
        self.start(texts)

    def start(self, texts: list[np.ndarray]) -> None:
        """The first weights, from the token ranks of some texts."""
        if texts and self.known:
            self._train([self.codes[t] for t in texts], LANES, [RATE if epoch == 0 else RATE * 0.3 for epoch in range(EPOCHS)], self.moments())

    def no_contexts(self) -> np.ndarray:
        return np.zeros((len(self.counts), DIMS), np.int64)

    def add_contexts(self, owner: np.ndarray, rank: np.ndarray, sums: np.ndarray, rows: int = 8191) -> None:
        """Adds to sums, by rank of the word, the random directions of the common words up to two places before and after
        each word in the same text. Directions are of -1 and 1, so sums are whole and the same in any order."""
        # One more than the directions, in 8 bits each, which are added eight at a time: four of at most 2 fit, and so many rows of them fit in 16 bits.
        ways = np.random.default_rng(17).choice(np.array([0, 2], np.uint8), (4, MARKS + 1, DIMS))
        ways[:, MARKS] = 1
        ways = ways.view(np.uint64)
        near = np.where((rank >= 0) & (rank < MARKS), rank, MARKS).astype(np.int16)
        # What stands so many places away in the same text, and nothing where that is another's.
        beside = []
        for shift in (-2, -1, 1, 2):
            x = np.full(len(rank), MARKS, np.int16)
            a, b = max(0, -shift), min(len(rank), len(rank) - shift)
            if a < b:
                x[a:b] = np.where(owner[a:b] == owner[a + shift : b + shift], near[a + shift : b + shift], MARKS)
            beside.append(x)
        for first in range(0, len(rank), rows):
            own = first + np.flatnonzero(rank[first : first + rows] >= 0)
            own = own[np.argsort(rank[own])]
            if not len(own):
                continue
            x = np.take(ways[0], beside[0][own], axis=0)
            for way, other in zip(ways[1:], beside[1:], strict=True):
                x += np.take(way, other[own], axis=0)
            edges = np.flatnonzero(np.diff(rank[own], prepend=-1))
            total = np.add.reduceat(x.view(np.uint8).astype(np.uint16).view(np.uint64), edges, axis=0).view(np.uint16).astype(sums.dtype)
            sums[rank[own[edges]]] += total - 4 * np.diff(edges, append=len(own))[:, None].astype(sums.dtype)

    def place(self, sums: np.ndarray, rounds: int = 8) -> None:
        """Words that stand beside the same common words share a class: k-means over the sums of add_contexts."""
        rng = np.random.default_rng(17)
        n = self.counts
        placed = np.flatnonzero((n >= 2) & (np.arange(len(n)) >= ALONE) & (np.arange(len(n)) != self.end) & sums.any(axis=1))
        if len(placed) >= CLUSTERS:
            x = sums[placed].astype(np.float32)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
            weight = np.log1p(n[placed])
            centre = x[rng.choice(len(x), CLUSTERS, replace=False)]
            for _ in range(rounds):
                own = (x @ centre.T).argmax(axis=1)
                for d in range(DIMS):
                    centre[:, d] = np.bincount(own, x[:, d] * weight, CLUSTERS)
                centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
            self.classes[placed] = ALONE + 1 + (x @ centre.T).argmax(axis=1)
        self._shares()
        self.wo[-1] = np.maximum(self.log_share, -20)
        self.wi[:, -1] = np.maximum(self.log_inner, -20)

    def weights(self) -> list[np.ndarray]:
        return [self.wx, self.wh, self.wo, self.wi]

    def take(self, weights: list[np.ndarray]) -> None:
        self.wx, self.wh, self.wo, self.wi = weights

    def moments(self) -> list:
        """Adam's state before the first step."""
        return [[np.zeros_like(w) for w in self.weights()], [np.zeros_like(w) for w in self.weights()], 0]

    def own_copy(self) -> RecurrentModel:
        """The same with weights of its own: a broadcast model serves many tasks of a worker."""
        out = copy.copy(self)
        out.take([w.copy() for w in self.weights()])
        return out

    def learn(self, texts: list[np.ndarray], moments: list) -> None:
        """Goes on learning from every token of the texts' ranks; in longer texts the state starts anew after every STRETCH tokens."""
        pieces = [self.codes[t[a : a + STRETCH]] for t in texts for a in range(0, len(t), STRETCH)]
        self._train(pieces, max(1, min(SHARD_LANES, sum(map(len, pieces)) // (4 * WINDOW))), [SHARD_RATE], moments)

    def _gates(self) -> tuple[np.ndarray, np.ndarray]:
        """wx and wh with z, r and c apart: (gate, input or place of the state, place). Those of z and r are negative, as exp() takes them."""
        out = tuple(np.ascontiguousarray(w.reshape(len(w), 3, HIDDEN).swapaxes(0, 1)) for w in (self.wx, self.wh))
        for w in out:
            np.negative(w[:2], out=w[:2])
        return out

    def _inner(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(which tokens have slots, ordered by cluster, their slots, and for each cluster (cluster, from, to) in that order)."""
        own = np.flatnonzero(codes & np.int16(CODE - 1))
        cluster = codes[own] // np.int16(CODE) - np.int16(ALONE + 1)
        order = np.argsort(cluster, kind="stable")
        own, cluster = own[order], cluster[order]
        edges = np.flatnonzero(np.diff(cluster, prepend=-1, append=CLUSTERS)).tolist()
        return own, (codes[own] & np.int16(CODE - 1)).astype(np.int64) - 1, [(int(cluster[a]), a, b) for a, b in zip(edges, edges[1:])]

    def _train(self, texts: list[np.ndarray], lanes: int, rates: list[float], moments: list) -> None:
        """Backpropagation through WINDOW steps, with the state carried from window to window; Adam, a pass for each rate.
        texts: codes of their tokens."""
        run = Lanes(texts, min(lanes, len(texts)))
        f, hid = np.float32, HIDDEN
        weights = self.weights()
        first, second, _ = moments
        ones, inner_ones = np.ones(CLASSES, f), np.ones(NAMED + 1, f)
        for rate in rates:
            h = np.zeros((run.lanes, hid), f)
            for x, codes, _ in run.steps(WINDOW):
                lanes = x.shape[1]
                h = h[:lanes]
                flat = codes.ravel()
                size = np.count_nonzero(flat >= 0)
                # Each gate has arrays of its own, so that what is worked out element by element lies in one piece.
                by_x, by_h = self._gates()
                gx = np.take(by_x, x, axis=1)
                fresh = [np.flatnonzero(row) for row in x == CLASSES]
                before, c, apart, states, ghs = (np.empty((len(x), lanes, hid), f) for _ in range(5))
                zr = np.empty((2, len(x), lanes, hid), f)
                z, r = zr
                for t in range(len(x)):
                    held, gates, ct = before[t], zr[:, t], c[t]
                    held[...] = h
                    held[fresh[t]] = 0
                    np.matmul(held, by_h[:2], out=gates)
                    gates += gx[:2, t]
                    np.exp(gates, out=gates)
                    gates += 1
                    np.reciprocal(gates, out=gates)
                    np.multiply(r[t], np.matmul(held, by_h[2], out=ghs[t]), out=ct)
                    ct += gx[2, t]
                    np.tanh(ct, out=ct)
                    h = np.multiply(z[t], np.subtract(held, ct, out=apart[t]), out=states[t])
                    h += ct
                hs = np.ones((len(flat), hid + 1), f)
                hs[:, :hid] = states.reshape(-1, hid)
                dhs, g_wo, back_o = np.empty((len(flat), hid), f), np.zeros_like(self.wo), np.ascontiguousarray(self.wo[:hid].T)
                for a in range(0, len(flat), ROWS):
                    some, codes = hs[a : a + ROWS], flat[a : a + ROWS]
                    d = some @ self.wo
                    np.exp(d, out=d)
                    d *= ((codes >= 0) / (d @ ones * f(size))).astype(f)[:, None]
                    here = np.flatnonzero(codes >= 0)
                    d.reshape(-1)[here * CLASSES + codes[here] // CODE] -= f(1 / size)
                    np.matmul(d, back_o, out=dhs[a : a + ROWS])
                    for b in range(0, len(d), PRODUCT):
                        g_wo += some[b : b + PRODUCT].T @ d[b : b + PRODUCT]
                own, slot, parts = self._inner(np.maximum(flat, 0))
                g_wi = np.zeros_like(self.wi)
                if parts:
                    given, back_i = np.take(hs, own, axis=0), np.empty((len(own), hid), f)
                    back_w = np.ascontiguousarray(self.wi[:, :hid].swapaxes(1, 2))
                    for some in batched(parts):
                        start, stop = some[0][1], some[-1][2]
                        d = np.empty((stop - start, NAMED + 1), f)
                        for k, a, b in some:
                            np.matmul(given[a:b], self.wi[k], out=d[a - start : b - start])
                        np.exp(d, out=d)
                        d *= (1 / (d @ inner_ones * f(size)))[:, None]
                        d.reshape(-1)[np.arange(stop - start) * (NAMED + 1) + slot[start:stop]] -= f(1 / size)
                        for k, a, b in some:
                            part = d[a - start : b - start]
                            np.matmul(given[a:b].T, part, out=g_wi[k])
                            np.matmul(part, back_w[k], out=back_i[a:b])
                    back_i += np.take(dhs, own, axis=0)
                    dhs[own] = back_i
                # What depends on no later step is worked out for the whole window: the derivatives by c as the state gives it, z, r, and c as the input gives it.
                by_gate = np.empty((4, len(x), lanes, hid), f)
                by_ch, by_z, by_r, by_cx = by_gate
                rest = np.subtract(1, z)
                np.multiply(c, c, out=by_cx)
                np.subtract(1, by_cx, out=by_cx)
                by_cx *= rest
                rest *= z
                np.multiply(apart, rest, out=by_z)
                np.multiply(by_cx, r, out=by_ch)
                np.subtract(1, r, out=rest)
                rest *= ghs
                np.multiply(by_ch, rest, out=by_r)
                dh_out, dh = dhs.reshape(len(x), lanes, hid), np.zeros((lanes, hid), f)
                back = np.ascontiguousarray(self.wh.reshape(hid, 3, hid)[:, [2, 0, 1]].transpose(1, 2, 0))
                parts = np.empty((3, lanes, hid), f)
                for t in range(len(x) - 1, -1, -1):
                    dh += dh_out[t]
                    gates = by_gate[:, t]
                    gates *= dh
                    dh *= z[t]
                    for part in np.matmul(gates[:3], back, out=parts):
                        dh += part
                    dh[fresh[t]] = 0
                order = np.argsort(x.ravel(), kind="stable")
                kinds = x.ravel()[order]
                edges = np.flatnonzero(np.diff(kinds, prepend=-1, append=CLASSES + 1)).tolist()
                g_wh = np.matmul(before.swapaxes(1, 2), by_gate[:3]).sum(axis=1)[[1, 2, 0]].swapaxes(0, 1).reshape(hid, 3 * hid)
                by_gate = by_gate.reshape(4, -1, hid)
                grads = [np.zeros_like(self.wx), g_wh, g_wo, g_wi]
                by_kind, all_ones = np.take(by_gate[1:], order, axis=1), np.ones(len(order), f)
                for a, b in zip(edges, edges[1:]):
                    np.matmul(all_ones[: b - a], by_kind[:, a:b], out=grads[0][kinds[a]].reshape(3, hid))
                norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads))
                moments[2] += 1
                step = moments[2]
                for w, g, m, v in zip(weights, grads, first, second, strict=True):
                    # 0.1 times the clipped gradient, whose square is 0.01 times the gradient's.
                    g *= 0.1 * min(1.0, 1.0 / max(norm, 1e-9))
                    m *= 0.9
                    m += g
                    g *= g
                    v *= 0.99
                    v += g
                    np.sqrt(v, out=g)
                    g += 1e-8 * math.sqrt(1 - 0.99**step)
                    np.divide(m, g, out=g)
                    g *= rate * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    w -= g

    def lift(self, texts: list[np.ndarray]) -> np.ndarray:
        """For each text of codes, log10 of how much likelier its classes and slots are given the state than by their shares."""
        out = np.zeros(len(texts))
        if not texts or not self.known:
            return out
        run = Lanes(texts, max(1, min(WIDE, len(texts), sum(map(len, texts)) // STEPS)))
        hid, f = HIDDEN, np.float32
        h = np.zeros((run.lanes, hid), f)
        ones, inner_ones = np.ones(CLASSES, f), np.ones(NAMED + 1, f)
        by_x, by_h = self._gates()
        for x, codes, index in run.steps(STEPS):
            lanes = x.shape[1]
            h = h[:lanes]
            hs, ct, apart = np.ones((len(x), lanes, hid + 1), f), np.empty((lanes, hid), f), np.empty((lanes, hid), f)
            zr = np.empty((2, lanes, hid), f)
            for t, row in enumerate(x):
                h[np.flatnonzero(row == CLASSES)] = 0
                gx = np.take(by_x, row, axis=1)
                np.matmul(h, by_h[:2], out=zr)
                zr += gx[:2]
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.matmul(h, by_h[2], out=ct)
                ct *= zr[1]
                ct += gx[2]
                np.tanh(ct, out=ct)
                h = np.multiply(zr[0], np.subtract(h, ct, out=apart), out=h)
                h += ct
                hs[t, :, :hid] = h
            hs = hs.reshape(-1, hid + 1)
            flat = codes.ravel()
            real = np.flatnonzero(flat >= 0)
            kind = flat[real] // np.int16(CODE)
            likely, whole = np.empty(len(real), f), np.empty(len(flat), f)
            bounds = np.searchsorted(real, np.arange(0, len(flat) + ROWS, ROWS))
            for a, i, j in zip(range(0, len(flat), ROWS), bounds, bounds[1:]):
                logits = hs[a : a + ROWS] @ self.wo
                likely[i:j] = logits.reshape(-1)[(real[i:j] - a) * CLASSES + kind[i:j]]
                np.exp(logits, out=logits)
                np.matmul(logits, ones, out=whole[a : a + ROWS])
            won = np.zeros(len(flat))
            won[real] = likely - self.log_share[kind] - np.log(whole[real].astype(np.float64))
            own, slot, parts = self._inner(np.maximum(flat, 0))
            if parts:
                given = np.take(hs, own, axis=0)
                chosen, whole, shares = np.empty(len(own), f), np.empty(len(own), f), np.empty(len(own))
                for some in batched(parts):
                    start, stop = some[0][1], some[-1][2]
                    logits = np.empty((stop - start, NAMED + 1), f)
                    for k, a, b in some:
                        np.matmul(given[a:b], self.wi[k], out=logits[a - start : b - start])
                        shares[a:b] = self.log_inner[k][slot[a:b]]
                    chosen[start:stop] = logits.reshape(-1)[np.arange(stop - start) * (NAMED + 1) + slot[start:stop]]
                    np.exp(logits, out=logits)
                    np.matmul(logits, inner_ones, out=whole[start:stop])
                won[own] += chosen - shares - np.log(whole.astype(np.float64))
            out += np.bincount(run.text[index.ravel()[real]], won[real], len(texts))
        return out / math.log(10)


def batched(parts: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """RecurrentModel._inner's clusters, as many at once as have about ROWS tokens together."""
    first = 0
    for n, (_, _, b) in enumerate(parts):
        if n + 1 == len(parts) or b - parts[first][1] >= ROWS:
            yield parts[first : n + 1]
            first = n + 1


class Lanes:
    """Texts one after another in lanes of about equal length, longest lane first. Only the tokens themselves are held, in the
    order of the lanes; what steps() lays out side by side is a slice of all lanes that still go on."""

    def __init__(self, texts: list[np.ndarray], lanes: int):
        self.lanes = lanes
        load = [(0, i) for i in range(lanes)]
        queue: list[list[int]] = [[] for _ in range(lanes)]
        for n in sorted(range(len(texts)), key=lambda n: -len(texts[n])):
            size, lane = heapq.heappop(load)
            queue[lane].append(n)
            heapq.heappush(load, (size + len(texts[n]), lane))
        sizes = [sum(len(texts[n]) for n in own) for own in queue]
        order = sorted(range(lanes), key=lambda i: -sizes[i])
        texts_in_order = [n for i in order for n in queue[i]]
        self.length = np.array([sizes[i] for i in order], np.int64)
        self.offset = np.r_[0, np.cumsum(self.length)[:-1]]
        # One spare token at the end for places past a lane's own.
        self.code = np.concatenate([*(texts[n] for n in texts_in_order), np.array([-1], np.int16)])
        self.text = np.repeat(np.array([*texts_in_order, -1], np.int32), [*(len(texts[n]) for n in texts_in_order), 1])
        self.given = np.empty(len(self.code), np.int16)
        self.given[1:] = self.code[:-1] // np.int16(CODE)
        self.given[np.flatnonzero(np.diff(self.text, prepend=-2))] = CLASSES

    def steps(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(input, code, place) of the next n places of every lane, by place and lane. The input is the class before, or CLASSES
        at a text's start; place is that in code and text, which are -1 past a lane's end."""
        spare = len(self.code) - 1
        for at in range(0, int(self.length.max(initial=0)), n):
            lanes = int((self.length > at).sum())
            place = at + np.arange(min(n, int(self.length[0]) - at))[:, None]
            index = self.offset[:lanes] + place
            if int(self.length[lanes - 1]) <= at + n:
                index = np.where(place < self.length[:lanes], index, spare)
            yield np.take(self.given, index), np.take(self.code, index), index


def ranked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The ranks of each text of Arrow batches of one binary column, about TOKENS at a time."""
    held, size = [], 0
    for batch in batches:
        for x in batch.column(0):
            held.append(np.frombuffer(x.as_buffer(), np.int32))
            size += len(held[-1])
            if size >= TOKENS:
                yield held
                held, size = [], 0
        if held:  # what is held points into the batch
            yield held
            held, size = [], 0


def context_sums(texts: DataFrame, model: RecurrentModel, shared: Broadcast) -> np.ndarray:
    """RecurrentModel.add_contexts over all texts, rows of one column of ranks. Every task sends its sums in blocks of words, in the
    fewest bytes that hold them; they are added up by block in Spark, and one sum for each of the commonest words reaches the driver."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = own.no_contexts().astype(np.int32)
        for some in ranked_texts(batches):
            own.add_contexts(np.repeat(np.arange(len(some)), [len(t) for t in some]), np.concatenate(some), sums)
        out = []
        for block in range(0, len(sums), SUMS):
            part = sums[block : block + SUMS]
            if part.any():
                kind = next(k for k in (np.int8, np.int16, np.int32) if np.abs(part).max() <= np.iinfo(k).max)
                out.append((block, np.dtype(kind).itemsize, part.astype(kind).tobytes()))
        if out:
            yield pa.RecordBatch.from_pydict({"block": pa.array([x[0] for x in out], pa.int32()), "size": pa.array([x[1] for x in out], pa.int32()), "s": pa.array([x[2] for x in out], pa.binary())})
        del sums, out
        released()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s, f"i{size}").astype(np.int64) for size, s in zip(group["size"], group["s"], strict=True))
        return pd.DataFrame({"block": group["block"][:1], "s": [total.tobytes()]})

    sent = texts.mapInArrow(gather, "block int, size int, s binary")
    sums = model.no_contexts()
    for r in sent.groupBy("block").applyInPandas(add, "block int, s binary").collect():
        sums[r["block"] : r["block"] + SUMS] = np.frombuffer(r["s"], np.int64).reshape(-1, DIMS)
    return sums


def learned(texts: DataFrame, shared: Broadcast) -> list[np.ndarray] | None:
    """Weights learned from all texts, rows of one column of ranks: every task goes on from the shared model over its own texts,
    and the mean of the tasks' weights by their numbers of tokens is taken, added up in Spark. None without texts."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.own_copy()
        n, moments = 0, own.moments()
        for some in ranked_texts(batches):
            own.learn(some, moments)
            n += sum(map(len, some))
        if n:
            part = TaskContext.get().partitionId()
            weights = np.concatenate([w.ravel() for w in own.weights()]).tobytes()
            yield pa.RecordBatch.from_pydict({"slot": pa.array([part % SLOTS], pa.int32()), "part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64()), "w": pa.array([weights], pa.binary())})
        del own, moments
        released()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        total = sum(n * np.frombuffer(w, np.float32).astype(np.float64) for n, w in zip(group["n"], group["w"], strict=True))
        return pd.DataFrame({"slot": group["slot"][:1], "n": [group["n"].sum()], "w": [total.tobytes()]})

    sent = texts.mapInArrow(learn, "slot int, part int, n long, w binary")
    rows = sorted(sent.groupBy("slot").applyInPandas(add, "slot int, n long, w binary").collect(), key=lambda r: r["slot"])
    if not rows:
        return None
    mean = (sum(np.frombuffer(r["w"], np.float64) for r in rows) / sum(r["n"] for r in rows)).astype(np.float32)
    shapes = [w.shape for w in shared.value.weights()]
    cuts = np.cumsum([math.prod(x) for x in shapes])[:-1]
    return [w.reshape(x) for w, x in zip(np.split(mean, cuts), shapes, strict=True)]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text with A-Z in lower case, and one end; null and empty texts are an end alone. Counts
    are of all learning texts, whose number of tokens is train_tokens. Classes come from the contexts of all their words, and
    weights from all their tokens; only the weights that this starts from are of a sample. The tasks' weights are
    averaged, so the last digits of score depend on how the input is dealt. Without learning texts both scores are those
    of unknown tokens. Repeated rows each return; a null id belongs to the learning part.

    Words are told apart by 64-bit hashes. Counts of the commonest go to every worker, which writes each text as the
    ranks of its words; learning and scoring read those. A text's other words
    meet their counts in a join, so common words never make a large key there.
    """
    spark = docs.sparkSession
    held = F.coalesce(crc_mod(id_col, FOLDS) == HELD_OUT, F.lit(False))
    counts = written(token_counts(docs.where(~held), text_col), "lm-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.where(F.col("c") >= least_common(counts)).toPandas()
    n_train = (counts.where(F.col("h") == int(END)).first() or {"c": 0})["c"]
    words = Vocabulary(top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64))
    model = RecurrentModel(words.counts, words.end, tokens, distinct)
    spelt, total = spark.sparkContext.broadcast(words), model.total

    @F.pandas_udf("n long, known long, base double, ranks binary, other array<long>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = spelt.value
        shares = np.log10((own.counts + SMOOTH) / total)
        for batch in batches:
            texts, out = list(batch), []
            for a, b in parts(texts):
                owner, h = token_hashes(texts[a:b])
                rank = own.ranks(h)
                n = b - a
                cut = np.searchsorted(owner, np.arange(1, n))
                common = rank >= 0
                base = np.bincount(owner[common], shares[rank[common]], n)
                other = np.split(h[~common].view(np.int64), np.searchsorted(owner[~common], np.arange(1, n)))
                out.append(pd.DataFrame({"n": np.bincount(owner, minlength=n), "known": np.bincount(owner[common], minlength=n), "base": base, "ranks": [x.tobytes() for x in np.split(rank, cut)], "other": other}))
                del owner, h, rank
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"n": [], "known": [], "base": [], "ranks": [], "other": []})
        released()

    judged = docs.select(F.col(id_col).alias("_id"), held.alias("held_out"), F.col(text_col).alias("_t")).withColumn("_uid", F.monotonically_increasing_id())
    read_ = written(judged.select("_uid", "_id", "held_out", judge("_t").alias("s")).select("_uid", "_id", "held_out", "s.*"), "lm-tokens")
    learning = read_.where(~F.col("held_out")).select("ranks")
    if model.known:
        digest = F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")))
        draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
        place = F.pmod(F.xxhash64(digest), F.greatest(F.col("n") - SPAN, F.lit(0)) + 1)
        some = F.substring(F.col("ranks"), (place * 4 + 1).cast("int"), F.lit(4 * SPAN))
        sample = read_.where(~F.col("held_out") & (draw < min(1.0, SAMPLE / max(1, n_train)))).select(digest.alias("o"), some.alias("r")).collect()
        shared = spark.sparkContext.broadcast(model)
        model.place(context_sums(learning, model, shared))
        shared.unpersist()
        model.start([np.frombuffer(r["r"], np.int32) for r in sorted(sample, key=lambda r: (r["o"], r["r"]))])
        shared = spark.sparkContext.broadcast(model)
        model.take(learned(learning, shared) or model.weights())
        shared.unpersist()
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def lift(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            found = [np.zeros(0)]
            for some in ranked_texts(iter([pa.RecordBatch.from_arrays([batch], ["r"])])):
                found.append(own.lift([own.codes[t] for t in some]))
            yield pa.array(np.concatenate(found))
        released()

    scored = read_.select("_uid", "_id", "held_out", "n", "known", "base", lift("ranks").alias("lift"))
    rest = read_.select("_uid", F.explode("other").alias("h")).join(counts, "h", "left")
    terms = rest.groupBy("_uid").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + F.lit(SMOOTH)) / F.lit(total))).alias("more"), F.count("c").alias("seen"))
    base = F.col("base") + F.coalesce("more", F.lit(0.0))
    return scored.join(terms, "_uid", "left").select(
        F.col("_id").alias(id_col),
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("lift")).alias("score"),
    )
