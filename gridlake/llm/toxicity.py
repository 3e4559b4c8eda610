"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read in overlapping windows of words. A word enters as the sum of a vector of its own,
if it is one of the words chosen in fitting, and vectors of the runs of characters in it that
were. Two gated recurrences, forwards and backwards, read a window; attention weighs their states
into one, which a linear layer scores. A text is as toxic as its worst window.

What a word adds to the gates depends on the word alone, so workers keep that in a table, and a
step of the recurrence is one small matrix product for thousands of windows at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common
from gridlake.llm.units import UnitCache, forget, kept

WINDOW, STRIDE = 16, 8
#: Labelled documents of each class that the network is fitted on, the first by hash of doc_id.
FIT_DOCUMENTS = 2000
#: Words and runs of characters with a vector, those that tell the classes apart best.
WORDS, GRAMS = 1500, 4000
GRAM_SIZES = (3, 4, 5)
WIDTH, HIDDEN, ATTENTION = 12, 8, 8
EDGES = ".,;:!?|*#$%&\"'()[]="
THRESHOLD = 0.3
#: Windows that are read in step.
CHUNK = 2048
#: Last bits of a run's number that are looked at first.
SIEVE = np.uint64((1 << 15) - 1)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def core(word: str) -> str:
    return word.strip(EDGES)


def grams(word: str) -> list[str]:
    word = f"^{word}$"
    return [word[i : i + n] for n in GRAM_SIZES for i in range(len(word) - n + 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name. Gates are kept side by side: update, reset, candidate."""

    def __init__(self, words: list[str], runs: list[str], seed: int = 1):
        self.words = {w: i for i, w in enumerate(words)}
        self.alphabet = np.array(sorted({ord(c) for g in runs for c in g}), np.uint32)
        self.base = np.uint64(len(self.alphabet) + 1)
        # By length: runs as numbers, in order; their features; and which last bits any of them has.
        self.codes = {}
        for n in GRAM_SIZES:
            own = [(g, len(words) + i) for i, g in enumerate(runs) if len(g) == n]
            if own:
                code = np.zeros(len(own), np.uint64)
                digit = self._digits(np.array([ord(c) for g, _ in own for c in g], np.uint32)).reshape(len(own), n)
                for k in range(n):
                    code = code * self.base + digit[:, k]
                order = np.argsort(code)
                sieve = np.zeros(int(SIEVE) + 1, bool)
                sieve[code & SIEVE] = True
                self.codes[n] = code[order], np.array([f for _, f in own], np.int64)[order], sieve
        self.features = {("w", w): i for i, w in enumerate(words)} | {("g", g): len(words) + i for i, g in enumerate(runs)}
        draw = np.random.default_rng(seed).normal
        h, d = HIDDEN, WIDTH
        self.p = {"embed": draw(0, 0.3, (len(self.features) + 1, d))}  # the last row: any word
        for way in ("f", "b"):
            self.p |= {f"x{way}": draw(0, d**-0.5, (d, 3 * h)), f"h{way}": draw(0, h**-0.5, (h, 3 * h)), f"c{way}": np.zeros(3 * h)}
        self.p |= {
            "a": draw(0, (2 * h) ** -0.5, (2 * h, ATTENTION)), "ab": np.zeros(ATTENTION), "v": draw(0, 0.3, ATTENTION),
            "o": draw(0, (2 * h) ** -0.5, 2 * h), "ob": np.zeros(1),
        }
        self.scale = np.array([1.0, 0.0])  # of a text's worst window to the logit of its label

    # ---- words

    def parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(owner, feature) of each known part of each word."""
        cores = [core(word) for word in words]
        own = np.fromiter(map(self.words.get, cores, repeat(-1)), np.int64, len(cores))
        at = np.flatnonzero(own >= 0)
        found = [at * len(self.features) + own[at]]
        # Runs of all words at once: characters are digits, and a run is a number.
        text = np.frombuffer("".join([f"^{word}$" for word in cores]).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(word) + 2 for word in cores], np.int64)
        owner = np.repeat(np.arange(len(cores)), sizes)
        left = np.cumsum(sizes)[owner] - np.arange(len(text)) if len(text) else owner
        digit = self._digits(text)
        code = digit
        for n in range(2, 1 + max(GRAM_SIZES)):
            code = code[: len(text) + 1 - n] * self.base + digit[n - 1 :]
            if n in self.codes:
                codes, features, sieve = self.codes[n]
                at = np.flatnonzero(sieve[code & SIEVE])
                at = at[left[at] >= n]
                place = np.minimum(np.searchsorted(codes, code[at]), len(codes) - 1)
                same = codes[place] == code[at]
                found.append(owner[at[same]] * len(self.features) + features[place[same]])
        both = np.sort(np.concatenate(found))
        return np.divmod(both[np.append(True, both[1:] != both[:-1])] if len(both) else both, max(1, len(self.features)))

    def _digits(self, text: np.ndarray) -> np.ndarray:
        """Characters as digits from 1; 0 for those that are in no run."""
        if not len(self.alphabet):
            return np.zeros(len(text), np.uint64)
        at = np.minimum(np.searchsorted(self.alphabet, text), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == text, at + 1, 0).astype(np.uint64)

    def vectors(self, n: int, owner: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Sums of the parts of ``n`` words; ``owner`` ascends."""
        out = np.tile(self.p["embed"][-1], (n, 1))
        if len(owner):
            head = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[head]] += np.add.reduceat(self.p["embed"][feature], head, axis=0)
        return out

    # ---- windows, for fitting

    def forward(self, x: np.ndarray, live: np.ndarray):
        """Scores of windows (n, length, WIDTH); ``live`` marks the words that are there."""
        n, t, _ = x.shape
        h, states, kept = HIDDEN, {}, {}
        for way in ("f", "b"):
            gates = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
            s, out, keep = np.zeros((n, h)), np.zeros((n, t, h)), [None] * t
            for i in range(t) if way == "f" else range(t - 1, -1, -1):
                rec = s @ self.p[f"h{way}"]
                zr = _sigmoid(gates[:, i, : 2 * h] + rec[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                cand = np.tanh(gates[:, i, 2 * h :] + r * rec[:, 2 * h :])
                new = np.where(live[:, i, None], (1 - z) * cand + z * s, s)
                keep[i] = (s, z, r, cand, rec[:, 2 * h :])
                s = out[:, i] = new
            states[way], kept[way] = out, keep
        both = np.concatenate([states["f"], states["b"]], axis=2)
        u = np.tanh(both @ self.p["a"] + self.p["ab"])
        e = np.where(live, u @ self.p["v"], -1e9)
        w = np.exp(e - e.max(axis=1, keepdims=True)) * live
        w = w / np.maximum(w.sum(axis=1, keepdims=True), 1e-9)
        pooled = (w[:, :, None] * both).sum(axis=1)
        return pooled @ self.p["o"] + self.p["ob"][0], (x, live, kept, both, u, w, pooled)

    def backward(self, slope: np.ndarray, memory) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all parameters but the embedding, and of the inputs."""
        x, live, kept, both, u, w, pooled = memory
        n, t, _ = x.shape
        h, g = HIDDEN, {}
        g["o"], g["ob"] = pooled.T @ slope, np.array([slope.sum()])
        d_pooled = slope[:, None] * self.p["o"]
        d_both = w[:, :, None] * d_pooled[:, None]
        d_w = (both * d_pooled[:, None]).sum(axis=2)
        d_e = w * (d_w - (w * d_w).sum(axis=1, keepdims=True))
        d_u = d_e[:, :, None] * self.p["v"] * (1 - u**2)
        g["v"] = (d_e[:, :, None] * u).sum(axis=(0, 1))
        g["a"], g["ab"] = np.einsum("nti,ntj->ij", both, d_u), d_u.sum(axis=(0, 1))
        d_both = d_both + d_u @ self.p["a"].T
        d_x = np.zeros_like(x)
        for k, way in enumerate(("f", "b")):
            d_state, g[f"h{way}"] = np.zeros((n, h)), np.zeros((h, 3 * h))
            d_gates = np.zeros((n, t, 3 * h))
            for i in range(t - 1, -1, -1) if way == "f" else range(t):
                s, z, r, cand, rec_c = kept[way][i]
                on = live[:, i, None]
                d_new = d_state + d_both[:, i, k * h : (k + 1) * h]
                d = np.where(on, d_new, 0)
                d_cand = d * (1 - z) * (1 - cand**2)
                d_z = d * (s - cand) * z * (1 - z)
                d_r = d_cand * rec_c * r * (1 - r)
                d_gates[:, i] = np.concatenate([d_z, d_r, d_cand], axis=1)
                d_rec = np.concatenate([d_z, d_r, d_cand * r], axis=1)
                g[f"h{way}"] += s.T @ d_rec
                d_state = np.where(on, d * z, d_new) + d_rec @ self.p[f"h{way}"].T
            g[f"x{way}"], g[f"c{way}"] = np.einsum("nti,ntj->ij", x, d_gates), d_gates.sum(axis=(0, 1))
            d_x += d_gates @ self.p[f"x{way}"].T
        return g, d_x

    # ---- whole texts

    def reader(self) -> "Reader":
        return Reader(self)


class Reader:
    """Scores whole texts; float32, and gates by word from a table."""

    def __init__(self, network: Network):
        self.network = network
        self.p = {k: v.astype(np.float32) for k, v in network.p.items()}
        self.cache = UnitCache(self._gates, kind=np.float32, limit=150_000)

    def _gates(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        x = self.network.vectors(len(words), *self.network.parts(words)).astype(np.float32)
        gates = np.concatenate([x @ self.p["xf"] + self.p["cf"], x @ self.p["xb"] + self.p["cb"]], axis=1)
        return words, gates.reshape(-1), np.full(len(words), 6 * HIDDEN), np.zeros(len(words))

    def worst(self, texts: list[str]) -> np.ndarray:
        """Logit of the worst window of each text; that of no words at all for an empty text."""
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        out = np.full(len(texts), float(self.p["ob"][0]))
        on = np.flatnonzero(sizes)
        if not len(on):
            return out
        rows = self.cache.rows([w for own in words for w in own])
        scores, many = self.all_windows(self.cache.ids.reshape(-1, 6 * HIDDEN), rows, sizes[on])
        out[on] = np.maximum.reduceat(scores, np.cumsum(many) - many)
        return out

    def all_windows(self, table: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each window of texts that have ``sizes`` words each (one at least), whose rows
        in ``table`` stand one text after the other; and windows of each text."""
        first, many = window_starts(sizes)
        owner = np.repeat(np.arange(len(sizes)), many)
        place, left = first + (np.cumsum(sizes) - sizes)[owner], sizes[owner] - first
        ways = [np.ascontiguousarray(table[:, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN]) for k in (0, 1)]
        scores = np.empty(len(first), np.float32)
        # Windows that are full need no mask; nearly all are.
        for some, full in ((np.flatnonzero(left >= WINDOW), True), (np.flatnonzero(left < WINDOW), False)):
            for at in range(0, len(some), CHUNK):
                part = some[at : at + CHUNK]
                index = place[part] + np.arange(WINDOW)[:, None]
                live = None if full else np.arange(WINDOW)[:, None] < left[part]
                scores[part] = self.windows(ways, rows[index if full else np.minimum(index, len(rows) - 1)], live)
        return scores, many

    def windows(self, ways: list[np.ndarray], index: np.ndarray, live: np.ndarray | None) -> np.ndarray:
        """Scores of windows; ``index`` (WINDOW, windows) tells the rows of both tables of ``ways``, ``live``
        which words are there. Windows lie along the last axis of all arrays, so numpy's loops are long."""
        n, h = index.shape[1], HIDDEN
        both = np.empty((WINDOW, 2 * h, n), np.float32)
        for k, way in enumerate(("f", "b")):
            s, u = np.zeros((h, n), np.float32), np.ascontiguousarray(self.p[f"h{way}"].T)
            for i in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
                gates = np.ascontiguousarray(ways[k].take(index[i], axis=0).T)
                rec = u @ s
                zr = gates[: 2 * h]
                zr += rec[: 2 * h]
                np.clip(zr, -30, 30, out=zr)
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                cand = zr[h:] * rec[2 * h :]
                cand += gates[2 * h :]
                np.tanh(cand, out=cand)
                new = s - cand
                new *= zr[:h]
                new += cand
                s = new if live is None else np.where(live[i], new, s)
                both[i, k * h : (k + 1) * h] = s
        e = self.p["v"] @ np.tanh(self.p["a"].T @ both + self.p["ab"][:, None])
        if live is not None:
            e = np.where(live, e, np.float32(-1e9))
        w = np.exp(e - e.max(axis=0))
        return (w * (self.p["o"] @ both)).sum(axis=0) / w.sum(axis=0) + self.p["ob"][0]

    def score(self, texts: list[str]) -> np.ndarray:
        a, b = self.network.scale
        return _sigmoid(a * self.worst(texts) + b)


def window_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window of each text, and windows of each text: every ``STRIDE`` words,
    until one reaches the end."""
    many = 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return nth * STRIDE, many


# --------------------------------------------------------------------------------------- fitting

#: Bytes of texts whose words and runs a task holds at once.
PART_BYTES = 1 << 19
#: Bytes of texts that a task scores at once: their words are strings meanwhile.
SCORED_BYTES = 1 << 20
#: Windows that fitting takes of a text in a round: its worst, and of clean texts one drawn besides.
_PICKED = "doc_id long, y int, drawn boolean, words array<string>"


def _parts_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class hold a word or a run; a text counts once. Counts leave the task by
    small slices of texts, since runs are many."""
    forget()
    for batch, *_ in common.buffers(batches, "text", PART_BYTES):
        counts: dict[tuple[str, str, int], int] = {}
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            own = {core(w) for w in words_of(text or "")}
            for name in own:
                counts["w", name, y] = counts.get(("w", name, y), 0) + 1
            for name in {g for w in own for g in grams(w)}:
                counts["g", name, y] = counts.get(("g", name, y), 0) + 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            ["kind", "name", "y", "n"],
        )


def telling_parts(rows: DataFrame, totals: np.ndarray, most: dict[str, int]) -> list[tuple[str, str, float]]:
    """(kind, name, log odds) of the words and runs whose shares in the two classes lie apart by most
    deviations; ``most`` bounds each kind."""
    counted = rows.mapInArrow(_parts_counted, "kind string, name string, y int, n long")
    both = counted.groupBy("kind", "name").agg(*[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(f"c{y}") for y in (0, 1)])
    share = [(F.col(f"c{y}") + 0.5) / (float(totals[y]) + 1) for y in (0, 1)]
    spread = sum((share[y] * (1 - share[y]) / (float(totals[y]) + 1) for y in (0, 1)), F.lit(0.0))
    apart = F.abs(share[1] - share[0]) / F.sqrt(spread)
    known = both.where("c0 + c1 >= 3").select("kind", "name", apart.alias("z"), (F.log(share[1]) - F.log(share[0])).alias("odds")).where("z > 2")
    found = []
    for kind, n in most.items():
        top = known.where(F.col("kind") == kind).orderBy(F.desc("z"), "name").limit(n)
        found += [(r.kind, r.name, r.odds) for r in top.select("kind", "name", "odds").collect()]
    return found


def _picker(net: Network, hint: np.ndarray | None, seed: int, turn: int):
    """Task that picks windows of texts: the worst by the network or, at first, by the odds of the
    parts of its words, and of clean texts a drawn one. What it sends back is bounded by the number
    of texts, not by their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        reader = net.reader() if hint is None else None
        worth: dict[str, float] = {}
        for part, *_ in common.buffers(batches, "text", 1 << 20):
            ids, labels, drawn, picked = [], [], [], []
            rows = [(d, y, words_of(t or "")) for d, y, t in zip(*(part.column(c).to_pylist() for c in ("doc_id", "y", "text")))]
            rows = [r for r in rows if r[2]]
            sizes = np.array([len(r[2]) for r in rows], np.int64)
            if not len(sizes):
                continue
            flat = [w for _, _, words in rows for w in words]
            if reader is not None:
                numbers = reader.cache.rows(flat)
                value, many = reader.all_windows(reader.cache.ids.reshape(-1, 6 * HIDDEN), numbers, sizes)
            else:
                if len(worth) > 100_000:
                    worth.clear()
                fresh = [w for w in dict.fromkeys(flat) if w not in worth]
                owner, feature = net.parts(fresh)
                total = np.zeros(len(fresh))
                np.add.at(total, owner, np.maximum(hint[feature], 0))
                worth.update(zip(fresh, total.tolist()))
                each = np.array([worth[w] for w in flat])
                first, many = window_starts(sizes)
                begin, of = np.repeat(np.cumsum(sizes) - sizes, many), np.repeat(sizes, many)
                place = first[:, None] + np.arange(WINDOW)
                value = np.where(place < of[:, None], each[np.minimum(begin[:, None] + place, len(each) - 1)], -1.0).max(axis=1)
            for (doc_id, y, words), own in zip(rows, np.split(value, np.cumsum(many)[:-1])):
                picks = {int(own.argmax()): False}
                if y == 0:
                    draw = np.random.default_rng([seed, turn, doc_id & 0xFFFFFFFFFFFF])
                    picks.setdefault(int(draw.integers(len(own))), True)
                for k, chance in picks.items():
                    ids.append(doc_id), labels.append(y), drawn.append(chance)
                    picked.append(words[k * STRIDE : k * STRIDE + WINDOW])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(drawn, pa.bool_()), pa.array(picked, pa.list_(pa.string()))],
                ["doc_id", "y", "drawn", "words"],
            )

    return run


def _worst_of(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        reader = net.reader()
        for part, *_ in common.buffers(batches, "text"):
            worst = reader.worst([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(worst, pa.float64())], ["doc_id", "y", "worst"])

    return run


def _train(net: Network, windows: list[list[str]], target: np.ndarray, mass: np.ndarray, rounds: int, draw, moment, step: int) -> int:
    """Rounds of Adam over windows of words."""
    vocabulary = sorted({w for own in windows for w in own})
    number = {w: i for i, w in enumerate(vocabulary)}
    owner, feature = net.parts(vocabulary)
    sizes = np.array([len(own) for own in windows])
    index = np.array([[number[w] for w in own] + [number[own[-1]]] * (WINDOW - len(own)) for own in windows])
    live = np.arange(WINDOW) < sizes[:, None]
    for _ in range(rounds):
        for batch in np.array_split(draw.permutation(len(windows)), max(1, len(windows) // 128)):
            own, back = np.unique(index[batch], return_inverse=True)
            lo, hi = np.searchsorted(owner, own), np.searchsorted(owner, own, "right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(own) else np.zeros(0, int)
            mine, parts = np.repeat(np.arange(len(own)), hi - lo), feature[at]
            vectors = net.vectors(len(own), mine, parts)
            logits, memory = net.forward(vectors[back.reshape(-1)].reshape(len(batch), WINDOW, -1), live[batch])
            slope = mass[batch] * (_sigmoid(logits) - target[batch]) / len(batch)
            grads, d_x = net.backward(slope, memory)
            d_vectors = np.zeros_like(vectors)
            np.add.at(d_vectors, back.reshape(-1), d_x.reshape(-1, WIDTH))
            grads["embed"] = np.zeros_like(net.p["embed"])
            np.add.at(grads["embed"], parts, d_vectors[mine])
            grads["embed"][-1] = d_vectors.sum(axis=0)
            step += 1
            for k, value in net.p.items():  # Adam
                m, v = moment[k]
                m += 0.1 * (grads[k] - m)
                v += 0.01 * (grads[k] ** 2 - v)
                value -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return step


def fit_network(rows: DataFrame, totals: np.ndarray, weight: dict[int, float], seed: int = 1, epochs: tuple[int, ...] = (6, 6, 6)) -> Network:
    """Fit on ``rows`` (doc_id, text, y), one for each id. Labels belong to texts, not to windows. Each
    round takes the worst window of each text by what is known so far (at first by the words and
    runs that tell the classes apart), and a second one drawn from the clean texts, and fits the
    network on those. Texts stay in their tasks: the driver gets names of parts, windows and scores."""
    found = telling_parts(rows, totals, {"w": WORDS, "g": GRAMS})
    net = Network([n for k, n, _ in found if k == "w"], [n for k, n, _ in found if k == "g"], seed)
    hint = np.zeros(len(net.features))
    for kind, name, odds in found:
        hint[net.features[kind, name]] = odds
    draw = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for turn, rounds in enumerate(epochs):
        picked = rows.mapInArrow(_picker(net, None if turn else hint, seed, turn), _PICKED).toArrow()
        order = sorted(zip(*(picked.column(c).to_pylist() for c in ("doc_id", "drawn", "y", "words"))))
        if not order:
            break
        of, many = np.unique([r[0] for r in order], return_counts=True)
        target = np.array([r[2] for r in order], float)
        mass = 1 / np.repeat(many, many)
        mass[target == 1] *= mass[target == 0].sum() / max(mass[target == 1].sum(), 1e-9)
        step = _train(net, [r[3] for r in order], target, mass / mass.mean(), rounds, draw, moment, step)
    # How a worst window's logit translates to the label, at the classes' true shares.
    scored = rows.mapInArrow(_worst_of(net), "doc_id long, y int, worst double").toPandas().sort_values("doc_id")
    worst, label = scored["worst"].to_numpy(float), scored["y"].to_numpy(float)
    weight = np.where(label == 1, weight[1], weight[0])
    weight = weight / weight.mean()
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * worst + b)
        slope = np.array([(weight * (p - label) * worst).sum() + 0.01 * (a - 1), (weight * (p - label)).sum()])
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        full = np.array([[(curve * worst**2).sum() + 0.01, (curve * worst).sum()], [(curve * worst).sum(), curve.sum() + 1e-6]])
        a, b = np.array([a, b]) - 0.5 * np.linalg.solve(full, slope)
    net.scale = np.array([a, b])
    return net


def fit(docs: DataFrame, labels: DataFrame, training: Column, documents: int = FIT_DOCUMENTS, column: str = "toxic") -> Network | None:
    """Fit on at most ``documents`` labelled rows of each class among those with ``training``
    true, chosen by hash. Class shares come from all training labels. Of rows that share an id the
    one with the smallest text hash is taken. None without labels of both classes."""
    marked = labels.where(training & F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(column).cast("int").alias("y"))
    shares = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    if len(shares) < 2:
        return None
    chosen = None
    for y in (0, 1):
        some = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
        chosen = some if chosen is None else chosen.union(some)
    chosen = chosen.groupBy("doc_id").agg(F.min("y").alias("y"))
    # Bounded by the parameter, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows, path = common.written(rows.repartition("doc_id"), "toxicity-fit")
    found = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    net = None
    if len(found) == 2:
        totals = np.array([found[0], found[1]], float)
        net = fit_network(rows, totals, {y: shares[y] / found[y] for y in (0, 1)})
    common.dropped(docs.sparkSession, path)
    return net


def score(docs: DataFrame, network: Network | None, keep: bool = False, name: str = "score") -> DataFrame:
    """(doc_id, score) of every whole text; with ``keep`` all columns of ``docs`` and the score under
    ``name``.

    NULL and empty texts have no window and get the score of none. Without a network every score
    is 0. NULL ids and repeated rows keep their rows. No shuffle."""
    rows = docs if keep else docs.select("doc_id", "text")
    names = [c for c in rows.columns if keep or c != "text"]
    mark = uuid.uuid4().hex
    out = rows.select(*names).withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = kept(("toxicity", mark), network.reader) if network is not None else None
        for part, *_ in common.buffers(batches, "text", SCORED_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            value = reader.score(texts) if reader else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(value)], [*names, name])

    return rows.mapInArrow(run, out)
