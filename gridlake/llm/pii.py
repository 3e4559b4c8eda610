"""Personal data in texts, by weak supervision.

Base spans follow fixed rules. Besides them there are looser candidates: written-out mail addresses,
defanged addresses of machines, numbers in other groups. Labelers (regular expression, gazetteer,
context, shape) vote on each candidate or abstain. How reliable each is follows from their agreement
over the whole corpus by expectation maximisation. Base spans are the seeds that tell which of the two
classes is personal data; the regular expression votes for them alone and abstains otherwise, and an
abstention tells nothing. The resulting soft labels train a span classifier on what a span looks like
and stands beside, not on the votes; it decides about the candidates that are not base spans. Votes and
features come from fixed lists, so the corpus reaches the driver as counts of their combinations only.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common

# Kinds in their order, and the patterns of the base rules.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates.
AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63})+", re.I)
DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[\[(](?:\.|dot)[\])] ?[0-9]{1,3}){3}(?![0-9])", re.I)
NUMBER = re.compile(r"(?<![0-9])[0-9]++(?:[\x20().-]{1,2}[0-9]++)*+")
GATE = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)

# Fixed values of the gazetteers and context labelers.
TLDS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl ch at eu ca au jp".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell"),
}
AGAINST = ("version", "license", "isbn", "order", "invoice", "section", "key", "token", "=", "#", "v.")
CONTEXT = 40  # characters before a span that the context labeler reads

#: Seeds weigh as much as the candidates together, and this much at least.
SEED_WEIGHT = 20.0
#: Labelers may differ; the rounds end here, well past the point where nothing moves.
EM_ROUNDS = 60


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules, leftmost and non-overlapping within a kind, in linear
    time: searches begin where a match can only begin (an @, the first digit of a run)."""
    out = []
    done = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((0, start, m.end()))
            done = m.end()
    for m in IP.finditer(text):
        if all(len(p) <= 3 or not p[:-3].strip("0") for p in m[0].split(".")) and max(int(p[-3:]) for p in m[0].split(".")) <= 255:
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


@dataclass(frozen=True)
class Candidate:
    kind: int
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    features: tuple[str, ...]


def candidates(text: str) -> list[Candidate]:
    """Base spans and looser ones that overlap none of them."""
    if not GATE.search(text):
        return []
    base = base_spans(text)
    found = [(*s, True) for s in base]
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        k = int(np.searchsorted(starts, b)) - 1
        return all(taken[j][1] <= a for j in range(max(0, k - 4), k + 1))

    for m in AT.finditer(text):
        if free(*m.span()):
            found.append((0, *m.span(), False))
    marked = []
    for m in DEFANGED.finditer(text):
        if free(*m.span()):
            marked.append(m.span())
            found.append((1, *m.span(), False))
    for m in NUMBER.finditer(text):
        at = bisect.bisect_right(marked, m.span()) - 1
        if any(0 <= k < len(marked) and marked[k][0] < m.end() and m.start() < marked[k][1] for k in (at, at + 1)):
            continue
        n = sum(c.isdigit() for c in m[0])
        if n < 7 or n > 19:
            continue
        a, b = m.span()
        if m[0].count(".") == 3 and re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", m[0]):
            kind = 1
        elif n >= 13:
            kind = 2
        elif re.search(r"[\x20().-]", m[0]):
            kind = 3
            if text[a - 1 : a] in ("(", "+"):
                a -= 1
        else:
            continue
        if free(a, b):
            found.append((kind, a, b, False))
    return [Candidate(k, a, b, own, *_judge(text, k, a, b, own)) for k, a, b, own in found]


def _judge(text: str, kind: int, a: int, b: int, base: bool) -> tuple[tuple[int, ...], tuple[str, ...]]:
    span = text[a:b]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before = text[max(0, a - CONTEXT) : a].lower()
    name = KINDS[kind]
    rule = 1 if base else 0
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    if kind == 0:
        gazetteer = 1 if re.split(r"[^a-z]+", span.lower().rstrip(")]"))[-1] in TLDS else -1
        shape = 1 if "@" in span and len(span) <= 64 else 0
    elif kind == 1:
        parts = [int(p[-9:]) for p in re.findall(r"[0-9]+", span)]
        gazetteer = 1 if 1 <= parts[0] <= 223 and parts[0] != 127 else -1
        shape = 1 if all(p <= 255 for p in parts) else -1
    elif kind == 2:
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
        shape = 1 if 15 <= len(digits) <= 19 and luhn(digits) else -1
    else:
        gazetteer = 1 if span.startswith("+") or digits.startswith("00") else 0
        shape = 1 if 10 <= len(digits) <= 13 and re.search(r"[)\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}$", span) else -1
    if any(w in before for w in CUES[name]):
        context = 1
    else:
        context = -1 if any(w in before for w in AGAINST) else 0
    marks = "".join(sorted({c for c in span if c in "+()[]-. "}))
    if kind == 0:
        looks = [f"end:{min(len(re.split(r'[^A-Za-z0-9]+', span.rstrip(')]'))[-1]), 8)}", f"at:{'@' in span}"]
    elif kind == 1:
        looks = [f"high:{max(parts) > 255}"]
    else:
        looks = [f"digits:{min(len(digits), 20)}", f"luhn:{luhn(digits)}", "groups:" + "-".join(str(min(g, 5)) for g in groups[:5])]
    beside = [f"near:{w}" for w in (*CUES[name], *AGAINST) if w in before]
    features = (name, *(f"{name}:{x}" for x in (f"marks:{marks}", *looks, *beside)))
    return (rule, gazetteer, context, shape), features


# -------------------------------------------------------------------------------------- learning


def reliabilities(votes: np.ndarray, count: np.ndarray, base: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Posterior that each vote pattern marks personal data, given how often it occurs. Labelers
    are independent given the truth; each has, where it doesn't abstain, its own chance of voting for
    it. ``base`` patterns are known to; they seed the chances with as much weight as the candidates
    have together. How many of the candidates are personal data is learnt from those alone."""
    labelers = votes.shape[1]
    loose = np.where(base, 0.0, count)
    seeds = np.where(base, count, 0.0)
    seeds *= min(1.0, max(loose.sum(), SEED_WEIGHT) / max(seeds.sum(), 1e-9))
    chance = np.array([[0.2, 0.8]] * labelers)  # labeler, truth
    prior = 0.3  # in doubt a candidate is none
    post = np.where(base, 1.0, prior)
    for _ in range(rounds):
        log = np.full((len(votes), 2), np.log([1 - prior, prior]))
        for j in range(labelers):
            for truth in (0, 1):
                log[:, truth] += np.where(votes[:, j] > 0, np.log(chance[j, truth]), np.where(votes[:, j] < 0, np.log(1 - chance[j, truth]), 0))
        post = np.where(base, 1.0, 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500))))
        prior = (loose @ post + 1) / (loose.sum() + 2)
        for j in range(labelers):
            for truth, w in ((0, loose * (1 - post)), (1, loose * post + seeds)):
                yes, no = w[votes[:, j] > 0].sum(), w[votes[:, j] < 0].sum()
                start = (2, 8) if truth == 0 else (8, 2)
                chance[j, truth] = (yes + start[0]) / (yes + no + 10)
    return post


class Classifier:
    """Logistic regression over features that are present or not."""

    def __init__(self, weight: dict[str, float]):
        self.weight = weight

    def accepts(self, c: Candidate) -> bool:
        return c.base or sum(self.weight.get(f, 0.0) for f in c.features) + self.weight.get("", 0.0) > 0

    @classmethod
    def train(cls, features: list[tuple[str, ...]], label: np.ndarray, count: np.ndarray, steps: int = 25):
        names = {f: i for i, f in enumerate(sorted({f for own in features for f in own}), 1)}
        x = np.zeros((len(features), len(names) + 1))
        x[:, 0] = 1
        for i, own in enumerate(features):
            x[i, [names[f] for f in own]] = 1
        w = np.zeros(x.shape[1])
        ridge = np.full(x.shape[1], 1e-2)
        count = count / count.mean() if len(count) else count
        for _ in range(steps):  # Newton
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (count * (p - label)) + ridge * w
            curve = (x * (count * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            w -= np.linalg.solve(curve, slope)
        return cls({"": w[0]} | {f: w[i] for f, i in names.items()})


def learn(docs: DataFrame) -> Classifier:
    """Labelers' reliabilities and the classifier, from all candidates of all texts."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total.update((c.kind, c.base, c.votes, c.features) for c in candidates(text or ""))
        rows = [(k, own, ",".join(map(str, v)), "\t".join(f), n) for (k, own, v, f), n in total.items()]
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["kind", "base", "votes", "features", "n"])

    found = docs.select("text").mapInArrow(patterns, "kind int, base boolean, votes string, features string, n long")
    rows = sorted(found.groupBy("kind", "base", "votes", "features").agg(F.sum("n").alias("n")).collect())
    if not rows:
        return Classifier({})
    kind, base = np.array([r.kind for r in rows]), np.array([r.base for r in rows])
    votes = np.array([[int(v) for v in r.votes.split(",")] for r in rows])
    count = np.array([r.n for r in rows], float)
    label = np.zeros(len(rows))
    for k in np.unique(kind):
        label[kind == k] = reliabilities(votes[kind == k], count[kind == k], base[kind == k])
        # Base spans are found anyway: they weigh no more than the candidates of their kind.
        own, loose = (kind == k) & base, count[(kind == k) & ~base].sum()
        count[own] *= min(1.0, max(loose, SEED_WEIGHT) / max(count[own].sum(), 1e-9))
    return Classifier.train([tuple(r.features.split("\t")) for r in rows], label, count)


# -------------------------------------------------------------------------------------- operator


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _spans(text: str | None, classifier: Classifier) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) of a text."""
    found = [c for c in candidates(text or "") if classifier.accepts(c)]
    return [(c.kind, c.start, c.end) for c in found if c.base], [(c.kind, c.start, c.end) for c in found]


def find(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """Personal data of every whole text: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 (of the base spans as text), spans (base and added: kind:start:end in code points,
    end exclusive).

    NULL and empty texts have no spans. NULL ids and repeated rows keep their rows; other columns
    are ignored. Two passes over the texts and no shuffle of them."""
    classifier = classifier or learn(docs)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, *_ in common.buffers(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                base, spans = _spans(text, classifier)
                counts = [sum(kind == k for kind, _, _ in base) for k in range(len(KINDS))]
                rows.append((doc_id, *counts, common.sha256(joined(base).encode()), joined(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def mask(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, all columns kept. NULL stays NULL."""
    classifier = classifier or learn(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, *_ in common.buffers(batches, "text"):
            text = [t if t is None else masked(t, _spans(t, classifier)[1]) for t in part.column("text").to_pylist()]
            text = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays([text if n == "text" else part.column(n) for n in names], names)

    return docs.mapInArrow(run, docs.schema)
