"""Fitted operators: exact parts against plain versions, the rest by accuracy on held-out rows."""

import math
import random
import re

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from gridlake.llm import langid, lattice, pii, toxicity

PIECES = path("piece_bpe_32k.model")


# ------------------------------------------------------------------------------------- language


def test_lattice_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aba", "c", "abc"])}
    cut = lattice.Lattice(pieces, unknown=len(pieces))
    weight = np.random.default_rng(1).random((len(pieces) + 1, 2))
    draw = random.Random(1)
    words = ["".join(draw.choice("abcx") for _ in range(draw.randint(1, 9))) for _ in range(200)]

    def ways(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            piece = pieces.get(word[:n], len(pieces) if n == 1 else None)
            if piece is not None:
                for rest in ways(word[n:]):
                    yield [piece, *rest]

    got = lattice.forward(cut.edges(words), weight, cut.longest)[1]
    for word, logs in zip(words, got):
        for k in range(2):
            assert math.isclose(logs[k], math.log(sum(math.prod(weight[p, k] for p in w) for w in ways(word))), rel_tol=1e-9)
    count = np.arange(1.0, len(words) + 1)
    uses = lattice.expected(cut.edges(words), weight[:, 0], count)
    want = np.zeros(len(weight))
    for word, n in zip(words, count):
        all_ways = list(ways(word))
        chance = [math.prod(weight[p, 0] for p in w) for w in all_ways]
        for w, c in zip(all_ways, chance):
            for p in w:
                want[p] += n * c / sum(chance)
    assert np.allclose(uses, want)


def test_long_words_do_not_underflow():
    cut = lattice.Lattice({"a": 0, "aa": 1}, unknown=2)
    weight = np.full((3, 1), 1e-9)
    edges = cut.edges(["a" * 3000])
    assert np.isfinite(lattice.forward(edges, weight, cut.longest)[1]).all()
    assert lattice.forward(edges, weight, cut.longest)[1][0, 0] < -10_000


def prose(language, draw, n=60):
    parts = {"en": ["the", "ing", "tion", "and", "er"], "de": ["ung", "sch", "der", "keit", "ein"]}[language]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))


def test_languages_are_told_apart(documents, odd):
    draw = random.Random(1)
    rows = [(i, prose(lang, draw), lang) for i in range(120) for lang in (("en", "de")[i % 2],)]
    rows.append((500, prose("en", draw), None))
    model = langid.fit(documents(rows), PIECES, F.col("doc_id") % 5 != 0)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.identify(documents(rows), model).collect()}
    assert all(got[i].lang_pred == lang and 0.5 <= got[i].score <= 1 for i, _, lang in rows if lang)
    out = langid.identify(documents(odd), model).collect()
    assert len(out) == len(odd)
    for r in out:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1
    assert langid.identify(documents([]), model).count() == 0


def test_nothing_to_learn(documents):
    model = langid.fit(documents([(1, "text", None)]), PIECES, F.lit(True))
    assert [r.lang_pred for r in langid.identify(documents([(1, "text")]), model).collect()] == ["und"]


def test_fitting_is_bounded_by_language(documents):
    rows = [(i, f"w{i}", "en") for i in range(200)]
    few, many = (langid.fit(documents(rows), PIECES, F.lit(True), documents=n, rounds=1) for n in (5, 1000))
    assert (few.weight[:, 0] > few.weight.min()).sum() < (many.weight[:, 0] > many.weight.min()).sum()


# ------------------------------------------------------------------------------- personal data

RULES = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in rule.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out)


def test_base_spans_like_the_rules():
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choice("a@.b1 +-(2)0.9") for _ in range(draw.randint(0, 40)))
        assert sorted(pii.base_spans(text)) == plain_spans(text), text


def test_long_texts_take_linear_time():
    pii.candidates("a" * 300_000 + "1." * 100_000 + "1" * 3_000 + "+1 " * 30_000 + "@a" * 30_000)


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_labelers_that_agree_are_trusted():
    draw = np.random.default_rng(1)
    truth = draw.random(5000) < 0.4
    flip = draw.random((5000, 4)) < np.array([0.05, 0.1, 0.2, 0.45])
    votes = np.where(truth[:, None] ^ flip, 1, -1)
    patterns, back, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    label = pii.reliabilities(patterns, count.astype(float), np.zeros(len(patterns), bool))[back.reshape(-1)] > 0.5
    assert (label == truth).mean() > 0.95


def written_out(draw):
    """Texts (base spans, looser spans of all four kinds, decoys) with what should become of them."""
    number = lambda n: "".join(str(draw.randrange(10)) for _ in range(n))

    def card(groups, good=True):
        body = draw.choice(["4", "51", "55", "37"]) + number(sum(groups))
        body = body[: sum(groups) - 1]
        last = next(d for d in "0123456789" if pii.luhn(body + d) == good)
        digits, out = body + last, []
        for g in groups:
            out.append(digits[:g])
            digits = digits[g:]
        return out

    name = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    octet = lambda: str(draw.randint(1, 220))
    base = [lambda: f"mail {name()}@{name()}.com", lambda: f"host 10.{octet()}.{octet()}.7", lambda: "card " + " ".join(card([4, 4, 4, 4])),
            lambda: f"phone +1 (555) {number(3)}-{number(4)}"]
    loose = {
        "email": lambda: (f"write to ", f"{name()} [at] {name()} [dot] com"),
        "ip": lambda: ("server ", f"{octet()}[.]{octet()}[.]{octet()}[.]{octet()}"),
        "card": lambda: ("credit card ", ".".join(card([4, 4, 4, 4]))),
        "phone": lambda: ("call ", f"({number(3)}) {number(3)}-{number(4)}"),
    }
    decoys = [
        lambda: ("order ", "".join(card([4, 4, 4, 4], good=False))), lambda: ("token ", "".join(card([18], good=False))), lambda: ("version ", f"{octet()}.400.{octet()}.999"),
        lambda: ("isbn ", f"{number(3)} {number(1)} {number(4)}"), lambda: ("section ", f"{number(2)}.{number(2)}.{number(4)}"),
    ]
    rows, planted, false = [], [], []
    for i in range(900):
        rows.append((i, f"some words {draw.choice(base)()} and more"))
    for i, kind in enumerate(list(loose) * 60):
        before, span = loose[kind]()
        text = f"some words {before}"
        rows.append((1000 + i, f"{text}{span} and more"))
        planted.append((1000 + i, kind, len(text), len(text) + len(span)))
    for i in range(300):
        before, span = draw.choice(decoys)()
        rows.append((2000 + i, f"some words {before}{span} and more"))
        false.append(2000 + i)
    return rows, planted, false


def test_looser_spans_are_learnt(documents):
    rows, planted, false = written_out(random.Random(7))
    got = {r.doc_id: r for r in pii.find(documents(rows)).collect()}
    for kind in pii.KINDS:
        own = [p for p in planted if p[1] == kind]
        found = sum(f"{k}:{a}:{b}" in got[i].spans.split(",") for i, k, a, b in own)
        assert found > 0.8 * len(own), kind
    for i, _, _, _ in planted:  # base results say nothing of added spans
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == (0, 0, 0, 0)
    assert [got[i].spans for i in false if got[i].spans] == []


def test_base_spans_alone_add_nothing(documents):
    rows = [(i, f"host 10.1.2.{i % 200} and 4529603461135147") for i in range(50)]
    assert all(r.spans.count(":") == 2 for r in pii.find(documents(rows)).collect())


def test_spans_of_texts(documents, odd):
    text = "mail joe.doe@mail.example.com or +1 (555) 123-4567, host 10.1.2.300, 192.168.1.77, card 4539 5787 6362 1486"
    rows = odd + [(100, text), (101, text)]
    got = {r.doc_id: r for r in pii.find(documents(rows)).collect() if r.doc_id in (1, 2, 100, 101)}
    assert pii.find(documents(rows)).count() == len(rows)
    r = got[100]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    base = pii.joined(plain_spans(text))
    assert all(s in r.spans.split(",") for s in base.split(","))
    assert got[1].spans == got[2].spans == "" and got[1].n_email == 0
    assert pii.find(documents([])).count() == 0
    shown = {r.doc_id: r for r in pii.mask(documents(rows)).collect()}
    assert "[email]" in shown[100].text and "joe.doe" not in shown[100].text and shown[100].score == "x"
    assert shown[1].text is None


def test_overlapping_spans_are_masked_once():
    assert pii.masked("abcdefgh", [(0, 1, 4), (3, 2, 6)]) == "a[email]gh"


def test_expected_uses_of_long_words():
    """Every character of a word counts, however long it is; so do many words of many lengths at once."""
    cut = lattice.Lattice({"a": 0, "b": 1, "ab": 2, "aba": 3}, unknown=4)
    weight = np.array([3e-5, 2e-5, 1e-5, 4e-6, 1e-6])
    sizes = [1, 20, 50, 300, 1000, 5000]
    for n in sizes:
        uses = lattice.expected(cut.edges(["a" * n]), weight, np.ones(1))
        assert uses == pytest.approx([n, 0, 0, 0, 0], rel=1e-6)
        uses = lattice.expected(cut.edges([("ab?" * n)[:n]]), weight, np.ones(1))
        assert uses @ np.array([1, 1, 2, 3, 1]) == pytest.approx(n, rel=1e-6)
    words = [("abbaab?" * n)[:n] for n in sizes]
    each = sum(lattice.expected(cut.edges([w]), weight, np.array([k + 1.0])) for k, w in enumerate(words))
    assert lattice.expected(cut.edges(words), weight, np.arange(1.0, 1 + len(words))) == pytest.approx(each, rel=1e-6)


def test_numbers_are_no_letters():
    assert [bool(langid.LETTER.search(t)) for t in ("½", "²³", "Ⅷ", "_1", "é", "執", "x²")] == [False, False, False, False, True, True, True]


# ------------------------------------------------------------------------------------- toxicity


def test_gradients():
    net = toxicity.Network(["w"], ["^w$"], seed=3)
    draw = np.random.default_rng(1)
    x, live = draw.normal(size=(4, 6, toxicity.WIDTH)), np.ones((4, 6), bool)
    live[1, 3:] = live[2, 1:] = False
    target = np.array([0.0, 1, 1, 0])

    def loss():
        s = net.forward(x, live)[0]
        return (np.logaddexp(0, s) - target * s).sum()

    scores, memory = net.forward(x, live)
    grads, d_x = net.backward(1 / (1 + np.exp(-scores)) - target, memory)
    for name, value in [*((n, net.p[n]) for n in grads), ("x", x)]:
        got = d_x if name == "x" else grads[name]
        for _ in range(4):
            at = tuple(draw.integers(n) for n in value.shape)
            old = value[at]
            value[at] = old + 1e-5
            up = loss()
            value[at] = old - 1e-5
            down = loss()
            value[at] = old
            assert math.isclose((up - down) / 2e-5, got[at], rel_tol=1e-3, abs_tol=1e-6), name


def test_reader_is_the_network():
    net = toxicity.Network(["bad", "good"], ["^ba", "oo"], seed=2)
    words = "good or bad things are all we have here bad good and so on it goes".split()[: toxicity.WINDOW]
    x = net.vectors(len(words), *net.parts(words))[None]
    want = net.forward(x, np.ones((1, len(words)), bool))[0][0]
    assert math.isclose(net.reader().worst([" ".join(words)])[0], want, rel_tol=1e-4, abs_tol=1e-5)


def test_full_windows_are_read_without_a_mask(monkeypatch):
    net = toxicity.Network(["bad"], ["^ba"], seed=2)
    masks, windows = [], toxicity.Reader.windows
    monkeypatch.setattr(toxicity.Reader, "windows", lambda *a: masks.append((a[2].shape[1], a[3])) or windows(*a))
    texts = ["bad or good " * n for n in (1, 30, 60)]
    got = net.reader().worst(texts)
    assert [m is None for _, m in masks] == [True, False] and masks[0][0] > masks[1][0]
    assert np.allclose(got, [net.reader().worst([t])[0] for t in texts], atol=1e-5)


def test_parts_of_words_like_a_search():
    words, runs = ["bad", "ñu", "a"], ["^ba", "ad$", "^bad$", "ñu$", "bad", "oo", "執行$"]
    net = toxicity.Network(words, runs)
    for some in (["bad!", "BAD", "ñu", "badbad", "", "執行", "😀x", "a^b$"], []):
        want = []
        for i, word in enumerate(map(toxicity.core, some)):
            found = {k for k, w in enumerate(words) if w == word} | {len(words) + k for k, g in enumerate(runs) if g in toxicity.grams(word)}
            want += [(i, f) for f in sorted(found)]
        assert list(zip(*(x.tolist() for x in net.parts(some)))) == want


def test_windows_cover_all_words():
    for n in range(1, 100):
        first, many = toxicity.window_starts(np.array([n]))
        seen = {i for a in first for i in range(a, min(n, a + toxicity.WINDOW))}
        assert seen == set(range(n)) and len(first) == many[0]


def test_toxicity_of_held_out_texts(spark, documents, odd):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = prose("en", draw, draw.randint(20, 80)).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["venom", "venomer"]))
        rows.append((i, " ".join(words))), labels.append((i, int(i % 4 == 0)))
    marks = spark.createDataFrame([*labels, (10_000, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    net = toxicity.fit(documents(rows), marks, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(documents(rows), net).collect()}
    held = [(got[i], y) for i, y in labels if i % 3 == 0]
    assert np.mean([(s >= toxicity.THRESHOLD) == y for s, y in held]) > 0.95
    out = toxicity.score(documents(odd), net).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    kept = toxicity.score(documents(odd), net, keep=True, name="_t")
    assert kept.columns == [*documents(odd).columns, "_t"] and kept.count() == len(odd)
    assert toxicity.score(documents([]), net).count() == 0


def test_no_labels_no_network(spark, documents):
    marks = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.fit(documents([(1, "a")]), marks, F.lit(True)) is None
    assert [r.score for r in toxicity.score(documents([(1, "a")]), None).collect()] == [0.0]
