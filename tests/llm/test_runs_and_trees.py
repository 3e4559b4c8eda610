"""Conversation repair, line runs and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridlake.llm import conversation_repair, line_runs, merkle, role_grammar, twins

BLANKS = " \t\n\x0b\x0c\r"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- conversations ------------------------------------------------------------------------


def cheapest(codes):
    """Least (cost, audit) over all edits, audits spelled out."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def with_inserts(states):
        for _ in range(4):
            for last, (cost, audit) in list(states.items()):
                for sign in "ua":
                    to, new = after[last].get(sign), (cost + 3, audit + "I")
                    if to and (to not in states or new < states[to]):
                        states[to] = new
        return states

    states = {"": (0, "")}
    for code in codes:
        new = {}
        for last, (cost, audit) in with_inserts(states).items():
            more, sign = 3 * code.isupper(), code.lower()
            ways = [(last, cost + 4, "D")]
            if code != "x":
                ways += [(after[last][sign], cost + more, "K")] if sign in after[last] else []
                ways += [(after[last][x], cost + more + 3, "R") for x in "ua" if x in after[last]]
            for to, total, letter in ways:
                if to not in new or (total, audit + letter) < new[to]:
                    new[to] = (total, audit + letter)
        states = new
    states = with_inserts(states)
    return min(states[x] for x in ("", "a") if x in states)


def repaired(rows):
    """The contract, plainly: rows (conv_id, turn, role, text) to results."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        x, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if x == 1 else "".join(c for c in text if c not in ".!?") if x == 2 else text
        convs[conv] += [(turn, "user" if x == 4 else role, text)] * (0 if x == 0 else 2 if x == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, blank, duplicate, truncated, illegal = set(), "", 0, 0, 0, 0
        for i, (_, role, text) in enumerate(kept):
            bare = text.strip(BLANKS)
            illegal += i > 0 and kept[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            if not bare or (role, text) in seen:
                blank, duplicate, codes = blank + (not bare), duplicate + bool(bare), codes + "x"
            else:
                cut = bare[-1] not in ".!?"
                code = role[:1] if role[:1] in tuple("sua") else "o"
                truncated, codes = truncated + cut, codes + (code.upper() if cut else code)
            seen.add((role, text))
        cost, audit = cheapest(codes)
        lines, at, last = [], 0, ""
        for letter in audit:
            role, text = ("", "") if letter == "I" else kept[at][1:]
            at += letter != "I"
            if letter != "D":
                role = role if letter == "K" else "assistant" if last == "u" else "user"
                last = role[:1]
                lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in kept if t is not None]
        missing = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, missing, blank, duplicate, truncated, illegal, cost, audit, sha("\n".join(lines))))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r))


def talk(seed):
    draw = random.Random(seed)
    words = ["Yes.", "no", "Why?", "", " \t ", "An answer. ", "So it is!", "half a", "long " * 40 + "end."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [*range(40), None]:
        rows += [(conv, draw.choice([t, t, t, t + 3, None]), draw.choice(roles), draw.choice([*words, None])) for t in range(draw.randint(1, 12))]
    hot = [(777, t, "user" if t % 2 else "assistant", f"Turn {t % 400}" + "." * draw.randint(0, 1)) for t in range(1500)]
    copies = [(778, 5, "user", "The same again.")] * 300
    lost = [(c, 0, "user", "Gone.") for c in range(1000, 1200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows + hot + copies + lost


CONVERSATIONS = "conv_id long, turn long, role string, text string, n string, fault string, piece string, x string"


@pytest.mark.parametrize("most_rows", [1000, 7])
def test_conversations_like_brute_force(spark, most_rows):
    rows = talk(most_rows)
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], CONVERSATIONS).repartition(5)
    got = conversation_repair.repair(conversation_repair.damaged(df), most_rows=most_rows).collect()
    assert order(got) == order(repaired(rows))
    assert any(r.audit == "" and r.cost == 0 for r in got)


def test_conversations_none(spark):
    df = spark.createDataFrame([], CONVERSATIONS)
    assert conversation_repair.repair(conversation_repair.damaged(df)).collect() == []


def test_repairs_of_all_short_sequences():
    import itertools

    for n in range(5):
        for codes in itertools.product("xsuaoSUAO", repeat=n):
            assert role_grammar.repair("".join(codes)) == cheapest(codes)


def test_grammar_is_the_regular_expression():
    import itertools
    import re

    for n in range(7):
        for signs in itertools.product("sua", repeat=n):
            node = role_grammar.START
            for sign in signs:
                node = node and role_grammar.read(node, sign)
            ends = node is not None and role_grammar.read(node, "$") is not None
            assert ends == bool(re.fullmatch("(s?(ua)+)?", "".join(signs)))


def test_pieces_chain_to_the_whole():
    draw = random.Random(5)
    for _ in range(200):
        codes = "".join(draw.choice("xsuaouauaSUAO") for _ in range(draw.randint(0, 40)))
        cuts = sorted(draw.randint(0, len(codes)) for _ in range(3))
        front = [(0, 0)]
        for a, b in zip([0, *cuts], [*cuts, len(codes)]):
            front, _ = role_grammar.chained(front, role_grammar.summary(codes[a:b]))
        cost, _, _ = role_grammar.finish(tuple((role_grammar.nodes()[top], cost) for top, cost in front))
        assert cost == cheapest(codes)[0]


# --- lines ----------------------------------------------------------------------------------


def lines_kept(rows, least=5, chars=40):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANKS).translate(lower)
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= chars:
                holders[k].append(-1 if doc_id is None else doc_id)
    top = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if top.get(key(x), doc_id) in (doc_id, -1 if doc_id is None else doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def pages(odd):
    draw = random.Random(2)
    common = [f"A line that stands in many documents, number {i}, é" for i in range(12)]
    edge = ["x" * 39, "y" * 40, "é" * 40, " \t" + "z" * 39 + "\r"]
    rows = []
    for i in range(150):
        lines = [draw.choice(common + edge) for _ in range(draw.randint(0, 6))] + [f"Of its own {i} " * 5]
        lines = [draw.choice([x, x.upper(), f"  {x}\t", x + "\x0b"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [rows[3]] * 6  # one document six times
    rows += [(None, "A line that only documents without an id hold, " + "q" * 9)] * 5
    return rows + [(i if i is None else i + 1000, t) for i, t in odd]


@pytest.mark.parametrize("batches, fanout", [(4, 2), (1, 2), (5, 3)])
def test_lines_like_brute_force(documents, odd, batches, fanout):
    rows = pages(odd)
    got = line_runs.dedup_lines(documents(rows), batches=batches, fanout=fanout, keep=True).collect()
    assert order(r[:4] for r in got) == order(lines_kept(rows))
    assert all(sha(r.text) == r.kept_sha256 for r in got)


def test_lines_of_no_documents(documents):
    assert line_runs.dedup_lines(documents([])).count() == 0


def test_runs_are_merged_without_moving(spark):
    store = line_runs.LineRuns(spark, fanout=2)
    ids = spark.range(4000).select(F.xxhash64("id").alias("h"), F.col("id").alias("i"), F.lit(1).cast("long").alias("n"), F.col("id").alias("top"))
    batches = [store.sorted_run(ids.where(f"i % 4 = {b} or i < 10").repartition(store.buckets, "h", "i")) for b in range(4)]
    for name in batches:
        store.add(spark.table(name))
    assert store.compactions == 3 and [len(x) for x in store.levels] == [0, 0, 1]
    assert {(r.n, r.top) for r in store.counts().where("i < 10").collect()} == {(4, i) for i in range(10)}
    assert store.counts().count() == 4000
    run = store.runs()[0]
    for plan in (spark.table(batches[0]).join(run.hint("merge"), ["h", "i"], "left_anti"), line_runs.merged_runs(run, spark.table(batches[0]))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
    store.close()


# --- manifests ------------------------------------------------------------------------------


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout=3):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        levels.append(nodes)
    return levels


def siblings(levels, p, fanout=3):
    out = []
    for level in levels[:-1]:
        run = level[p // fanout * fanout :][:fanout]
        out.append((run[: p % fanout], run[p % fanout + 1 :]))
        p //= fanout
    return out


def manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) to the contract's columns."""
    leaf = lambda r, text: sha(*map(framed, (r[0], r[3], r[2], r[4], text)))
    sources = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))):
        sources[r[3]].append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([leaf(r, r[1]) for r in sources[s]]) for s in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, name in enumerate(names):
        for p, r in enumerate(sources[name]):
            path = siblings(trees[k], p) + siblings(top, k)
            altered = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf(r, r[1].replace("\n", "") if altered else r[1])
            for left, right in path:
                node = sha(*left, node, *right)
            proof = sha(*(x for left, right in path for x in left + right))
            out.append((r[0], leaf(r, r[1]), trees[k][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, n string, node string, id string, root string"


@pytest.mark.parametrize("sizes", [(1,), (1, 1, 1, 1), (2, 3, 4), (27, 28, 1, 81, 10), (300, 5)])
def test_manifest_like_brute_force(spark, odd, sizes):
    rows, doc_id = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((doc_id, f"text {doc_id}\nof é {k}" * (doc_id % 3), "en" if doc_id % 5 else None, f"s{k}é" if k else None, doc_id % 7 or None))
            doc_id += 1
    if len(sizes) > 2:
        rows += [(i, t, None, "", None) for i, t in odd] + [(None, None, None, None, None)] * 3
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], DOCUMENTS).repartition(4)
    got = merkle.verified_documents(df).collect()
    assert order(got) == order(manifest(rows))
    assert {r.verified for r in got} <= {True, False} and any(r.verified for r in got)


def test_manifest_of_nothing(spark):
    assert merkle.verified_documents(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_crc_in_sql():
    import duckdb

    db = duckdb.connect()
    for text in ("0", "123456:7", " :5", "-1: "):
        assert db.execute(f"SELECT {twins.crc(repr(text))}").fetchone()[0] == zlib.crc32(text.encode())
