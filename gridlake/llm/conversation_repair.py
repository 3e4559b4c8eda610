"""Repair of conversations whose turns are missing, empty, doubled, cut short or in the wrong role.

Rows are dealt out by range of (conversation, turn), which Spark measures. A conversation that lies
inside a range, as nearly all do, is repaired where it lies. One that a range border cuts, or that is
large, is taken apart in pieces of bounded size: pieces are summed up in parallel (what it costs to
get from each stack top to each other), the sums are chained, and the pieces are then edited in
parallel. Only the hash of the repaired text, which is sequential by nature, reads the pieces of a
conversation one after the other, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common, role_grammar

#: Rows and characters after which a piece of a conversation is closed.
PIECE_ROWS = 1000
PIECE_CHARS = 4 << 20

#: Characters of role and text that order rows of the same turn before their digest does.
ORDER_CHARS = 64

#: Fixed value: white space.
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1

ROW = "struct<turn:long,role:string,text:string,n:int,fault:string>"
STATS = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first_turn long, last_turn long, head string, tail string"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
             "array<array<long>>": pa.list_(pa.list_(pa.int64())),
             f"array<{ROW}>": pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int32()), ("fault", pa.string())]))}
    fields, depth, start = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            fields.append(ddl[start:i].strip().split(" ", 1))
            start = i + 1
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def batches_of(rows: Iterator[dict], schema: pa.Schema, weight: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 if weight is None else 1 + sum(len(r["text"]) for r in row[weight] or []) // 4096
        if size >= 2000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def fault_of(text: Column) -> Column:
    """``b`` for a blank text, ``t`` for one that ends without a mark, else empty."""
    seen = F.rtrim(text, F.lit(BLANKS))
    return F.when(seen == "", F.lit("b")).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), F.lit("")).otherwise(F.lit("t"))


# --- one conversation or a piece of one ------------------------------------------------


def coded(rows: list[dict], new) -> dict:
    """Row codes and counts of ordered rows; ``new(i)`` tells whether the role and text of row ``i``
    come for the first time. ``at`` names the row of each code."""
    codes, at, pairs, previous = [], [], 0, None
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    turns, head = [], None
    for i, row in enumerate(rows):
        if not row["n"]:
            continue
        if row["turn"] is not None and (not turns or turns[-1] != row["turn"]):
            turns.append(row["turn"])
        initial = row["role"][:1]
        head = initial if head is None else head
        first = row["fault"] != "b" and new(i)
        for copy in range(row["n"]):
            if previous is not None and previous + initial not in LEGAL:
                pairs += 1
            previous = initial
            if row["fault"] == "b" or copy or not first:
                count["blank" if row["fault"] == "b" else "duplicate"] += 1
                codes.append(role_grammar.GONE)
            else:
                code = initial if initial and initial in role_grammar.TERMINALS else role_grammar.OTHER
                count["truncated"] += row["fault"] == "t"
                codes.append(code.upper() if row["fault"] == "t" else code)
            at.append(i)
    return {"codes": "".join(codes), "at": at, "illegal": pairs, "head": head, "tail": previous, **count, "turns": len(turns),
            "low": min(turns, default=None), "high": max(turns, default=None),
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None}


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, MOST)


def whole(conv_id, rows: list[dict]) -> dict:
    """The result of a conversation whose rows are all here."""
    seen = set()

    def new(i):
        pair = (rows[i]["role"], rows[i]["text"])
        return pair not in seen and not seen.add(pair)

    c = coded(rows, new)
    cost, audit = role_grammar.repair(c["codes"])
    lines = role_grammar.applied(audit, [(rows[i]["role"], rows[i]["text"]) for i in c["at"]], "")
    return {"conv_id": conv_id, "gaps": gaps(c["low"], c["high"], c["turns"]), "blank": c["blank"], "duplicate": c["duplicate"],
            "truncated": c["truncated"], "illegal": c["illegal"], "cost": cost, "audit": audit,
            "repaired_sha256": common.sha256("\n".join(lines).encode())}


def parted(most_rows: int, most_chars: int):
    """Task over ordered rows: results of conversations that lie inside, pieces of the others."""
    schema = arrow(f"{RESULT}, piece long, rows array<{ROW}>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def found():
            nonlocal number
            held, size, conv, cut, begun = [], 0, None, True, False
            for row in rows_of(batches):
                if begun and row["conv_id"] != conv:
                    if cut and held:
                        yield {"conv_id": conv, "piece": number, "rows": held}
                        number += 1
                    elif not cut:
                        yield whole(conv, held) | {"rows": None}
                    held, size, cut = [], 0, False
                begun, conv = True, row.pop("conv_id")
                held.append(row)
                size += len(row["text"])
                if len(held) >= most_rows or size >= most_chars:
                    yield {"conv_id": conv, "piece": number, "rows": held}
                    number += 1
                    held, size, cut = [], 0, True
            if held:  # may go on in the next task
                yield {"conv_id": conv, "piece": number, "rows": held}

        yield from batches_of(found(), schema, "rows")

    return run


# --- conversations in pieces -----------------------------------------------------------


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow(f"conv_id long, piece long, rows array<{ROW}>, codes string, at array<int>, ways array<array<long>>, {STATS}")

    def found():
        for p in rows_of(batches):
            first = set(p.pop("firsts") or [])
            c = coded(p["rows"], first.__contains__)
            yield {**p, **c, "ways": role_grammar.summary(c["codes"])}

    yield from batches_of(found(), schema, "rows")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: for each the stack tops before and behind it, and the conversation's counts."""
    schema = arrow("piece long, before int, behind int, ending string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")

    def settled(pieces, trail, front, c):
        nodes = role_grammar.nodes()
        cost, index, word = role_grammar.finish(tuple((nodes[top], cost) for top, cost in front))
        out = {"cost": cost, "gaps": gaps(c["low"], c["high"], c["turns"]), **{k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")}}
        found, ending = [], word
        for piece, (tops, came) in zip(reversed(pieces), reversed(trail)):
            behind, index = tops[index][0], came[index]
            found.append([piece, behind, index, ending])
            ending = ""
        fronts = [[(0, 0)], *[tops for tops, _ in trail[:-1]]]
        for (piece, behind, index, ending), before in zip(reversed(found), fronts):
            yield {"piece": piece, "before": before[index][0], "behind": behind, "ending": ending, **out}

    def found():
        conv, begun = None, False
        for p in rows_of(batches):
            if not begun or p["conv_id"] != conv:
                if begun:
                    yield from settled(pieces, trail, front, c)
                begun, conv, pieces, trail, front = True, p["conv_id"], [], [], [(0, 0)]
                c = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "last_turn": None, "tail": None}
            front, came = role_grammar.chained(front, p["ways"])
            pieces.append(p["piece"])
            trail.append((front, came))
            for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                c[k] += p[k]
            if p["head"] is not None:
                c["illegal"] += c["tail"] is not None and c["tail"] + p["head"] not in LEGAL
                c["tail"] = p["tail"]
            if p["first_turn"] is not None:
                c["turns"] -= c["last_turn"] == p["first_turn"]
                c["last_turn"], c["high"] = p["last_turn"], p["high"]
                c["low"] = p["low"] if c["low"] is None else c["low"]
        if begun:
            yield from settled(pieces, trail, front, c)

    yield from batches_of(found(), schema)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit and the repaired lines of each piece."""
    schema = arrow("conv_id long, piece long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, lines string")
    for p in rows_of(batches):
        audit = role_grammar.between(p["codes"], p["before"], p["behind"]) + p["ending"]
        last = role_grammar.TABLE.symbol[p["before"]]
        lines = role_grammar.applied(audit, [(p["rows"][i]["role"], p["rows"][i]["text"]) for i in p["at"]], last)
        row = {f.name: p.get(f.name) for f in schema} | {"audit": audit, "lines": "\n".join(lines) if lines else None}
        yield pa.RecordBatch.from_pylist([row], schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, as a stream: one row for each conversation."""
    schema = arrow(RESULT)

    def found():
        row = None
        for p in rows_of(batches):
            if row is None or p["conv_id"] != row["conv_id"]:
                if row is not None:
                    yield row | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                row, audit, digest, some = {f.name: p.get(f.name) for f in schema}, [], hashlib.sha256(), False
            audit.append(p["audit"])
            if p["lines"] is not None:
                digest.update(("\n" if some else "").encode() + p["lines"].encode())
                some = True
        if row is not None:
            yield row | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    yield from batches_of(found(), schema)


def first_rows(pieces: DataFrame) -> DataFrame:
    """(piece, firsts): places of the rows whose role and text come for the first time in their
    conversation."""
    rows = pieces.select("conv_id", "piece", F.posexplode("rows").alias("pos", "r")).where("r.n > 0 and r.fault <> 'b'")
    name = F.sha2(F.concat(F.length("r.role").cast("string"), F.lit(":"), "r.role", "r.text"), 256)
    least = rows.groupBy("conv_id", name.alias("name")).agg(F.min(F.struct("piece", "pos")).alias("at"))
    return least.groupBy(F.col("at.piece").alias("piece")).agg(F.collect_list("at.pos").alias("firsts"))


def repair(rows: DataFrame, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS) -> DataFrame:
    """Cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text, n): conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``n`` says how often a row stands there; at 0 it only names its conversation, and one without
    other rows has zeros, an empty audit and the hash of nothing. Roles and texts are not NULL. A NULL
    conv_id is a conversation of its own; a NULL turn comes first and is no turn. Rows of the same turn
    are ordered by role and text (64 characters of each, then a digest), so repeated rows stand side by
    side. An empty table gives no rows. A text may be as long as a row can be. A conversation may have
    any number of rows; its audit, one letter a row, is one value."""
    spark = rows.sparkSession
    begin = [F.left(F.col(c), F.lit(ORDER_CHARS)) for c in ("role", "text")]
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    dealt = rows.withColumn("_read", F.monotonically_increasing_id()).withColumn("fault", fault_of(F.col("text")))
    order = ["conv_id", "turn", *begin, digest, "_read"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "n", "fault")
    found, _ = common.written(dealt.mapInArrow(parted(most_rows, most_chars), f"{RESULT}, piece long, rows array<{ROW}>"), "conversations")
    names = [x.split()[0] for x in RESULT.split(", ")]
    done = found.where("piece is null").select(*names)
    pieces = found.where("piece is not null").select("conv_id", "piece", "rows")
    marked = pieces.join(first_rows(pieces), "piece", "left").select("conv_id", "piece", "rows", "firsts")
    summed, summed_path = common.written(
        marked.mapInArrow(_summed, f"conv_id long, piece long, rows array<{ROW}>, codes string, at array<int>, ways array<array<long>>, {STATS}"), "pieces"
    )
    in_order = lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    tops = in_order(summed.drop("rows", "codes", "at")).mapInArrow(_chain, f"piece long, before int, behind int, ending string, {counts}")
    edited = summed.select("conv_id", "piece", "rows", "codes", "at").join(tops, "piece")
    edited = edited.mapInArrow(_edited, f"conv_id long, piece long, {counts}, audit string, lines string")
    rest, _ = common.written(in_order(edited).mapInArrow(_hashed, RESULT), "repaired")
    common.dropped(spark, summed_path)
    return done.union(rest)


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` after the damage that the crc32 of ``conv_id:turn`` modulo 20 does to a row:
    0 drops it (``n`` is 0), 1 empties the text, 2 takes its end marks, 3 repeats it (``n`` is 2),
    4 makes it the user's. NULL values count as one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kept = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("x"))
    text = F.when(F.col("x").isin(0, 1), "").when(F.col("x") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("x") == 4, "user").otherwise(F.col("role"))
    n = F.when(F.col("x") == 0, 0).when(F.col("x") == 3, 2).otherwise(1)
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), n.cast("int").alias("n"))
