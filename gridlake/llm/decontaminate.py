"""Documents that hold a benchmark item, in DataFrame functions only.

A window of a document has as many words as the item it is held against. Both have a 64-bit
SimHash over their word shingles. Fingerprints are cut into ``RADIUS + 1`` blocks, so any two
within ``RADIUS`` bits agree in one of them; each window meets the item it was made for on equal
blocks, and of what remains the best by exact weighted-shingle similarity is told. The blocks are a
filter behind the shingles and find no pairs of their own.

The documents and items that are held against each other at all are those that share shingles.
How much each window shares with the item is a running count over the places of shared shingles,
exact and linear in their number, so every start is tried; windows that share enough are made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
#: Bits. At similarity 0.8 two fingerprints differ in about 10 of 64 bits, with a deviation of 3.
RADIUS = 20
#: Rows of item shingles that are broadcast at once (under 64 bytes each); a larger benchmark is
#: held against the documents in several such blocks. Runs of starts are broadcast up to as many.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def with_shingles(df: DataFrame, text: str, name: str, k: int) -> DataFrame:
    """``df`` with the hashes of each run of ``k`` words; none where there are fewer words.

    The words are a column of their own: written into the function of each position they would be
    split out of the text once for each."""
    df = df.withColumn("_words", words_of(F.col(text)))
    n = F.size("_words") - (k - 1)
    hashes = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.concat_ws(" ", F.slice("_words", i, k)))
    )
    return df.withColumn(name, F.when(n < 1, F.array().cast("array<bigint>")).otherwise(hashes)).drop("_words")


def simhash(hashes: Column) -> Column:
    """Bit b is set where more shingles, counted with repetition, have it set than not."""

    def bit(b: Column) -> Column:
        balance = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int") * 2 - 1)
        return F.expr("1L") * F.when(balance > 0, F.lit(1)).otherwise(F.lit(0))

    bits = F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda out, b: out.bitwiseOR(F.call_function("shiftleft", bit(b), b)),
    )
    return F.coalesce(bits, F.lit(0).cast("bigint"))  # never NULL, so no filter asks for it twice


def likeness(shared: Column, n: Column, m: Column) -> Column:
    """Sum of the smaller over the sum of the larger counts of ``n`` and ``m`` shingles."""
    return shared / (n + m - shared)


def runs_of_starts(docs: DataFrame, counted: DataFrame, k: int, similarity: float) -> DataFrame:
    """(doc_id, th, item_id, ih, m, n, shared, first, last): the starts of all windows that are as
    similar to the item as asked, in runs that share the same number of shingles with it.

    A shingle that the item has c times counts at a place of the window if fewer than c of the
    same are before it in there: for the starts behind its c-th last occurrence, as far as the
    window reaches. Each place so adds one at the first of its starts and takes it away behind
    the last."""
    hashed = with_shingles(docs, "text", "doc", k).withColumn("d", F.size("doc"))
    # The outer form: Spark turns the plain one into a filter on the array's size, written out with
    # all that makes the array, below it.
    seen = hashed.select("doc_id", "th", "d", F.posexplode_outer("doc").alias("pos", "h"))
    pair = ["doc_id", "th", "d", "item_id", "ih", "m"]
    # A set, since repeated rows of a document have the same places.
    places = F.sort_array(F.collect_set(F.struct("h", "pos", "c")))
    met = seen.join(F.broadcast(counted), "h").groupBy(*pair).agg(places.alias("places")).withColumn("n", F.least("m", "d"))
    met = met.where(likeness(F.least(F.size("places"), "n"), F.col("n"), F.col("m")) >= similarity)

    def steps(x: Column, i: Column) -> Column:
        before = F.get("places", i - x["c"])
        behind = F.when(before["h"] == x["h"], before["pos"] + 1).otherwise(0)
        begin = F.greatest(behind, x["pos"] - F.col("n") + 1)
        return F.array(
            F.struct(begin.alias("first"), F.lit(1).alias("step")), F.struct((x["pos"] + 1).alias("first"), F.lit(-1).alias("step"))
        )

    turns = met.select(*pair, "n", F.explode(F.flatten(F.transform("places", steps))).alias("t")).select(*pair, "n", "t.*")
    along = Window.partitionBy(*pair).orderBy("first")
    runs = turns.select(
        *pair, "n", "first", F.sum("step").over(along).cast("int").alias("shared"), F.lead("first").over(along).alias("next")
    ).withColumn("last", F.least(F.col("next") - 1, F.col("d") - F.col("n")))
    runs = runs.where((F.col("first") <= F.col("last")) & (likeness(F.col("shared"), F.col("n"), F.col("m")) >= similarity))
    return runs.select("doc_id", "th", "item_id", "ih", "m", "n", "shared", "first", "last")


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block, value) pairs: the 64 bits in ``radius + 1`` blocks as even as can be."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    pairs = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND((1 << (b - a)) - 1).alias("value"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ]
    return F.explode(F.array(*pairs))


def contaminated(
    docs: DataFrame, items: DataFrame, k: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS,
    texts: bool = False,
) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, distance): each document and item with a
    window of similarity ``similarity`` at least, the best window (the first of equals).

    Words are lower-cased and split at white space. The similarity of a window is the sum of the
    smaller counts over the sum of the larger counts of its and the item's ``k``-word shingles.
    ``start`` counts words from 0; ``n_words`` is the size of the window, that of the item or of
    the whole document if that is shorter; ``distance`` is in bits of the fingerprints. Items and
    documents of fewer than ``k`` words, NULL or empty ones included, match nothing. Repeated
    rows of an id count once; NULL ids are kept as they are. With ``texts``, rows that differ in text
    are told apart also where they share an id: ``th``, the hash of the text, follows doc_id. Other
    columns are ignored."""
    items = with_shingles(items.select("item_id", "text"), "text", "item", k).where(F.size("item") > 0).drop("text")
    items = items.distinct().withColumn("ih", F.xxhash64("item"))
    items = cut_lineage(items.withColumn("item_print", simhash(F.col("item"))))
    counted = items.select("item_id", "ih", F.size("item").alias("m"), F.explode("item").alias("h"))
    counted = cut_lineage(counted.groupBy("item_id", "ih", "m", "h").agg(F.count(F.lit(1)).cast("int").alias("c")))
    parts = max(1, -(-counted.count() // BROADCAST_ROWS))

    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    found = [
        runs_of_starts(docs, counted.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part), k, similarity)
        for part in range(parts)
    ]
    run = F.struct("item_id", "ih", "m", "n", "shared", "first", "last")
    runs = reduce(DataFrame.unionByName, found).groupBy("doc_id", "th").agg(F.collect_list(run).alias("runs"))
    runs = cut_lineage(runs.select(F.col("doc_id").alias("r_id"), F.col("th").alias("r_th"), "runs"))
    if (runs.agg(F.sum(F.size("runs"))).first()[0] or 0) <= BROADCAST_ROWS:
        runs = F.broadcast(runs)
    # Only documents with such windows are read again; of each run what its windows cover goes on.
    held = docs.join(runs, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")))
    held = with_shingles(held.select("doc_id", "th", "text", "runs"), "text", "doc", k)
    cover = lambda r: F.slice("doc", r["first"] + 1, r["last"] - r["first"] + r["n"])
    held = held.select("doc_id", "th", F.explode_outer(F.transform("runs", lambda r: F.struct(r.alias("run"), cover(r).alias("cover")))).alias("r"))
    held = held.select("doc_id", "th", "r.run.*", "r.cover")
    windows = held.withColumn("start", F.explode(F.sequence("first", "last")))
    windows = windows.withColumn("window", F.slice("cover", F.col("start") - F.col("first") + 1, F.col("n")))
    pair = ["doc_id", "th", "item_id", "ih", "m", "n", "shared", "start"]
    windows = windows.select(*pair, simhash(F.col("window")).alias("print"))

    # A hash of both sides' key keeps windows of a frequent item apart: the items' side is small
    # and the join is by block, so the windows stay where they are.
    item_blocks = items.select(F.col("item_id").alias("i_id"), "ih", "item_print", blocks(F.col("item_print"), radius).alias("b"))
    item_blocks = item_blocks.select("i_id", "ih", "item_print", "b.block", "b.value")
    window_blocks = windows.select(*pair, "print", blocks(F.col("print"), radius).alias("b"))
    window_blocks = window_blocks.select(*pair, "print", "b.block", "b.value")
    near = window_blocks.join(item_blocks, ["ih", "block", "value"]).where(F.col("item_id").eqNullSafe(F.col("i_id")))
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    # Blocks that agree: of several for one pair only the first goes on.
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    agree = [
        F.shiftrightunsigned(F.col("print").bitwiseXOR(F.col("item_print")), a).bitwiseAND((1 << (b - a)) - 1) == 0
        for a, b in zip(edges, edges[1:])
    ]
    first = F.array_position(F.array(*agree), F.lit(True)) - 1
    near = near.where((F.col("block") == first) & (distance <= radius))
    checked = near.select(
        "doc_id", "th", "item_id", "start", (F.col("n") + (k - 1)).alias("n_words"), distance.alias("distance"),
        likeness(F.col("shared"), F.col("n"), F.col("m")).alias("similarity"),
    )
    order = F.struct("similarity", (-F.col("start")).alias("s"), "n_words", "distance")
    names = ["doc_id", *(["th"] if texts else []), "item_id"]
    best = checked.groupBy(*names).agg(F.max(order).alias("best"))
    return best.select(
        *names, "best.similarity", (-F.col("best.s")).alias("start"), "best.n_words", "best.distance"
    )
