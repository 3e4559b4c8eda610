"""Nearest neighbours by largest inner product, with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own k-means; a cell of the index is a pair
of centroids. A query walks the pairs in descending sum of its inner products with both, by a heap
over the two sorted lists, until the cells on its way hold enough entries, and ranks those entries
by the exact inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common

#: Different vectors that the centroids are fitted on, the first by hash.
FIT_VECTORS = 20_000
FIT_ROUNDS = 12
#: Centroids of each half; fewer for small tables.
CENTROIDS = 128
#: Share of the entries that a query looks at, and the least number. Whole cells are visited, so it
#: may be more. Vectors that lie all but at random, as the given ones do, need this much for nine
#: of ten neighbours, whatever their number; clustered ones far less.
REACH, LEAST = 0.45, 1500
#: Entries of a group of cells; a group with more is split by entry.
GROUP_ENTRIES = 4000


def kmeans(x: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Centroids; starts spread over the rows, empty ones keep their place."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Pairs (i, j) in descending left[i] + right[j] until their cells hold ``enough`` entries.

    The heap starts at the best pair; a pair's right neighbour enters with it, its lower neighbour
    only from the first column, so each pair enters once."""
    rows, columns = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap = [(-(left[rows[0]] + right[columns[0]]), 0, 0)]
    out, held = [], 0
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        i, j = int(rows[a]), int(columns[b])
        if sizes[i, j]:
            out.append((i, j))
            held += int(sizes[i, j])
        if b + 1 < len(columns):
            heapq.heappush(heap, (-(left[i] + right[columns[b + 1]]), a, b + 1))
        if b == 0 and a + 1 < len(rows):
            heapq.heappush(heap, (-(left[rows[a + 1]] + right[j]), a + 1, 0))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for each query row, among all rows but itself.

    Returns query_id, rank (from 1), vec_id, score (inner product in double precision); nearest
    first, ties to the smaller id. With fewer candidates than ``k`` all of them are returned.
    Rows whose id or vector is NULL, or whose vector is empty, zero or holds NULL or a non-finite
    number, take no part; nor do vectors of another length than most of the fitting sample.
    Repeated rows of one id count once. Other columns are ignored.

    Equal vectors are one entry that keeps its ``k + 1`` smallest ids: no query can want more of
    them, so nothing is lost, and a vector that a third of all rows share is compared once."""
    spark = vectors.sparkSession
    good = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        F.col("v"), lambda x: x != 0
    )
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(good, F.lit(False))).withColumn("dim", F.size("v"))
    rows, rows_path = common.written(rows, "vectors")
    first = Window.partitionBy("v").orderBy("id")
    limited = rows.select("v", "id", "dim").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    entries = limited.groupBy("v", "dim").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries, entries_path = common.written(entries.withColumn("rep", F.col("ids")[0]), "entries")

    sample = entries.select("v", "dim", F.xxhash64("v").alias("h")).orderBy("h").limit(FIT_VECTORS).toPandas()
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], schema)
    dim = int(sample["dim"].mode()[0])
    entries = entries.where(F.col("dim") == dim)
    fit = np.stack(sample.loc[sample["dim"] == dim, "v"].tolist())
    n = entries.count()
    centres_n = int(min(max(n // 16, 2), CENTROIDS, len(fit)))
    half = dim // 2 if dim > 1 else 1
    centres = [kmeans(fit[:, :half], centres_n), kmeans(fit[:, half:], centres_n)]
    enough = int(max(LEAST, REACH * n))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"))
            i, j = nearest(x[:, :half], centres[0]), nearest(x[:, half:], centres[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i * centres_n + j, pa.int32()), b.column("rep"), b.column("ids"), b.column("v")],
                ["cell", "rep", "ids", "v"],
            )

    index = entries.select("rep", "ids", "v").mapInArrow(assign, "cell int, rep long, ids array<long>, v array<double>")
    index, index_path = common.written(index, "index")
    sizes = np.zeros(centres_n**2, np.int64)
    for r in index.groupBy("cell").count().collect():  # at most the square of the centroids
        sizes[r.cell] = r["count"]
    groups = int(min(max(n // GROUP_ENTRIES, 1), 4096))
    load = np.bincount(np.arange(len(sizes)) % groups, sizes, groups)
    parts_of = F.array(*[F.lit(int(p)) for p in np.maximum(1, -(-load // (2 * GROUP_ENTRIES)))])

    # A query's vector is looked up once for all queries that share it.
    asking = rows.where("asks").where(F.col("dim") == dim).select("id", "v").distinct()
    asking = asking.join(entries.select("v", "rep"), "v").select("id", "rep", "v")
    asked, asked_path = common.written(asking, "asked")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"))
            left, right = x[:, :half] @ centres[0].T, x[:, half:] @ centres[1].T
            row, group, cells = [], [], []
            for q in range(len(x)):
                way = np.array(walk(left[q], right[q], sizes.reshape(centres_n, -1), enough), np.int64)
                way = way[:, 0] * centres_n + way[:, 1]
                way = way[np.argsort(way % groups, kind="stable")]
                own, first = np.unique(way % groups, return_index=True)
                row += [q] * len(own)
                group += own.tolist()
                cells += np.split(way, first[1:])
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("rep").take(take), pa.array(group, pa.int32()), pa.array(cells, pa.list_(pa.int32())),
                 b.column("v").take(take)],
                ["rep", "g", "cells", "v"],
            )

    # Walks cost time, not bytes: by size alone Spark would put them all into one task.
    walks = max(4 * spark.sparkContext.defaultParallelism, asked.count() // 2000)
    visits = asked.select("rep", "v").dropDuplicates(["rep"]).repartition(walks, "rep")
    visits = visits.mapInArrow(visit, "rep long, g int, cells array<int>, v array<double>")
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(parts_of, F.col("g") + 1) - 1)))
    entries_in = index.withColumn("g", F.col("cell") % groups)
    entries_in = entries_in.withColumn("part", F.pmod(F.xxhash64("rep"), F.element_at(parts_of, F.col("g") + 1)).cast("int"))

    def compare(key, asks: pa.Table, held: pa.Table) -> pa.Table:
        rep, ids, score = [], [], []
        if asks.num_rows and held.num_rows:
            cell = held.column("cell").to_numpy()
            x, own = matrix(held.column("v")), held.column("ids").to_pylist()
            least = np.array([o[0] for o in own])
            queries = matrix(asks.column("v"))
            seen = np.zeros(centres_n**2, bool)
            for q, (r, cells) in enumerate(zip(asks.column("rep").to_pylist(), asks.column("cells"))):
                cells = cells.values.to_numpy()
                seen[cells] = True
                at = np.flatnonzero(seen[cell])
                seen[cells] = False
                s = x[at] @ queries[q]
                if len(at) > k + 1:  # the best k + 1 and whatever ties with the last of them
                    on = s >= np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                    at, s = at[on], s[on]
                best = np.lexsort((least[at], -s))[: k + 1]
                for e, value in zip(at[best].tolist(), s[best].tolist()):
                    rep += [r] * len(own[e])
                    ids += own[e]
                    score += [value] * len(own[e])
        return pa.table({"rep": pa.array(rep, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})

    found = visits.groupBy("g", "part").cogroup(entries_in.groupBy("g", "part")).applyInArrow(compare, "rep long, vec_id long, score double")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = asked.select(F.col("id").alias("query_id"), "rep").join(found, "rep").where("query_id <> vec_id")
    answers = answers.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
