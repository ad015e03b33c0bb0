"""Nearest neighbours by cosine and the predictions made from them.

The similarity of all users (or items) is a sparse matrix product. Emitting one
row per co-rated pair would make a heavy user or a popular item cost the square
of its ratings in shuffled rows, so the product is formed block by block: the
compared side is cut into blocks of bounded size, the other side into chunks of
bounded cell count, each task multiplies one chunk of two blocks in memory, and
only the best ``k`` of each block row leave it. Nothing is dropped on the way, so the
lists are exact. With many blocks such copies for every block pair would be most of the work; then
the sparse products of ``marquee.operators.sparse`` take their place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import r6
from marquee.operators import sparse
from marquee.operators.joins import lookup_with_default
from marquee.session import materialise, new_path

BLOCK = 2048          # compared rows per block: a block product is at most 32 MB
CHUNK_CELLS = 2_000_000  # cells a single task reads for one block pair
STEP = 4_000_000      # products formed at once inside a task
BROADCAST_BLOCKS = 100_000
GRAPH_ROWS = 1_000_000  # edges of neighbour lists that are broadcast, some 50 MB
ALL_PARTNERS = 8      # up to this many blocks a list simply goes to every block pair
PASS_CELLS = 3.0      # rows of a pass of user-based predictions, as a multiple of the cells
DENSE = 0.05          # share of all possible products from which blocks are multiplied as dense matrices


def normalise(cells: DataFrame, method: str = "z-score") -> DataFrame:
    """Centre ratings per user, or divide by the user's deviation as well.

    Users whose deviation is zero or undefined have no z-score and are left out.
    Adds ``user_mean``, ``user_sd`` and ``z``.
    """
    own = Window.partitionBy("user_id")
    known = cells.filter("user_id IS NOT NULL").withColumns({
        "user_mean": F.avg("rating").over(own),
        "user_sd": F.lit(1.0) if method == "center" else F.stddev_samp("rating").over(own),
    })
    if method != "center":
        known = known.filter("user_sd > 1e-9")
    return known.withColumn("z", (F.col("rating") - F.col("user_mean")) / F.col("user_sd"))


def _block_product(table: pa.Table, rows: int, cols: int, diagonal: bool) -> np.ndarray:
    """Dot products of one block's rows with another's over the cells of ``table``."""
    code = pd.factorize(table.column("other").to_pandas())[0]
    side = table.column("side").to_numpy()
    lists = table.column("v").combine_chunks()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    flat = lists.flatten()
    slot = flat.field(0).to_numpy().astype(np.int64)
    weight = flat.field(1).to_numpy()

    left = np.flatnonzero(side == 0)
    right = left if diagonal else np.flatnonzero(side == 1)
    _, li, ri = np.intersect1d(code[left], code[right], return_indices=True)
    left, right = left[li], right[ri]
    product = np.zeros(rows * cols)
    pairs = size[left] * size[right]
    batch = np.cumsum(pairs) // STEP
    for b in np.unique(batch):
        rows_here = np.flatnonzero(batch == b)
        ll, rr, n = left[rows_here], right[rows_here], pairs[rows_here]
        total = int(n.sum())
        if total > 0.05 * len(ll) * rows * cols:
            dense = np.zeros((len(ll), rows)), np.zeros((len(ll), cols))
            for out, members in zip(dense, (ll, rr)):
                for i, m in enumerate(members):
                    s = slice(start[m], start[m] + size[m])
                    out[i, slot[s]] = weight[s]
            product += (dense[0].T @ dense[1]).ravel()
            continue
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(size[rr], n)
        x = np.repeat(start[ll], n) + at // width
        y = np.repeat(start[rr], n) + at % width
        np.add.at(product, slot[x] * cols + slot[y], weight[x] * weight[y])
    product = product.reshape(rows, cols)
    if diagonal:
        np.fill_diagonal(product, 0.0)
    return product


def _best(product: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and values of the ``k`` largest positive entries of each row.

    Slots follow the id order, so ties are broken by the smaller id.
    """
    k = min(k, product.shape[1])
    kth = np.partition(product, product.shape[1] - k, axis=1)[:, [product.shape[1] - k]]
    keep = product > kth
    tied = product == kth
    room = k - keep.sum(axis=1, keepdims=True)
    keep |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= room)
    i, j = np.nonzero(keep & (product > 0))
    return i, j, product[i, j]


_TOP_SCHEMA = "block int, slot int, n_block int, n_slot int, similarity double"
_PART_SCHEMA = "b1 int, b2 int, i int, js array<int>, dots array<double>"


def _top_batch(b1: int, b2: int, product: np.ndarray, k: int) -> pa.RecordBatch:
    product = np.round(product, 9)
    i, j, s = _best(product, k)
    parts = [(np.full(len(i), b1), i, np.full(len(i), b2), j, s)]
    if b1 != b2:
        j, i, s = _best(product.T, k)
        parts.append((np.full(len(i), b2), j, np.full(len(i), b1), i, s))
    cols = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32()) for c in cols[:4]] + [pa.array(cols[4], pa.float64())],
        names=["block", "slot", "n_block", "n_slot", "similarity"],
    )


def _multiply_and_rank(key, table: pa.Table, k: int, width: int) -> pa.Table:
    b1, b2 = key[0].as_py(), key[1].as_py()
    product = _block_product(table, width, width, b1 == b2)
    return pa.Table.from_batches([_top_batch(b1, b2, product, k)])


def _multiply(key, table: pa.Table, width: int) -> pa.Table:
    b1, b2 = key[0].as_py(), key[1].as_py()
    product = _block_product(table, width, width, b1 == b2)
    i, j = np.nonzero(product)
    used, n = np.unique(i, return_counts=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.table({
        "b1": pa.array(np.full(len(used), b1), pa.int32()),
        "b2": pa.array(np.full(len(used), b2), pa.int32()),
        "i": pa.array(used, pa.int32()),
        "js": pa.ListArray.from_arrays(offsets, pa.array(j, pa.int32())),
        "dots": pa.ListArray.from_arrays(offsets, pa.array(product[i, j])),
    })


def _add_and_rank(key, batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Sum the chunk products of one block pair batch by batch, then rank."""
    b1, b2 = key[0].as_py(), key[1].as_py()
    product = np.zeros(width * width)
    for batch in batches:
        js = batch.column("js")
        n = pc.list_value_length(js).to_numpy(zero_copy_only=False)
        i = np.repeat(batch.column("i").to_numpy().astype(np.int64), n)
        at = i * width + js.flatten().to_numpy()
        np.add.at(product, at, batch.column("dots").flatten().to_numpy())
    yield _top_batch(b1, b2, product.reshape(width, width), k)


def _from_lists(cells: DataFrame, norms: DataFrame, entity: str, other: str, k: int) -> DataFrame | None:
    """The neighbours from stored lists, for many entities; None where so many products meet that dense blocks are better."""
    spark = cells.sparkSession
    members, total = sparse.ordered_codes(norms.filter(F.col(entity).isNotNull()).select(entity, "norm"), entity)
    path = new_path(spark, "lists")
    sparse.store_lists(cells.filter("__w IS NOT NULL").join(members, entity).select(
        F.col(other).alias("other"), "code", (F.col("__w") / F.col("norm")).alias("w")), path)
    work, rows, lists = sparse.count_products(spark, path, total)
    if sum(work) > DENSE * lists * total * total:
        return None
    # Stored, so that the planner sees its size and the products are formed once.
    best = materialise(sparse.top_products(spark, path, sparse.blocks_of(work, rows, total), total, k), "best")
    ids = members.select(F.col(entity), "code")
    neighbours = ids.select(F.col(entity).alias("neighbour"), F.col("code").alias("n_code"))
    return best.join(neighbours, "n_code").join(ids, "code").select(entity, "neighbour", "similarity", "rank")


def nearest_neighbours(
    cells: DataFrame, entity: str, other: str, k: int, weight: str = "z",
    block: int = BLOCK, chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """The ``k`` most similar entities of each entity with positive cosine.

    ``cells`` has one row per (entity, other). Returns ``entity``, ``neighbour``,
    ``similarity`` (nine decimals) and ``rank``; ties go to the smaller id.
    """
    cells = cells.select(entity, other, F.col(weight).alias("__w"))
    norms = materialise(cells.groupBy(entity).agg(
        F.sqrt(F.sum(F.col("__w") * F.col("__w"))).alias("norm"), F.count("*").alias("n")
    ).filter("norm > 0"), "norms")
    blocks = max(1, -(-norms.count() // block))
    if blocks > ALL_PARTNERS:
        found = _from_lists(cells, norms, entity, other, k)
        if found is not None:
            return found
    members = materialise(
        norms.withColumn("block", F.pmod(F.xxhash64(entity), F.lit(blocks)).cast("int"))
        .withColumn(
            "slot", (F.row_number().over(Window.partitionBy("block").orderBy(entity)) - 1)
        ),
        "members",
    )
    sizes = members.groupBy("block").agg(
        F.sum("n").alias("cells"), (F.max("slot") + 1).alias("slots")
    )
    limits = sizes.agg(F.max("cells").alias("cells"), F.max("slots").alias("slots")).first()
    width = limits["slots"] or 1
    single = 2 * (limits["cells"] or 0) <= chunk_cells

    packed = (
        cells.join(members.select(entity, "block", "slot", "norm"), entity)
        .groupBy(F.col(other).alias("other"), "block")
        .agg(F.collect_list(F.struct("slot", (F.col("__w") / F.col("norm")).alias("w"))).alias("v"))
    )
    partners = F.sequence(F.lit(0), F.lit(blocks - 1))
    paired = packed.withColumn("partner", F.explode(partners)).select(
        F.least("block", "partner").alias("b1"), F.greatest("block", "partner").alias("b2"),
        (F.col("block") > F.col("partner")).cast("int").alias("side"), "other", "v",
    )
    if single:
        def rank_one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            return _multiply_and_rank(key, table, k, width)

        best = paired.groupBy("b1", "b2").applyInArrow(rank_one, _TOP_SCHEMA)
    else:
        def multiply(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            return _multiply(key, table, width)

        def add_up(
            key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
        ) -> Iterator[pa.RecordBatch]:
            yield from _add_and_rank(key, batches, k, width)

        # One row per block; the block count is known, so the broadcast is bounded.
        need = sizes.select("block", "cells")
        need = F.broadcast(need) if blocks <= BROADCAST_BLOCKS else need
        chunked = (
            paired.join(need.select(F.col("block").alias("b1"), F.col("cells").alias("c1")), "b1")
            .join(need.select(F.col("block").alias("b2"), F.col("cells").alias("c2")), "b2")
            .withColumn("chunks", F.ceil((F.col("c1") + F.col("c2")) / F.lit(chunk_cells)))
            .withColumn("chunk", F.pmod(F.xxhash64("other"), F.col("chunks")))
            .select("b1", "b2", "chunk", "side", "other", "v")
        )
        parts = chunked.groupBy("b1", "b2", "chunk").applyInArrow(multiply, _PART_SCHEMA)
        best = parts.groupBy("b1", "b2").applyInArrow(add_up, _TOP_SCHEMA)

    ids = members.select(entity, "block", "slot")
    named = best.join(
        ids.select(F.col(entity).alias("neighbour"), F.col("block").alias("n_block"),
                   F.col("slot").alias("n_slot")),
        ["n_block", "n_slot"],
    ).join(ids, ["block", "slot"])
    order = Window.partitionBy(entity).orderBy(F.desc("similarity"), "neighbour")
    return (
        named.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(entity, "neighbour", "similarity", "rank")
    )


def _scores(found: DataFrame) -> DataFrame:
    """Similarity-weighted mean of neighbour z-scores."""
    return found.groupBy("user_id", "item_id").agg(
        (F.sum(F.col("similarity") * F.col("z")) / F.sum("similarity")).alias("score")
    )


def _rescaled(scores: DataFrame, cells: DataFrame) -> DataFrame:
    """Scores back on the user's scale."""
    users = cells.groupBy("user_id").agg(
        F.first("user_mean").alias("user_mean"), F.first("user_sd").alias("user_sd")
    )
    return scores.join(users, "user_id").select(
        "user_id", "item_id",
        r6(F.col("user_mean") + F.col("user_sd") * F.col("score")).alias("prediction"),
    )


def predict_item_based(pairs: DataFrame, cells: DataFrame, neighbours: DataFrame, default: float = 1.0) -> DataFrame:
    """Predict each (user, item) from the user's ratings of the item's neighbours.

    Pairs and scores are stored, so the shuffle files of each step are gone before the next one writes its own.
    """
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select("user_id", "item_id").distinct()
    found = wanted.join(neighbours.select("item_id", "neighbour", "similarity"), "item_id").join(
        cells.select("user_id", F.col("item_id").alias("neighbour"), "z"), ["user_id", "neighbour"]
    )
    return lookup_with_default(pairs, _rescaled(materialise(_scores(found), "scores"), cells), ["user_id", "item_id"], "prediction", default)


def predict_user_based(
    pairs: DataFrame, cells: DataFrame, neighbours: DataFrame, default: float = 1.0, pass_cells: float = PASS_CELLS
) -> DataFrame:
    """Predict each (user, item) from what the user's neighbours gave the item.

    Every wanted item meets every neighbour of its user. Where that is more than ``pass_cells`` times the
    rows of ``cells``, users are taken in several passes, so that only a part of those rows is on disk at a time.
    """
    pairs = materialise(pairs, "pairs")
    wanted = materialise(pairs.select("user_id", "item_id").distinct(), "wanted")
    near = materialise(neighbours.select("user_id", "neighbour", "similarity"), "near")
    rated = cells.select(F.col("user_id").alias("neighbour"), "item_id", "z")
    meet = wanted.groupBy("user_id").agg(F.count("*").alias("a")).join(
        near.groupBy("user_id").agg(F.count("*").alias("b")), "user_id").agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0
    passes = max(1, math.ceil(meet / (pass_cells * max(1, cells.count()))))

    def scores(users: DataFrame) -> DataFrame:
        return _scores(users.join(near, "user_id").join(rated, ["neighbour", "item_id"]))

    place = F.pmod(F.xxhash64("user_id"), F.lit(passes))
    found = reduce(DataFrame.unionByName, [materialise(scores(wanted.filter(place == p)), "scores") for p in range(passes)])
    return lookup_with_default(pairs, _rescaled(found, cells), ["user_id", "item_id"], "prediction", default)


def recommend_unseen(cells: DataFrame, neighbours: DataFrame, n: int = 25, graph_rows: int = GRAPH_ROWS) -> DataFrame:
    """The ``n`` best unseen items of each user, scored from item neighbours.

    The neighbour lists get an edge from every item to itself, without a similarity: a sum that holds
    such an edge belongs to an item the user has rated. Lists of up to ``graph_rows`` edges are
    broadcast, so only the ratings are shuffled, once, by user: what a hub item multiplies is summed,
    compared and cut to ``n`` in the user's own partition. Longer lists are joined by a shuffle.
    """
    own = cells.select("item_id").distinct().select("item_id", F.col("item_id").alias("neighbour"),
                                                    F.lit(None).cast("double").alias("similarity"))
    graph = materialise(neighbours.select("item_id", "neighbour", "similarity").unionByName(own), "graph")
    rated = cells.select("user_id", F.col("item_id").alias("neighbour"), "z", "user_mean", "user_sd")
    if graph.count() <= graph_rows:
        rated, graph = rated.repartition("user_id"), F.broadcast(graph)
    unseen = rated.join(graph, "neighbour").groupBy("user_id", "item_id").agg(
        (F.sum(F.col("similarity") * F.col("z")) / F.sum("similarity")).alias("score"),
        F.max(F.col("similarity").isNull()).alias("seen"),
        F.first("user_mean").alias("user_mean"), F.first("user_sd").alias("user_sd"),
    ).filter("NOT seen").select(
        "user_id", "item_id", r6(F.col("user_mean") + F.col("user_sd") * F.col("score")).alias("prediction"))
    order = Window.partitionBy("user_id").orderBy(F.desc("prediction"), "item_id")
    return unseen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
