"""Neighbours and predictions against brute force on small matrices."""

import re

import numpy as np
import pytest

from marquee.operators import similarity as S
from marquee.operators import sparse
from marquee.operators.reshape import user_item_cells
from marquee.session import materialise


def ratings(seed=3, users=60, items=40, hot=True):
    """A sparse matrix; with ``hot`` one user and one item hold about a third of all cells."""
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(users):
        for i in range(items):
            if rng.random() < 0.12 or (hot and (u == 0 or i == 0)):
                rows.append((f"u{u}", i, int(rng.integers(1, 6))))
    return rows + [("flat", i, 3) for i in range(5)]


def brute(rows, k, axis):
    users = sorted({u for u, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    cells = {}
    for u, i, r in rows:
        cells.setdefault((u, i), []).append(r)
    z = np.full((len(users), len(items)), np.nan)
    for (u, i), r in cells.items():
        z[users.index(u), items.index(i)] = np.mean(r)
    mean, sd = np.nanmean(z, axis=1, keepdims=True), np.nanstd(z, axis=1, ddof=1, keepdims=True)
    with np.errstate(all="ignore"):
        z = np.where(sd > 1e-9, (z - mean) / sd, np.nan)
    m, names = (z, users) if axis == 0 else (z.T, items)
    w = np.nan_to_num(m)
    norm = np.sqrt((w ** 2).sum(axis=1))
    sim = np.round((w @ w.T) / np.outer(np.where(norm > 0, norm, 1), np.where(norm > 0, norm, 1)), 9)
    np.fill_diagonal(sim, 0)
    out = {}
    for a, name in enumerate(names):
        best = sorted((-sim[a, b], names[b]) for b in range(len(names)) if sim[a, b] > 0)[:k]
        if best:
            out[name] = [(b, round(-s, 6)) for s, b in best]
    return out, z, mean, sd, users, items


def frame(spark, rows):
    return S.normalise(user_item_cells(spark.createDataFrame(rows, "user_id string, item_id long, rating int")))


@pytest.mark.parametrize("block,chunk,step,spread", [
    (2048, 2_000_000, 4_000_000, 32),  # one block, one chunk
    (8, 2_000_000, 50, 32),            # many blocks, many steps
    (8, 40, 4_000_000, 32),            # many chunks, summed in a second stage
    (8, 40, 4_000_000, 1),             # block lists only where blocks meet
])
@pytest.mark.parametrize("axis", [0, 1])
def test_neighbours_equal_brute_force(spark, monkeypatch, block, chunk, step, spread, axis):
    monkeypatch.setattr(S, "STEP", step)
    monkeypatch.setattr(S, "ALL_PARTNERS", spread)
    rows = ratings()
    entity, other = (("user_id", "item_id"), ("item_id", "user_id"))[axis]
    got = {}
    for r in S.nearest_neighbours(frame(spark, rows), entity, other, 4, block=block, chunk_cells=chunk).collect():
        got.setdefault(r[entity], []).append((r["rank"], r.neighbour, round(r.similarity, 6)))
    want = brute(rows, 4, axis)[0]
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == want


@pytest.mark.parametrize("products,cells,ranges", [
    (4_000_000, 1 << 17, 1 << 16),  # one block, one chunk for each partition
    (40, 16, 1 << 16),              # blocks of a row or a few, sums added up on the way, many chunks
    (300, 50, 8),                   # ranges of several rows
])
@pytest.mark.parametrize("axis", [0, 1])
def test_neighbours_from_lists_equal_brute_force(spark, monkeypatch, products, cells, ranges, axis):
    for name, value in (("PRODUCTS", products), ("LIST_CELLS", cells), ("RANGES", ranges)):
        monkeypatch.setattr(sparse, name, value)
    monkeypatch.setattr(S, "ALL_PARTNERS", 1)
    monkeypatch.setattr(S, "DENSE", 2.0)
    rows = ratings()
    entity, other = (("user_id", "item_id"), ("item_id", "user_id"))[axis]
    near = S.nearest_neighbours(frame(spark, rows), entity, other, 4, block=8)
    got = {}
    for r in near.collect():
        got.setdefault(r[entity], []).append((r["rank"], r.neighbour, round(r.similarity, 6)))
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == brute(rows, 4, axis)[0]
    assert near.columns == [entity, "neighbour", "similarity", "rank"]


def test_cells_of_many_entities_are_not_copied_to_block_pairs(spark, tmp_path, monkeypatch):
    """Before, every list went to each block that its row has a cell in: here some 20 copies of each cell."""
    rng = np.random.default_rng(1)
    rows = [(f"u{u}", int(i), int(rng.integers(1, 6))) for u in range(300) for i in rng.choice(2000, 20, replace=False)]
    cells = materialise(frame(spark, rows), "cells")
    stored, sent = [], []
    monkeypatch.setattr(sparse, "store_lists", lambda c, path, f=sparse.store_lists: (f(c, path), stored.append(path)))
    monkeypatch.setattr(S, "materialise", lambda df, label, f=materialise: (out := f(df, label), sent.append((label, out.count())))[0])
    near = S.nearest_neighbours(cells, "item_id", "user_id", 3, block=50)
    want = brute(rows, 3, 1)[0]
    got = {}
    for r in near.collect():
        got.setdefault(r.item_id, []).append((r["rank"], r.neighbour, round(r.similarity, 6)))
    assert {k: [x[1:] for x in sorted(v)] for k, v in got.items()} == want
    bytes_ = spark.read.parquet(stored[0]).selectExpr("sum(length(codes)) / 4 AS n").first().n
    assert bytes_ == cells.count() and dict(sent)["best"] == sum(map(len, want.values()))


def test_flat_user_is_left_out(spark):
    cells = frame(spark, ratings())
    assert cells.filter("user_id = 'flat'").count() == 0
    assert S.normalise(user_item_cells(spark.createDataFrame(ratings(), "user_id string, item_id long, rating int")),
                       "center").filter("user_id = 'flat' AND z = 0").count() == 5


@pytest.mark.parametrize("axis", [0, 1])
def test_predictions_equal_brute_force(spark, axis):
    rows = ratings()
    near, z, mean, sd, users, items = brute(rows, 5, axis)
    cells = frame(spark, rows)
    pairs = [(u, i) for u in users[:12] + ["nobody"] for i in items[:10] + [999]]
    df = spark.createDataFrame(pairs, "user_id string, item_id long")
    entity, other = (("user_id", "item_id"), ("item_id", "user_id"))[axis]
    nb = S.nearest_neighbours(cells, entity, other, 5)
    predict = (S.predict_user_based, S.predict_item_based)[axis]
    got = {(r.user_id, r.item_id): r.prediction for r in predict(df, cells, nb, default=1.0).collect()}
    assert set(got) == set(pairs)
    for u, i in pairs:
        want = 1.0
        if u in users and i in items and sd[users.index(u), 0] > 1e-9:
            a = users.index(u)
            if axis == 0:
                found = [(s, z[users.index(v), items.index(i)]) for v, s in near.get(u, [])]
            else:
                found = [(s, z[a, items.index(j)]) for j, s in near.get(i, [])]
            found = [(s, x) for s, x in found if not np.isnan(x)]
            if found:
                want = mean[a, 0] + sd[a, 0] * sum(s * x for s, x in found) / sum(s for s, _ in found)
        assert got[u, i] == pytest.approx(want, abs=2e-5)


def test_user_based_predictions_in_passes_are_those_of_one_pass(spark):
    cells = materialise(frame(spark, ratings()), "cells")
    near = materialise(S.nearest_neighbours(cells, "user_id", "item_id", 5), "near")
    pairs = spark.createDataFrame([(f"u{u}", i) for u in range(30) for i in range(20)] + [("nobody", 1)], "user_id string, item_id long")
    told = [{(r.user_id, r.item_id): r.prediction for r in S.predict_user_based(pairs, cells, near, pass_cells=p).collect()} for p in (1e9, 0.5)]
    assert told[0] == told[1] and len(told[0]) == 601 and len(set(told[0].values())) > 100


def test_recommendations_are_unseen_and_ranked(spark):
    cells = frame(spark, ratings())
    nb = S.nearest_neighbours(cells, "item_id", "user_id", 5)
    out = S.recommend_unseen(cells, nb, 3)
    assert out.join(cells, ["user_id", "item_id"], "left_semi").count() == 0
    per_user = {}
    for r in out.collect():
        per_user.setdefault(r.user_id, []).append((r["rank"], -r.prediction))
    assert per_user and all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in per_user.values())
    assert all([x[1] for x in sorted(v)] == sorted(x[1] for x in v) for v in per_user.values())


@pytest.mark.parametrize("graph_rows", [10**6, 0])
def test_recommendations_equal_brute_force_with_a_hub(spark, graph_rows):
    """One item is rated by all and near to all others, so it meets every user's candidates."""
    cells = materialise(frame(spark, ratings()), "cells")
    z = {(r.user_id, r.item_id): (r.z, r.user_mean, r.user_sd) for r in cells.collect()}
    items = sorted({i for _, i in z})
    hub = items[0]
    edges = [(i, hub, 0.5) for i in items[1:]] + [(i, items[-1 - k], 0.9 - k / 100) for k, i in enumerate(items) if i != items[-1 - k]]
    edges = list({(a, b): (a, b, s) for a, b, s in edges}.values())
    got = {}
    out = S.recommend_unseen(cells, spark.createDataFrame(edges, "item_id long, neighbour long, similarity double"), 4, graph_rows)
    for r in out.collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.item_id, r.prediction))
    for u in {u for u, _ in z}:
        sums = {}
        for i, j, s in edges:
            if (u, j) in z and (u, i) not in z:
                a, b = sums.get(i, (0.0, 0.0))
                sums[i] = a + s * z[u, j][0], b + s
        _, mean, sd = next(v for (v_, _), v in z.items() if v_ == u)
        want = sorted(((-round(mean + sd * a / b, 6), i) for i, (a, b) in sums.items()))[:4]
        assert [(x[0], x[1]) for x in sorted(got.get(u, []))] == [(k + 1, i) for k, (_, i) in enumerate(want)]
        assert [x[2] for x in sorted(got.get(u, []))] == pytest.approx([-p for p, _ in want], abs=2e-6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Sums leave the user's partition only if the lists are not broadcast.
    assert bool(re.search(r"hashpartitioning\(user_id#\d+L?, item_id#", plan)) == (graph_rows == 0)
