"""Hard negatives, prefix trie and mixing against brute force, with nulls, ties, repeats, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bursttrie, covertree, hardneg, mixture
from marquee.llm.ordinals import positions

RNG = random.Random(5)


# Hard negatives

def vectors():
    g = np.random.default_rng(3)
    centres = g.normal(size=(6, 8))
    rows = []
    for i in range(700):
        v = (centres[i % 6] * g.uniform(0.5, 2) + g.normal(size=8) * 0.3).astype(np.float32)
        rows.append((i if i % 41 else None, [float(x) for x in v], int(g.integers(0, 3)) if i % 29 else None))
    rows += [(100, rows[100][1], rows[100][2])] * 2  # repeated anchors
    rows += [(1000 + i, rows[1][1], 1) for i in range(150)]  # one vector many times
    rows += [(2000, None, 1), (2100, [1.0, None] + [0.0] * 6, 1), (2200, [math.nan] + [0.0] * 7, 1), (2300, [math.inf] + [0.0] * 7, 2),
             (2400, [1.0, 2.0], 1), (2401, [2.0, 1.0], 1), (2402, [0.5, 0.6], 2), (2500, [], 1), (2501, [], 1), (2502, [], 2)]
    return rows


def brute_negatives(rows):
    valid = []
    for vid, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vid is not None and vid % 7 == 0:
            label = (label + 1) % 10
        valid.append((vid, [math.floor(256 * x) for x in v], label))
    out = []
    for i, (anchor, a, label) in enumerate(valid):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), vid is None, vid or 0, vid, other == label)
                  for j, (vid, v, other) in enumerate(valid) if j != i and len(v) == len(a)]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4]][:5]:
            window = [s for s in scored if not s[4] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(anchor, p[3], k + 1, n[3], -p[0], -n[0]) for k, n in enumerate(window)]
    return Counter(out)


def told_negatives(df):
    return Counter(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # many cells, shards and blocks on few rows
        for name, value in (("PER_CELL", 60), ("SHARD", 640), ("BLOCK", 32)):
            monkeypatch.setattr(hardneg, name, value)
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, row int, v string").repartition(4)
    got = told_negatives(hardneg.hard_negatives(table))
    assert got == brute_negatives(rows)
    assert sum(got.values()) > 100
    assert hardneg.hard_negatives(table.limit(0)).count() == 0


def test_few_rows_beyond_the_sample_reach_the_driver(spark):
    total, n = 20_000, 50
    rows = spark.range(0, total, 1, 64).select(F.col("id").alias("row"), F.array("id").alias("v"))
    told = [r.v for r in rows.orderBy(F.xxhash64("row"), "row").limit(n).collect()]
    assert [r.v for r in hardneg.least_hashed(rows, n, total)] == told
    assert n <= hardneg.low_hashed(rows, 2 * n / total).count() <= 4 * n  # before: n of each of 64 tasks
    assert [r.v for r in hardneg.least_hashed(rows, n, 100 * total)] == told  # too small a share is widened
    assert len(hardneg.least_hashed(rows.limit(7), n, 7)) == 7 and hardneg.least_hashed(rows.limit(0), n, 0) == []


def test_scores_beyond_doubles_and_longs(spark):
    big = [(0, [2.0**21, 2.0**20 + 1]), (1, [2.0**21, 3.0]), (2, [2.0**20, 5.0]), (3, [2.0**20 + 1, 7.0])]
    rows = [(i, v, i % 2 + (i == 0)) for i, v in big]
    table = spark.createDataFrame([(i, v, lab) for i, v, lab in rows], "vec_id long, embedding array<double>, label int")
    assert told_negatives(hardneg.hard_negatives(table)) == brute_negatives(rows)
    with pytest.raises(ValueError):
        hardneg.hard_negatives(spark.createDataFrame([(0, [1e30], 1)], "vec_id long, embedding array<double>, label int"))


def test_cover_tree_radii_and_skipping():
    g = np.random.default_rng(1)
    x = np.round(np.concatenate([c + g.normal(size=(400, 6)) for c in g.normal(size=(20, 6)) * 60]))
    norm = float((x * x).sum(axis=1).max())
    tree = covertree.build(x, norm)
    assert sorted(tree["order"].tolist()) == list(range(len(x)))
    points = covertree.lifted(x, norm)

    def under(node):
        start, stop = tree["child"][node]
        if start == stop:
            return tree["order"][slice(*tree["leaf"][node])]
        return np.concatenate([under(c) for c in range(start, stop)])

    for node in range(len(tree["centre"])):
        gaps = covertree.apart(points[under(node)], points[tree["centre"][node]][None, :])[:, 0]
        assert abs(gaps.max() - tree["radius"][node]) < 1e-6
    q = x[:5]
    none = np.zeros(len(x), bool)
    low, high = np.full((5, 1), -hardneg.NO_LIMIT), np.full((5, 1), hardneg.NO_LIMIT)
    rows, products = covertree.search(tree, norm, x, np.zeros(len(x), int), none, np.arange(len(x)), np.arange(len(x)), q, np.zeros(5, int),
                                      np.arange(5), low, high, 5, True)
    scores = q @ x.T
    scores[range(5), range(5)] = -np.inf
    assert (-rows[:, 2].reshape(5, 5) == -np.sort(-scores, axis=1)[:, :5]).all()
    assert products < scores.size / 2  # most of the tree is skipped


# Prefix trie

def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    node, ends, below = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
        ends[tuple(seq)].append(c)
        for d in range(len(seq) + 1):
            node[tuple(seq[:d])].append(c)
    for p in node:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(node, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        saved[p] = sum(saved[k] for k in below[p]) + ((len(node[p]) - 1) * len(p[-1][1]) if p else 0)
    return Counter((min(node[p]), len(p), min(node[p[:-1]]) if p else None, len(node[p]), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p in node)


def told_trie(df):
    return Counter(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def talks():
    rows = []
    for c in [*range(0, 230), 700, 701, -5, 1205, 1206]:  # no donor for some
        if c == 100:
            continue
        for t in range(RNG.randint(1, 9)):
            rows.append((c, t if RNG.random() > 0.02 else None, RNG.choice(["user", "assistant", None]), RNG.choice(["", None, "é😀", "one", "two " * t])))
    rows += [(c, t, "user", f"long {min(t, 9)}") for c in (900, 905, 910, 950) for t in range(14 + c % 3)]  # deep, shared and partly equal
    rows += [(c, t, "user", "same") for c in range(2000, 2200) for t in range(12)]  # many copies
    return rows + [rows[3], rows[3], (None, 1, "user", "nobody's")]


@pytest.mark.parametrize("settings", [{}, {"most": 2, "stride": 4}])
def test_prefix_trie(spark, settings):
    rows = talks()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, at string").repartition(3)
    assert told_trie(bursttrie.trie(table, **settings)) == brute_trie(rows)


def test_prefix_trie_of_little(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert bursttrie.trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(c, 0, None, None) for c in range(1, 30)]  # no donor: those with h > 0 are turnless
    assert told_trie(bursttrie.trie(spark.createDataFrame(rows, schema))) == brute_trie(rows)


def test_positions(spark):
    rows = [(RNG.choice("aab") if i % 9 else None, RNG.randint(0, 40), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(6)
    got = positions(df, ("g",), (F.col("x"), F.col("i")), "at").collect()
    for g in ("a", "b", None):
        mine = sorted((r.x, r.i) for r in got if r.g == g)
        assert [(r.x, r.i) for r in sorted((r for r in got if r.g == g), key=lambda r: r.at)] == mine
        assert sorted(r.at for r in got if r.g == g) == list(range(1, len(mine) + 1))


# Mixing

def brute_targets(size):
    """Shares by weight; what exceeds three times a source goes to the others, by weight again and again."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, left, open_ = dict.fromkeys(size, 0.0), float(sum(size.values())), set(size)
    while left > 1e-6 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 3 * size[s]:
                left += target[s] - 3 * size[s]
                target[s] = 3.0 * size[s]
                open_.discard(s)
    return target


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixture, "RANKED", 8)
    rows = []
    for i in range(1500):
        source = RNG.choice(["a", "a", "a", "a", "b", "é", "zz", None, "tiny"])
        n = RNG.choice([0, 1, 7, 7, 7, 7, RNG.randint(1, 90)])
        rows.append((i if i % 17 else None, " ".join(["w x"] * n) if i % 23 else None, "tiny" if i < 3 else source if source != "tiny" else "b"))
    rows += [rows[7]] * 40 + [(9999, "w " * 30_000, "big")]
    table = spark.createDataFrame([(*r, 5, 2.0, "s") for r in rows], "doc_id long, text string, source string, size int, target double, taken string").repartition(5)
    out = mixture.mix(table, ("doc_id", "source")).collect()
    assert len(out) == len(rows)
    size, taken = Counter(), Counter()
    want = Counter((d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows)
    assert Counter((r.doc_id, r.source, r["size"]) for r in out) == want
    for r in out:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
    for s, target in brute_targets(size).items():
        mine = [r for r in out if r.source == s]
        assert {r.source_size for r in mine} == {size[s]}
        assert all(abs(r.target - target) < 1e-6 * max(target, 1) for r in mine)
        assert abs(taken[s] - target) <= (0.51 if s != "big" else 30_000)
    assert sorted(map(repr, mixture.mix(table.repartition(2), ("doc_id", "source")).collect())) == sorted(map(repr, out))
    assert mixture.mix(table.limit(0)).count() == 0
    assert "size_" in mixture.mix(table, ("size",)).columns  # a carried column keeps its name


@pytest.mark.parametrize("seed", range(30))
def test_knapsack_finds_the_nearest_sum(seed):
    g = random.Random(seed)
    lengths = np.array(sorted(g.sample(range(1, 60), g.randint(1, 6))))
    counts = np.array([g.randint(1, 4) for _ in lengths])
    reachable = {0}
    for length, n in zip(lengths.tolist(), counts.tolist()):
        reachable = {r + k * length for r in reachable for k in range(n + 1)}
    budget = g.randint(1, int((lengths * counts).sum()))
    chosen, reached = mixture.knapsack(lengths, counts, budget)
    assert (chosen <= counts).all() and int((chosen * lengths).sum()) == reached
    assert abs(reached - budget) == min(abs(r - budget) for r in reachable)
    passes, once = mixture.fit(lengths, counts, float(budget))
    assert passes == budget // int((lengths * counts).sum()) and (once <= counts).all()
    assert passes or abs(int((once * lengths).sum()) - budget) == min(abs(r - budget) for r in reachable)
