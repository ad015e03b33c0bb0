"""Prefix trie of conversations by burst tries.

A conversation is a sequence of turn ids, a turn id the SHA-256 of role and text. Equal sequences are merged
first. All of them begin in one container under the root. A container with too many sequences
bursts: its next turns become heads, and the sequences go to containers below them, several turns at a time.
What remains is small; a container's turns are sorted by depth and swept twice, down to name the nodes
and up to sum their subtrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare
from marquee.llm.ordinals import positions
from marquee.session import materialise

EVERY, MOST_SHARED = 100, 6  # conversations that share a beginning; number of lengths it can have
CONTAINER = 512  # sequences that a container may hold without bursting
STRIDE = 8  # turns by which a container bursts at a time
SENT = 2000  # rows of one Arrow batch that a sweep sends
ROOT = b"\0" * 32


def digest(role: Column, text: Column) -> Column:
    """Id of a turn. The role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def turns(table: DataFrame) -> DataFrame:
    """Stored (conv, at, id, size): each turn with its 1-based position, its id and its text's code points.

    Ordered by turn, null first, then by role and text, null as empty. Rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = table.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    # Rows that tie in turn are compared by role and text, so both take part in the sort.
    order = (F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    ids = rows.select("conv", "turn", "role", "text", digest(F.col("role"), F.col("text")).alias("id"), F.length("text").alias("size"))
    repeated = ids.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if not repeated:  # the usual case: turns alone decide, and texts need not be moved
        ids, order = ids.drop("role", "text"), order[:1]
    return materialise(positions(ids, ("conv",), order, "at").select("conv", "at", "id", "size"), "trie-turns")


def rebuilt(own: DataFrame, every: int = EVERY, lengths: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and (conv, n) for every conversation, both stored.

    The first h turns come from conversation conv - conv % every, the others are its own behind its first h, with
    h = crc32(conv) % lengths. At most lengths - 1 turns of a donor are used, and at most every conversations use them.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % lengths
    known = own.select("conv", h.alias("h")).distinct().withColumn("donor", F.col("conv") - F.col("conv") % every)
    given = own.where((F.col("conv") % every == 0) & (F.col("at") < lengths)).groupBy(F.col("conv").alias("from")).agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "size"))).alias("first"))
    whole = materialise(known.join(given, F.col("donor") == F.col("from"), "left").select(
        "conv", "h", F.coalesce(F.slice("first", F.lit(1), F.col("h").cast("int")), F.array().cast(given.schema["first"].dataType)).alias("first")), "trie-starts")
    kept = whole.select(F.col("conv").alias("of"), "h", F.size("first").alias("k"))
    tail = own.join(kept, F.col("conv") == F.col("of")).where("at > h").select("conv", (F.col("at") - F.col("h") + F.col("k")).alias("at"), "id", "size")
    start = whole.select("conv", F.explode("first").alias("t")).select("conv", "t.at", "t.id", "t.size")
    rows = materialise(start.unionByName(tail), "trie-rebuilt")
    # Sums before the join, so a long conversation is no group in one task.
    sizes = rows.select("conv", _mark().alias("mark")).groupBy("conv").agg(F.count(F.lit(1)).alias("n"), *[
        F.bit_xor(F.conv(F.substring("mark", 16 * i + 1, 16), 16, -10).cast("long")).alias(f"m{i}") for i in range(4)])
    marks = [f"m{i}" for i in range(4)]
    return rows, materialise(whole.select("conv").join(sizes, "conv", "left").select(
        "conv", F.coalesce("n", F.lit(0)).alias("n"), *[F.coalesce(m, F.lit(0)).alias(m) for m in marks]), "trie-convs")


def _mark() -> Column:
    """SHA-256 of a position with its turn id. The bitwise sum of a sequence's marks tells it from others.

    The sum needs no order, so turns are combined before they are shuffled.
    """
    return F.sha2(F.concat(F.col("at").cast("string").cast("binary"), F.col("id")), 256)


def _streamed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (rep, conv) -> (rep, ends): the digest of each rep's ids, comma-joined, fed to it one by one."""
    rep, state, reps, told = None, None, [], []
    for batch in batches:
        for r, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if r != rep:
                if rep is not None:
                    reps.append(rep)
                    told.append(state.hexdigest())
                rep, state = r, sha256(b"%d" % c)
            else:
                state.update(b",%d" % c)
        if len(reps) >= SENT:
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(told, pa.string())], ["rep", "ends"])
            reps, told = [], []
    if rep is not None:
        reps.append(rep)
        told.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(told, pa.string())], ["rep", "ends"])


def sequences(convs: DataFrame) -> DataFrame:
    """Stored (rep, n, copies, ends), one row per distinct sequence; rep is its smallest conversation."""
    marks = ["n", "m0", "m1", "m2", "m3"]
    groups = materialise(convs.groupBy(*marks).agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("copies")), "trie-groups")
    several = groups.where("copies > 1").select(*[F.col(m).alias(f"{m}_") for m in marks], "rep")
    same = F.lit(True)
    for m in marks:
        same &= F.col(m) == F.col(f"{m}_")
    members = convs.join(several, same).select("rep", "conv")
    # A digest takes its ids in order, one after another: a group's ids stream through a task, which holds one batch.
    ends = members.repartition("rep").sortWithinPartitions("rep", "conv").mapInArrow(_streamed_ends, "rep long, ends string")
    alone = groups.where("copies = 1").withColumn("ends", F.sha2(F.col("rep").cast("string").cast("binary"), 256))
    both = alone.unionByName(groups.where("copies > 1").join(ends, "rep"))
    return materialise(both.select("rep", "n", "copies", "ends"), "trie-sequences")


def burst(rows: DataFrame, seqs: DataFrame, most: int, stride: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Stored heads (key, up, depth, n_convs, conv, size), containers (rep, key, up, depth), ends (at, rep), and the number of rounds.

    In a round every sequence of an oversized container gives the keys of its next ``stride`` prefixes, at most. Prefixes
    shared by more than ``most`` sequences become heads, the first other one is the sequence's container, and a sequence
    without another one ends at its last head. ``above`` holds the heads above from the one that the round began under on.
    """
    spark = rows.sparkSession
    live = seqs.where("n > 0").select("rep", "n", "copies", F.lit(ROOT).alias("start"), F.lit(0).cast("long").alias("depth"))
    none = spark.createDataFrame([], "key binary, up binary, depth long, n_convs long, conv long, size long, above array<binary>, round int")
    heads, containers = none, spark.createDataFrame([], "rep long, key binary, up binary, depth long, above array<binary>, round int")
    ended = spark.createDataFrame([], "at binary, rep long")
    number = 0
    while True:
        near = rows.select(F.col("conv").alias("of"), "at", "id", "size").join(live, F.col("of") == F.col("rep")).where(
            (F.col("at") > F.col("depth")) & (F.col("at") <= F.col("depth") + stride))
        path = near.groupBy("rep", "n", "copies", "start", "depth").agg(F.sort_array(F.collect_list(F.struct("at", "id", "size"))).alias("path"))
        steps = F.transform("path", lambda p, i: F.struct(
            F.unhex(F.sha2(F.concat(F.col("start"), F.array_join(F.transform(F.slice("path", F.lit(1), i + 1), lambda q: F.hex(q["id"])), "").cast("binary")), 256)).alias("key"),
            p["at"].alias("depth"), p["size"].cast("long").alias("size")))
        path = materialise(path.select("rep", "n", "copies", "start", F.col("depth").alias("from"), steps.alias("steps")), "trie-paths")
        each = path.select("rep", "copies", "start", F.posexplode("steps").alias("i", "s"), "steps")
        up = F.when(F.col("i") == 0, F.col("start")).otherwise(F.element_at(F.col("steps")["key"], F.greatest("i", F.lit(1))))
        above = F.concat(F.array("start"), F.slice(F.col("steps")["key"], F.lit(1), F.col("i")))
        large = materialise(each.select("copies", "rep", "s", up.alias("up"), above.alias("above")).groupBy(F.col("s.key").alias("key")).agg(
            F.count(F.lit(1)).alias("sequences"), F.sum("copies").alias("n_convs"), F.min("rep").alias("conv"), F.first("up").alias("up"),
            F.first("above").alias("above"), F.first("s.depth").alias("depth"), F.first("s.size").alias("size")).where(F.col("sequences") > most), "trie-heads")
        heads = heads.unionByName(large.select("key", "up", "depth", "n_convs", "conv", "size", "above", F.lit(number).alias("round")))
        over = each.select("rep", F.col("s.key").alias("key_"), "i").join(large.select(F.col("key").alias("large")), F.col("key_") == F.col("large")).groupBy(
            F.col("rep").alias("rep_")).agg(F.max("i").alias("last"))  # prefixes of a large one are large too
        placed = path.join(over, F.col("rep") == F.col("rep_"), "left").withColumn("k", F.coalesce(F.col("last") + 1, F.lit(0)))
        placed = materialise(placed.select("rep", "n", "copies", "start", "from", "steps", "k"), "trie-placed")
        stay = placed.where(F.col("k") < F.size("steps"))
        mine = F.col("steps")[F.col("k")]
        keys = F.concat(F.array("start"), F.slice(F.col("steps")["key"], F.lit(1), F.col("k")))
        containers = containers.unionByName(stay.select("rep", mine["key"].alias("key"), F.element_at(keys, -1).alias("up"), mine["depth"].alias("depth"),
                                                        keys.alias("above"), F.lit(number).alias("round")))
        through = placed.where(F.col("k") == F.size("steps"))
        stops = F.col("n") == F.col("from") + F.size("steps")
        ended = ended.unionByName(through.where(stops).select(F.element_at(F.col("steps")["key"], -1).alias("at"), "rep"))
        go = through.where(~stops)
        live = go.select("rep", "n", "copies", F.element_at(F.col("steps")["key"], -1).alias("start"), (F.col("from") + F.size("steps")).alias("depth"))
        live = materialise(live, "trie-live")
        if live.isEmpty():
            return materialise(heads, "trie-heads"), materialise(containers, "trie-containers"), materialise(ended, "trie-ended"), number + 1
        number += 1


DOWN = "key binary, depth long, node long, parent long, n_convs long, size long, ends string"
UP = "key binary, depth long, conv_id long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of containers, sorted by (key, at, id, rep) -> their nodes, each named by its smallest conversation.

    Only the nodes of one depth are held: for each sequence that of the depth before.
    """
    out: list[tuple] = []
    key = depth = None
    node_of: dict[int, int] = {}
    level: dict[tuple, list] = {}

    def close() -> None:
        now = {}
        for (parent, _), (node, copies, size, ends, reps) in level.items():
            out.append((key, depth, node, parent, copies, size, ends))
            now.update(dict.fromkeys(reps, node))
        node_of.clear()
        node_of.update(now)
        level.clear()

    for batch in batches:
        for k, at, turn, rep, n, copies, size, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if k != key or at != depth:
                close()
                if k != key:
                    node_of.clear()
                key, depth = k, at
            held = level.setdefault((node_of.get(rep), turn), [rep, 0, size, None, []])
            held[0] = min(held[0], rep)
            held[1] += copies
            if n == at:
                held[3] = ends
            held[4].append(rep)
        while len(out) >= SENT:
            yield _sent(out[:SENT], DOWN)
            del out[:SENT]
    close()
    yield _sent(out, DOWN)


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, deepest first within each -> with the sums over their subtrees."""
    out: list[tuple] = []
    key = depth = None
    below: dict[int, list[int]] = {}
    here: dict[int, list[int]] = {}
    for batch in batches:
        for k, at, node, parent, n, size, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if k != key:
                key, depth, below, here = k, at, {}, {}
            elif at != depth:
                depth, below, here = at, here, {}
            children, leaves, saved = below.get(node) or (0, 0, 0)
            leaves, saved = leaves or 1, saved + (n - 1) * size
            out.append((k, at, node, parent, n, children, leaves, saved, ends))
            if parent is not None:
                sums = here.setdefault(parent, [0, 0, 0])
                sums[0] += 1
                sums[1] += leaves
                sums[2] += saved
        while len(out) >= SENT:
            yield _sent(out[:SENT], UP)
            del out[:SENT]
    yield _sent(out, UP)


_TYPES = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}


def _sent(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*[f.split() for f in schema.split(", ")], strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _TYPES[t]) for c, t in zip(columns, types, strict=True)], list(names))


def trie(table: DataFrame, every: int = EVERY, lengths: int = MOST_SHARED, most: int = CONTAINER, stride: int = STRIDE) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations of ``table`` (conv_id, turn, role, text).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Null role or
    text counts as empty; turns that tie are ordered by role and text; a repeated row is a further turn; rows without conv_id are
    left out; extra columns are ignored; an empty table gives an empty result.
    A container with one sequence that nobody else has needs no sweep: its nodes follow from its turns, so a
    single conversation of any length is spread over tasks. Other containers hold at most ``most`` sequences, and a sweep
    holds one entry per sequence, however long they are.
    """
    prepare(table.sparkSession)
    rows, convs = rebuilt(turns(table), every, lengths)
    seqs = sequences(convs)
    kept = seqs.where("n > 0").select(F.col("rep").alias("rep_"))
    rows = materialise(rows.join(kept, F.col("conv") == F.col("rep_"), "left_semi"), "trie-rows") if _fewer(convs, seqs) else rows
    heads, containers, ended, rounds = burst(rows, seqs, most, stride)
    told = containers.join(seqs.select(F.col("rep").alias("rep_"), "n", "copies", "ends"), F.col("rep") == F.col("rep_")).drop("rep_")
    held = told.groupBy(F.col("key").alias("key_")).agg(F.count(F.lit(1)).alias("held"))
    told = materialise(told.join(held, F.col("key") == F.col("key_")).drop("key_"), "trie-held")
    within = rows.select("conv", "at", "id", "size").join(told.select("rep", "key", "depth", "n", "copies", "ends", "held"), F.col("conv") == F.col("rep")).where("at >= depth")
    lone = (F.col("held") == 1) & (F.col("copies") == 1)
    inner = F.col("at") < F.col("n")
    plain = within.where(lone).select(
        "key", F.col("at").alias("depth"), F.col("conv").alias("conv_id"), F.when(F.col("at") > F.col("depth"), F.col("conv")).alias("parent"),
        F.lit(1).cast("long").alias("n_convs"), inner.cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(~inner, F.col("ends")).alias("ends"))
    sorted_ = within.where(~lone).select("key", "at", "id", "conv", "n", "copies", F.col("size").cast("long").alias("size"), "ends").repartition("key").sortWithinPartitions("key", "at", "id", "conv")
    named = materialise(sorted_.mapInArrow(_down, DOWN), "trie-down")
    swept = named.repartition("key").sortWithinPartitions("key", F.col("depth").desc()).mapInArrow(_up, UP)
    nodes = materialise(plain.unionByName(swept), "trie-nodes")
    return _with_heads(nodes, heads, told, ended, seqs, rounds)


def _fewer(convs: DataFrame, seqs: DataFrame) -> bool:
    return seqs.count() < convs.count()


def _with_heads(nodes: DataFrame, heads: DataFrame, told: DataFrame, ended: DataFrame, seqs: DataFrame, rounds: int) -> DataFrame:
    """The containers' nodes and the heads above them, whose sums come from the containers' tops, last round first."""
    spark = nodes.sparkSession
    places = told.select(F.col("key").alias("key_"), "up", "above", "round").dropDuplicates(["key_"])
    tops = nodes.where(F.col("parent").isNull()).join(places, F.col("key") == F.col("key_")).select(
        "key", "up", "above", "round", "conv_id", "depth", "n_leaves", "saved_tokens")
    tops = materialise(tops, "trie-tops")
    sums = spark.createDataFrame([], "key binary, n_leaves long, saved long")
    later = spark.createDataFrame([], "above array<binary>, n_leaves long, saved long")
    own = (F.col("n_convs") - 1) * F.col("size")
    for number in reversed(range(rounds)):
        parts = tops.where(F.col("round") == number).select("above", "n_leaves", F.col("saved_tokens").alias("saved")).unionByName(
            heads.where(F.col("round") == number).select(
                F.concat("above", F.array("key")).alias("above"), F.lit(0).cast("long").alias("n_leaves"), own.alias("saved"))).unionByName(later)
        found = materialise(parts.select(F.explode("above").alias("key"), "n_leaves", "saved").groupBy("key").agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")), "trie-sums")
        # The head that this round began under belongs to an earlier round, and so do the heads above it.
        sums = sums.unionByName(found)
        begun = heads.where(F.col("round") < number).select(F.col("key").alias("at"), F.col("above").alias("above_"))
        later = found.join(begun, F.col("key") == F.col("at")).select(F.col("above_").alias("above"), "n_leaves", "saved")
    sums = materialise(sums.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")), "trie-sums")
    children = tops.select("up").unionAll(heads.select("up")).groupBy(F.col("up").alias("up_")).agg(F.count(F.lit(1)).alias("n_children"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    root = seqs.agg(F.min("rep").alias("conv"), F.coalesce(F.sum("copies"), F.lit(0)).alias("n_convs"), F.max(F.when(F.col("n") == 0, F.col("ends"))).alias("ends"))
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("depth"), "n_convs", "conv", F.lit(0).cast("long").alias("size"), "ends").where("n_convs > 0")
    ended = ended.join(seqs.select(F.col("rep").alias("rep_"), "ends"), F.col("rep") == F.col("rep_")).select("at", "ends")
    upper = heads.join(ended, F.col("key") == F.col("at"), "left").select("key", "up", "depth", "n_convs", "conv", "size", "ends").unionByName(root)
    upper = materialise(upper, "trie-upper")
    names = upper.select(F.col("key").alias("named"), F.col("conv").alias("parent_conv_id"))
    top_names = tops.select(F.col("key").alias("of"), "up").join(names, F.col("up") == F.col("named"), "left").select("of", "parent_conv_id")
    first = nodes.where(F.col("parent").isNull()).join(top_names, F.col("key") == F.col("of"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    high = upper.join(names, F.col("up") == F.col("named"), "left").join(
        sums.select(F.col("key").alias("s"), "n_leaves", "saved"), F.col("key") == F.col("s"), "left").join(
        children, F.col("key") == F.col("up_"), "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), "ends")
    rest = nodes.where(F.col("parent").isNotNull()).withColumn("parent_conv_id", F.col("parent"))
    result = high.select(*columns).unionByName(first.select(*columns)).unionByName(rest.select(*columns))
    return result.withColumn("ends_sha256", F.coalesce("ends", none)).drop("ends")

