"""Prefix trie of conversations, from ternary search trees of range shards.

A node is a distinct sequence of first turns. Conversations are cut into segments of `SEGMENT` turns, so no
row holds a whole long one; equal segments with equal beginnings are counted as one row. Segments are
ordered by where they begin and by their turns, dealt in ranges, and each shard of a range becomes a
ternary search tree over numbers that stand for its turns, filled with the median of every stretch first,
so that it is balanced. An iterative walk gives each node its members, leaves and savings.

A node can stand in several shards only if it lies on the path of a shard's first or last sequence. Those
nodes, and the paths down to where segments of several conversations go on, are boundary nodes: their parts
are summed over the shards, and what lies below them is added up along the chain of ancestors by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm.batches import trimmed
from specloom.llm.joins import broadcast_if_small, row_key
from specloom.operators import scan
from specloom.session import stable

# Turns of a segment, and turns of a shard's tree; they bound the memory of a task.
SEGMENT = 256
SHARD_TURNS = 200_000
# Characters of ids that are joined in one row before the digest of a node's ends.
PIECE = 1 << 16

_NODE = "depth bigint, p1 bigint, p2 bigint, up1 bigint, up2 bigint, size bigint, n bigint, conv bigint, kids bigint, leaves bigint, saved bigint, boundary boolean, parent_conv bigint, tail boolean"
_ID = ["depth", "p1", "p2"]


class TernaryTree:
    """Ternary search tree: `low` and `high` lead to other turns at the same depth, `equal` one turn
    deeper. `up` is the node one turn above, `at` the place of a turn that the node stands for."""

    def __init__(self) -> None:
        self.code: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.equal: list[int] = []
        self.up: list[int] = []
        self.at: list[int] = []

    def add(self, codes: list[int], begin: int, end: int) -> int:
        """Inserts codes[begin:end]; its last node, -1 for an empty sequence."""
        code, low, high, equal = self.code, self.low, self.high, self.equal
        above, node = -1, 0 if code else -1
        for place in range(begin, end):
            c = codes[place]
            beside = -1
            while node >= 0 and code[node] != c:
                beside = node
                node = low[node] if c < code[node] else high[node]
            if node < 0:
                node = len(code)
                code.append(c)
                low.append(-1)
                high.append(-1)
                equal.append(-1)
                self.up.append(above)
                self.at.append(place)
                if beside >= 0:
                    (low if c < code[beside] else high)[beside] = node
                elif above >= 0:
                    equal[above] = node
            above, node = node, equal[node]
        return above

    def walk(self) -> list[int]:
        """All nodes, each after the one above it."""
        order, stack = [], [0] if self.code else []
        while stack:
            node = stack.pop()
            order.append(node)
            stack += [x for x in (self.low[node], self.high[node], self.equal[node]) if x >= 0]
        return order


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the median of each stretch before its halves."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            stack += [(middle + 1, b), (a, middle)]


def shard_nodes(group: dict, lists: dict[str, list]) -> dict[str, list]:
    """Node rows (columns of _NODE) of the sequences of one beginning: `group` holds its depth and key, and
    of each sequence, in order, begin and end in `lists`, members, smallest member, whether one
    conversation goes on alone after it, and whether several do."""
    tree = TernaryTree()
    rows = group["rows"]
    ends = [0] * len(rows)
    for i in medians(len(rows)):
        ends[i] = tree.add(lists["code"], rows[i][0], rows[i][1])
    total = len(tree.code)
    # One more place, -1, is the node at which all of them begin.
    n, kids, leaves, saved = ([0] * (total + 1) for _ in range(4))
    conv: list = [None] * (total + 1)
    tail, open_ = [False] * (total + 1), [False] * (total + 1)
    for i, (_, _, members, smallest, alone, several) in enumerate(rows):
        v = ends[i]
        n[v] += members
        conv[v] = smallest if conv[v] is None else min(conv[v], smallest)
        if alone:
            kids[v], leaves[v], tail[v] = 1, 1, True
        if several or i in (0, len(rows) - 1):
            while v >= 0 and not open_[v]:
                open_[v] = True
                v = tree.up[v]
    open_[-1] = True
    order = tree.walk()
    size, up = lists["size"], tree.up
    for v in reversed(order):
        u = up[v]
        n[u] += n[v]
        conv[u] = conv[v] if conv[u] is None else min(conv[u], conv[v])
        if not open_[v]:
            leaves[v] = leaves[v] or 1
            saved[v] += (n[v] - 1) * size[tree.at[v]]
            kids[u] += 1
            leaves[u] += leaves[v]
            saved[u] += saved[v]
    start, begins = group["depth"], group["depth"] > 0
    depth = [start] * (total + 1)
    for v in order:
        depth[v] = depth[up[v]] + 1
    at = tree.at
    above = [at[up[v]] if up[v] >= 0 else -1 for v in order]
    key = (group["p1"], group["p2"])
    out = {
        "depth": [depth[v] for v in order],
        "p1": [lists["p1"][at[v]] for v in order],
        "p2": [lists["p2"][at[v]] for v in order],
        "up1": [lists["p1"][a] if a >= 0 else key[0] for a in above],
        "up2": [lists["p2"][a] if a >= 0 else key[1] for a in above],
        "size": [size[at[v]] for v in order],
        "n": [n[v] for v in order],
        "conv": [conv[v] for v in order],
        "kids": [kids[v] for v in order],
        "leaves": [leaves[v] for v in order],
        "saved": [saved[v] for v in order],
        "boundary": [open_[v] for v in order],
        "parent_conv": [None if open_[up[v]] else conv[up[v]] for v in order],
        "tail": [tail[v] for v in order],
    }
    # The beginning itself; its members are counted one segment further up, but for the root.
    first = (start, *key, None, None, 0, 0 if begins else n[-1], None if begins else conv[-1], kids[-1], leaves[-1], saved[-1], True, None, tail[-1])
    for name, value in zip(out, first, strict=True):
        out[name].append(value)
    return out


def _shards(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _NODE.split(", ")]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in _NODE.split(", ")]

    def built(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        flat = {}
        turns = rows["turns"].combine_chunks()
        inner = turns.flatten()
        for field in ("t1", "t2", "size", "p1", "p2"):
            flat[field] = inner.field(field).to_numpy(zero_copy_only=False)
        pairs = np.stack([flat["t1"], flat["t2"]], axis=1) if len(inner) else np.zeros((0, 2), dtype=np.int64)
        lists = {k: flat[k].tolist() for k in ("size", "p1", "p2")}
        lists["code"] = np.unique(pairs, axis=0, return_inverse=True)[1].ravel().tolist()
        stop = np.cumsum(turns.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        out: dict[str, list] = {c: [] for c in names}
        group: dict = {}
        columns = [rows[c].to_pylist() for c in ("depth", "s1", "s2", "n", "conv", "more")]
        for i, (depth, s1, s2, n, conv, more) in enumerate(zip(*columns, strict=True)):
            if group and (group["depth"], group["p1"], group["p2"]) != (depth, s1, s2):
                for c, values in shard_nodes(group, lists).items():
                    out[c] += values
                group = {}
            group = group or {"depth": depth, "p1": s1, "p2": s2, "rows": []}
            group["rows"].append((stop[i - 1] if i else 0, stop[i], n, conv, more == 1, more > 1))
        for c, values in shard_nodes(group, lists).items():
            out[c] += values
        return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(names, types, strict=True)], names)

    held, turns = [], 0
    for batch in trimmed(batches):
        at = 0
        sizes = np.cumsum(np.append(0, batch.column("turns").value_lengths().to_numpy(zero_copy_only=False)) + 1)
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + shard_turns - turns, side="right")) - 1)
            to = min(to, batch.num_rows)
            held.append(batch.slice(at, to - at))
            turns += int(sizes[to] - sizes[at])
            at = to
            if turns >= shard_turns:
                yield built(held)
                held, turns = [], 0
    if held and sum(p.num_rows for p in held):
        yield built(held)


def number_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, size) of rows (conv_id, turn, role, text): the position of each turn from 0 in
    the order of `turn` (null first), role and text, a key of its role and text, and the UTF-8 bytes of its
    text. Null roles and texts count as empty; rows without conv_id are left out. A conversation with more
    turns than `specloom.hotRows` is numbered range by range."""
    turns = rows.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = scan.run(turns, ["conv_id"], ["turn", "role", "text"], {"pos": scan.position()})
    t1, t2 = row_key(F.col("role"), F.col("text"))
    return placed.select("conv_id", F.col("pos").cast("bigint").alias("pos"), t1.alias("t1"), t2.alias("t2"), F.octet_length("text").cast("bigint").alias("size"))


def _node_id(depth: Column, p1: Column, p2: Column) -> Column:
    return F.struct(depth.alias("depth"), p1.alias("p1"), p2.alias("p2"))


def _segments(turns: DataFrame, members: DataFrame, segment: int) -> DataFrame:
    """(conv_id, depth, s1, s2, turns, e1, e2, more): the segments of each conversation with the keys of
    their first and last node; a conversation without turns has one empty segment."""
    # The key of a node is the sum over its turns of a hash of position and turn; 44 bits each leave room
    # for the sums, two of them tell the nodes apart.
    worth = {f"v{i}": F.shiftright(F.xxhash64(F.lit(i), "pos", "t1", "t2"), 20) for i in (1, 2)}
    keyed = scan.run(turns.withColumns(worth), ["conv_id"], ["pos"], {f"p{i}": scan.running_sum(F.col(f"v{i}")) for i in (1, 2)})
    parts = keyed.groupBy("conv_id", F.expr(f"pos div {segment}").alias("part")).agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "size", "p1", "p2", "v1", "v2"))).alias("all"))
    first, last = F.col("all")[0], F.element_at("all", -1)
    cut = parts.select(
        "conv_id",
        (F.col("part") * segment).alias("depth"),
        *[(first[f"p{i}"] - first[f"v{i}"]).alias(f"s{i}") for i in (1, 2)],
        F.transform("all", lambda t: F.struct(t["t1"].alias("t1"), t["t2"].alias("t2"), t["size"].alias("size"), t["p1"].alias("p1"), t["p2"].alias("p2"))).alias("turns"),
        *[last[f"p{i}"].alias(f"e{i}") for i in (1, 2)],
    ).join(members, "conv_id")
    cut = cut.withColumn("more", F.col("turns_in_all") > F.col("depth") + F.size("turns")).drop("turns_in_all")
    zero = F.lit(0).cast("bigint")
    none = F.expr("cast(array() as array<struct<t1:bigint,t2:bigint,size:bigint,p1:bigint,p2:bigint>>)")
    bare = members.where("turns_in_all = 0").select("conv_id", *[zero.alias(c) for c in ("depth", "s1", "s2")], none.alias("turns"), zero.alias("e1"), zero.alias("e2"), F.lit(False).alias("more"))
    return cut.select(*bare.columns).unionByName(bare)


def _totals(nodes: DataFrame) -> DataFrame:
    """(id, leaves, saved) summed over each node and all below it, of (id, up, leaves, saved)."""
    now = stable(nodes.select("id", "up", "leaves", "saved"))
    while not now.where("up is not null").isEmpty():
        below = now.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = now.select(F.col("id").alias("up"), F.col("up").alias("next"))
        step = now.join(below, "id", "left").join(further, "up", "left")
        now = stable(step.select("id", F.col("next").alias("up"), *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]))
    return now.drop("up")


def _ends(ends: DataFrame) -> DataFrame:
    """(id, n_ends, ends_sha256): the digest of the ids of the members that end at a node, in order and
    joined by commas. Ids are joined range by range, so a node at which very many end reaches the task that
    computes its digest as a few long strings, one at a time."""
    kind = "id struct<depth:bigint,p1:bigint,p2:bigint>"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, firsts, texts, size = [], [], [], 0
            for i, c in zip(batch.column(0).to_pylist(), map(str, batch.column(1).to_pylist()), strict=True):
                if not ids or ids[-1] != i or size >= PIECE:
                    ids.append(i)
                    firsts.append(int(c))
                    texts.append([])
                    size = 0
                texts[-1].append(c)
                size += len(c) + 1
            columns = [pa.array(ids, batch.schema.field(0).type), pa.array(firsts, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([",".join(t) for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "first", "n", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, now, count, state = None, None, 0, None
        names = ["id", "n_ends", "ends_sha256"]

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), pa.string()), strict=True)], names)

        for batch in batches:
            id_type, done = batch.schema.field(0).type, []
            for i, n, ids in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "ids")), strict=True):
                if i != now:
                    if state is not None:
                        done.append((now, count, state.hexdigest()))
                    now, count, state = i, 0, hashlib.sha256()
                else:
                    state.update(b",")
                count += n
                state.update(ids.encode())
            yield rows(done)
        if state is not None:
            yield rows([(now, count, state.hexdigest())])

    order = ["id", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, f"{kind}, first bigint, n bigint, ids string")
    return pieces.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digest, f"{kind}, n_ends bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie: `conv_id` (smallest member), `depth`, `parent_conv_id` (null for
    the root), `n_convs`, `n_children`, `n_leaves` (childless nodes of the subtree), `saved_tokens` (over
    the subtree, members but one times the bytes of the last text), `n_ends` and `ends_sha256` (members
    that end here).

    `turns` has (conv_id, pos, t1, t2, size) as of `number_turns`, positions without gaps from 0; `members`
    (conv_id, turns_in_all) all conversations, also those without turns, which end at the root. No members,
    no rows. Turns and nodes are told apart by 128 and 88 bits of hashes.
    """
    cut = stable(_segments(turns, members, segment))
    folded = cut.groupBy("depth", "s1", "s2", "e1", "e2", F.size("turns").alias("n_turns")).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"), F.count_if("more").alias("more"), F.first("turns").alias("turns"))
    folded = stable(folded)
    tails = None
    if not folded.where("depth > 0").isEmpty():
        # A beginning that one conversation has alone needs no tree: its nodes form a chain.
        alone = folded.where("depth > 0").groupBy("depth", "s1", "s2").agg(F.sum("n").alias("held")).where("held = 1").drop("held")
        alone = broadcast_if_small(stable(alone))
        tails = folded.join(alone, ["depth", "s1", "s2"], "left_semi")
        folded = folded.join(alone, ["depth", "s1", "s2"], "left_anti")

    order = ["depth", "s1", "s2", "turns"]
    dealt = folded.select(*order, "n", "conv", "more").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stable(dealt.mapInArrow(lambda batches: _shards(batches, shard_turns), _NODE))
    own_id, up_id = _node_id(*map(F.col, _ID)), _node_id(F.col("depth") - 1, F.col("up1"), F.col("up2"))
    inner = rows.where("not boundary").select(own_id.alias("id"), up_id.alias("up"), "n", "conv", "kids", "leaves", "saved", "parent_conv", "tail")

    parts = rows.where("boundary").groupBy(*_ID).agg(*[F.max(c).alias(c) for c in ("up1", "up2", "size", "tail")], *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")], F.min("conv").alias("conv"))
    merged = stable(parts.select(own_id.alias("id"), F.when(F.col("up1").isNotNull(), up_id).alias("up"), "size", "n", "conv", "kids", "leaves", "saved", "tail"))
    below = merged.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("below"))
    merged = merged.join(below, "id", "left").withColumn("kids", F.col("kids") + F.coalesce("below", F.lit(0)))
    merged = merged.withColumn("leaves", F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves"))).withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("size"))
    totals = _totals(merged)
    edge = merged.drop("leaves", "saved", "below", "size").join(totals, "id")
    names = stable(edge.select("id", "up", "n", "conv", "kids", "leaves", "saved", "tail"))

    known = broadcast_if_small(names.select(F.col("id").alias("up"), F.col("conv").alias("above")))
    nodes = [x.join(known, "up", "left") for x in (inner, names.withColumn("parent_conv", F.lit(None).cast("bigint")))]
    columns = ["id", F.coalesce("parent_conv", "above").alias("parent_conv"), "n", "conv", "kids", "leaves", "saved"]
    every = [x.select(*columns) for x in nodes]
    if tails is not None:
        each = tails.select("depth", "s1", "s2", "conv", "more", F.size("turns").alias("size"), F.posexplode("turns").alias("i", "t"))
        chain = each.select(_node_id(F.col("depth") + F.col("i") + 1, F.col("t.p1"), F.col("t.p2")).alias("id"), _node_id(F.col("depth"), F.col("s1"), F.col("s2")).alias("up"), "conv", F.when((F.col("i") == F.col("size") - 1) & (F.col("more") == 0), 0).otherwise(1).cast("bigint").alias("kids"), "i")
        joints = inner.where("tail").select("id", "conv").unionByName(names.where("tail").select("id", "conv")).select(F.col("id").alias("up"), F.col("conv").alias("above"))
        # Only the first node of a tail can have a parent with other members.
        begun = chain.where("i = 0").join(joints, "up", "left").select("id", F.coalesce("above", "conv").alias("parent_conv"), "conv", "kids")
        chain = begun.unionByName(chain.where("i > 0").select("id", F.col("conv").alias("parent_conv"), "conv", "kids"))
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        every.append(chain.select("id", "parent_conv", one.alias("n"), "conv", "kids", one.alias("leaves"), zero.alias("saved")))

    ends = cut.where("not more").select(_node_id(F.col("depth") + F.size("turns"), F.col("e1"), F.col("e2")).alias("id"), "conv_id")
    done = reduce(DataFrame.unionByName, every).join(_ends(ends), "id", "left")
    return done.select(
        F.col("conv").alias("conv_id"),
        F.col("id.depth").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("n_ends", F.lit(0).cast("bigint")).alias("n_ends"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
