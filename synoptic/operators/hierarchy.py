"""Problem 5: parent-child links to full hierarchies.

`links` makes (child, parent) pairs from references stated by the child or by the parent. `hierarchy` turns them into
one row per node with root, depth, path, Euler interval and number of descendants:

1. Loops. Leaves are peeled off 2^i layers at a time: the map f^(2^i) from each node to its ancestor 2^i steps up is
   joined with itself; nodes whose way up has ended leave it, and its image is what is left after peeling 2^i layers.
   When no more nodes leave, all that remain lead into a loop; when the image no longer shrinks, it is the loops.
   So a chain of a million links takes twenty rounds, not a million.
2. Euler tour. Each link gives a down arc and an up arc; each arc names the next one. Siblings are chained within
   buckets, and the buckets of a parent are chained by a table of at most SIBLING_BUCKETS rows a parent, so a parent
   with a third of all children is never one task's work.
3. List ranking. Runs of arcs are contracted: a random independent set of arcs is taken out round after round (each
   predecessor inherits its length), until at most BASE_ARCS are left, which one task ranks; then the arcs come back in
   reverse order. Work falls geometrically, whatever the shape of the trees.
4. Entry and exit ranks give intervals: depth is the running balance, descendants are (exit - entry - 1) / 2 and the
   ancestors of a node are the intervals around it. Paths are read off in entry order by tasks that each take blocks of
   the tour: every block starts from the intervals that are open at its first rank.

`ways` gives root, depth and path alone, by doubling of the ways up.

Nulls: a null id or reference makes no link. A node with several parents keeps the smallest parent id. Links to itself are
dropped. Repeated rows count once. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synoptic.runtime import Scratch

SIBLING_BUCKETS = 256
#: A tour of at most so many arcs is ranked by one task (under 100 MB).
BASE_ARCS = 200_000
#: Ranks of a tour whose paths one task reads off.
BLOCK = 100_000
#: Levels of whose nodes the paths are kept, and characters of paths that go out at once.
SHALLOW, PART_CHARS = 128, 1 << 25


def clean_reference(ref: Column) -> Column:
    """Lower case, without blanks around it and without a version suffix ::n.n"""
    return F.lower(F.regexp_replace(ref, r"^[\s\p{Z}]+|(?:[\s\p{Z}]*::\d+(?:\.\d+)*)?[\s\p{Z}]*\z", ""))


def links(nodes: DataFrame, extra: DataFrame, node_id: str, name: str, parent_ref: str, child_refs: str) -> DataFrame:
    """(child, parent): from `parent_ref` of the child and `child_refs` of the parent. `extra` (node_id, name) are
    further nodes that references may mean. A name that several nodes bear means the smallest id."""
    named = nodes.select(F.col(node_id).alias("id"), clean_reference(F.col(name)).alias("ref")).union(extra.select(F.col(node_id).alias("id"), clean_reference(F.col(name)).alias("ref")))
    names = named.where("id is not null and ref is not null").groupBy("ref").agg(F.min("id").alias("id"))
    up = nodes.select(F.col(node_id).alias("own"), clean_reference(F.col(parent_ref)).alias("ref"), F.lit(True).alias("up"))
    down = nodes.select(F.col(node_id).alias("own"), F.explode(child_refs).alias("r")).select("own", clean_reference(F.col("r")).alias("ref"), F.lit(False).alias("up"))
    stated = up.union(down).where("own is not null and ref is not null and ref <> ''").distinct()
    meant = stated.join(names, "ref").where("own <> id")
    pairs = meant.select(F.when(F.col("up"), F.col("own")).otherwise(F.col("id")).alias("child"), F.when(F.col("up"), F.col("id")).otherwise(F.col("own")).alias("parent"))
    return pairs.groupBy("child").agg(F.min("parent").alias("parent"))


def peel(pairs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(nodes on or below a loop, nodes on a loop), both as (id), from (child, parent)."""
    jump = scratch.write(pairs.select(F.col("child").alias("v"), F.col("parent").alias("up")))
    left, image = jump.count(), -1
    while left:
        step = jump.select(F.col("v").alias("up"), F.col("up").alias("up2"))
        after = scratch.write(jump.join(step, "up").select("v", F.col("up2").alias("up")))
        counts = after.agg(F.count("*"), F.count_distinct("up")).first()
        scratch.drop(jump)
        jump, before, shown = after, left, image
        left, image = counts
        if left == before and image == shown:
            break
    return jump.select(F.col("v").alias("id")), jump.select(F.col("up").alias("id")).distinct()


def tour(tree: DataFrame) -> DataFrame:
    """(arc, next, w): of each link of a forest the arc 2*child (down, w=1) and 2*child+1 (up, w=-1), and the arc that
    follows; next is null at the end of a tree's tour."""
    bucketed = tree.withColumn("b", F.pmod(F.xxhash64("child"), F.lit(SIBLING_BUCKETS)))
    within = Window.partitionBy("parent", "b").orderBy("child")
    chained = bucketed.withColumn("sib", F.lead("child").over(within))
    buckets = bucketed.groupBy("parent", "b").agg(F.min("child").alias("head"))
    across = Window.partitionBy("parent").orderBy("b")
    buckets = buckets.withColumn("next_head", F.lead("head").over(across)).withColumn("first", F.first("head").over(across))
    sib = chained.join(buckets, ["parent", "b"]).select("child", "parent", F.coalesce("sib", "next_head").alias("sib"))
    firsts = buckets.where("head = first").select(F.col("parent").alias("child"), F.col("first").alias("kid"))
    has_parent = tree.select(F.col("child").alias("parent"), F.lit(True).alias("inner"))
    full = sib.join(firsts, "child", "left").join(has_parent, "parent", "left")
    down = full.select((F.col("child") * 2).alias("arc"), F.coalesce(F.col("kid") * 2, F.col("child") * 2 + 1).alias("next"), F.lit(1).alias("w"))
    up = full.select((F.col("child") * 2 + 1).alias("arc"), F.coalesce(F.col("sib") * 2, F.when(F.col("inner"), F.col("parent") * 2 + 1)).alias("next"), F.lit(-1).alias("w"))
    return down.union(up)


def rank_lists(arcs: DataFrame, scratch: Scratch, base: int = BASE_ARCS) -> DataFrame:
    """(arc, pos, bal, last) from linked lists (arc, next, w): the number of arcs that follow and their sum of w, each
    with the arc itself, and the last arc of its list (which names the list)."""
    live = scratch.write(arcs.select("arc", "next", F.lit(1).cast("bigint").alias("n"), F.col("w").cast("bigint").alias("s")))
    removed: list[DataFrame] = []
    size, turn = live.count(), 0
    while size > base:
        coin = lambda c, t=turn: F.pmod(F.xxhash64(c, F.lit(t)), F.lit(2)) == 0
        # An arc goes if its coin shows heads and its predecessor's tails; the predecessor takes over its reach.
        # A list's last arc stays, as it names the list.
        heads = live.where(coin(F.col("arc")) & F.col("next").isNotNull()).select(F.col("arc").alias("next"), F.col("next").alias("next2"), F.col("n").alias("n2"), F.col("s").alias("s2"))
        joined = live.where(~coin(F.col("arc"))).join(heads, "next", "left").withColumn("takes", F.col("n2").isNotNull())
        kept = joined.select("arc", F.when(F.col("takes"), F.col("next2")).otherwise(F.col("next")).alias("next"), (F.col("n") + F.coalesce(F.col("n2"), F.lit(0))).alias("n"), (F.col("s") + F.coalesce(F.col("s2"), F.lit(0))).alias("s"), F.when(F.col("takes"), F.col("next")).alias("gone"))
        kept = scratch.write(kept)
        gone = kept.where("gone is not null").select(F.col("gone").alias("arc"))
        heads_full = live.where(coin(F.col("arc")))
        out = scratch.write(heads_full.join(gone, "arc"))
        rest = heads_full.join(gone, "arc", "left_anti")
        after = scratch.write(kept.select("arc", "next", "n", "s").union(rest.select("arc", "next", "n", "s")))
        scratch.drop(live, kept)
        removed.append(out)
        live, size, turn = after, after.count(), turn + 1
    # An arc without a next names itself: a null would turn the column into floats.
    ranked = scratch.write(live.withColumn("next", F.coalesce("next", "arc")).coalesce(1).mapInPandas(_rank_base, "arc bigint, pos bigint, bal bigint, last bigint"))
    scratch.drop(live)
    for out in reversed(removed):
        ahead = ranked.select(F.col("arc").alias("next"), F.col("pos").alias("p2"), F.col("bal").alias("b2"), F.col("last").alias("l2"))
        back = out.join(ahead, "next").select("arc", (F.col("n") + F.col("p2")).alias("pos"), (F.col("s") + F.col("b2")).alias("bal"), F.col("l2").alias("last"))
        after = scratch.write(ranked.union(back))
        scratch.drop(ranked, out)
        ranked = after
    return ranked


def _rank_base(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pointer jumping over at most BASE_ARCS arcs."""
    df = pd.concat(list(batches) or [pd.DataFrame({"arc": [], "next": [], "n": [], "s": []})])
    arc = df["arc"].to_numpy(np.int64)
    order = np.argsort(arc)
    arc, pos, bal = arc[order], df["n"].to_numpy(np.int64)[order], df["s"].to_numpy(np.int64)[order]
    to = np.searchsorted(arc, df["next"].to_numpy(np.int64)[order])
    end = to == np.arange(len(arc))
    pos2, bal2 = np.where(end, 0, pos), np.where(end, 0, bal)
    while len(to) and (to[to] != to).any():
        pos2, bal2, to = pos2 + pos2[to], bal2 + bal2[to], to[to]
    yield pd.DataFrame({"arc": arc, "pos": pos2 + pos[to], "bal": bal2 + bal[to], "last": arc[to]})


def intervals(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root, entry, exit, depth) of every node of the forest (child, parent) that has a parent. entry and exit count
    from the start of the root's tour (a root has entry 0)."""
    ranked = rank_lists(tour(tree), scratch)
    # All arcs of one root end with the up arc of its last child; that child's parent is the root.
    ends = ranked.where("arc = last").select("last", F.shiftright("arc", 1).alias("child")).join(tree, "child").select("last", F.col("parent").alias("root"))
    total = ranked.groupBy("last").agg(F.max("pos").alias("total")).join(ends, "last")
    by_node = ranked.groupBy(F.shiftright("arc", 1).alias("id")).agg(F.max("pos").alias("p_in"), F.min("pos").alias("p_out"), F.min("bal").alias("bal_up"), F.max("last").alias("last"))
    # bal counts from the arc to the end: the up arc of a node at depth d has -d.
    return by_node.join(total, "last").select("id", "root", (F.col("total") - F.col("p_in") + 1).alias("entry"), (F.col("total") - F.col("p_out") + 1).alias("exit"), (-F.col("bal_up")).alias("depth"))


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (root, block, mark first, entry). The stack holds the nodes whose intervals are open; whole paths are
    kept for its first levels only, so that memory grows with the depth and not with its square, and results go out in
    parts of bounded size."""
    here, stack, names, prefix = None, [], [], []
    for df in batches:
        at, out, size = [], [], 0
        columns = [df[c].tolist() for c in ("root", "block", "mark", "id", "entry", "exit")]

        def part(at: list[int], out: list[str], df: pd.DataFrame = df) -> pd.DataFrame:
            own = df.iloc[at]
            return pd.DataFrame({"node_id": own["id"].to_numpy(), "root_id": own["root"].to_numpy(), "depth": own["depth"].to_numpy(), "path": out, "entry": own["entry"].to_numpy(), "exit": own["exit"].to_numpy()})

        for row, (root, block, mark, node, entry, leave) in enumerate(zip(*columns, strict=True)):
            if (root, block) != here:
                here, stack, names, prefix = (root, block), [], [], [str(root)]
            while stack and stack[-1] < entry:
                stack.pop()
                names.pop()
                if len(stack) < SHALLOW:
                    prefix.pop()
            name = str(node)
            deep = names[SHALLOW:] if len(names) > SHALLOW else []
            if len(stack) < SHALLOW:
                path = f"{prefix[-1]}/{name}"
                prefix.append(path)
            elif not mark:
                path = "/".join([prefix[SHALLOW], *deep, name])
            stack.append(leave)
            names.append(name)
            if not mark:
                at.append(row)
                out.append(path)
                size += len(path)
                if size > PART_CHARS:
                    yield part(at, out)
                    at, out, size = [], [], 0
        yield part(at, out)


def paths(spans: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds to (id, root, entry, exit, depth) the path of ids from the root.

    Each tour is cut into blocks of ranks. A node whose interval reaches into later blocks is sent to each of them as a
    mark, so that a block knows what is open at its start: (blocks x depth) rows in all, and no block needs another.
    """
    first, last = F.floor(F.col("entry") / block), F.floor(F.col("exit") / block)
    own = spans.withColumn("block", first).withColumn("mark", F.lit(False))
    marks = spans.where(first < last).withColumn("block", F.explode(F.sequence(first + 1, last))).where(F.col("exit") > F.col("block") * block).withColumn("mark", F.lit(True))
    rows = own.union(marks).repartition("root", "block").sortWithinPartitions("root", "block", F.desc("mark"), "entry")
    return rows.mapInPandas(_paths, "node_id bigint, root_id bigint, depth bigint, path string, entry bigint, exit bigint")


def hierarchy(pairs: DataFrame, name: str = "hierarchy") -> DataFrame:
    """(node_id, root_id, depth, path, entry, exit, n_descendants) of every node with a parent. A node on a loop or
    below one has root_id -1, depth -1, an empty path and null entry, exit and n_descendants."""
    scratch = Scratch(pairs.sparkSession, name)
    pairs = scratch.write(pairs)
    lost, _ = peel(pairs, scratch)
    lost = scratch.write(lost)
    tree = scratch.write(pairs.join(lost.select(F.col("id").alias("child")), "child", "left_anti"))
    spans = scratch.write(intervals(tree, scratch))
    good = paths(spans).withColumn("n_descendants", F.expr("cast((exit - entry - 1) / 2 as bigint)"))
    bad = lost.select(F.col("id").alias("node_id"), F.lit(-1).cast("bigint").alias("root_id"), F.lit(-1).cast("bigint").alias("depth"), F.lit("").alias("path"), *[F.lit(None).cast("bigint").alias(c) for c in ("entry", "exit", "n_descendants")])
    return good.unionByName(bad)


def ways(pairs: DataFrame, name: str = "ways") -> DataFrame:
    """(node_id, root_id, depth, path) as `hierarchy` has them, without its tours.

    Only parents that have a parent themselves can be on a loop or have a way that several nodes share, so loops are peeled
    and ways are doubled among them alone; every node then takes its parent's. A way doubles by joining the way of the node
    where it ends so far, as often as the depth can be halved; no way gets longer than the result has it."""
    scratch = Scratch(pairs.sparkSession, name)
    pairs = scratch.write(pairs)
    inner = scratch.write(pairs.join(pairs.select(F.col("parent").alias("child")).distinct(), "child", "left_semi"))
    lost, _ = peel(inner, scratch)
    lost = scratch.write(lost)
    # (v, up, way): the ids from below `up` to v. `done` are those where `up` is a root.
    start = inner.join(lost.select(F.col("id").alias("child")), "child", "left_anti")
    above = inner.select(F.col("child").alias("parent"), F.lit(True).alias("more"))
    live = scratch.write(start.join(above, "parent", "left").select(F.col("child").alias("v"), F.col("parent").alias("up"), F.col("child").cast("string").alias("way"), F.coalesce("more", F.lit(False)).alias("more")))
    scratch.drop(inner)
    done: list[DataFrame] = []
    while not live.isEmpty():
        known = live
        for part in done:
            known = known.unionByName(part)
        done.append(live.where("not more"))
        step = known.select(F.col("v").alias("up"), F.col("up").alias("up2"), F.col("way").alias("way2"), F.col("more").alias("more2"))
        live = scratch.write(live.where("more").join(step, "up").select("v", F.col("up2").alias("up"), F.concat_ws("/", "way2", "way").alias("way"), F.col("more2").alias("more")))
    whole = lost.select(F.col("id").alias("parent"), F.lit(-1).cast("bigint").alias("root"), F.lit(None).cast("string").alias("way"), F.lit(True).alias("bad"))
    for part in done:
        whole = whole.unionByName(part.select(F.col("v").alias("parent"), F.col("up").alias("root"), F.concat_ws("/", F.col("up").cast("string"), "way").alias("way"), F.lit(False).alias("bad")))
    # A parent without a parent is a root: its way is itself.
    out = pairs.join(whole, "parent", "left").withColumn("root", F.coalesce("root", "parent"))
    path = F.when(F.col("bad"), "").otherwise(F.concat_ws("/", F.coalesce("way", F.col("parent").cast("string")), F.col("child").cast("string")))
    out = out.select(F.col("child").alias("node_id"), F.col("root").alias("root_id"), path.alias("path"))
    depth = F.when(F.col("path") == "", -1).otherwise(F.length("path") - F.length(F.replace("path", F.lit("/"))))
    return out.select("node_id", "root_id", depth.cast("bigint").alias("depth"), "path")


def loops(pairs: DataFrame, name: str = "loops") -> DataFrame:
    """(node_id, loop_id): the nodes on loops; loop_id is the smallest id on the loop, found by doubling along it."""
    scratch = Scratch(pairs.sparkSession, name)
    pairs = scratch.write(pairs)
    _, on = peel(pairs, scratch)
    ring = scratch.write(pairs.join(on.select(F.col("id").alias("child")), "child").select("child", "parent", F.least("child", "parent").alias("low")))
    size = ring.count()
    reach = 1
    while size and reach < size:
        ahead = ring.select(F.col("child").alias("parent"), F.col("parent").alias("p2"), F.col("low").alias("l2"))
        after = scratch.write(ring.join(ahead, "parent").select("child", F.col("p2").alias("parent"), F.least("low", "l2").alias("low")))
        changed = after.join(ring.select("child", F.col("low").alias("was")), "child").where("low <> was").limit(1).count()
        scratch.drop(ring)
        ring, reach = after, reach * 2
        if not changed:
            break
    return ring.select(F.col("child").alias("node_id"), F.col("low").alias("loop_id"))


def descendants(nodes: DataFrame) -> DataFrame:
    """(node_id, descendant_id, distance) from a result of `hierarchy`: as many rows as the nodes have ancestors."""
    steps = nodes.where("depth > 0").select(F.col("node_id").alias("descendant_id"), "depth", F.posexplode(F.split("path", "/")).alias("at", "a"))
    return steps.where("at < depth").select(F.col("a").cast("bigint").alias("node_id"), "descendant_id", (F.col("depth") - F.col("at")).alias("distance"))
