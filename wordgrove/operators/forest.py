"""Roots, depths, closures and other questions on forests of parent pointers.

``edges`` frames have ``node`` and ``parent`` (null at roots).  Loops keep their
state with ``checkpoint()`` and stop when a round changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.common import checkpointed, written

#: Pointer doubling reaches 2**MAX_ROUNDS generations.
MAX_ROUNDS = 40
#: Parts of a reached set that are held apart before they are put together.
REACHED_PARTS = 8


def _doubled(edges: DataFrame) -> tuple[DataFrame, int]:
    """``node``, ``up`` (the farthest ancestor found) and ``hops`` after pointer doubling; and how many rows still moved.

    A parent that isn't a node itself counts as none.
    """
    nodes = edges.select("node").hint("merge")
    known = edges.join(nodes.select(F.col("node").alias("parent")), "parent", "left_semi").hint("merge")
    state = nodes.join(known.select("node", "parent"), "node", "left").select(
        "node", F.coalesce("parent", "node").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("hops")
    )
    state = checkpointed(state).hint("merge")
    limit = max(1, state.count()).bit_length() + 1
    moved = 1
    for _ in range(min(limit, MAX_ROUNDS)):
        upper = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"))
        state = checkpointed(state.join(upper, "up").select("node", F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), (F.col("more") > 0).alias("moved"))).hint("merge")
        moved = state.where("moved").count()
        state = state.drop("moved")
        if not moved:
            break
    return state, moved


def roots_of(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``.  Nodes on or below a cycle have no root and are left out (see ``find_cycles``)."""
    state, moved = _doubled(edges)
    if moved:
        tops = edges.where("parent IS NULL").select(F.col("node").alias("up"))
        state = state.join(tops, "up", "left_semi")
    return state.select("node", F.col("up").alias("root"))


def depths(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` and ``depth``, 1 at a root; without nodes on or below a cycle."""
    state, moved = _doubled(edges)
    if moved:
        tops = edges.where("parent IS NULL").select(F.col("node").alias("up"))
        state = state.join(tops, "up", "left_semi")
    return state.select("node", F.col("up").alias("root"), (F.col("hops") + 1).alias("depth"))


def find_cycles(edges: DataFrame) -> DataFrame:
    """Nodes that lie on a cycle; an empty frame for a forest."""
    _, moved = _doubled(edges)
    if not moved:
        return edges.select("node").limit(0)
    return on_cycles(edges.where("parent IS NOT NULL").select("node", "parent"))


def on_cycles(pairs: DataFrame) -> DataFrame:
    """Nodes of pairs (``node``, ``parent``), of which a node may have several, on or between cycles.

    By contraction: every round peels off nodes that are nobody's parent or have
    none, and puts one pair in place of each chain of nodes with one pair in and one
    out, whose ends pointer doubling finds.  Chains and trees are gone after
    log rounds, however long; what is left at last, with the chains between what is
    left, lies on or between cycles.
    """
    left = checkpointed(pairs.select("node", "parent").distinct()).hint("merge")
    count, chains, rings = left.count(), [], []
    while count:
        peeled = left.join(left.select(F.col("parent").alias("node")).distinct(), "node", "left_semi").join(left.select(F.col("node").alias("parent")).distinct(), "parent", "left_semi")
        peeled = checkpointed(peeled.select("node", "parent")).hint("merge")
        chain, ring = _chains(peeled)
        inner = chain.select("node").unionByName(ring).hint("merge")
        passed = chain.select(F.col("entry").alias("node"), F.col("exit").alias("parent")).distinct()
        rest = peeled.join(inner, "node", "left_anti").join(inner.select(F.col("node").alias("parent")), "parent", "left_anti").select("node", "parent")
        left = checkpointed(rest.unionByName(passed).distinct()).hint("merge")
        chains.append(chain)
        rings.append(ring)
        now = left.count()
        if now == count:
            break
        count = now
    found = left.select("node").distinct()
    for chain, ring in zip(reversed(chains), reversed(rings)):
        ends = chain.join(found.select(F.col("node").alias("entry")), "entry", "left_semi").join(found.select(F.col("node").alias("exit")), "exit", "left_semi")
        found = checkpointed(found.unionByName(ends.select("node")).unionByName(ring).distinct()).hint("merge")
    return found


def _chains(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with one pair in and one out, with the ``entry`` and ``exit`` of their chain; and those that make up rings by themselves."""
    own = pairs.where("node = parent").select("node").distinct()
    outs = pairs.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.first("parent").alias("exit")).where("_n = 1").drop("_n")
    ins = pairs.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("_n"), F.first("node").alias("entry")).where("_n = 1").drop("_n")
    state = checkpointed(outs.join(ins, "node").join(own, "node", "left_anti").select("node", "entry", "exit", F.lit(True).alias("moved"))).hint("merge")
    limit = state.count().bit_length() + 1
    for _ in range(limit):
        if state.where("moved").isEmpty():
            break
        step = state.select(F.col("node").alias("_at"), F.col("entry").alias("_entry"), F.col("exit").alias("_exit"))
        ahead = state.join(step.select(F.col("_at").alias("exit"), "_exit"), "exit", "left")
        both = ahead.join(step.select(F.col("_at").alias("entry"), "_entry"), "entry", "left")
        state = written(both.select("node", F.coalesce("_entry", "entry").alias("entry"), F.coalesce("_exit", "exit").alias("exit"), (F.col("_entry").isNotNull() | F.col("_exit").isNotNull()).alias("moved")))
    return state.where("NOT moved").drop("moved"), state.where("moved").select("node")


def closure(edges: DataFrame, seeds: DataFrame | None = None, include_self: bool = True) -> DataFrame:
    """``node``, ``ancestor`` and ``dist`` of all pairs upwards from ``seeds`` (a frame of ``node``; all nodes if none).

    Walks a generation at a time; a walk that meets its start again, on a cycle,
    stops there.
    """
    start = edges.select("node") if seeds is None else seeds.select("node").distinct()
    step = edges.where("parent IS NOT NULL").select(F.col("node").alias("ancestor"), "parent")
    front = checkpointed(start.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("dist")))
    found = front
    while True:
        front = checkpointed(front.join(step, "ancestor").select("node", F.col("parent").alias("ancestor"), (F.col("dist") + 1).alias("dist")).where("node <> ancestor"))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found if include_self else found.where("dist > 0")


def descendants(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``ancestor`` (a seed), ``node`` and ``dist`` of everything in the seeds' subtrees, themselves included."""
    step = edges.where("parent IS NOT NULL").select("node", "parent")
    front = checkpointed(seeds.select(F.col("node").alias("ancestor"), F.col("node").alias("node"), F.lit(0).cast("long").alias("dist")).distinct())
    found = front
    while True:
        front = checkpointed(
            front.select("ancestor", F.col("node").alias("parent"), "dist").join(step, "parent").select("ancestor", "node", (F.col("dist") + 1).alias("dist")).where("node <> ancestor")
        )
        if front.isEmpty():
            return found
        found = found.unionByName(front)


def path_fold(edges: DataFrame, values: DataFrame, merge: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """``node`` and columns of ``values`` folded from the root down to each node, itself included.

    ``merge`` names the columns, each with an associative function of the upper and
    the lower part of a path.  By pointer doubling: log2(depth) rounds over all
    nodes, however deep the trees are.  Nodes on or below a cycle are left out; a
    parent that isn't a node counts as none.
    """
    nodes = edges.select("node").hint("merge")
    known = edges.where("parent IS NOT NULL").select("node", F.col("parent").alias("_up")).join(nodes.select(F.col("node").alias("_up")), "_up", "left_semi").hint("merge")
    state = written(nodes.join(known, "node", "left").hint("merge").join(values.select("node", *merge).hint("merge"), "node", "left"))
    left, limit = state.where("_up IS NOT NULL").count(), max(1, state.count()).bit_length() + 1
    for _ in range(limit):
        if not left:
            break
        upper = state.select(F.col("node").alias("_up"), F.col("_up").alias("_next"), F.lit(True).alias("_has"), *[F.col(c).alias(f"_of_{c}") for c in merge])
        folded = state.join(upper, "_up", "left")
        state = written(folded.select("node", F.col("_next").alias("_up"), *[F.when(F.col("_has"), f(F.col(f"_of_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) for c, f in merge.items()]))
        left = state.where("_up IS NOT NULL").count()
    return state.where("_up IS NULL").select("node", *merge)


def contracted(edges: DataFrame, terminals: DataFrame) -> DataFrame:
    """For each of some nodes (``node``): its ``parent``, the nearest of them above it (``up``), and the ``root`` of its tree.

    The paths between them are left out, so what comes of a forest is no larger than
    the list of nodes; by pointer doubling, as in ``path_fold``.
    """
    kind = dict(edges.dtypes)["node"]
    named = terminals.select("node", F.col("node").alias("term")).distinct().hint("merge")
    values = edges.select("node").join(named, "node", "left").select("node", "term", F.col("node").alias("root"))
    above = path_fold(edges, values, {"term": lambda upper, lower: F.coalesce(lower, upper), "root": lambda upper, lower: upper})
    known = edges.select("node", "parent").join(named.select("node"), "node", "left_semi").join(above.select("node", "root"), "node")
    return known.join(above.select(F.col("node").alias("parent"), F.col("term").cast(kind).alias("up")), "parent", "left").select("node", "parent", "up", "root")


def subtree_agg(edges: DataFrame, nodes: DataFrame, sums: tuple[str, ...] = (), maxima: tuple[str, ...] = (), height: str | None = None) -> DataFrame:
    """Sums and greatest values of columns of ``nodes`` (keyed by ``node``) over the subtree of each node, itself included.

    ``height`` names a column for the generations below the node.  What a node has
    gathered from fewer than 2**k generations below it goes to its ancestor 2**k
    above: log2(depth) rounds over all nodes, and no row for each pair of node and
    ancestor.  Nodes on or below a cycle are left out.
    """
    own = edges.select("node").hint("merge")
    known = edges.where("parent IS NOT NULL").select("node", F.col("parent").alias("_up")).join(own.select(F.col("node").alias("_up")), "_up", "left_semi").hint("merge")
    state = own.join(known, "node", "left").hint("merge").join(nodes.select("node", *sums, *maxima).hint("merge"), "node", "left")
    tall = [height] if height else []
    if height:
        state = state.withColumn(height, F.lit(0).cast("long"))
    state = written(state)
    left, limit = state.where("_up IS NOT NULL").count(), max(1, state.count()).bit_length() + 1
    for k in range(limit):
        if not left:
            break
        rising = state.where("_up IS NOT NULL")
        gains = [F.sum(c).alias(f"_of_{c}") for c in sums] + [F.max(c).alias(f"_of_{c}") for c in maxima] + [(F.max(c) + (1 << k)).alias(f"_of_{c}") for c in tall]
        gained = rising.groupBy(F.col("_up").alias("node")).agg(*gains)
        steps = rising.select("node", "_up").join(state.select(F.col("node").alias("_up"), F.col("_up").alias("_next")), "_up").select("node", "_next").hint("merge")
        added = [F.coalesce(F.col(c) + F.col(f"_of_{c}"), F.col(c), F.col(f"_of_{c}")).alias(c) for c in sums]
        higher = [F.greatest(c, f"_of_{c}").alias(c) for c in (*maxima, *tall)]
        state = written(state.drop("_up").join(gained, "node", "left").hint("merge").join(steps, "node", "left").select("node", F.col("_next").alias("_up"), *added, *higher))
        left = state.where("_up IS NOT NULL").count()
    return state.where("_up IS NULL").drop("_up")


def heights(edges: DataFrame, leaf: int = 1) -> DataFrame:
    """``node`` and ``height``: ``leaf`` at a node without children, one more than the highest child elsewhere."""
    return subtree_agg(edges, edges, height="height").select("node", (F.col("height") + leaf).alias("height"))


def below(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``node`` of everything in the subtrees of ``seeds`` (``node``), themselves included."""
    flags = edges.select("node").join(seeds.select("node", F.lit(True).alias("_in")).distinct(), "node", "left")
    return path_fold(edges, flags, {"_in": lambda upper, lower: F.coalesce(upper, lower)}).where("_in").select("node")


def roots(edges: DataFrame) -> DataFrame:
    """Nodes without a parent."""
    return edges.where("parent IS NULL")


def non_roots(edges: DataFrame) -> DataFrame:
    """Nodes with a parent."""
    return edges.where("parent IS NOT NULL")


def leaves(edges: DataFrame) -> DataFrame:
    """Nodes that nobody has as a parent."""
    return edges.join(edges.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")


def singletons(edges: DataFrame) -> DataFrame:
    """Roots without children."""
    return roots(edges).join(edges.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")


def has_ancestor(relations: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of ``nodes`` (``node``), those with an ancestor in ``wanted`` (``node``) over all ``relations`` (``source``, ``target``).

    Reached nodes are told to their targets, each once, however many ways lead to
    it: what is kept is never more than the nodes and the relations.
    """
    down = written(relations.select(F.col("source").alias("node"), "target").distinct())
    front = written(wanted.select("node").distinct())
    reached: list[DataFrame] = []
    while True:
        step = front.join(down, "node").select(F.col("target").alias("node")).distinct()
        for part in reached:
            step = step.join(part, "node", "left_anti")
        # a front comes of all fronts before it: as checkpoints, what is known of their columns would double every round
        front = written(step)
        if front.isEmpty():
            break
        reached.append(front)
        # parts of like size are put together, so that there are few of them
        if len(reached) >= REACHED_PARTS:
            reached = [written(_united(reached))]
    return nodes.join(_united(reached), "node", "left_semi").select("node").distinct() if reached else nodes.select("node").limit(0)


def _united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def intervals(edges: DataFrame) -> DataFrame:
    """``node``, ``tree``, ``pos`` and ``size``: a node is above those of its tree whose ``pos`` lies in the ``size`` places from its own on."""
    return dfs_ids(edges, []).join(subtree_agg(edges, edges.select("node", F.lit(1).cast("long").alias("size")), sums=("size",)), "node")


def dfs_ids(edges: DataFrame, sort_cols: list[str]) -> DataFrame:
    """``node``, ``tree`` and ``pos``: roots numbered in order, and nodes of a tree depth first, siblings in order.

    A node comes after its parent and the subtrees of its earlier siblings, so its
    place is the sum of such offsets down its path.  Siblings are summed up in a
    range-partitioned sort and paths by pointer doubling: neither a wide nor a deep
    tree comes into one task.
    """
    tops = numbered(edges.where("parent IS NULL").select("node", *sort_cols), [*sort_cols, "node"]).select(F.col("node").alias("root"), (F.col("number") - 1).alias("tree"))
    sizes = subtree_agg(edges, edges.select("node", F.lit(1).cast("long").alias("size")), sums=("size",))
    siblings = running_sum(edges.where("parent IS NOT NULL").join(sizes, "node"), ["parent", *sort_cols, "node"], "size", "before")
    first = siblings.groupBy("parent").agg(F.min("before").alias("_first"))
    offsets = siblings.join(first.hint("merge"), "parent").select("node", (F.col("before") - F.col("_first") + 1).alias("pos"), F.lit(None).cast(dict(edges.dtypes)["node"]).alias("root"))
    start = edges.where("parent IS NULL").select("node", F.lit(0).cast("long").alias("pos"), F.col("node").alias("root")).unionByName(offsets)
    placed = path_fold(edges, start, {"pos": lambda upper, lower: upper + lower, "root": lambda upper, lower: F.coalesce(upper, lower)})
    return placed.join(tops, "root").select("node", "tree", "pos").hint("merge")


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Rows with the sum of a column over the rows before them in an order, without bringing them into one task."""
    dealt = checkpointed(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.sum(value).alias("_n"))
    # one row for each partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return dealt.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.coalesce(within, F.lit(0))).cast("long")).drop("_part", "_before").hint("merge")


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Rows with a running number from 1 in an order, without bringing them into one task."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", name).withColumn(name, F.col(name) + 1).drop("_one")


def render_trees(edges: DataFrame, label: str, sort_cols: list[str]) -> DataFrame:
    """``tree``, ``line_no`` and ``text``: every tree drawn with lines, one row for each node."""
    order = dfs_ids(edges, sort_cols)
    ends = edges.where("parent IS NOT NULL").groupBy("parent").agg(F.max(F.struct(*sort_cols, "node"))["node"].alias("_last"))
    drawn = edges.join(ends.hint("merge"), "parent", "left").select("node", "parent", F.col(label).cast("string").alias("label"), (F.col("node") == F.col("_last")).alias("last")).hint("merge")
    stems = path_fold(edges, drawn.select("node", F.when(F.col("last"), "  ").when(~F.col("last"), "│ ").otherwise("").alias("stem")), {"stem": F.concat})
    own = F.when(F.col("parent").isNull(), "").when(F.col("last"), "└─").otherwise("├─")
    lines = drawn.join(stems.select(F.col("node").alias("parent"), "stem"), "parent", "left").select("node", F.concat(F.coalesce("stem", F.lit("")), own, "label").alias("text"))
    return order.join(lines, "node").select("tree", F.col("pos").alias("line_no"), "text")


def signatures(edges: DataFrame, label: str) -> DataFrame:
    """``root`` and ``sig``: the labels of a tree as ``A->(B->(C),D)``, children's signatures sorted.

    By tree contraction.  A node whose children are all known gets its signature and
    tells it to its parent (rake).  Where that gets on slowly, chains of nodes that
    wait for one child each become one node with the levels of them all (compress),
    so that the rounds grow with the logarithm of the nodes.  Nodes on or below a
    cycle are left out.
    """
    kids = edges.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("waits"))
    level = F.struct(F.col(label).cast("string").alias("label"), F.array().cast("array<string>").alias("known"))
    known = edges.where("parent IS NOT NULL").join(edges.select(F.col("node").alias("parent")), "parent", "left_semi").select("node", "parent")
    start = edges.drop("parent").join(known, "node", "left").join(kids, "node", "left").select("node", "parent", F.col("node").alias("top"), F.coalesce("waits", F.lit(0)).alias("waits"), F.array(level).alias("levels"))
    left, done = written(start), []
    count = left.count()
    while count:
        raked = left.where("waits = 0").select("parent", "top", _signature(F.col("levels"), F.lit(None).cast("string")).alias("sig"))
        raked = checkpointed(raked)
        done.append(raked.where("parent IS NULL").select(F.col("top").alias("root"), "sig"))
        told = raked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.collect_list("sig").alias("_sigs"))
        first = F.col("levels")[0]
        bottom = F.struct(first["label"].alias("label"), F.concat(first["known"], F.coalesce("_sigs", F.array().cast("array<string>"))).alias("known"))
        levels = F.concat(F.array(bottom), F.slice("levels", F.lit(2), F.size("levels")))
        left = written(left.where("waits > 0").join(told, "node", "left").select("node", "parent", "top", (F.col("waits") - F.coalesce(F.size("_sigs"), F.lit(0))).alias("waits"), levels.alias("levels")))
        now = left.count()
        if now == count:
            break
        if now * 2 > count:
            left = _compressed(left)
            now = left.count()
        count = now
    return _united(done) if done else edges.select(F.col("node").alias("root"), F.lit("").alias("sig")).limit(0)


def _signature(levels: Column, inner: Column) -> Column:
    """The signature of the top of some levels, the lowest first, above a child of the signature ``inner``, if there is one."""

    def above(below: Column, level: Column) -> Column:
        every = F.when(below.isNull(), level["known"]).otherwise(F.concat(level["known"], F.array(below)))
        return F.when(F.size(every) == 0, level["label"]).otherwise(F.concat(level["label"], F.lit("->("), F.array_join(F.array_sort(every), ","), F.lit(")")))

    return F.aggregate(levels, inner, above)


def _compressed(waiting: DataFrame) -> DataFrame:
    """Chains of nodes that wait for one child each made one: it goes by the name of the lowest, at which the child will ask."""
    single = waiting.where("waits = 1").select("node", "parent")
    inside = single.join(single.select(F.col("node").alias("parent")), "parent", "left_semi").select("node", F.col("parent").alias("_up"))
    placed = depths(single.select("node").join(inside, "node", "left").select("node", F.col("_up").alias("parent")))
    lowest_first = F.sort_array(F.collect_list(F.struct("depth", "levels")), asc=False)
    joined = waiting.join(placed.select("node", F.col("root").alias("_chain"), "depth"), "node").groupBy("_chain").agg(
        F.flatten(F.transform(lowest_first, lambda x: x["levels"])).alias("levels"), F.max_by("node", "depth").alias("node"), F.min_by(F.struct("parent", "top"), "depth").alias("_upper")
    )
    made = joined.select("node", F.col("_upper.parent").alias("parent"), F.col("_upper.top").alias("top"), F.lit(1).alias("waits"), "levels")
    return written(waiting.where("waits <> 1").select(*made.columns).unionByName(made))


def parents_report(lexemes: DataFrame, relations: DataFrame, words: DataFrame, attribute: str) -> DataFrame:
    """For each input ``lemma``: the sorted distinct ``attribute`` of all parents and of the roots; ``ROOT`` without parents."""
    edges = lexemes.select("node").join(relations.where("ord = 0").select(F.col("target").alias("node"), F.col("source").alias("parent")), "node", "left")
    hit = words.select("lemma").distinct().join(lexemes.select("node", "lemma"), "lemma")
    value = lexemes.select(F.col("node").alias("at"), F.col(attribute).cast("string").alias("value"))
    parents = hit.join(relations.select(F.col("target").alias("node"), F.col("source").alias("at")), "node").join(value, "at").groupBy("lemma").agg(F.array_join(F.array_sort(F.collect_set("value")), ",").alias("parents"))
    tops = hit.join(roots_of(edges).withColumnRenamed("root", "at"), "node").join(value, "at").groupBy("lemma").agg(F.array_join(F.array_sort(F.collect_set("value")), ",").alias("roots"))
    return tops.join(parents, "lemma", "left").select("lemma", F.coalesce("parents", F.lit("ROOT")).alias("parents"), "roots")


def propagate(edges: DataFrame, annotations: DataFrame, gate: DataFrame) -> DataFrame:
    """``node`` and ``value``: in each tree the annotation nearest the root (ties: the least value) goes to the root,
    and down to children that ``gate`` (``node``, ``open``) lets through."""
    placed = depths(edges)
    best = placed.join(annotations, "node").groupBy("root").agg(F.min(F.struct("depth", "value"))["value"].alias("value"))
    shut = edges.join(gate.where("open").select("node", F.lit(True).alias("_open")), "node", "left").select("node", (F.col("parent").isNotNull() & F.col("_open").isNull()).alias("shut"))
    reached = path_fold(edges, shut, {"shut": lambda upper, lower: upper | lower}).where("NOT shut")
    return reached.join(placed.select("node", "root"), "node").join(best, "root").select("node", "value")


def lift_marks(edges: DataFrame, marks: DataFrame, word: str | None = None) -> DataFrame:
    """Marks of nodes (``node``) moved up their trees: ``node``, ``moved_to``, ``dropped`` and ``held_by``.

    A mark below another one is dropped.  The others rise to the root, or, with
    ``word`` (a column of ``edges``), stop at the first node on the way whose word
    holds its parent's word: that edge, named by its parent in ``held_by``, may be
    wrong.
    """
    flags = edges.select("node").join(marks.select("node", F.lit(True).alias("_mark")).distinct(), "node", "left").select("node", F.coalesce("_mark", F.lit(False)).alias("mark"))
    up = edges.select("node", "parent").join(flags.select(F.col("node").alias("parent"), F.col("mark").alias("_above")), "parent", "left")
    over = path_fold(edges, up.select("node", F.coalesce("_above", F.lit(False)).alias("under")), {"under": lambda upper, lower: upper | lower})
    if word is None:
        stops = edges.select("node", F.when(F.col("parent").isNull(), F.col("node")).alias("stop"), F.lit(None).cast(dict(edges.dtypes)["parent"]).alias("held_by"))
    else:
        parents = edges.select(F.col("node").alias("parent"), F.col(word).alias("_w"))
        held = F.col("parent").isNotNull() & F.contains(F.col(word), F.col("_w"))
        stops = edges.join(parents, "parent", "left").select("node", F.when(F.col("parent").isNull() | held, F.col("node")).alias("stop"), F.when(held, F.col("parent")).alias("held_by"))
    at = path_fold(edges, stops.select("node", F.when(F.col("stop").isNotNull(), F.struct("stop", "held_by")).alias("to")), {"to": lambda upper, lower: F.coalesce(lower, upper)})
    found = marks.select("node").distinct().join(over, "node").join(at, "node")
    return found.select("node", F.when(~F.col("under"), F.col("to.stop")).alias("moved_to"), F.col("under").alias("dropped"), F.when(~F.col("under"), F.col("to.held_by")).alias("held_by"))


def largest_trees(edges: DataFrame, n: int) -> DataFrame:
    """``root`` and ``size`` of the ``n`` largest trees, ties by root."""
    return roots_of(edges).groupBy("root").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "root").limit(n)


def families_of(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``root`` and ``node`` of all members of trees that hold one of ``nodes``."""
    placed = roots_of(edges)
    touched = placed.join(nodes.select("node"), "node", "left_semi").select("root").distinct()
    return placed.join(touched, "root", "left_semi").select("root", "node")


def families_with(edges: DataFrame, labels: DataFrame, excluded: DataFrame) -> DataFrame:
    """Members (``root``, ``node``, ``label``) of trees with a true label, labels below ``excluded`` nodes being false."""
    out = below(edges, excluded).withColumn("out", F.lit(True))
    placed = roots_of(edges).join(labels, "node", "left").join(out, "node", "left").withColumn("label", F.coalesce("label", F.lit(False)) & F.col("out").isNull())
    kept = placed.groupBy("root").agg(F.max("label").alias("any")).where("any").select("root")
    return placed.join(kept, "root", "left_semi").select("root", "node", "label")


def root_conflicts(edges: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotated nodes (``node``, ``values``) whose root has a set of values neither of which holds the other."""
    placed = annotations.select("node", "values").join(roots_of(edges), "node")
    top = annotations.select(F.col("node").alias("root"), F.col("values").alias("root_values"))
    both = placed.where("node <> root").join(top, "root")
    return both.where((F.size(F.array_except("values", "root_values")) > 0) & (F.size(F.array_except("root_values", "values")) > 0)).select("node", "root")


def connected(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every end of the pairs ``a``, ``b``, by alternating star contractions."""
    edges = checkpointed(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).hint("merge")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m")).hint("merge")
        star = large.join(floor, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = checkpointed(star.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            tops = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops.select("node", F.col("node").alias("component"))).hint("merge")
        before = now
    raise RuntimeError("components haven't settled")
