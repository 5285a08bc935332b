"""Batches of edits to forests and networks.

``edges`` frames have ``node`` and ``parent``; ``relations`` have ``source``,
``target``, ``type`` and ``ord`` (0 for the main one); relations of several
sources have ``sources`` and ``main``.  Edits have a ``line``; the result is that
of applying the lines in order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.common import checkpointed
from wordgrove.functions.text import common_prefix_length
from wordgrove.operators.candidates import endings
from wordgrove.operators.forest import below, connected, contracted, intervals, numbered, on_cycles, roots_of, subtree_agg
from wordgrove.operators.linkcut import LinkCut
from wordgrove.operators.resolve import resolve_all


def append_relations(relations: DataFrame, edits: DataFrame) -> DataFrame:
    """Relations with those of edits (``line``, ``source``, ``target``, ``type``) after them.

    The first relation of a target is its main one.  An edit equal to the main one
    is no change; any other is one more relation, also if it is there already.
    """
    main = relations.where("ord = 0").select("target", F.struct("source", "type").alias("_main"))
    had = relations.groupBy("target").agg(F.max("ord").alias("_last"))
    order = Window.partitionBy("target").orderBy("line")
    own = F.struct("source", "type")
    # where a target has no main relation yet, its first edit becomes that
    marked = edits.join(main, "target", "left").withColumn("_main", F.coalesce("_main", F.first(own).over(order))).withColumn("_k", F.row_number().over(order))
    new = marked.join(had, "target", "left").where(~(own == F.col("_main")) | (F.col("_last").isNull() & (F.col("_k") == 1)))
    more = new.select("source", "target", "type", (F.coalesce(F.col("_last"), F.lit(-1)) + F.row_number().over(order)).cast("int").alias("ord"))
    return relations.select("source", "target", "type", F.col("ord").cast("int").alias("ord")).unionByName(more)


def check_arity(edits: DataFrame) -> DataFrame:
    """Edits (``line``, ``type``, ``sources``, ``main``, ``target``) that no relation can be made of, and why."""
    many = F.col("type").isin("Compounding", "Univerbisation")
    problem = (
        F.when(many & (F.size("sources") < 2), "needs two sources")
        .when(~many & (F.size("sources") != 1), "needs one source")
        .when(~F.array_contains("sources", F.col("main")), "main source not among the sources")
        .when(F.array_contains("sources", F.col("target")), "target among the sources")
    )
    return edits.select("line", problem.alias("problem")).where("problem IS NOT NULL")


#: Rows of one task when lines are replayed, but for a single component that has more.
REPLAY_ROWS = 100_000


def _in_buckets(rows: DataFrame, component: str) -> DataFrame:
    """Rows with a ``bucket`` for whole components, so that small ones share a task."""
    buckets = rows.count() // REPLAY_ROWS + 1
    return rows.withColumn("bucket", F.pmod(F.xxhash64(component), F.lit(buckets)))


def _replayed(core: DataFrame, edits: DataFrame, on_cycle: str) -> DataFrame:
    """``node`` and ``parent`` of nodes on or between cycles of old and new edges, after their edits, line by line.

    ``core`` has ``component``, ``node``, ``parent`` and ``up``, the nearest node of
    the core above it: a path between two of them can't change, so it is one step
    here.  ``reject`` leaves an edit out whose node is above the new parent;
    ``detach`` takes the new parent off its own parent first.
    """
    kind = dict(core.dtypes)["node"]
    old = core.select("component", "node", "parent", "up", F.lit(-1).cast("long").alias("line"))
    new = edits.join(core.select("component", "node"), "node").select("component", "node", "parent", F.lit(None).cast(kind).alias("up"), F.col("line").cast("long").alias("line"))

    def replay(rows: pd.DataFrame) -> pd.DataFrame:
        held, lines = rows[rows.line < 0], rows[rows.line >= 0].sort_values("line", kind="stable")
        nodes = held.node.tolist()
        number = {node: i for i, node in enumerate(nodes)}
        parent = [None if pd.isna(p) else p for p in held.parent.tolist()]
        trees = LinkCut(len(nodes))
        linked = [False] * len(nodes)
        for i, up in enumerate(held.up.tolist()):
            if up in number:
                trees.link(i, number[up])
                linked[i] = True

        def take_off(i: int) -> None:
            if linked[i]:
                trees.cut(i)
            linked[i], parent[i] = False, None

        for node, up in zip(lines.node.tolist(), lines.parent.tolist()):
            i, above = number[node], number.get(up)
            if on_cycle == "reject" and parent[i] is not None:
                continue
            if above is not None and trees.is_above(i, above):
                if on_cycle == "reject":
                    continue
                take_off(above)
            take_off(i)
            parent[i] = up
            if above is not None:
                trees.link(i, above)
                linked[i] = True
        return pd.DataFrame({"node": pd.Series(nodes, dtype="object"), "parent": pd.Series(parent, dtype="object")})

    return _in_buckets(old.unionByName(new), "component").groupBy("bucket").applyInPandas(replay, f"node {kind}, parent {kind}")


def _with_edits(edges: DataFrame, chosen: DataFrame, edits: DataFrame, on_cycle: str) -> DataFrame:
    """Edges with the chosen parents; nodes on cycles of old and new edges together have their ``edits`` replayed.

    Without such a cycle no order of the lines can close one on the way, and an edit
    outside of them can't either.  Cycles are looked for between the ends of edits
    only, the paths between these being one step each.
    """
    kind = dict(edges.dtypes)["node"]
    changed = edges.select("node", F.col("parent").alias("_old")).join(chosen.select("node", F.col("parent").alias("_new")).hint("merge"), "node", "left")
    after = changed.select("node", F.coalesce("_new", "_old").alias("parent")).hint("merge")
    # where all parents come before their nodes, or all after them, in the order of ids, there is no cycle: one pass tells
    every = edges.where("parent IS NOT NULL").select("node", "parent").unionByName(edits.select("node", "parent"))
    ordered = every.agg(F.bool_and(F.col("parent") < F.col("node")).alias("before"), F.bool_and(F.col("parent") > F.col("node")).alias("after")).first()
    if ordered.before is not False or ordered.after:
        return after
    ends = edits.select("node").unionByName(edits.select(F.col("parent").alias("node"))).distinct()
    short = checkpointed(contracted(edges, ends)).hint("merge")
    steps = checkpointed(short.where("up IS NOT NULL").select("node", F.col("up").alias("parent")).unionByName(edits.select("node", "parent")).distinct()).hint("merge")
    core = checkpointed(on_cycles(steps)).hint("merge")
    if core.isEmpty():
        return after
    inner = steps.join(core, "node", "left_semi").join(core.select(F.col("node").alias("parent")), "parent", "left_semi")
    label = connected(inner.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    held = short.join(label, "node").join(core.select(F.col("node").alias("up"), F.col("node").alias("_up")), "up", "left").select("component", "node", "parent", F.col("_up").cast(kind).alias("up"))
    replayed = checkpointed(_replayed(checkpointed(held).hint("merge"), edits, on_cycle)).select("node", F.col("parent").alias("_then"), F.lit(True).alias("_core"))
    return after.join(replayed, "node", "left").select("node", F.when(F.col("_core"), F.col("_then")).otherwise(F.col("parent")).alias("parent"))


def check_cycles(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits (``line``, ``parent``, ``node``) whose node is already an ancestor of the parent, or the parent itself.

    A node is an ancestor of those that are numbered after it, depth first, as far
    as its subtree goes; no path is walked.
    """
    places = intervals(edges).hint("merge")
    side = lambda c: places.select(F.col("node").alias(c), *[F.col(x).alias(f"_{c}_{x}") for x in ("tree", "pos", "size")])
    placed = edits.join(side("parent"), "parent", "left").hint("merge").join(side("node"), "node", "left")
    inside = (F.col("_parent_tree") == F.col("_node_tree")) & (F.col("_parent_pos") >= F.col("_node_pos")) & (F.col("_parent_pos") < F.col("_node_pos") + F.col("_node_size"))
    return placed.where((F.col("node") == F.col("parent")) | inside).select("line", "parent", "node")


def replace_parent(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """Nodes hung on new parents, the last line of a node counting; a new parent below its child is detached first.

    A line that hangs a node on itself is no edit.
    """
    lines = edits.where("node <> parent").select("line", "parent", "node")
    last = lines.groupBy("node").agg(F.max_by("parent", "line").alias("parent"))
    return _with_edits(edges, last, lines, "detach")


def fill_parent(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """Roots hung on parents, the first line of a node counting; edits that would close a cycle are left out."""
    free = edits.where("node <> parent").join(edges.where("parent IS NULL").select("node").hint("merge"), "node", "left_semi").select("line", "parent", "node")
    first = free.groupBy("node").agg(F.min_by("parent", "line").alias("parent"))
    return _with_edits(edges, first, free, "reject")


def reverse_edges(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Edges (``line``, ``parent``, ``node``) turned round in the order of lines: the node takes the parent's place and the parent hangs on it.

    A line whose node doesn't hang on the parent when its turn comes does nothing.
    A turn reads and writes the parents of its two nodes only, so lines that share
    no node with another are turned at once; those that do are replayed, all lines
    that hang together through nodes in one task.  Without a ``line``, pairs are
    taken in the order of parent and node.
    """
    kind = dict(edges.dtypes)["node"]
    lines = pairs.select("line", "parent", "node") if "line" in pairs.columns else numbered(pairs.select("parent", "node"), ["parent", "node"], "line")
    lines = checkpointed(lines.where("node <> parent"))
    crowded = lines.select(F.explode(F.array("node", "parent")).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("at")
    by = lambda side: lines.join(crowded.withColumnRenamed("at", side), side, "left_semi").select(*lines.columns)
    shared = checkpointed(by("node").unionByName(by("parent")).distinct())
    own = edges.select("node", F.col("parent").alias("_p"))
    above = edges.select(F.col("node").alias("parent"), F.col("parent").alias("_g"))
    alone = lines.join(shared, ["line", "parent", "node"], "left_anti").join(own, "node").where("_p = parent").join(above, "parent")
    moved = alone.select("node", F.col("_g").alias("_to")).unionByName(alone.select(F.col("parent").alias("node"), F.col("node").alias("_to")))
    if not shared.isEmpty():
        label = connected(shared.select(F.col("node").alias("a"), F.col("parent").alias("b")))
        rows = shared.join(label, "node").join(own, "node", "left").join(above, "parent", "left").select("component", "line", "node", "parent", F.col("_p").alias("own"), F.col("_g").alias("above"))

        def replay(held: pd.DataFrame) -> pd.DataFrame:
            up = dict(zip(held.node, held.own)) | dict(zip(held.parent, held.above))
            up = {node: None if pd.isna(p) else p for node, p in up.items()}
            for row in held.sort_values(["line", "parent", "node"]).itertuples():
                if up[row.node] == row.parent:
                    up[row.node], up[row.parent] = up[row.parent], row.node
            return pd.DataFrame({"node": pd.Series(list(up), dtype="object"), "_to": pd.Series(list(up.values()), dtype="object")})

        moved = moved.unionByName(_in_buckets(checkpointed(rows), "component").groupBy("bucket").applyInPandas(replay, f"node {kind}, _to {kind}"))
    return edges.join(moved.withColumn("_moved", F.lit(True)), "node", "left").select("node", F.when(F.col("_moved"), F.col("_to")).otherwise(F.col("parent")).alias("parent"))


def force_reconnect(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """As ``replace_parent``, the reverse edge being dropped where there is one."""
    back = edits.select(F.col("parent").alias("node"), F.col("node").alias("parent"))
    hit = edges.join(back, ["node", "parent"], "left_semi").select("node", F.lit(True).alias("_hit"))
    freed = edges.join(hit, "node", "left").select("node", F.when(F.col("_hit").isNull(), F.col("parent")).alias("parent"))
    return replace_parent(freed, edits)


def attach_roots(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """The root of each named child's tree hung on the parent, unless both are in one tree; the first line of a root counts."""
    placed = roots_of(edges)
    named = edits.join(placed, "node").join(placed.select(F.col("node").alias("parent"), F.col("root").alias("_other")), "parent").where("root <> _other")
    return fill_parent(edges, named.select("line", "parent", F.col("root").alias("node")))


def insert_intermediate(edges: DataFrame, triples: DataFrame) -> DataFrame:
    """Decisions on ``grandparent``, ``parent``, ``node``: YES hangs both edges where they are free, NO only the lower,
    RECONNECT also where the node hangs elsewhere."""
    lower = triples.select("line", "parent", "node", "decision")
    upper = triples.where("decision <> 'NO'").select("line", F.col("grandparent").alias("parent"), F.col("parent").alias("node"))
    moved = replace_parent(edges, lower.where("decision = 'RECONNECT'").select("line", "parent", "node"))
    return fill_parent(moved, lower.where("decision <> 'RECONNECT'").select("line", "parent", "node").unionByName(upper))


def remove_edges(edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges without the named ones (``parent``, ``node``), and names that aren't edges."""
    hit = pairs.select("node", "parent").distinct().withColumn("_hit", F.lit(True))
    left = edges.join(hit, ["node", "parent"], "left").select("node", F.when(F.col("_hit").isNull(), F.col("parent")).alias("parent"))
    return left, pairs.select("parent", "node").join(edges, ["parent", "node"], "left_anti")


def detach(edges: DataFrame, nodes: DataFrame, side: str = "both") -> DataFrame:
    """Edges without those to the parents, to the children, or to both, of ``nodes``."""
    own = nodes.select("node", F.lit(True).alias("_own"))
    out = edges.join(own, "node", "left").join(nodes.select(F.col("node").alias("parent"), F.lit(True).alias("_up")), "parent", "left")
    cut = {"parents": F.col("_own"), "children": F.col("_up"), "both": F.coalesce("_own", "_up")}[side]
    return out.select("node", F.when(cut.isNull(), F.col("parent")).alias("parent"))


def add_compounds(lexemes: DataFrame, lists: DataFrame, all_required: bool = True) -> DataFrame:
    """Compound relations (``target``, ``sources``, ``main``) from component lists (``ref_id`` = target, ``lemmas``); the last is the head."""
    found = resolve_all(lists, lexemes, at_least=None if all_required else 2).where(F.size("nodes") >= 2)
    return found.select(F.col("ref_id").alias("target"), F.col("nodes").alias("sources"), F.element_at("nodes", -1).alias("main"))


def type_compounds(lists: DataFrame) -> DataFrame:
    """What an entry (``lemma``, ``parents``) makes: one component equal to the word leaves it unmotivated, another one derives it;
    several compound it; a leading ``!`` makes a univerbisation.  Gives ``kind`` and the components."""
    bare = F.regexp_replace("parents", r"^!", "")
    parts = F.split(F.trim(bare), r"\s+")
    kind = (
        F.when((F.size(parts) == 1) & (parts[0] == F.col("lemma")), "Unmotivated")
        .when(F.size(parts) == 1, "Derivation")
        .when(F.startswith("parents", F.lit("!")), "Univerbisation")
        .otherwise("Compounding")
    )
    return lists.select("lemma", kind.alias("kind"), parts.alias("components"))


def add_univerbisations(lexemes: DataFrame, alternatives: DataFrame) -> DataFrame:
    """For each ``target`` (``lemma``) the first alternative (``alt``, ``lemmas``) all of whose words are known; the head shares the longest start with the word."""
    keyed = alternatives.withColumn("ref_id", F.struct("target", "alt"))
    found = resolve_all(keyed.select("ref_id", "lemmas"), lexemes).join(keyed.select("ref_id", "lemma", "lemmas"), "ref_id")
    first = found.groupBy("ref_id.target").agg(F.min(F.struct("ref_id.alt", "lemma", "lemmas", "nodes")).alias("b"))
    each = first.select("target", F.col("b.alt").alias("alt"), F.col("b.lemma").alias("lemma"), F.col("b.nodes").alias("sources"), F.posexplode(F.arrays_zip("b.lemmas", "b.nodes")).alias("place", "z"))
    scored = each.select("target", "alt", "sources", "place", F.col("z.nodes").alias("node"), common_prefix_length(F.col("lemma"), F.col("z.lemmas")).alias("shared"))
    best = scored.groupBy("target", "alt", "sources").agg(F.max(F.struct("shared", (-F.col("place")).alias("p"), "node")).alias("m"))
    return best.select("target", "alt", "sources", F.col("m.node").alias("main"))


def retype_conversions(relations: DataFrame, lexemes: DataFrame) -> DataFrame:
    """Relations of one source whose lemma equals the target's as conversions."""
    side = lambda c: lexemes.select(F.col("node").alias(c), F.col("lemma").alias(f"_{c}"))
    joined = relations.join(side("source"), "source").join(side("target"), "target")
    return joined.withColumn("type", F.when(F.col("_source") == F.col("_target"), "Conversion").otherwise(F.col("type"))).drop("_source", "_target")


class _Variants:
    """Nodes of a forest that become variants of others, one after another.

    A node's children hang in its bag.  When it becomes a variant, its bag goes into
    that of its representative, with all that is in it, so children are lifted
    without being touched one by one; a bag in another one belongs to the owner of
    that one.
    """

    def __init__(self, parents: list, above: list[int]) -> None:
        n = len(parents)
        self.trees = LinkCut(2 * n)
        #: a parent outside, as it is, or the number of a bag
        self.outside: list = [None] * n
        self.bag_of = [-1] * n
        #: the bag that stands over a node in the trees
        self.over = [-1] * n
        self.bags = [n + i for i in range(n)]
        self.within = {n + i: n + i for i in range(n)}
        self.owner = {n + i: i for i in range(n)}
        self.is_variant = [False] * n
        for i in range(n):
            self.trees.link(n + i, i)
        for i, (parent, up) in enumerate(zip(parents, above)):
            if parent is not None:
                self._hang(i, *parent, n + up if up >= 0 else -1)

    def _find(self, bag: int) -> int:
        while self.within[bag] != bag:
            self.within[bag] = bag = self.within[self.within[bag]]
        return bag

    def _hang(self, i: int, outside, bag: int, over: int) -> None:
        self.outside[i], self.bag_of[i], self.over[i] = outside, bag, over
        if over >= 0:
            self.trees.link(i, over)

    def has_parent(self, i: int) -> bool:
        return self.outside[i] is not None or self.bag_of[i] >= 0

    def take_off(self, i: int) -> None:
        if self.over[i] >= 0:
            self.trees.cut(i)
        self.outside[i], self.bag_of[i], self.over[i] = None, -1, -1
        if self.is_variant[i]:
            # what it had stays with its representative
            self.is_variant[i] = False
            self.bags[i] = bag = self.trees.add()
            self.trees.link(bag, i)
            self.within[bag], self.owner[bag] = bag, i

    def merge(self, first: int, variant: int) -> None:
        if self.trees.is_above(variant, first):
            self.take_off(first)
        if self.trees.is_above(first, variant):
            self.take_off(variant)
        if self.has_parent(variant):
            place = self.outside[variant], self.bag_of[variant], self.over[variant]
            self.take_off(variant)
            if not self.has_parent(first):
                self._hang(first, *place)
        bag, lifted = self.bags[first], self.bags[variant]
        self._hang(variant, None, bag, bag)
        self.is_variant[variant] = True
        self.trees.cut(lifted)
        self.trees.link(lifted, bag)
        self.within[self._find(lifted)] = self._find(bag)

    def parent(self, i: int, names: list):
        return names[self.owner[self._find(self.bag_of[i])]] if self.bag_of[i] >= 0 else self.outside[i]


def merge_variants(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets of variants (``set_id``, ``node``, ``seq``) hung on their first node, and their children lifted to it.

    Sets are taken in the order of their ids, members in that of ``seq``.  A
    representative below its variant is taken off its parent first, and so is a
    variant below its representative.  A representative without a parent then takes
    the variant's place.  What hangs on a variant in the end hangs on its
    representative.  Only the members of sets come together, with what lies between
    them as one step, and only those of trees that sets connect.
    """
    kind = dict(edges.dtypes)["node"]
    members = sets.select("set_id", "seq", "node").distinct()
    short = checkpointed(contracted(edges, members.select("node"))).hint("merge")
    placed = checkpointed(members.join(short, "node")).hint("merge")
    first = placed.groupBy("set_id").agg(F.min("root").alias("a"))
    label = connected(placed.join(first, "set_id").select("a", F.col("root").alias("b")).where("a <> b"))
    rows = placed.join(label.select(F.col("node").alias("root"), "component"), "root", "left").withColumn("component", F.coalesce("component", "root"))

    def replay(held: pd.DataFrame) -> pd.DataFrame:
        once = held.drop_duplicates("node")
        names = once.node.tolist()
        number = {name: i for i, name in enumerate(names)}
        n = len(names)
        parents = [None if pd.isna(p) else (None, n + number[p]) if p in number else (p, -1) for p in once.parent.tolist()]
        state = _Variants(parents, [number.get(up, -1) if not pd.isna(up) else -1 for up in once.up.tolist()])
        first_of: dict = {}
        for set_id, node in held.sort_values(["set_id", "seq", "node"])[["set_id", "node"]].itertuples(index=False):
            leading = first_of.setdefault(set_id, number[node])
            if leading != number[node]:
                state.merge(leading, number[node])
        owners = [names[state.owner[state._find(n + i)]] for i in range(n)]
        return pd.DataFrame({c: pd.Series(v, dtype="object") for c, v in (("node", names), ("_to", [state.parent(i, names) for i in range(n)]), ("_owner", owners))})

    done = checkpointed(_in_buckets(checkpointed(rows), "component").groupBy("bucket").applyInPandas(replay, f"node {kind}, _to {kind}, _owner {kind}")).hint("merge")
    lifted = edges.select("node", "parent").join(done.select(F.col("node").alias("parent"), "_owner"), "parent", "left")
    own = done.select("node", "_to", F.lit(True).alias("_member"))
    return lifted.join(own, "node", "left").select("node", F.when(F.col("_member"), F.col("_to")).otherwise(F.coalesce("_owner", "parent")).alias("parent"))


def merge_labelled_variants(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """``node``, ``parent`` and ``label``: variants hung on the first node of their set by edges labelled ``Variant``, their children lifted to it.

    The representative keeps its parent, unless that lies in the subtree of one of
    its variants: then it becomes a root.  A variant of two sets goes with the
    first of them.  Whether a node lies in a subtree is told by their places in
    depth-first order.
    """
    once = sets.groupBy("node").agg(F.min(F.struct("set_id", "seq")).alias("s")).select("node", "s.set_id", "s.seq").hint("merge")
    rep = once.groupBy("set_id").agg(F.min_by("node", "seq").alias("rep"))
    variant = once.join(rep, "set_id").where("node <> rep").select("node", "rep").hint("merge")
    places = checkpointed(intervals(edges)).hint("merge")
    side = lambda c: places.select(F.col("node").alias(c), *[F.col(x).alias(f"_{c}_{x}") for x in ("tree", "pos", "size")])
    inside = (F.col("_rep_tree") == F.col("_node_tree")) & (F.col("_rep_pos") > F.col("_node_pos")) & (F.col("_rep_pos") < F.col("_node_pos") + F.col("_node_size"))
    freed = variant.join(side("node"), "node").join(side("rep"), "rep").where(inside).select(F.col("rep").alias("node")).distinct().withColumn("_freed", F.lit(True)).hint("merge")
    into = lambda c: variant.select(F.col("node").alias(c), F.col("rep").alias(f"_{c}"))
    out = edges.join(into("node"), "node", "left").join(into("parent"), "parent", "left").join(freed, "node", "left")
    up = F.when(F.col("_node").isNotNull(), F.col("_node")).when(F.col("_freed"), None).otherwise(F.coalesce("_parent", "parent"))
    return out.select("node", up.alias("parent"), F.when(F.col("_node").isNotNull(), "Variant").alias("label"))


def parents_from_suffix_codes(lexemes: DataFrame, edges: DataFrame) -> DataFrame:
    """Roots hung on the word that a code in their technical lemma makes of them.

    ``lexemes`` has ``node``, ``seq``, ``lemma`` and ``techlemma``, for instance
    ``word-2_^(*3er)``: three letters off, ``er`` on; ``**`` replaces the whole
    word.  Of the words so called the first with the same homonym number is taken,
    else the first; a word that makes itself is left alone.
    """
    plain, odd = r"_\^?\(\*(\d+)([^)]*)\)", r"_\^.*\(\^[^*]*\*(\*|\d+)([^)]*)\)"
    pattern = F.when(F.col("techlemma").rlike(plain), 1).when(F.col("techlemma").rlike(odd), 2)
    part = lambda i: F.when(pattern == 1, F.regexp_extract("techlemma", plain, i)).when(pattern == 2, F.regexp_extract("techlemma", odd, i))
    bare = F.regexp_replace("techlemma", r"[_`].*$", "")
    number = lambda c: F.regexp_extract(c, r"^.+-(\d+)$", 1)
    off = F.when(part(1) == "*", F.length(bare)).otherwise(part(1).try_cast("int"))
    made = F.concat(F.substring(bare, F.lit(1), F.length(bare) - off), part(2))
    short = lambda c: F.regexp_replace(c, r"^(.+)-\d+$", "$1")
    coded = lexemes.where(pattern.isNotNull()).select("node", F.col("seq").alias("line"), number(bare).alias("_number"), short(made).alias("_lemma"), short(bare).alias("_own")).where("_lemma <> _own")
    known = lexemes.select(F.col("node").alias("parent"), F.col("lemma").alias("_lemma"), F.col("seq").alias("_seq"), number(F.regexp_replace("techlemma", r"[_`].*$", "")).alias("_parent_number"))
    # a code's own number first; of equal ones the first
    rank = F.struct((F.col("_number") != F.col("_parent_number")).alias("other"), "_seq", "parent")
    edits = coded.join(known, "_lemma").where("node <> parent").groupBy("node", "line").agg(F.min(rank)["parent"].alias("parent"))
    return fill_parent(edges, edits.select("line", "parent", "node"))


def parents_from_codes(lexemes: DataFrame, edges: DataFrame, parent_lemma: Column) -> DataFrame:
    """Roots hung on the first node of the lemma that a code in their own names (``parent_lemma`` is an expression over ``lexemes``)."""
    wanted = lexemes.select("node", "seq", parent_lemma.alias("_lemma")).where("_lemma IS NOT NULL")
    first = lexemes.groupBy(F.col("lemma").alias("_lemma")).agg(F.min_by("node", "seq").alias("parent"))
    edits = wanted.join(first, "_lemma").where("node <> parent").select(F.col("seq").alias("line"), "parent", "node")
    return fill_parent(edges, edits)


def add_phantoms(lexemes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of lemmas (``child``, ``parent``) both of which are unique, as edges with a ``fictitious`` parent."""
    only = lexemes.groupBy("lemma").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    side = lambda c: only.select(F.col("lemma").alias(c), F.col("node").alias(f"{c}_node"))
    return pairs.join(side("child"), "child").join(side("parent"), "parent").select(F.col("child_node").alias("node"), F.col("parent_node").alias("parent"), F.lit(True).alias("fictitious"))


def edges_from_solutions(lexemes: DataFrame, lines: DataFrame) -> DataFrame:
    """Edges of ``SOLUTION: a > b`` lines (``value``) whose words are both unique."""
    pattern = r"^SOLUTION:\s*(\S+)\s*>\s*(\S+)\s*$"
    pairs = lines.where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("parent"), F.regexp_extract("value", pattern, 2).alias("child"))
    return add_phantoms(lexemes, pairs).select("node", "parent")


def restructure_clusters(members: DataFrame, patterns: DataFrame) -> DataFrame:
    """Edges within clusters (``cluster``, ``node``, ``lemma``, ``pos``) by pattern pairs (``source_pos``, ``source_suffix``, ``target_pos``, ``target_suffix``, ``drop``)."""
    # members meet patterns by their endings, and each other only under one pattern
    keyed = patterns.select(F.xxhash64("source_pos", "source_suffix", "target_pos", "target_suffix").alias("_pattern"), "*")

    def fitting(side: str, name: str) -> DataFrame:
        wanted = keyed.select("_pattern", "drop", F.col(f"{side}_pos").alias("pos"), F.col(f"{side}_suffix").alias("_ending"), F.length(f"{side}_suffix").alias("_size"))
        return endings(members, "lemma", wanted, 0).join(wanted, ["pos", "_ending", "_size"]).select("cluster", "_pattern", "drop", F.col("node").alias(name))

    # a pair comes out under the least pattern that it fits, so that pairs need no search for copies
    above = fitting("source", "parent").groupBy("cluster", "parent", "drop").agg(F.collect_set("_pattern").alias("_mine")).withColumn("_pattern", F.explode("_mine"))
    under = fitting("target", "node").groupBy("cluster", "node").agg(F.collect_set("_pattern").alias("_theirs")).withColumn("_pattern", F.explode("_theirs"))
    hit = above.join(under, ["cluster", "_pattern"]).where("node <> parent").where(F.array_min(F.array_intersect("_mine", "_theirs")) == F.col("_pattern"))
    return hit.select("cluster", "node", "parent", "drop")


def reconnect_by_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """Children moved from a wrong parent to its other child: rules (``suffix``, ``sibling_suffix``) on words of one family.

    A node that ends in ``suffix`` hangs on the sibling with the same stem and
    ``sibling_suffix``.  Gives ``node`` and the new ``parent``.
    """
    sized = rules.select(F.col("suffix").alias("_ending"), F.length("suffix").alias("_size"), "sibling_suffix")
    cut = endings(nodes.where("parent IS NOT NULL").select("node", "parent", "lemma"), "lemma", sized, 0).join(sized, ["_ending", "_size"])
    wanted = cut.select("node", F.col("parent").alias("_p"), F.concat("_stem", "sibling_suffix").alias("_l"))
    return wanted.join(nodes.select(F.col("node").alias("parent"), F.col("parent").alias("_p"), F.col("lemma").alias("_l")), ["_p", "_l"]).where("node <> parent").groupBy("node").agg(F.min("parent").alias("parent"))


def apply_confirmed(instances: DataFrame, confirmed: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Rule instances (``source``, ``target``, ``rule``) whose rule is confirmed, without rejected pairs."""
    kept = instances.join(confirmed.select("rule").distinct(), "rule", "left_semi")
    return kept if rejected is None else kept.join(rejected.select("source", "target"), ["source", "target"], "left_anti")


def edges_from_brackets(lines: DataFrame, known: DataFrame | None = None, bridge: bool = True) -> DataFrame:
    """Edges of nested trees ``a ( b c ( d ) )`` (``line``, ``value``): ``line``, ``place``, ``lemma`` and ``parent_lemma``.

    The parent is the last word one level up.  With ``known`` (``lemma``), words
    that aren't known are left out; their children hang on the nearest known
    ancestor with ``bridge``, and on nothing without.
    """
    tokens = F.filter(F.split(F.regexp_replace("value", r"([()])", " $1 "), r"\s+"), lambda t: t != "")
    empty = F.array().cast("array<struct<place:int,word:string>>")
    # the path holds, for each level, the last word on it; what stands on a level is dropped when a word comes on it or above
    start = F.struct(F.lit(0).alias("depth"), empty.alias("path"), F.array().cast("array<struct<word:string,above:array<struct<place:int,word:string>>>>").alias("out"))

    def walk(acc: Column, t: Column) -> Column:
        depth = F.when(t == "(", acc["depth"] + 1).when(t == ")", F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"]).cast("int")
        bracket = t.isin("(", ")")
        above = F.filter(acc["path"], lambda x: x["place"] < acc["depth"])
        path = F.when(bracket, acc["path"]).otherwise(F.concat(above, F.array(F.struct(acc["depth"].alias("place"), t.alias("word")))))
        out = F.when(bracket, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(t.alias("word"), above.alias("above")))))
        return F.struct(depth.alias("depth"), path.alias("path"), out.alias("out"))

    words = lines.select("line", F.posexplode(F.aggregate(tokens, start, walk, lambda a: a["out"])).alias("place", "w")).select("line", "place", F.col("w.word").alias("lemma"), F.col("w.above").alias("above"))
    if known is None:
        return words.select("line", "place", "lemma", F.try_element_at("above", F.lit(-1))["word"].alias("parent_lemma"))
    listed = known.select("lemma").distinct()
    kept = words.join(listed, "lemma", "left_semi").select("line", "place", "lemma", F.size("above").alias("n"), F.posexplode_outer("above").alias("level", "a"))
    met = kept.join(listed.select(F.col("lemma").alias("_l"), F.lit(True).alias("_there")), F.col("a.word") == F.col("_l"), "left")
    nearest = F.col("_there") if bridge else F.col("_there") & (F.col("level") == F.col("n") - 1)
    return met.groupBy("line", "place", "lemma").agg(F.max(F.when(nearest, F.struct("level", F.col("a.word").alias("word"))))["word"].alias("parent_lemma"))


def single_parent(relations: DataFrame) -> DataFrame:
    """Main relations only, the other sources of each target listed in ``omitted``."""
    rest = relations.where("ord > 0").groupBy("target").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "source"))), lambda x: x["source"].cast("string")), ",").alias("omitted"))
    return relations.where("ord = 0").drop("ord").join(rest, "target", "left").withColumn("omitted", F.coalesce("omitted", F.lit("")))


def label_edges(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels (``line``, ``parent``, ``child`` lemmas, ``label``) on edges: each line takes the next edge of that pair, in order of nodes."""
    up = nodes.select(F.col("node").alias("parent"), F.col("lemma").alias("_p"))
    edges = nodes.select("node", "parent", F.col("lemma").alias("_c")).join(up, "parent")
    edges = edges.withColumn("_k", F.row_number().over(Window.partitionBy("_p", "_c").orderBy("node")))
    wanted = labels.withColumn("_k", F.row_number().over(Window.partitionBy("parent", "child").orderBy("line"))).select(F.col("parent").alias("_p"), F.col("child").alias("_c"), "_k", "label")
    return edges.join(wanted, ["_p", "_c", "_k"]).select("node", "parent", "label")


def add_nodes(lexemes: DataFrame, new: DataFrame) -> DataFrame:
    """Lemmas with parts of speech of ``new`` that aren't there, once each."""
    return new.select("lemma", "pos").distinct().join(lexemes.select("lemma", "pos"), ["lemma", "pos"], "left_anti")


def delete_nodes(nodes: DataFrame, doomed: DataFrame, cascade: bool = True) -> tuple[DataFrame, DataFrame]:
    """Nodes without ``doomed``, whose children become roots; and, unless ``cascade``, those that can't go as they have relations."""
    gone = doomed.select("node").distinct()
    kids = nodes.join(gone.withColumnRenamed("node", "parent"), "parent", "left_semi")
    tied = gone.join(kids.select(F.col("parent").alias("node")).unionByName(nodes.where("parent IS NOT NULL").select("node")).distinct(), "node", "left_semi")
    refused = tied.limit(0) if cascade else tied
    if not cascade:
        gone = gone.join(tied, "node", "left_anti")
    left = nodes.join(gone, "node", "left_anti")
    freed = left.join(gone.select(F.col("node").alias("parent"), F.lit(True).alias("_gone")), "parent", "left")
    return freed.withColumn("parent", F.when(F.col("_gone").isNull(), F.col("parent"))).select(*nodes.columns), refused


def delete_subtrees(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes without those below, and at, ``tops``."""
    return nodes.join(below(nodes.select("node", "parent"), tops), "node", "left_anti")


def prune_unattested(nodes: DataFrame) -> DataFrame:
    """Nodes with an attested node (``n`` above 0 or null) in their subtree."""
    flags = nodes.select("node", (F.col("n").isNull() | (F.col("n") > 0)).alias("attested"))
    kept = subtree_agg(nodes.select("node", "parent"), flags, maxima=("attested",)).where("attested")
    return nodes.join(kept, "node", "left_semi")
