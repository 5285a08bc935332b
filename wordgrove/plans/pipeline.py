"""Pipelines of named steps over a network, with a history of what changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.common import checkpointed


@dataclass(frozen=True)
class Network:
    """What steps work on: ``nodes`` (keyed by ``node``, any other columns) and ``relations`` (``target``, ``ord``, ``type``, ``main``, ``sources``)."""

    nodes: DataFrame
    relations: DataFrame

    @property
    def edges(self) -> DataFrame:
        """``node`` and ``parent`` of every node by its main relation."""
        main = self.relations.where("ord = 0").select(F.col("target").alias("node"), F.col("main").alias("parent"))
        return self.nodes.select("node").join(main, "node", "left")

    def with_edges(self, edges: DataFrame) -> Network:
        """The network with other parents: main relations that changed become derivations, those of nodes without a parent go."""
        kept = edges.where("parent IS NOT NULL").select(F.col("node").alias("target"), F.col("parent").alias("_p"))
        own = self.relations.where("ord = 0").join(kept, "target", "full")
        same = F.col("main").eqNullSafe(F.col("_p"))
        main = own.where("_p IS NOT NULL").select("target", F.lit(0).alias("ord"), F.when(same, F.col("type")).otherwise("Derivation").alias("type"), F.col("_p").alias("main"), F.when(same, F.col("sources")).otherwise(F.array("_p")).alias("sources"))
        return replace(self, relations=main.unionByName(self.relations.where("ord > 0").select(*main.columns)))


Step = tuple[str, Callable[[Network], Network]]


@dataclass(frozen=True)
class Run:
    """What a pipeline gives: the network, its history, and the steps that failed."""

    network: Network
    history: DataFrame | None
    failed: tuple[str, ...]


def on_edges(step: Callable[[DataFrame], DataFrame]) -> Callable[[Network], Network]:
    """A step on ``node`` and ``parent`` as a step on a network."""
    return lambda network: network.with_edges(step(network.edges))


def log_changes(before: DataFrame, after: DataFrame, creator: str, version: str, args: str = "") -> DataFrame:
    """What a step has done to the nodes of two frames of edges: ``node``, ``creator``, ``args``, ``version``, ``change``, ``old_parent``, ``new_parent``.

    ``change`` is ``added`` or ``deleted`` for nodes that came or went, with or
    without a parent, and ``connected``, ``moved`` or ``detached`` for others.
    """
    old = before.select("node", F.col("parent").alias("old_parent"), F.lit(True).alias("_was"))
    new = after.select("node", F.col("parent").alias("new_parent"), F.lit(True).alias("_is"))
    change = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "deleted")
        .when(F.col("old_parent").eqNullSafe(F.col("new_parent")), None)
        .when(F.col("old_parent").isNull(), "connected")
        .when(F.col("new_parent").isNull(), "detached")
        .otherwise("moved")
    )
    both = old.join(new, "node", "full").withColumn("change", change).where("change IS NOT NULL")
    return both.select("node", F.lit(creator).alias("creator"), F.lit(args).alias("args"), F.lit(version).alias("version"), "change", "old_parent", "new_parent")


def run(network: Network, steps: list[Step], version: str = "", keep_going: bool = False) -> Run:
    """Applies steps in order; each takes and returns a network, of which it may change nodes and relations.

    The result of each step is computed and kept in the shared folder, so an error
    of its jobs is the step's own.  It ends the run, or, with ``keep_going``, the
    step is passed over and named in ``failed``.
    """
    history, failed = None, []
    for name, step in steps:
        try:
            made = step(network)
            after = Network(checkpointed(made.nodes), checkpointed(made.relations))
        except (ValueError, PySparkException):
            if not keep_going:
                raise
            failed.append(name)
            continue
        log = log_changes(network.edges, after.edges, name, version)
        history = log if history is None else history.unionByName(log)
        network = after
    return Run(network, history, tuple(failed))


def productivity(history: DataFrame) -> DataFrame:
    """How many nodes each creator connected, moved, detached, added and deleted."""
    counts = [F.count_if(F.col("change") == kind).alias(kind) for kind in ("connected", "moved", "detached", "added", "deleted")]
    return history.groupBy("creator").agg(*counts)
