"""Connected components of a graph that is a table of edges.

Each round hooks every node to the neighbour (or itself) that comes first in an
order of the round, and replaces nodes by what they are hooked to, so the edges
shrink from round to round. Orders take turns: by id, in which stars around a
smallest node vanish at once, and at random, in which a chain loses most of its
nodes whatever their ids; so the rounds grow with the logarithm of the input. Edges and hooks are written
to the shared folder after each round, so a lost executor costs one round at most.
Nothing but whether edges are left reaches the driver.
"""

from pyspark.sql import functions as F

from visitlog.session import stage


def _round(edges, number):
    """``(node, hook)`` of each node of the edges."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionAll(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))

    def ranked(name):
        rank = F.xxhash64(name, F.lit(number)) if number % 2 else F.lit(0).cast("long")
        return F.struct(rank.alias("rank"), F.col(name).alias("node"))

    return both.groupBy("node").agg(F.least(F.min(ranked("other")), ranked("node"))["node"].alias("hook"))


def connected_components(edges, a="a", b="b"):
    """``(node, component)`` for each node of an edge; a component is named by its
    smallest node. No edges give no rows; loops and repeated edges do no harm."""
    left = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct(), "edges")
    rounds = []
    while not left.isEmpty():
        hooks = stage(_round(left, len(rounds)), "hooks")
        rounds.append(hooks)
        of_a = hooks.select(F.col("node").alias("a"), F.col("hook").alias("hook_a"))
        of_b = hooks.select(F.col("node").alias("b"), F.col("hook").alias("hook_b"))
        met = left.join(of_a, "a").join(of_b, "b").filter("hook_a != hook_b")
        left = stage(
            met.select(F.least("hook_a", "hook_b").alias("a"), F.greatest("hook_a", "hook_b").alias("b")).distinct(),
            "edges",
        )
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0]
    for hooks in rounds[1:]:
        later = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("later"))
        found = found.join(later, "hook", "left").select("node", F.coalesce("later", "hook").alias("hook"))
    found = stage(found, "hooks")
    least = found.groupBy("hook").agg(F.min("node").alias("component"))
    return stage(found.join(least, "hook").select("node", "component"), "components")
