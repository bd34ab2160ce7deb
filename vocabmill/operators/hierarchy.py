"""Recursion over edges: closure, ancestors, nearest match, climbs, walks and reach, all as joins to a fixpoint.

Rounds are semi-naive: only pairs found in the last round are joined again, and known pairs are taken out by an anti-join, so
cycles end. Each round is written, which keeps plans short. The number of rounds is the depth of the hierarchy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

#: Single steps of a closure before paths double.
STEPS = 6


def closure(isa: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(ancestor, descendant) proper pairs of (child, parent) edges; on a cycle a node is its own ancestor.

    After a few single steps, paths double each round, so a deep chain or a long cycle needs few rounds too.
    """
    step = stored(isa.select("child", "parent").distinct(), "isa")
    known = front = step.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant"))
    depth = 1
    while max_depth is None or depth < max_depth:
        if max_depth is None and depth > STEPS:
            near, far = front.toDF("middle", "low"), known.toDF("high", "middle")
            up = near.join(far, "middle").select(F.col("high").alias("ancestor"), F.col("low").alias("descendant"))
            near, far = known.toDF("middle", "low"), front.toDF("high", "middle")
            up = up.union(near.join(far, "middle").select("high", "low")).distinct()
        else:
            up = front.join(step, front.ancestor == step.child).select(F.col("parent").alias("ancestor"), "descendant").distinct()
        front = stored(up.join(known, ["ancestor", "descendant"], "left_anti"), "closure")
        if front.isEmpty():
            break
        known = known.union(front)
        depth += 1
    return known


def ancestors(seeds: DataFrame, isa: DataFrame, max_depth: int | None = None, include_self: bool = True) -> DataFrame:
    """(start, node) with the least number of steps ``depth``, upwards from the seeds' column ``start``."""
    step = stored(isa.select("child", "parent").distinct(), "isa")
    known = front = stored(seeds.select("start", F.col("start").alias("node"), F.lit(0).alias("depth")).distinct(), "seeds")
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        up = front.join(step, front.node == step.child).select("start", F.col("parent").alias("node")).distinct()
        front = stored(up.join(known, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)), "ancestors")
        if front.isEmpty():
            break
        known = known.union(front)
    return known if include_self else known.where("depth > 0")


def nearest(seeds: DataFrame, isa: DataFrame, qualifies: DataFrame) -> DataFrame:
    """(start, node, depth): for each seed all qualifying ancestors at the fewest steps; a seed stops where it hits."""
    step = stored(isa.select("child", "parent").distinct(), "isa")
    good = stored(qualifies.select(F.col("node")).distinct(), "qualifies")
    front = stored(seeds.select("start", F.col("start").alias("node")).distinct(), "seeds")
    seen, hits, depth = front, [], 0
    while not front.isEmpty():
        depth += 1
        up = front.join(step, front.node == step.child).select("start", F.col("parent").alias("node")).distinct()
        up = stored(up.join(seen, ["start", "node"], "left_anti"), "nearest")
        hit = up.join(good, "node", "left_semi").select("start", "node", F.lit(depth).alias("depth"))
        hits.append(hit)
        front = up.join(hit.select("start").distinct(), "start", "left_anti")
        seen = seen.union(up)
    out = hits[0]
    for h in hits[1:]:
        out = out.union(h)
    return out


def climb(held: DataFrame, edges: DataFrame) -> DataFrame:
    """All edges (child, parent) on paths upwards from the held nodes."""
    step = stored(edges.select("child", "parent").distinct(), "edges")
    front = stored(held.select("node").distinct(), "held")
    seen, taken = front, None
    while True:
        got = stored(step.join(front, step.child == front.node, "left_semi"), "climb")
        taken = got if taken is None else taken.union(got)
        front = stored(got.select(F.col("parent").alias("node")).distinct().join(seen, "node", "left_anti"), "front")
        if front.isEmpty():
            return taken
        seen = seen.union(front)


def steps(edge: DataFrame, follow: list[str], keep_inadmissible: bool = True) -> DataFrame:
    """(source, predicate, target) of the predicates to follow; ``~p`` goes backwards over ``p``."""
    usable = edge.where("state <> 'rejected'" + ("" if keep_inadmissible else " and tier <> 'inadmissible'"))
    s, o = F.concat_ws(":", "s_vocab", "s_code"), F.concat_ws(":", "o_vocab", "o_code")
    forward = [p for p in follow if not p.startswith("~")]
    backward = [p[1:] for p in follow if p.startswith("~")]
    ahead = usable.where(F.col("predicate").isin(forward)).select(s.alias("source"), "predicate", o.alias("target"))
    back = usable.where(F.col("predicate").isin(backward)).select(o.alias("source"), F.concat(F.lit("~"), "predicate").alias("predicate"), s.alias("target"))
    return ahead.union(back)


def walk(edge: DataFrame, start: str, follow: list[str], depth: int) -> DataFrame:
    """(key, depth, via): nodes on simple paths from ``start``, with the least depth and the first path of that length.

    Paths carry the nodes they have visited, so cycles end; ``depth`` bounds the number of joins.
    """
    move = steps(edge, follow)
    spark = edge.sparkSession
    front = spark.createDataFrame([(start, [start], "")], "node string, visited array<string>, via string")
    found = None
    for d in range(1, depth + 1):
        front = front.join(move, front.node == move.source).where(~F.array_contains("visited", F.col("target")))
        via = F.when(F.col("via") == "", F.col("predicate")).otherwise(F.concat("via", F.lit(" > "), "predicate"))
        front = front.select(F.col("target").alias("node"), F.concat("visited", F.array("target")).alias("visited"), via.alias("via"))
        level = front.select(F.col("node").alias("key"), F.lit(d).alias("depth"), "via")
        found = level if found is None else found.union(level)
    return found.groupBy("key").agg(F.min(F.struct("depth", "via")).alias("m")).select("key", F.col("m.depth").alias("depth"), F.col("m.via").alias("via"))


def reach(members: DataFrame, moves: DataFrame, hops: int) -> DataFrame:
    """(member, node, state, hop): breadth-first, with states 0 identity only, 1 classified, 2 by a loose alignment.

    ``moves`` (source, target, kind in id, cls, end). From state 0 all kinds go on, from state 1 only ``cls``, from 2 none.
    """
    move = stored(moves.select("source", "target", "kind").distinct(), "moves")
    seen = front = stored(members.select("member", F.col("member").alias("node"), F.lit(0).alias("state"), F.lit(0).alias("hop")).distinct(), "members")
    for hop in range(1, hops + 1):
        go = front.join(move, front.node == move.source).where("(kind = 'cls' and state in (0, 1)) or (kind in ('id', 'end') and state = 0)")
        state = F.when(F.col("kind") == "end", 2).when((F.col("kind") == "cls") | (F.col("state") == 1), 1).otherwise(0)
        go = go.select("member", F.col("target").alias("node"), state.alias("state"), F.lit(hop).alias("hop")).distinct()
        front = stored(go.join(seen.select("member", "node").distinct(), ["member", "node"], "left_anti"), "reach")
        if front.isEmpty():
            break
        seen = seen.union(front)
    return seen
