"""Subtree totals of a forest by centroid decomposition, in rounds over all rows and then piece by piece."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import saved, ship
from rosterflow.llm.turns import looked_up

# Nodes of a component that one task may finish.
PIECE = 8_192

# Depths of one member that are looked up together.
BLOCK_BITS = 12

TOP = ["top_depth", "top_1", "top_2"]
CENTROID = ["at_depth", "at_1", "at_2"]


def subtree_totals(nodes: DataFrame, path: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """``nodes`` with each of ``values`` summed over the node's subtree, itself included.

    A node is (``depth``, ``key_1``, ``key_2``), its parent (``depth`` - 1, ``parent_1``, ``parent_2``).
    ``member`` is a path through the node, ``path`` has the nodes of each member's path by depth,
    with their parents, and ``weight`` is a positive weight of every node summed over its subtree.

    The nodes heavier than half of their component form one path from its top; the deepest is the centroid. Taking it
    out splits the component into the centroid's child subtrees and the rest, each of at most half the
    weight, so rounds grow with the logarithm of the weight, however deep or wide the forest is. The
    centroid's total is added to it and along the path to the top, which also lose its weight; members'
    paths tell the child under which a node lies. All components are split at once. Those
    of at most ``piece`` nodes are finished in the same way by one task each.
    """
    ship(nodes.sparkSession)
    own, names = [f"own_{v}" for v in values], nodes.columns
    state = nodes.select("*", *[F.col(v).alias(o) for v, o in zip(values, own, strict=True)])
    # One component to begin with, below the only node of the least depth; parents that are no nodes make tops.
    state = state.withColumns({TOP[0]: F.lit(0).cast("long"), TOP[1]: F.lit(0).cast("long"), TOP[2]: F.lit(0).cast("long")})
    resting: list[DataFrame] = []
    kept = state.columns
    while True:
        total = state.count()
        sizes = state.groupBy(*TOP).agg(F.count(F.lit(1)).alias("_n"), F.max("weight").alias("_whole"))
        sizes = sizes.withColumn("_size", F.col("_n"))
        if sizes.filter(F.col("_n") > piece).isEmpty():
            resting.append(state)
            break
        known = saved(looked_up(state, sizes, TOP, "_n", total))
        resting.append(known.filter(F.col("_size") <= piece).select(kept))
        live = known.filter(F.col("_size") > piece).withColumn("_heavy", 2 * F.col("weight") > F.col("_whole"))
        deepest = F.max_by(F.struct("depth", "key_1", "key_2"), "depth")
        centroids = live.filter("_heavy").groupBy(*TOP).agg(deepest.alias("_at"), F.max("_size").alias("_n"))
        centroids = centroids.select(*TOP, "_n", *[F.col("_at")[k].alias(c) for k, c in zip(("depth", "key_1", "key_2"), CENTROID, strict=True)])
        live = looked_up(live, centroids, TOP, "_n", total).withColumn("_block", F.shiftright("depth", BLOCK_BITS))
        asked = live.filter(F.col("depth") > F.col("at_depth")).select("member", "_block", *CENTROID).distinct()
        below = path.select("member", F.col("depth").alias("_child_depth"), F.col("parent_1").alias("at_1"), F.col("parent_2").alias("at_2"),
                            F.col("key_1").alias("_child_1"), F.col("key_2").alias("_child_2"))
        under = asked.withColumn("_child_depth", F.col("at_depth") + 1).join(below, ["member", "_child_depth", "at_1", "at_2"])
        on = ["member", "_block", *CENTROID]
        live = live.join(under.select(*on, "_child_1", "_child_2"), on, "left")
        # Above the centroid's depth nothing lies under it, although its block may.
        live = saved(
            live.withColumns(
                {
                    "_is": F.expr("depth = at_depth AND key_1 = at_1 AND key_2 = at_2"),
                    "_under": (F.col("depth") > F.col("at_depth")) & F.col("_child_1").isNotNull(),
                    "_child_depth": F.col("at_depth") + 1,
                }
            )
        )
        cut = live.filter("_is OR _under").groupBy(*CENTROID).agg(
            *[F.sum(o).alias(f"_sum_{o}") for o in own], F.max("weight").alias("_cut"), F.max("_size").alias("_n")
        )
        # Only the path to the top needs the totals; other rows ask for nothing.
        path_only = {c: F.when(F.col("_heavy"), F.col(c)).alias(c) for c in CENTROID}
        live = looked_up(live.withColumns(path_only), cut, CENTROID, "_n", total)
        raised = {
            v: F.when(F.col("_is"), F.col(v) + F.col(f"_sum_{o}") - F.col(o)).when(F.col("_heavy"), F.col(v) + F.col(f"_sum_{o}")).otherwise(F.col(v))
            for v, o in zip(values, own, strict=True)
        }
        moved = {
            "weight": F.when(F.col("_heavy") & ~F.col("_is"), F.col("weight") - F.col("_cut")).otherwise(F.col("weight")),
            TOP[0]: F.when(F.col("_under"), F.col("_child_depth")).otherwise(F.col(TOP[0])),
            TOP[1]: F.when(F.col("_under"), F.col("_child_1")).otherwise(F.col(TOP[1])),
            TOP[2]: F.when(F.col("_under"), F.col("_child_2")).otherwise(F.col(TOP[2])),
        }
        live = live.withColumns({**raised, **moved})
        split = saved(live.select(*kept, "_is"))
        # A centroid is finished: a component of its own, of one node.
        done = {t: F.col(k) for t, k in zip(TOP, ("depth", "key_1", "key_2"), strict=True)}
        resting.append(split.filter("_is").select(kept).withColumns(done))
        state = split.filter("NOT _is").select(kept)
    finished = reduce(DataFrame.union, resting)
    schema = finished.select(names).schema

    def finish(component: pa.Table) -> pa.Table:
        return finish_component(component, names, values)

    return finished.groupBy(*TOP).applyInArrow(finish, schema)


def finish_component(component: pa.Table, names: list[str], values: list[str]) -> pa.Table:
    """The nodes of one component with their totals, by recursive splits at weighted centroids."""
    component = component.sort_by("depth")
    columns = {n: component.column(n).to_pylist() for n in ("depth", "key_1", "key_2", "parent_1", "parent_2", "weight")}
    at = {key: i for i, key in enumerate(zip(columns["depth"], columns["key_1"], columns["key_2"], strict=True))}
    parents = zip(columns["depth"], columns["parent_1"], columns["parent_2"], strict=True)
    parent = [at.get((depth - 1, one, two), -1) for depth, one, two in parents]
    weight = columns["weight"]
    own = [component.column(f"own_{v}").to_pylist() for v in values]
    totals = [component.column(v).to_pylist() for v in values]
    part = [0] * len(parent)
    waiting = [list(range(len(parent)))]
    while waiting:
        nodes = waiting.pop()
        if len(nodes) < 2:
            continue
        heavy = [i for i in nodes if 2 * weight[i] > weight[nodes[0]]]
        centre, cut = heavy[-1], weight[heavy[-1]]
        parts: dict[int, list[int]] = {}
        for i in nodes:
            if i == centre:
                part[i] = -1
                continue
            above = parent[i]
            part[i] = i if i == nodes[0] or above == centre else part[above]
            parts.setdefault(part[i], []).append(i)
        for mine, total in zip(own, totals, strict=True):
            below = sum(mine[i] for top, rows in parts.items() if top != nodes[0] for i in rows)
            total[centre] += below
            for i in heavy[:-1]:
                total[i] += below + mine[centre]
        for i in heavy[:-1]:
            weight[i] -= cut
        waiting.extend(parts.values())
    done = {v: total for v, total in zip(values, totals, strict=True)}
    return pa.table({n: pa.array(done[n], pa.int64()) if n in done else component.column(n) for n in names})
