"""Subtree totals of a forest of parent edges, by centroid decomposition.

A component of the forest is split at its centroid, the deepest node whose subtree holds at least
half of the component. What hangs below the centroid and what is left above it are components of
at most half the size, split in turn. Components are then put together again, the last split first:
the totals of the components below a centroid and its own value are its subtree's total, and that
is added along the path from the centroid to the component's top.

Over a whole forest the work is cut as follows. Subtree sizes come from pointers that double their
reach every round. Subtrees of at most ``limit`` nodes below larger ones are components of their own:
each lies in one task and is decomposed there. The totals of their tops go to their parents, and the
larger nodes that are left are decomposed in one task if they are at most ``limit`` too. If not, each
chain of them without a branch is made one node, which leaves at most two nodes per branch end, that
is 2 / ``limit`` of all nodes, and this smaller forest is treated in the same way. So neither a node
with very many children nor a very long path meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.llm.common import Rounds
from roostline.operators.running import running
from roostline.session import staged

# Nodes of a component that one task decomposes at a time.
LIMIT = 16_384


def centroid_totals(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals of a small forest; ``parents`` holds -1 for tops, ``values`` a list per column."""
    n = len(parents)
    children: list[list[int]] = [[] for _ in range(n)]
    tops = []
    for node, parent in enumerate(parents):
        (children[parent] if parent >= 0 else tops).append(node)
    order = list(tops)
    for node in order:
        order.extend(children[node])
    sizes = [1] * n
    for node in reversed(order):
        if parents[node] >= 0:
            sizes[parents[node]] += sizes[node]
    cut = [parent < 0 for parent in parents]
    # Of each component: its centroid, the path from there to its top, and its parts.
    splits: list[tuple[int, list[int], list[int], int]] = []
    waiting = [(top, -1, False) for top in tops]
    while waiting:
        top, whole, below = waiting.pop()
        number = len(splits)
        half = sizes[top]
        path, centroid = [], top
        while True:
            heavy = max((c for c in children[centroid] if not cut[c]), key=sizes.__getitem__, default=-1)
            if heavy < 0 or 2 * sizes[heavy] < half:
                break
            path.append(centroid)
            centroid = heavy
        splits.append((centroid, path, [], -1))
        if whole >= 0:
            mother = splits[whole]
            if below:
                mother[2].append(number)
            else:
                splits[whole] = (*mother[:3], number)
        for child in children[centroid]:
            if not cut[child]:
                cut[child] = True
                waiting.append((child, number, True))
        if path:
            cut[centroid] = True
            for node in path:
                sizes[node] -= sizes[centroid]
            waiting.append((top, number, False))
    result = []
    for column in values:
        totals, whole_of = [0] * n, [0] * len(splits)
        for number in range(len(splits) - 1, -1, -1):
            centroid, path, below, above = splits[number]
            total = column[centroid] + sum(whole_of[b] for b in below)
            totals[centroid] += total
            for node in path:
                totals[node] += total
            whole_of[number] = total + (whole_of[above] if above >= 0 else 0)
        result.append(totals)
    return result


def _in_tasks(forest: DataFrame, names: Sequence[str], limit: int) -> DataFrame:
    """node, top and totals of whole trees, column ``top`` naming the tree of a row."""

    def solve(batches):
        import pandas as pd
        import pyarrow as pa

        def totals(rows: pd.DataFrame) -> pa.RecordBatch:
            place = {node: n for n, node in enumerate(rows["node"])}
            parents = [
                -1 if node == top else place[parent]
                for node, top, parent in zip(rows["node"], rows["top"], rows["parent"])
            ]
            found = centroid_totals(parents, [rows[c].tolist() for c in names])
            columns = {"node": pa.array(rows["node"], pa.binary()), "top": pa.array(rows["top"], pa.binary())}
            return pa.RecordBatch.from_pydict(
                columns | {c: pa.array(t, pa.int64()) for c, t in zip(names, found)}
            )

        held: list[pd.DataFrame] = []
        for batch in batches:
            rows = batch.to_pandas()
            if not len(rows):
                continue
            held.append(rows)
            # Rows come tree by tree: all trees but the last are whole.
            if sum(map(len, held)) >= limit:
                rows = pd.concat(held, ignore_index=True)
                last = (rows["top"] == rows["top"].iloc[-1]).to_numpy()
                if not last.all():
                    yield totals(rows[~last])
                held = [rows[last]]
        if held:
            yield totals(pd.concat(held, ignore_index=True))

    schema = "node binary, top binary, " + ", ".join(f"`{c}` bigint" for c in names)
    rows = forest.select("node", "parent", "top", *names)
    return rows.repartition("top").sortWithinPartitions("top").mapInArrow(solve, schema)


def subtree_sizes(edges: DataFrame) -> DataFrame:
    """(node, size) of a table of (node, parent): the number of nodes of each subtree.

    A node knows its ancestor 2^k steps up and the nodes less than 2^k steps below. Each round adds
    what the nodes that point to it know and doubles the reach, so the rounds are the logarithm
    of the longest path. Counts are combined before they move."""
    rounds = Rounds(edges.sparkSession)
    now = rounds.next(edges.select("node", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("size")), "sizes")
    while now.filter("up IS NOT NULL").limit(1).count():
        below = now.filter("up IS NOT NULL").groupBy("up").agg(F.sum("size").alias("below"))
        above = now.filter("up IS NOT NULL").select(F.col("node").alias("at"), F.col("up").alias("next"))
        now = rounds.next(
            now.join(below.withColumnRenamed("up", "of"), F.col("node") == F.col("of"), "left")
            .join(above, F.col("up") == F.col("at"), "left")
            .select("node", F.col("next").alias("up"), (F.col("size") + F.coalesce("below", F.lit(0))).alias("size")),
            "sizes",
        )
    return now


def highest_reached(links: DataFrame) -> DataFrame:
    """(node, head, steps) of a table of (node, up): the node without ``up`` that its links lead
    to and the number of links, in as many rounds as the logarithm of the longest path."""
    rounds = Rounds(links.sparkSession)
    now = rounds.next(
        links.select(
            "node",
            F.coalesce("up", "node").alias("head"),
            F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("steps"),
            F.col("up").isNull().alias("done"),
        ),
        "heads",
    )
    while now.filter("NOT done").limit(1).count():
        ends = now.select(
            F.col("node").alias("at"), F.col("head").alias("end"), F.col("steps").alias("more"), F.col("done").alias("ended")
        )
        # Ended rows meet nothing and wait.
        now = rounds.next(
            now.join(ends, ~F.col("done") & (F.col("head") == F.col("at")), "left").select(
                "node",
                F.coalesce("end", "head").alias("head"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                (F.col("done") | F.coalesce("ended", F.lit(False))).alias("done"),
            ),
            "heads",
        )
    return now.drop("done")


def subtree_totals(forest: DataFrame, names: Sequence[str], limit: int = LIMIT) -> DataFrame:
    """(node, totals) of a table of (node binary, parent binary or null, whole-number columns
    ``names``). Nodes are unique and not null; a parent is a node; there are no cycles."""
    names = list(names)
    sized = staged(forest.select("node", "parent", *names).join(subtree_sizes(forest), "node"), "forest")[0]
    large = sized.filter(F.col("size") > limit)
    larger = large.select(F.col("node").alias("of"))
    # Of a small node the parent is left out where that is large: it is a top.
    small = (
        sized.filter(F.col("size") <= limit)
        .join(larger, F.col("parent") == F.col("of"), "left")
        .select("node", F.when(F.col("of").isNull(), F.col("parent")).alias("up"))
    )
    tops = highest_reached(small).select("node", F.col("head").alias("top"))
    below = staged(_in_tasks(sized.join(tops, "node"), names, limit), "small-trees")[0]
    result = below.select("node", *names)
    count = large.count()
    if not count:
        return result
    hanging = (
        below.filter("node = top")
        .join(sized.select("node", "parent"), "node")
        .filter("parent IS NOT NULL")
        .groupBy("parent")
        .agg(*[F.sum(c).alias(f"_{c}") for c in names])
        .withColumnRenamed("parent", "of")
    )
    heavy = staged(
        large.join(hanging, F.col("node") == F.col("of"), "left").select(
            "node", "parent", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in names]
        ),
        "large-nodes",
    )[0]
    if count <= limit:
        # At most ``limit`` nodes: one task, in which only nodes without a parent are tops.
        return result.union(_in_one_task(heavy, names))
    return result.union(_without_chains(heavy, names, limit))


def _in_one_task(forest: DataFrame, names: list[str]) -> DataFrame:
    def solve(rows):
        place = {node: n for n, node in enumerate(rows["node"])}
        found = centroid_totals(
            [-1 if p is None else place[p] for p in rows["parent"]], [rows[c].tolist() for c in names]
        )
        return rows[["node"]].assign(**dict(zip(names, map(np.array, found))))

    schema = "node binary, " + ", ".join(f"`{c}` bigint" for c in names)
    return forest.groupBy(F.lit("all")).applyInPandas(solve, schema)


def _without_chains(forest: DataFrame, names: list[str], limit: int) -> DataFrame:
    """Totals of a forest, each chain of nodes with one child made a node of a smaller forest."""
    single = forest.groupBy("parent").count().filter("count = 1").select(F.col("parent").alias("of"))
    links = forest.join(single, F.col("parent") == F.col("of"), "left").select(
        "node", F.when(F.col("of").isNotNull(), F.col("parent")).alias("up")
    )
    placed = forest.join(highest_reached(links), "node")
    sums = {f"_{c}": c for c in names}
    # What lies above a node in its chain, the node included.
    chained = staged(running(placed, [F.col("steps")], ["head"], "_place", sums), "chains")[0]
    heads = chained.filter("node = head").select("node", "parent")
    above = chained.select(F.col("node").alias("of"), F.col("head").alias("up"))
    shorter = (
        heads.join(above, F.col("parent") == F.col("of"), "left")
        .select("node", F.col("up").alias("parent"))
        .join(chained.groupBy(F.col("head").alias("node")).agg(*[F.sum(c).alias(c) for c in names]), "node")
    )
    totals = subtree_totals(staged(shorter, "chain-forest")[0], names, limit)
    of_head = totals.select(F.col("node").alias("of"), *[F.col(c).alias(f"_all_{c}") for c in names])
    return chained.join(of_head, F.col("head") == F.col("of")).select(
        "node", *[(F.col(f"_all_{c}") - F.col(f"_{c}") + F.col(c)).alias(c) for c in names]
    )
