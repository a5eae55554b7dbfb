"""Parent-child links to full paths, tops and depths, with loops found.

Each task takes one partition of the links, follows every chain as far as the
partition goes and writes, per node, the way to where its chain leaves (the
fragment exit). Exits that are nodes elsewhere form a smaller graph of the same
kind, the quotient, which is solved in the same way over fewer partitions, until
it fits one task. The fragments are then expanded by one join a level. A quotient
that hardly shrinks, as that of chains in no order, is solved by pointer jumping.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage, unstage

#: Links of a task, about 200 bytes each: as few as keep all tasks busy, within these bounds.
FRAGMENT_LEAST, FRAGMENT_MOST = 1_000, 50_000
OPEN, TOP, LOOP, BELOW = 0, 1, 2, 3
_SCHEMA = "id long, state int, at long, seg string, steps int"


def _contract(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow chains within one fragment of (id, parent, seg, steps, state, at).

    A row stands for the way ``seg`` of ``steps`` links from below ``parent`` down
    to ``id``; rows whose state is LOOP or BELOW are known already. Out come, per
    node, OPEN with the first id outside; TOP with the topmost id; LOOP or BELOW
    with the smallest id on the loop. ``seg`` is then the path from below that
    outer id, or from the top itself; for LOOP it stays the node's own.
    """
    ids, segs = pdf["id"].tolist(), pdf["seg"].tolist()
    up = [None if pd.isna(p) else int(p) for p in pdf["parent"]]
    known, known_at, steps = pdf["state"].tolist(), pdf["at"].tolist(), pdf["steps"].tolist()
    where = {x: i for i, x in enumerate(ids)}
    n = len(ids)
    state, at, seg, far, mark = [-1] * n, [0] * n, list(segs), list(steps), [-1] * n
    for i in range(n):
        if known[i] >= LOOP:
            state[i], at[i] = BELOW if known[i] == BELOW else LOOP, int(known_at[i])
    for start in range(n):
        chain, i = [], start
        while i is not None and state[i] < 0 and mark[i] != start:
            mark[i] = start
            chain.append(i)
            i = where.get(up[i]) if up[i] is not None else None
        if i is not None and state[i] < 0:  # the chain met itself
            loop = chain[chain.index(i) :]
            least = min(int(x) for j in loop for x in segs[j].split("/"))
            for j in loop:
                state[j], at[j] = LOOP, least
            del chain[len(chain) - len(loop) :]
        for j in reversed(chain):
            k = where.get(up[j]) if up[j] is not None else None
            if up[j] is None:
                state[j], at[j] = TOP, int(segs[j].split("/", 1)[0])
            elif k is None:
                state[j], at[j] = OPEN, up[j]
            elif state[k] >= LOOP:
                state[j], at[j] = BELOW, at[k]
            else:
                state[j], at[j], seg[j], far[j] = state[k], at[k], f"{seg[k]}/{segs[j]}", far[k] + steps[j]
    return pd.DataFrame({"id": ids, "state": np.array(state, np.int32), "at": np.array(at, np.int64), "seg": seg, "steps": np.array(far, np.int32)})


def _fragments(nodes: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        pdfs = list(batches)
        if pdfs:
            yield _contract(pd.concat(pdfs))

    placed = nodes.repartitionByRange(parts, "id") if parts > 1 else nodes.coalesce(1)
    return placed.mapInPandas(run, _SCHEMA)


def _as_nodes(solved: DataFrame) -> DataFrame:
    """Contracted fragments as a graph of the same kind."""
    known = F.col("state") >= LOOP
    return solved.select(
        "id",
        F.when(F.col("state") == OPEN, F.col("at")).alias("parent"),
        "seg",
        "steps",
        F.when(known, F.col("state")).otherwise(OPEN).alias("state"),
        F.when(known, F.col("at")).otherwise(0).cast("long").alias("at"),
    )


def _solve(nodes: DataFrame, n: int, fragment: int) -> DataFrame:
    """(id, state, at, seg, steps) of all ``n`` nodes; OPEN is left only where the outer id is no node.

    A level holds a fragment a task and keeps the nodes with a child in another
    task. A level that keeps more than half of its nodes is followed by pointer
    jumping instead of another level, so there are at most log2(n / fragment)
    levels, and no task ever holds more than a fragment.
    """
    parts = max(1, -(-n // fragment))
    local = stage(_fragments(nodes, parts), "fragments")
    if parts == 1:
        return local
    exits = local.filter(F.col("state") == OPEN).select(F.col("at").alias("id")).distinct()
    quotient = stage(_as_nodes(exits.join(local, "id")), "quotient")
    q = quotient.count()
    solved = _solve(quotient, q, fragment) if q <= max(n // 2, fragment) else _jump(quotient, q)
    # A loop over several fragments holds every id on the ways between its quotient nodes.
    on_loop = stage(
        solved.filter(F.col("state") == LOOP)
        .select(F.explode(F.split("seg", "/")).alias("x"))
        .select(F.col("x").cast("long").alias("id"), F.lit(True).alias("on_loop"))
        .distinct(),
        "loops",
    )
    s = solved.select(F.col("id").alias("s_id"), F.col("state").alias("s_state"), F.col("at").alias("s_at"), F.col("seg").alias("s_seg"), F.col("steps").alias("s_steps"))
    joined = local.join(s, (F.col("state") == OPEN) & (F.col("at") == F.col("s_id")), "left").join(on_loop, "id", "left")
    outer = F.col("s_id").isNotNull()
    looped = outer & (F.col("s_state") >= LOOP)
    onward = outer & (F.col("s_state") < LOOP)
    expanded = stage(
        joined.select(
            "id",
            F.when(looped, F.when(F.col("on_loop"), LOOP).otherwise(BELOW)).when(onward, F.col("s_state")).otherwise(F.col("state")).cast("int").alias("state"),
            F.when(outer, F.col("s_at")).otherwise(F.col("at")).alias("at"),
            F.when(onward, F.concat_ws("/", "s_seg", "seg")).otherwise(F.col("seg")).alias("seg"),
            F.when(onward, F.col("s_steps") + F.col("steps")).otherwise(F.col("steps")).cast("int").alias("steps"),
        ),
        "expanded",
    )
    unstage(local, quotient, solved, on_loop)
    return expanded


def _jump(nodes: DataFrame, n: int) -> DataFrame:
    """(id, state, at, seg, steps) of all nodes as ``_solve`` gives, by pointer jumping.

    First without paths: whatever has not arrived after more than ``n`` links is on
    a loop or below one, and then points at a node of its loop; as a loop's nodes
    are all pointed at, these are the nodes of loops. Then the paths of the others.
    A round joins only the nodes still on their way with where they point, the side
    that points being split where a node is hot.
    """
    open_way = (F.col("state") == OPEN) & F.col("parent").isNotNull()
    least = F.array_min(F.transform(F.split("seg", "/"), lambda x: x.cast("long")))
    going = stage(nodes.filter(open_way).select("id", F.col("parent").alias("to"), least.alias("least")), "going")
    moves, old = going, []
    for _ in range(n.bit_length()):
        ends = moves.select(F.col("id").alias("t"), F.col("to").alias("t_to"), F.col("least").alias("t_least"))
        # What is not found has arrived: at a top, at an outer id, or at what is known to be on a loop or below one.
        further = stage(moves.join(ends, F.col("to") == F.col("t")).select("id", F.col("t_to").alias("to"), F.least("least", "t_least").alias("least")), "going")
        old.append(moves)
        moves = further
        if moves.isEmpty():
            break
    looped = moves.select("id", "to")
    on_loop = looped.select(F.col("to").alias("l_id")).distinct()
    at_loop = stage(
        looped.join(moves.select(F.col("id").alias("t"), F.col("least").alias("loop_least")), F.col("to") == F.col("t"))
        .join(on_loop, F.col("id") == F.col("l_id"), "left")
        .select("id", F.when(F.col("l_id").isNotNull(), LOOP).otherwise(BELOW).alias("loop_state"), "loop_least"),
        "looped",
    )
    unstage(*old, moves)
    # Nodes with their own way as far as it is known, and whether it ends there.
    known = F.col("state") >= LOOP
    marked = nodes.join(at_loop, "id", "left")
    top = F.col("parent").isNull() & ~known
    way = stage(
        marked.select(
            "id",
            F.coalesce("loop_state", F.when(top, TOP).otherwise(F.col("state"))).cast("int").alias("state"),
            F.coalesce("loop_least", F.when(top, F.substring_index("seg", "/", 1).cast("long")).when(known, F.col("at")).otherwise(F.col("parent"))).alias("at"),
            "seg",
            "steps",
            (open_way & F.col("loop_state").isNull()).alias("on_way"),
        ),
        "ways",
    )
    while not (pending := way.filter("on_way")).isEmpty():
        t = way.select(*[F.col(c).alias(f"t_{c}") for c in way.columns])
        found, looped_there = F.col("t_id").isNotNull(), F.col("t_state") >= LOOP
        moved = pending.join(t, F.col("at") == F.col("t_id"), "left").select(
            "id",
            F.when(looped_there, BELOW).when(found, F.col("t_state")).otherwise(OPEN).cast("int").alias("state"),
            F.when(found, F.col("t_at")).otherwise(F.col("at")).alias("at"),
            F.when(found & ~looped_there, F.concat_ws("/", "t_seg", "seg")).otherwise(F.col("seg")).alias("seg"),
            F.when(found & ~looped_there, F.col("t_steps") + F.col("steps")).otherwise(F.col("steps")).cast("int").alias("steps"),
            F.coalesce("t_on_way", F.lit(False)).alias("on_way"),
        )
        last, way = way, stage(way.filter("NOT on_way").unionByName(moved), "ways")
        unstage(last)
    unstage(at_loop)
    return way.drop("on_way")


def resolve_hierarchy(links: DataFrame, node: str, parent: str, fragment: int | None = None) -> DataFrame:
    """(node, top_id, tree_depth, id_path) for every node of ``links``.

    ``links`` has one row per node, integer ids; its other columns are ignored. A
    null parent marks a topmost node. A node whose parent is no node is its own
    top, at depth 0. Nodes on a loop have depth -1, nodes below one -2; their
    top_id is the smallest id on the loop, their path is ``''``. Rows with a null
    node are left out; of rows repeating a node, the one with the largest parent
    counts. An empty table gives an empty result. ``fragment`` is the number of links
    of a task.
    """
    nodes = stage(
        links.select(F.col(node).cast("long").alias("id"), F.col(parent).cast("long").alias("parent"))
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max("parent").alias("parent"))
        .select(
            "id",
            "parent",
            F.col("id").cast("string").alias("seg"),
            F.when(F.col("parent").isNull(), 0).otherwise(1).alias("steps"),
            F.lit(OPEN).alias("state"),
            F.lit(0).cast("long").alias("at"),
        ),
        "links",
    )
    n = nodes.count()
    if fragment is None:
        tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fragment = max(FRAGMENT_LEAST, min(FRAGMENT_MOST, -(-n // tasks)))
    solved = _solve(nodes, n, fragment)
    unstage(nodes)
    orphan, loop = F.col("state") == OPEN, F.col("state") >= LOOP
    return solved.select(
        F.col("id").alias(node),
        F.when(orphan, F.substring_index("seg", "/", 1).cast("long")).otherwise(F.col("at")).alias("top_id"),
        F.when(loop, F.lit(1) - F.col("state")).when(orphan, F.col("steps") - 1).otherwise(F.col("steps")).cast("int").alias("tree_depth"),
        F.when(loop, "").otherwise(F.col("seg")).alias("id_path"),
    )


def descendants(resolved: DataFrame, node: str = "id") -> DataFrame:
    """(ancestor, descendant, distance) from the paths: one row per pair on a path, so as many as paths have steps."""
    hops = resolved.filter(F.col("id_path") != "").select(F.col(node).alias("descendant"), F.split("id_path", "/").alias("way"))
    pairs = hops.select("descendant", F.size("way").alias("n"), F.posexplode("way").alias("i", "ancestor"))
    return pairs.filter(F.col("i") < F.col("n") - 1).select(F.col("ancestor").cast("long").alias("ancestor"), "descendant", (F.col("n") - 1 - F.col("i")).alias("distance"))
