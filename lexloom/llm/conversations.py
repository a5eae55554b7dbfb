"""Conversations rebuilt from message rows.

Two operators: ``thread`` takes rows with parent pointers to ordered paths by
pointer jumping; ``message_parents`` finds the pointers where rows only have a time,
by a range-partitioned sort, so that no conversation needs one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def thread(rows: DataFrame, node: str, parent: str, speaker: str) -> DataFrame:
    """(node, root, root_speaker, depth, broken) by iterative pointer jumping.

    ``rows``: one row per node, integer ids. A null parent is a start. Nodes whose
    way up leaves the table (orphans) or never ends (cycles) have broken = True and
    a null root and depth. Each round joins the nodes still on their way, and only
    those, with where they point, and doubles the distance they see. Rounds end when
    none is left, or when those left have gone farther than there are rows, which
    are cycles. Null nodes are left out; an empty table gives an empty result.
    """
    ids = rows.filter(F.col(node).isNotNull()).select(F.col(node).cast("long").alias("n"), F.col(parent).cast("long").alias("p"), F.col(speaker).alias("s"))
    start = F.col("p").isNull()
    state = stage(
        ids.select("n", F.coalesce("p", "n").alias("at"), F.when(start, F.col("s")).alias("at_s"), F.when(start, 0).otherwise(1).cast("long").alias("d"), start.alias("done"), F.lit(False).alias("lost")),
        "pointers",
    )
    settled, moving = [state.filter("done")], state.filter("NOT done")
    for _ in range(state.count().bit_length()):
        if moving.isEmpty():
            break
        everything = reduce(DataFrame.unionByName, [*settled, moving])
        target = everything.select(*[F.col(c).alias(f"t_{c}") for c in everything.columns])
        found = F.col("t_n").isNotNull()
        moved = stage(
            moving.join(target, F.col("at") == F.col("t_n"), "left").select(
                "n",
                F.when(found, F.col("t_at")).otherwise(F.col("at")).alias("at"),
                F.when(found, F.col("t_at_s")).alias("at_s"),
                F.when(found, F.col("d") + F.col("t_d")).otherwise(F.col("d")).alias("d"),
                (~found | F.col("t_done")).alias("done"),
                (~found | F.col("t_lost")).alias("lost"),
            ),
            "pointers",
        )
        settled.append(moved.filter("done"))
        moving = moved.filter("NOT done")
    pointers = reduce(DataFrame.unionByName, [*settled, moving])
    broken = F.col("lost") | ~F.col("done")
    return pointers.select(
        F.col("n").alias(node),
        F.when(~broken, F.col("at")).alias("root"),
        F.when(~broken, F.col("at_s")).alias("root_speaker"),
        F.when(~broken, F.col("d")).alias("depth"),
        broken.alias("broken"),
    )


def message_parents(rows: DataFrame, group: str, order: list[str], node: str, parts: int | None = None) -> DataFrame:
    """``rows`` with ``parent``: the node before each in its group, null for the first.

    Rows are range-partitioned by group and order together, so that a group may
    lie in many partitions; the last row of each partition, as many rows as there
    are partitions, is handed to the next partition that holds any.
    """
    key = [group, *order]
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(rows.repartitionByRange(n, *key).withColumn("_part", F.spark_partition_id()), "ordered")
    w = Window.partitionBy("_part").orderBy(*key)
    near = placed.withColumn("_before", F.lag(F.struct(group, F.col(node).alias("x"))).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = placed.groupBy("_part").agg(F.max_by(F.struct(F.col(group).alias("g"), F.col(node).alias("x")), F.struct(*key)).alias("_last"))
    across = last.select((F.lead("_part").over(Window.orderBy("_part"))).alias("_part"), F.col("_last")).filter("_part IS NOT NULL")
    joined = near.join(F.broadcast(across), "_part", "left")  # one row a partition
    before = F.when(F.col("_first") & (F.col("_last.g") == F.col(group)), F.col("_last.x")).when(F.col(f"_before.{group}") == F.col(group), F.col("_before.x"))
    return joined.withColumn("parent", before).drop("_part", "_before", "_first", "_last")


def _blank(c: Column) -> Column:
    return ~F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def rebuild(messages: DataFrame, names: DataFrame) -> DataFrame:
    """(conv_id, turn_no, msg_id, speaker_role) of every kept message.

    ``messages``: msg_id, participants (any string that names the set), sender,
    timestamp_ms, content. ``names``: participants, members (sorted distinct
    names), one row per readable ``participants``. Rows whose participants are in
    no such row, or null, form no conversation. A conversation is dropped if a row
    has no sender, a sender who is no member, or a time that is null or not
    positive, or if fewer than two senders wrote anything. Blank messages are left
    out; the same sender, time and content are one message, the smallest msg_id.
    Ties in time are ordered by msg_id.
    """
    known = names.select("participants", "members", F.md5(F.concat_ws("\x1f", "members")).alias("conv"))
    rows = stage(messages.join(known, "participants").select("msg_id", "conv", "members", "sender", "timestamp_ms", "content"), "messages")
    said = ~_blank(F.col("content"))
    bad = _blank(F.col("sender")) | ~F.coalesce(F.array_contains("members", F.col("sender")), F.lit(False)) | ~F.coalesce(F.col("timestamp_ms") > 0, F.lit(False))
    kept = (
        rows.groupBy("conv")
        .agg(F.max(bad).alias("bad"), F.min(F.when(said, F.col("sender"))).alias("one"), F.max(F.when(said, F.col("sender"))).alias("other"))
        .filter("NOT bad AND one <> other")
        .select("conv")
    )
    once = (
        rows.filter(said)
        .join(kept, "conv")
        .groupBy("conv", "sender", "timestamp_ms", F.xxhash64("content").alias("h"), F.length("content").alias("l"), F.md5("content").alias("m"))
        .agg(F.min("msg_id").alias("msg_id"))
        .select("conv", "msg_id", "timestamp_ms", "sender")
    )
    linked = stage(message_parents(once, "conv", ["timestamp_ms", "msg_id"], "msg_id").select("msg_id", "parent", "sender"), "linked")
    paths = thread(linked, "msg_id", "parent", "sender")
    role = F.when(F.col("sender") == F.col("root_speaker"), "asker").otherwise("replier")
    return (
        paths.filter("NOT broken")
        .join(linked.select("msg_id", "sender"), "msg_id")
        .select(F.col("root").alias("conv_id"), (F.col("depth") + 1).cast("int").alias("turn_no"), "msg_id", role.alias("speaker_role"))
    )
