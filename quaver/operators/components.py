"""Connected components by randomised contraction, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.session import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 80) -> DataFrame:
    """(id, root) for every node of an edge; root is the smallest node of its component.

    Each round every node moves to the neighbour (or itself) of the smallest seeded hash
    and the edges follow, which halves a path and collapses a star. Moves are a map-side
    combined min; the joins that relabel edges exchange both sides, so AQE may split a hub.
    Null ends and self loops are ignored; an empty input gives an empty result.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v")
    live = materialize(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    nodes = live.select(F.col("u").alias("id")).union(live.select(F.col("v").alias("id"))).distinct()
    label, first, moves = nodes.select("id", F.col("id").alias("at")), live, []
    for turn in range(max_rounds):
        if live.isEmpty():
            break
        both = live.union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c, t=turn: F.xxhash64(F.lit(t), F.col(c))
        best = both.select("u", F.least(F.struct(rank("u").alias("r"), F.col("u").alias("x")), F.struct(rank("v").alias("r"), F.col("v").alias("x"))).alias("m"))
        move = materialize(best.groupBy("u").agg(F.min("m").alias("m")).select("u", F.col("m.x").alias("to")), "move")
        left = live.join(move.select("u", F.col("to").alias("a")), "u").select("a", "v")
        done = left.join(move.select(F.col("u").alias("v"), F.col("to").alias("b")), "v").where("a != b")
        after = materialize(done.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        if live is not first:
            discard(live)
        live = after
        moves.append(move)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # the moves of all rounds, one after the other, lead each node to its component's last label
    for move in moves:
        label = label.join(move.select(F.col("u").alias("at"), "to"), "at", "left").select("id", F.coalesce("to", "at").alias("at"))
    label = materialize(label, "label")
    for old in (first, *moves):
        discard(old)
    smallest = materialize(label.groupBy("at").agg(F.min("id").alias("root")), "roots")
    return label.join(smallest, "at").select("id", "root")
