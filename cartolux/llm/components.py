"""Consolidating pairwise matches into groups by random graph contraction.

A round: every vertex hooks to the least of itself and its neighbours in an order that is fresh for the
round; edges are relabelled to the hooked-to vertices, loops dropped, repeats removed. In expectation at
least a quarter of the vertices with edges disappears per round, so the tables shrink geometrically and
the number of rounds grows with the logarithm of the input, whatever its shape (chains, stars, cliques);
``MAX_ROUNDS`` without an end raises, nothing is cut short. The mappings of the rounds are expanded
backwards at the end. Edge and mapping tables are written to the shared folder each round; nothing is
collected but their numbers of rows.

The order of a round is a one-to-one mixing of the ids (xor with the round's seed and shifts), so hooking
is the least of a number per vertex, combined before the shuffle, and the vertex is read back from it.

Skew. Tables of at most ``FEW`` rows, by their count, are looked up by broadcast. Beyond, the rows of a
round count each vertex's edges. At most ``HOT`` vertices can hold more than one
``HOT``-th of all edge ends: these and only these are looked up by broadcast, the rest by an ordinary
join on the vertex, where no key is hot. Nothing is copied.

Cases. A null end links nothing, its other end is still a record. Self links and repeated or turned
links change nothing. A record without links is its own group. No input rows give no groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..runtime import Stage

MAX_ROUNDS = 200
#: The most keys of a join that are looked up by broadcast, each with more than one HOT-th of the rows.
HOT = 1000
#: A table of so few rows is broadcast whole.
FEW = 10_000
#: Shifts (left, right, left) of the one-to-one mixing, taken in turn.
SHIFTS = ((25, 27, 33), (31, 22, 26), (23, 29, 37), (28, 24, 35), (35, 26, 29))


def _shifted(df: DataFrame, name: str, steps: list[tuple[str, int]]) -> DataFrame:
    """Column ``name`` xored with itself shifted, step by step: a projection each, so no step is computed twice."""
    for way, n in steps:
        shift = F.shiftleft if way == "left" else F.shiftrightunsigned
        df = df.withColumn(name, F.col(name).bitwiseXOR(shift(F.col(name), n)))
    return df


def _steps(turn: int) -> list[tuple[str, int]]:
    return list(zip(("left", "right", "left"), SHIFTS[turn % len(SHIFTS)]))


def _seed(turn: int) -> Column:
    return F.lit(((turn + 1) * 0x9E3779B97F4A7C15) % (1 << 63))


def mixed(df: DataFrame, name: str, turn: int) -> DataFrame:
    """Ids in column ``name`` replaced by their places in the order of round ``turn``."""
    return _shifted(df.withColumn(name, F.col(name).bitwiseXOR(_seed(turn))), name, _steps(turn))


def unmixed(df: DataFrame, name: str, turn: int) -> DataFrame:
    """Places replaced by ids. A step is undone by taking it with its shift doubled until 64 bits are covered."""
    undo = [(way, n << i) for way, n in reversed(_steps(turn)) for i in range(6) if n << i < 64]
    return _shifted(df, name, undo).withColumn(name, F.col(name).bitwiseXOR(_seed(turn)))


def _counted(stage: Stage, df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The table written, and its number of rows, counted as it is written."""
    seen = Observation()
    out = stage.write(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def _looked_up(big: DataFrame, on: str, hot: DataFrame, small: DataFrame, size: int) -> DataFrame:
    """``big`` left-joined with ``small`` (on and other columns, unique in on, ``size`` rows). ``hot`` is the rows of
    ``small`` for the keys of more than a HOT-th of ``big``, so HOT at most."""
    if size <= FEW:
        return big.join(F.broadcast(small), on, "left")
    marked = hot.withColumn("_hot", F.lit(True))
    known = big.join(F.broadcast(marked), on, "left")
    cold = big.join(F.broadcast(hot.select(on)), on, "left_anti").join(small, on, "left")
    return known.filter("_hot").drop("_hot").unionByName(cold)


def contract(links: DataFrame, records: DataFrame, stage: Stage) -> DataFrame:
    """(record_id, group_id) of all ``records`` (id) and ends of ``links`` (a, b), group_id the least id."""
    whole = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    loose = records.select(F.col("id").cast("long").alias("v")).union(whole.select(F.explode(F.array("a", "b")))).filter("v IS NOT NULL")
    edges, n = _counted(stage, whole.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edges")
    rounds: list[tuple[DataFrame, int]] = []
    while n or not rounds:
        turn = len(rounds)
        if turn == MAX_ROUNDS:
            raise RuntimeError(f"{MAX_ROUNDS} rounds did not contract the graph")
        both = F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))
        ends = edges.select(F.explode(both).alias("e")).select("e.v", "e.w", F.lit(1).alias("times"))
        if turn == 0:
            ends = ends.unionByName(loose.select("v", F.col("v").alias("w"), F.lit(0).alias("times")))
        least = mixed(ends, "w", turn).groupBy("v").agg(F.min("w").alias("r"), F.sum("times").alias("times"))
        least = mixed(least.withColumn("own", F.col("v")), "own", turn).select("v", F.least("r", "own").alias("r"), "times")
        hooks, vertices = _counted(stage, unmixed(least, "r", turn), "hooks")
        rounds.append((hooks, vertices))
        if not n:
            break
        moved = edges
        for end in ("a", "b"):
            new = [F.col("v").alias(end), F.col("r").alias(f"r{end}")]
            moved = _looked_up(moved, end, hooks.filter(F.col("times") > 2 * n // HOT).select(*new), hooks.filter("times > 0").select(*new), vertices).drop(end)
        old = edges
        edges, n = _counted(stage, moved.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        stage.drop(old)
    groups, total = rounds[-1][0].select("v", F.col("r").alias("g")), rounds[-1][1]
    for turn in reversed(range(len(rounds) - 1)):
        (hooks, total), size = rounds[turn], rounds[turn + 1][1]
        many = hooks.groupBy("r").agg(F.count("*").alias("times")).filter(F.col("times") > total // HOT).select("r")
        roots = groups.withColumnRenamed("v", "r")
        found = _looked_up(hooks.select("v", "r"), "r", many.join(roots, "r", "left"), roots, size)
        groups = found.select("v", F.coalesce("g", "r").alias("g"))
        if total > FEW:
            groups = stage.write(groups, "groups")
    if total <= FEW:
        groups = stage.write(groups, "groups")
    least, size = _counted(stage, groups.groupBy("g").agg(F.min("v").alias("group_id"), F.count("*").alias("times")), "least")
    named = _looked_up(groups, "g", least.filter(F.col("times") > total // HOT).drop("times"), least.drop("times"), size)
    return named.select(F.col("v").alias("record_id"), "group_id")


def consolidated(records: DataFrame, links: DataFrame) -> DataFrame:
    """(record_id, group_id) of all ``records`` (id) and of all ends of ``links`` (a, b)."""
    return contract(links, records.select("id"), Stage(records.sparkSession))


def map_links(edges: DataFrame, glues: DataFrame) -> DataFrame:
    """Links (a, b) of the edge table and of the glue table, whose query contig ties to both maps."""
    sides = F.explode(F.array("RefContigID_x", "RefContigID_y"))
    return edges.select(F.col("id1").alias("a"), F.col("id2").alias("b")).union(glues.select(F.col("QryContigID").alias("a"), sides.alias("b")))


def group_sizes(groups: DataFrame) -> DataFrame:
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("n_records"))
    return sizes.groupBy("n_records").agg(F.count("*").alias("n_groups"))
