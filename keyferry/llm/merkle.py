"""Merkle manifest of a dataset: a tree per group, a forest root over the groups.

Every row is a leaf, H of its columns. The leaves of a group (here a language)
ascend by document; every two consecutive nodes become H of both (the last of an
odd level alone becomes H of itself) until one is left, the group's subroot, and
the subroots in the order of their groups give the root the same way.

Only every `every`-th level is written. A node of the next written level is
computed from the aligned run of at most 2**every nodes below it; its interior
nodes are dropped. Proofs go top-down: each run is gathered again beside the
path of the node above it, its interior nodes are computed once more, every
member's siblings are emitted in front of that path, and the nodes are dropped.
No task ever holds more than one run.

A path is an array with one step per level, from the leaf up: "<" and the
sibling's hash if it stands left, ">" and the hash if it stands right, empty if
the node has none. `fold` needs nothing else to get from a leaf to the root.

Defined results: a null cell is hashed as "-", so it differs from an empty
text; null ids come first in their group and the null group first of all; rows
of one group and id are ordered by their hash, and equal rows, which no order can
tell apart, stand side by side as leaves of their own; an empty table has no
leaves and no root; columns other than those named are not hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.llm.common import discard, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*columns: Column) -> Column:
    """Hex SHA-256 of the cells: "-" for null, else the length in bytes, ":" and the value."""
    texts = [c.cast("string") for c in columns]
    cells = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*cells), 256)


def fold(node: Column, path: Column) -> Column:
    """The root that `node` and its path lead to."""
    def step(x: Column, s: Column) -> Column:
        other, left = F.substr(s, F.lit(2)), F.startswith(s, F.lit("<"))
        return F.sha2(F.when(left, F.concat(other, x)).otherwise(F.concat(x, other)), 256)

    return F.aggregate(path, node, step)


def siblings_digest(path: Column) -> Column:
    """Hex SHA-256 of the siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substr(s, F.lit(2))), ""), 256)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition with its number and their place among those of their tree."""
    part, tree, nth = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for t in batch.column(0).to_pylist():
            tree, nth = t, nth + 1 if t == tree else 0
            places.append(nth)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
            names=[*batch.schema.names, "part", "nth"])


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """`nodes` (tree, ...) with pos, the place from 0 in its tree by `order`, and n, the size of the tree.

    The whole table is sorted by range, so a large tree spreads over many tasks;
    the tasks' counts, one row per task and tree, tell where each task starts.
    """
    own = ["tree", *[c for c in nodes.columns if c != "tree"], "twin"]
    tagged = stored(nodes.withColumn("twin", F.monotonically_increasing_id()).select(*own), "merkle-nodes")  # twin parts equal rows
    by = ["tree", *order, "twin"]
    schema = T.StructType([*tagged.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())])
    in_order = tagged.repartitionByRange(*by).sortWithinPartitions(*by)
    ranked = stored(in_order.mapInArrow(_index, schema), "merkle-sorted")
    discard(tagged)
    counts = ranked.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("own"))
    sums = counts.selectExpr("tree", "part", "sum(own) over (partition by tree order by part) - own as start",
                             "sum(own) over (partition by tree) as n")
    return ranked.join(sums, ["tree", "part"]).withColumn("pos", F.col("start") + F.col("nth")).drop("part", "nth", "start", "twin")


def _up(nodes: list[str]) -> list[str]:
    """The next level of a run of nodes."""
    return [hashlib.sha256("".join(nodes[i:i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]


def _steps(n: int, every: int) -> int:
    """Levels to climb from a level of n nodes: up to the root, at most `every`."""
    return min(every, (n - 1).bit_length())


def _run_levels(run: pa.Table, every: int) -> list[list[str]]:
    """The run's nodes by level, up to the one node that is next written."""
    levels = [run["node"].to_pylist()]
    for _ in range(_steps(run["n"][0].as_py(), every)):
        levels.append(_up(levels[-1]))
    return levels


def _path(levels: list[list[str]], i: int) -> list[str]:
    """Siblings of member i on the way to the top of its run."""
    out = []
    for nodes in levels[:-1]:
        other = i ^ 1
        out.append("" if other >= len(nodes) else ("<" if other < i else ">") + nodes[other])
        i //= 2
    return out


def written_levels(leaves: DataFrame, every: int = 8) -> list[DataFrame]:
    """The written levels: `leaves` (tree, pos, n, node), then tree, pos, n, node of every `every`-th level, up to the roots."""
    def climb(run: pa.Table) -> pa.Table:
        run = run.sort_by("pos")
        n = run["n"][0].as_py()
        return pa.table({"tree": run["tree"][:1], "pos": [run["pos"][0].as_py() >> every],
                         "n": [-(-n // (1 << _steps(n, every)))], "node": _run_levels(run, every)[-1]})

    levels = [leaves]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        runs = levels[-1].select("tree", "pos", "n", "node", F.shiftright("pos", every).alias("at"))
        levels.append(stored(runs.groupBy("tree", "at").applyInArrow(climb, "tree string, pos bigint, n bigint, node string"), "merkle-level"))
        largest = -(-largest // (1 << every))
    return levels


def with_paths(levels: list[DataFrame], above: DataFrame, every: int = 8) -> DataFrame:
    """Rows of the lowest level with `path`, to the root of their tree and on along `above` (tree, path)."""
    paths = above.select("tree", F.lit(0).cast("long").alias("at"), F.col("path").alias("up"))
    for level in reversed(levels):
        own = [f for f in level.schema.fields if f.name not in ("pos", "n")]
        schema = T.StructType([*own, T.StructField("place", T.LongType()), T.StructField("path", T.ArrayType(T.StringType()))])
        names = [f.name for f in own]

        def descend(run: pa.Table, up: pa.Table) -> pa.Table:
            run = run.sort_by("pos")
            nodes, rest = _run_levels(run, every), up["up"][0].as_py()
            found = pa.array([_path(nodes, i) + rest for i in range(len(run))], pa.list_(pa.string()))
            return pa.table([*[run[c] for c in names], run["pos"], found], names=[*names, "place", "path"])

        runs = level.withColumn("at", F.shiftright("pos", every)).groupBy("tree", "at")
        found = runs.cogroup(paths.groupBy("tree", "at")).applyInArrow(descend, schema)
        if level is levels[0]:
            return found
        paths = stored(found.select("tree", F.col("place").alias("at"), F.col("path").alias("up")), "merkle-paths")
    return found


def manifest(documents: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id",
             carry: Sequence[Column] = (), every: int = 8) -> DataFrame:
    """One row per document: key, leaf, subroot, root, path, and the columns `carry` (of the document).

    Groups ascend bytewise by their text, documents by `key`, nulls first.
    """
    if not 1 <= every <= 16:
        raise ValueError("every must be 1 to 16")
    # "-" sorts before "=": the null group comes first.
    tree = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = documents.select(tree.alias("tree"), F.col(key).alias("key"), digest(*[F.col(c) for c in columns]).alias("node"), *carry)
    leaves = stored(numbered(leaves, ["key", "node"]), "merkle-leaves")
    levels = written_levels(leaves, every)
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), "node")
    forest = written_levels(stored(numbered(subroots, ["member"]), "merkle-forest"), every)
    top = forest[-1].select("tree", F.col("node").alias("root"))
    none = levels[-1].sparkSession.createDataFrame([("", [])], "tree string, path array<string>")
    above = with_paths(forest, none, every).join(top, "tree")
    above = stored(above.select(F.col("member").alias("tree"), F.col("node").alias("subroot"), "root", "path"), "merkle-above")
    found = with_paths(levels, above, every).join(above.select("tree", "subroot", "root"), "tree")
    rest = [c for c in found.columns if c not in ("tree", "key", "node", "subroot", "root", "place", "path")]
    return found.select(F.col("key").alias(key), F.col("node").alias("leaf"), "subroot", "root", "path", *rest)
