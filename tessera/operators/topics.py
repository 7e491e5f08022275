"""Topic trees and graphs: expansion level by level, root-to-leaf paths, cycles, tools.

Levels are DataFrames, joined once a level; paths and reachability are loops over levels, each a join of the frontier with the
edges. They end on the data: a path takes no node twice, and a round that changes nothing is the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.shared import discard, materialise


def expand(level: DataFrame, children: DataFrame, degree: int) -> DataFrame:
    """The next level of (path): ``degree`` children each, from (parent, rank, child); missing ones are padded, surplus ones cut."""
    slots = level.select("path", F.explode(F.sequence(F.lit(1), F.lit(degree))).alias("rank")).withColumn("parent", F.element_at("path", -1))
    named = slots.join(children, ["parent", "rank"], "left")
    padded = F.coalesce("child", F.concat(F.lit("subtopic_"), F.col("rank").cast("string"), F.lit("_for_"), F.col("parent")))
    return named.select(F.array_append("path", padded).alias("path"))


def build_tree(spark, root: str, children: DataFrame, degree: int, depth: int) -> DataFrame:
    """All paths of a tree of the depth."""
    level = spark.createDataFrame([([root],)], "path array<string>")
    for _ in range(depth):
        level = expand(level, children, degree)
    return level


def leaves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes (id) without children."""
    return nodes.join(edges.select(F.col("parent_id").alias("id")).distinct(), "id", "left_anti")


def add_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    return edges.unionByName(new).dropDuplicates(["parent_id", "child_id"])


def root_paths(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(path) from each root (id) to each leaf; a path stops before a node it already has. Each level is a written table.

    Ends when no path is open; raises if one is after ``max_depth`` nodes, where given, rather than leave it out.
    """
    e = edges.select(F.col("parent_id").alias("at"), "child_id").distinct()
    front = materialise(roots.select(F.array("id").alias("path"), F.col("id").alias("at")), "paths")
    done, depth = [], 0
    while not front.isEmpty():
        if depth == max_depth:
            raise ValueError(f"paths of more than {max_depth} nodes")
        depth += 1
        ends = materialise(front.join(e.select("at").distinct(), "at", "left_anti").select("path"), "leaf-paths")
        done.append(ends._tessera_path)
        before, front = front, materialise(front.join(e, "at").filter(~F.array_contains("path", F.col("child_id"))).select(F.array_append("path", F.col("child_id")).alias("path"), F.col("child_id").alias("at")), "paths")
        discard(before)
    kind = roots.schema["id"].dataType.simpleString()
    discard(front)
    # one scan of all levels, so the plan does not grow with the depth
    return edges.sparkSession.read.schema(f"path array<{kind}>").parquet(*done) if done else edges.sparkSession.createDataFrame([], f"path array<{kind}>")


def cyclic_nodes(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(id) of nodes on a cycle or between cycles: what stays when nodes without incoming or outgoing edges go, round by round.

    Ends when a round changes nothing; raises if that takes more than ``max_rounds``, where given.
    """
    left = materialise(edges.select("parent_id", "child_id").distinct(), "edges")
    n = left.count()
    rounds, was = 0, None
    while n != was:
        if rounds == max_rounds:
            raise ValueError(f"nodes still go after {max_rounds} rounds")
        rounds += 1
        both = left.select(F.col("child_id").alias("id")).intersect(left.select("parent_id"))
        after = left.join(both.withColumnRenamed("id", "parent_id"), "parent_id", "left_semi").join(both.withColumnRenamed("id", "child_id"), "child_id", "left_semi")
        before, left = left, materialise(after.select("parent_id", "child_id"), "edges")
        discard(before)
        was, n = n, left.count()
    return left.select(F.col("parent_id").alias("id")).union(left.select("child_id")).distinct()


def merge_tools(registries: list[DataFrame], order: str) -> DataFrame:
    """Tools (name, the order column, ...) of several registries: the later definition wins, the first place stays."""
    rows = None
    for k, r in enumerate(registries):
        part = r.withColumn("_k", F.lit(k))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    body = F.struct(*[c for c in rows.columns if c not in ("_k", order)])
    out = rows.groupBy("name").agg(F.max_by(body, F.struct("_k", order)).alias("t"), F.min(F.struct("_k", order)).alias("first"))
    return out.orderBy("first").select("t.*")


def pick_tools(tools: DataFrame, names: list[str]) -> DataFrame:
    """The tools of the names, in their order; names without a tool are passed over."""
    wanted = tools.sparkSession.createDataFrame(list(enumerate(names)), "_i int, name string")
    return F.broadcast(wanted).join(tools, "name").orderBy("_i").drop("_i")


def categories(tools: DataFrame) -> DataFrame:
    """(category, tools, names): each category with its tools' sorted names."""
    return tools.groupBy("category").agg(F.count("*").alias("tools"), F.sort_array(F.collect_list("name")).alias("names"))


def fits(steps: int, batch: int, degree: int, depth: int) -> tuple[bool, list[tuple[int, int]]]:
    """Whether a tree has paths enough, and up to three (steps, batch) that use all of them."""
    paths = degree**depth
    if steps * batch <= paths:
        return True, []
    combos = sorted(((paths // b, b) for b in range(1, paths + 1) if paths % b == 0), key=lambda x: (x[0], -x[1]))
    return False, combos[:3]


def wrapped(topic: Column, width: int = 30) -> Column:
    """A label in lines of up to ``width`` characters, cut between words; a longer word stands alone."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("line"))

    def step(a, w):
        joined = F.when(a["line"] == "", w).otherwise(F.concat(a["line"], F.lit(" "), w))
        fits = (a["line"] == "") | (F.length(joined) <= width)
        done = F.when(a["done"] == "", a["line"]).otherwise(F.concat(a["done"], F.lit("<br>"), a["line"]))
        return F.struct(F.when(fits, a["done"]).otherwise(done).alias("done"), F.when(fits, joined).otherwise(w).alias("line"))

    words = F.filter(F.split(topic, " "), lambda w: w != "")
    return F.aggregate(words, start, step, lambda a: F.when(a["done"] == "", a["line"]).otherwise(F.concat(a["done"], F.lit("<br>"), a["line"])))


def mermaid(nodes: DataFrame, edges: DataFrame, width: int = 30) -> DataFrame:
    """(line) of a Mermaid graph: a line a node, its topic wrapped at the width, and a line an edge."""
    n = nodes.select(F.concat(F.lit("    "), F.col("id").cast("string"), F.lit('["'), wrapped(F.col("topic"), width), F.lit('"]')).alias("line"))
    e = edges.select(F.concat(F.lit("    "), F.col("parent_id").cast("string"), F.lit(" --> "), F.col("child_id").cast("string")).alias("line"))
    return n.union(e)


def add_nodes(nodes: DataFrame, fresh: DataFrame, order: list[str]) -> DataFrame:
    """fresh with ids after the greatest of nodes (id), in the order.

    A level is numbered in one window: it is as large as the replies of one round of a model, which the driver sends out.
    """
    top = nodes.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]
    return fresh.withColumn("id", (F.row_number().over(Window.orderBy(*order)) + F.lit(top)).cast("int"))


def grow(nodes: DataFrame, edges: DataFrame, proposals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A graph's next level: nodes (id, topic) and edges with the proposals (parent_id, rank, topic, connections array<int>) of leaves.

    Proposals for nodes that are no leaves are passed over. New ids follow the greatest one in the order of parent and rank;
    connections count to nodes that are there when theirs is made, older ones and those numbered before it.
    """
    ends = leaves(nodes, edges).select(F.col("id").alias("parent_id"))
    fresh = materialise(add_nodes(nodes, proposals.join(ends, "parent_id", "left_semi"), ["parent_id", "rank"]), "graph-level")
    links = fresh.select(F.explode("connections").alias("parent_id"), F.col("id").alias("child_id"))
    known = nodes.select(F.col("id").alias("parent_id")).union(fresh.select("id"))
    links = links.join(known, "parent_id", "left_semi").filter("parent_id <= child_id").select("parent_id", "child_id")
    out = edges.select("parent_id", "child_id").union(fresh.select("parent_id", F.col("id").alias("child_id"))).union(links).distinct()
    return nodes.select("id", "topic").union(fresh.select("id", "topic")), out


def expand_graph(nodes: DataFrame, edges: DataFrame, propose: Callable[[DataFrame, int], DataFrame], degree: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """``depth`` rounds of grow(): propose(leaves, degree) gives each round's proposals, of which each leaf keeps ``degree``."""
    for _ in range(depth):
        wanted = propose(leaves(nodes, edges).select("id", "topic"), degree).filter(F.col("rank") <= degree)
        nodes, edges = (materialise(x, "graph") for x in grow(nodes, edges, wanted))
    return nodes, edges


def tree_rows(paths: DataFrame, failed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(value) lines of a tree's file and of the file of failed generations beside it."""
    rows = paths.select(F.to_json(F.struct("path")).alias("value"))
    none = paths.sparkSession.createDataFrame([], "value string")
    return rows, none if failed is None else failed.select(F.to_json(F.struct("failed_generation")).alias("value"))


def graph_json(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, topic, children, parents): each node with the sorted ids of its neighbours."""
    kids = edges.groupBy(F.col("parent_id").alias("id")).agg(F.sort_array(F.collect_set("child_id")).alias("children"))
    ups = edges.groupBy(F.col("child_id").alias("id")).agg(F.sort_array(F.collect_set("parent_id")).alias("parents"))
    empty = F.array().cast("array<int>")
    return nodes.join(kids, "id", "left").join(ups, "id", "left").select("id", "topic", F.coalesce(F.col("children").cast("array<int>"), empty).alias("children"), F.coalesce(F.col("parents").cast("array<int>"), empty).alias("parents"))


def level_counts(paths: DataFrame) -> DataFrame:
    """(depth, nodes): distinct nodes of a tree by depth, as a printout shows them."""
    at = F.explode(F.sequence(F.lit(1), F.size("path")))
    return paths.select("path", at.alias("depth")).select("depth", F.slice("path", F.lit(1), F.col("depth")).alias("p")).distinct().groupBy("depth").agg(F.count("*").alias("nodes"))


def path_prompt(path: Column) -> Column:
    return F.concat(F.lit("Topic path: "), F.array_join(path, " -> "))
