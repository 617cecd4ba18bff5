"""Density clusters of vectors: a hierarchy over mutual reachability, of which the most stable clusters are taken.

A neighbour graph gives each row's core distance (to its min_samples-th neighbour); an
edge weighs the greatest of its length and both core distances. Then, each by joins over
edges and nodes:

* a least spanning forest by Boruvka rounds: each component takes its least edge;
* the forest's merges in order of weight (the dendrogram), by halving: the lighter half of
  the edges is contracted to its components, each standing for its heaviest merge, for the
  heavier half; the halves then go on apart, and blocks of bounded size end it;
* the condensed tree: a merge of two sides of min_cluster_size rows and more is a split,
  smaller sides fall out of their cluster one by one;
* stability, the reciprocal weights that a cluster's rows stay in it, and from the leaves
  up a cluster instead of those below it where it is at least as stable as they together.

Weights are ordered with their edge's ends and reciprocals counted in whole millionths, so
that neither ties nor the order of sums decide anything.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.cluster import neighbours
from loomcast.operators.reliable import components, cut, ranked_rows

#: Edges that one task merges: the last ones of a forest, and a block of the dendrogram; pointers and clusters that one task follows.
EDGES_AT_ONCE = 1 << 17
SCALE = 10**6


def reachability(graph: DataFrame, min_samples: int) -> DataFrame:
    """(a, b, w), a < b, of a neighbour graph (a, b, sim): the distance of unit vectors or a greater core distance of either."""
    distance = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("sim")))
    near = graph.select("a", "b", distance.alias("d"))
    held = near.groupBy("a").agg(F.sort_array(F.collect_list("d")).alias("ds"))  # at most k
    core = held.select("a", F.element_at("ds", F.least(F.lit(min_samples), F.size("ds"))).alias("core"))
    # Rows are near to others that may have them among their own nearest or not.
    both = near.join(core.withColumnRenamed("core", "ca"), "a").join(core.select(F.col("a").alias("b"), F.col("core").alias("cb")), "b")
    return both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(F.greatest("d", "ca", "cb")).alias("w"))


def _local_forest(pdf: pd.DataFrame) -> pd.DataFrame:
    """The least spanning forest's edges of a bounded number."""
    top: dict = {}

    def find(x):
        while top.setdefault(x, x) != x:
            top[x] = x = top[top[x]]
        return x

    kept = []
    pdf = pdf.sort_values(["w", "a", "b"], kind="stable")
    for k, (x, y) in enumerate(zip(pdf["ca"], pdf["cb"], strict=True)):
        x, y = find(x), find(y)
        if x != y:
            top[x] = y
            kept.append(k)
    return pdf.iloc[kept][["a", "b", "w"]]


def spanning_forest(edges: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(a, b, w): the least spanning forest of edges (a, b, w), a < b, each pair once; equal weights are ordered by (a, b).

    A round takes the least edge of each component and leaves, between any two components,
    their least edge; what fits one task ends it.
    """
    kind = edges.schema["a"].dataType.simpleString()
    now, forest = edges.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")), None
    while True:
        whole = F.min(F.struct("w", "a", "b")).alias("e")
        now = cut(now.where("ca <> cb").groupBy(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).agg(whole).select("ca", "cb", "e.*"))
        last = now.count() <= at_once
        if last:
            taken = now.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_local_forest, f"a {kind}, b {kind}, w double")
        else:
            ends = now.select(F.explode(F.array("ca", "cb")).alias("c"), F.struct("w", "a", "b", "ca", "cb").alias("e"))
            chosen = cut(ends.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct())
            of = components(chosen.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            for c in ("ca", "cb"):
                now = now.join(of.toDF(c, "to"), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
            taken = chosen.select("a", "b", "w")
        forest = taken if forest is None else forest.unionByName(taken)
        if last:
            return forest


def _local_merges(pdf: pd.DataFrame) -> pd.DataFrame:
    """What a block's merges join, lightest first: earlier merges of the block where they met its ends."""
    top: dict = {}

    def find(x):
        while top.get(x, x) != x:
            top[x] = x = top.get(top[x], top[x])
        return x

    pdf = pdf.sort_values("rank")
    size = dict(zip([*pdf["a"], *pdf["b"]], [*pdf["sa"], *pdf["sb"]], strict=True))
    out = []
    for rank, a, b in zip(pdf["rank"], pdf["a"], pdf["b"], strict=True):
        a, b, mine = find(a), find(b), -1 - rank
        out.append((a, b, size[a], size[b]))
        top[a] = top[b] = mine
        size[mine] = size[a] + size[b]
    pdf[["a", "b", "sa", "sb"]] = out
    return pdf[["rank", "w", "a", "b", "sa", "sb"]]


def dendrogram(ranked: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(rank, w, a, b, sa, sb) of a forest's edges (rank, w, a, b) over nodes from 0: what each merge joins, and their rows.

    A merge of earlier ones names them: -1 - rank.
    """
    count = ranked.count()
    one = F.lit(1).cast("long")
    now = ranked.select("rank", "w", "a", "b", one.alias("sa"), one.alias("sb"))
    small = max(0, at_once.bit_length() - 1)
    for bit in reversed(range(small, max(0, count - 1).bit_length())):
        group, heavy = F.shiftright("rank", bit + 1), F.shiftright("rank", bit).bitwiseAND(F.lit(1)) == 1
        at = now.withColumns({"x": F.struct(group.alias("g"), F.col("a").alias("v")), "y": F.struct(group.alias("g"), F.col("b").alias("v"))})
        low = at.where(~heavy)
        of = components(low.select(F.col("x").alias("a"), F.col("y").alias("b")))
        nodes = low.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("sa").alias("s")), F.struct(F.col("y").alias("node"), F.col("sb").alias("s")))).alias("e")).select("e.*").distinct()
        sizes = nodes.join(of, "node").groupBy("component").agg(F.sum("s").alias("size"))
        tops = low.select(F.col("x").alias("node"), "rank").join(of, "node").groupBy("component").agg((-1 - F.max("rank")).alias("top"))
        stands = cut(of.join(sizes, "component").join(tops, "component").select("node", "top", "size"))
        high = at.where(heavy)
        for end, name, rows in (("x", "a", "sa"), ("y", "b", "sb")):
            high = high.join(stands.toDF(end, "top", "size"), end, "left").withColumns({name: F.coalesce("top", name), rows: F.coalesce("size", rows)}).drop("top", "size")
        columns = ["rank", "w", "a", "b", "sa", "sb"]
        now = cut(low.select(columns).unionByName(high.select(columns)))
    return now.groupBy(F.shiftright("rank", small).alias("g")).applyInPandas(_local_merges, "rank long, w double, a long, b long, sa long, sb long")


def _local_ends(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bounded number of pointers, each followed to its end."""
    to = dict(zip(pdf["node"], pdf["to"], strict=True))
    for node in list(to):
        passed = []
        while to[node] in to:
            passed.append(node)
            node = to[node]
        for x in passed:
            to[x] = to[node]
    return pd.DataFrame({"node": list(to), "to": list(to.values())}, dtype="int64")


def followed(steps: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(node, to) of pointers (node, to), each followed to its end; what doesn't fit one task goes twice as far each round."""
    now = cut(steps.select("node", "to"))
    if now.count() <= at_once:
        return now.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_local_ends, "node long, to long")
    while True:
        met = now.join(now.select(F.col("node").alias("to"), F.col("to").alias("further")), "to", "left")
        now = cut(met.select("node", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("node", "to")
        now = now.select("node", "to")


def _local_chosen(pdf: pd.DataFrame) -> pd.DataFrame:
    """The clusters taken of a bounded number."""
    up = {c: None if pd.isna(p) else int(p) for c, p in zip(pdf["c"], pdf["parent"], strict=True)}
    stable, able = ({c: f(x) for c, x in zip(pdf["c"], pdf[name], strict=True)} for name, f in (("stability", int), ("able", bool)))
    kids: dict[int, list[int]] = {}
    for c, p in up.items():
        kids.setdefault(p, []).append(c)
    order = list(kids.get(None, []))
    for c in order:  # grows: from the top down
        order += kids.get(c, [])
    best, taken = {}, {}
    for c in reversed(order):
        below = sum(best[x] for x in kids.get(c, []))
        taken[c] = able[c] and (c not in kids or stable[c] >= below)
        best[c] = max(stable[c], below) if c in kids else stable[c]
    top: dict = {}
    for c in order:
        above = top.get(up[c])
        top[c] = above if above is not None else c if taken[c] else None
    return pd.DataFrame({"c": pd.array(list(top), "Int64"), "top": pd.array(list(top.values()), "Int64")})


def _chosen(clusters: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(c, top) of clusters (c, parent, stability, able): the cluster taken instead of c, itself or one above; null if none is.

    From the leaves up, in as many rounds as clusters lie in each other, unless they fit one task.
    """
    clusters = cut(clusters)
    if clusters.count() <= at_once:
        return clusters.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_local_chosen, "c long, top long")
    kids = clusters.where("parent is not null").groupBy(F.col("parent").alias("c")).agg(F.count(F.lit(1)).alias("kids"))
    waiting = cut(clusters.join(kids, "c", "left").na.fill(0, ["kids"]))
    done = waiting.where("kids = 0").select("c", "parent", F.col("stability").alias("best"), F.col("able").alias("taken"))
    waiting = waiting.where("kids > 0")
    while not waiting.isEmpty():
        below = done.groupBy(F.col("parent").alias("c")).agg(F.sum("best").alias("below"), F.count(F.lit(1)).alias("known"))
        met = cut(waiting.join(below, "c", "left"))
        ready = met.where("known = kids").select("c", "parent", F.greatest("stability", "below").alias("best"), (F.col("able") & (F.col("stability") >= F.col("below"))).alias("taken"))
        done = cut(done.unionByName(ready))
        waiting = met.where("known is null or known < kids").select(waiting.columns)
    now = cut(done.select("c", F.col("parent").alias("up"), F.when(F.col("taken"), F.col("c")).alias("top")))
    while not now.where("up is not null").isEmpty():
        above = now.select(F.col("c").alias("up"), F.col("up").alias("upper"), F.col("top").alias("higher"))
        now = cut(now.join(above, "up", "left").select("c", F.col("upper").alias("up"), F.coalesce("higher", "top").alias("top")))
    return now.select("c", "top")


def density_clusters(
    vectors: DataFrame, min_cluster_size: int = 5, min_samples: int | None = None, k: int = 15, single: bool = False,
    vec_id: str = "vec_id", vector: str = "e", graph: DataFrame | None = None, at_once: int = EDGES_AT_ONCE,
) -> DataFrame:
    """(vec_id, cluster): the density cluster of each row, numbered from 0 by their least ids; -1 is noise.

    min_samples (by default min_cluster_size) is the neighbour that a core distance reaches.
    graph (a, b, sim) has each row's nearest; without it the k nearest, and at least
    min_samples, are found exactly, in blocks. Where the graph falls apart each part is a
    cluster from the start; one that holds all is none by itself, unless single. Rows
    without a vector are noise.
    """
    samples = min_samples or min_cluster_size
    if graph is None:
        graph = neighbours(vectors, max(k, samples), -2.0, vec_id, vector)
    rows = ranked_rows(vectors.select(F.col(vec_id).alias("id")), ["id"], "n")
    number = lambda c: rows.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"))
    near = cut(graph.join(number("a"), "a").join(number("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"), "sim"))
    forest = spanning_forest(reachability(near, samples), at_once)
    merges = cut(dendrogram(ranked_rows(forest, ["w", "a", "b"], "rank"), at_once))
    least = F.lit(min_cluster_size)
    merges = merges.select((-1 - F.col("rank")).alias("node"), F.floor(SCALE / F.greatest("w", F.lit(1 / SCALE))).cast("decimal(20,0)").alias("lam"), "a", "b", "sa", "sb", ((F.col("sa") >= least) & (F.col("sb") >= least)).alias("splits"))
    merges = cut(merges.withColumn("size", F.col("sa") + F.col("sb")))
    child = lambda c: F.struct(F.col(c).alias("node"), F.col(f"s{c}").alias("size"), F.col("node").alias("to"), F.col("splits").alias("born"), F.col("lam").alias("birth"))
    links = cut(merges.select(F.explode(F.array(child("a"), child("b"))).alias("l")).select("l.*"))
    large = merges.where(F.col("size") >= least)
    falls = followed(links.where(F.col("size") < least), at_once).join(large.select(F.col("node").alias("to"), "lam"), "to").where("node >= 0").select("node", F.col("to").alias("at"), "lam")
    heads = large.join(links.select("node", F.col("to").alias("parent"), "born", "birth"), "node", "left").where("born is null or born").select("node", "parent", F.coalesce("birth", F.lit(0).cast("decimal(20,0)")).alias("birth"))
    heads = cut(heads)
    inside = followed(links.where((F.col("size") >= least) & ~F.col("born")), at_once).unionByName(heads.select("node", F.col("node").alias("to")))
    inside = cut(inside.select("node", F.col("to").alias("c")))
    points = cut(falls.join(inside.select(F.col("node").alias("at"), "c"), "at").select("node", "c", "lam"))
    stay = points.select("c", "lam", F.lit(1).cast("long").alias("rows")).unionByName(large.where("splits").join(inside, "node").select("c", "lam", F.col("size").alias("rows")))
    stable = stay.join(heads.select(F.col("node").alias("c"), "birth"), "c").groupBy("c").agg(F.sum((F.col("lam") - F.col("birth")) * F.col("rows").cast("decimal(12,0)")).alias("stability"))
    above = heads.join(inside.select(F.col("node").alias("parent"), F.col("c").alias("up")), "parent", "left").select(F.col("node").alias("c"), F.col("up").alias("parent"))
    lone = above.where("parent is null").limit(2).count() == 1 and not single
    clusters = above.join(stable, "c").withColumn("able", F.lit(True) if not lone else F.col("parent").isNotNull())
    tops = _chosen(clusters, at_once)
    held = cut(points.join(tops, "c").where("top is not null").select("node", "top"))
    names = ranked_rows(held.groupBy("top").agg(F.min("node").alias("first")), ["first"], "cluster")
    found = held.join(names, "top").select(F.col("node").alias("n"), F.col("cluster").cast("int").alias("cluster"))
    return rows.join(found, "n", "left").select(F.col("id").alias(vec_id), F.coalesce("cluster", F.lit(-1)).alias("cluster"))
