"""Parent-child rows to full hierarchies: path, root, depth, descendants, cycles (problem 5).

Level by level, a frontier of finished nodes is joined with what hangs below it and extends
path and depth. Every node first learns its ancestors up to ``REACH`` steps away (by doubling:
log2 joins, one row per node and step), so that one frontier join finishes ``REACH`` levels.
Roots are the nodes without a parent and the nodes whose parent does not exist. Nodes that no
frontier reaches lie on a cycle or below one. Their cycles are found by doubling the step on
until it is as long as there are such nodes: where a walk of that length can still end is a
cycle. The cycle nodes, at depth 0, are then the roots of a second frontier walk.

In every join one side has one row, or one row per step, per key, and the other side's rows
for a hot key (a parent of a third of all nodes) can be split freely; adaptive execution does
so when a partition is out of proportion. Rounds are written to the shared folder, so plans
stay short and a lost executor costs no recomputation of earlier levels.

Results for odd input: null ids are dropped; rows repeated exactly count once; an id with
several parents keeps the smallest non-blank one; blank parents count as none; a node that
is its own parent is a cycle of length 1. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import cut

#: Levels that one frontier join finishes; a power of two.
REACH = 16


def blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def edges(df: DataFrame, node: str = "id", parent: str = "parent") -> DataFrame:
    """(id, parent): one row per id; parent is null for none."""
    p = F.when(~blank(F.col(parent)), F.col(parent))
    return df.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("id")).agg(F.min(p).alias("parent"))


def _ancestors(tree: DataFrame, paths: bool) -> DataFrame:
    """(x, a, d, going[, via]) of ``tree(id, parent, going)``: a is the ancestor of x d steps up,
    for d up to ``REACH``; via are the nodes from below a down to x."""
    via = [F.array("id").alias("via")] if paths else []
    got = cut(tree.select(F.col("id").alias("x"), F.col("parent").alias("a"), F.lit(1).alias("d"), "going", *via))
    span = 1
    while span < REACH:
        low = got.where(F.col("d") == span)
        if low.isEmpty():
            break
        up = got.select(F.col("x").alias("a"), F.col("a").alias("_a"), F.col("d").alias("_d"), *([F.col("via").alias("_via")] if paths else []))
        more = low.join(up, "a").select("x", F.col("_a").alias("a"), (F.col("d") + F.col("_d")).alias("d"), "going", *([F.concat("_via", "via").alias("via")] if paths else []))
        got = cut(got.unionByName(more))
        span *= 2
    return got


def _frontier(start: DataFrame, tree: DataFrame) -> tuple[DataFrame, int]:
    """``start(id, root_id, depth = 0, going, state[, path])`` and all that hangs below it in
    ``tree(id, parent, going)``; and the number of nodes."""
    paths = "path" in start.columns
    start = cut(start)
    count, going = start.agg(F.count(F.lit(1)), F.count_if("going")).first()
    levels, level, base = [start], start.where("going"), 0
    if going:
        below = _ancestors(tree, paths)
    while going:
        step = level.select(F.col("id").alias("a"), "root_id", "depth", "state", *(["path"] if paths else [])).join(below, "a")
        done = cut(step.select(F.col("x").alias("id"), "root_id", (F.col("depth") + F.col("d")).alias("depth"), "going", "state", *([F.concat("path", "via").alias("path")] if paths else [])))
        base += REACH
        edge = (F.col("depth") == base) & F.col("going")
        n, going = done.agg(F.count(F.lit(1)), F.count_if(edge)).first()
        levels.append(done)
        count += n
        level = done.where(edge)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out, count


def resolve(df: DataFrame, node: str = "id", parent: str = "parent", paths: bool = True) -> DataFrame:
    """(id, parent, root_id, depth, state, path): one row per id, path from the root down;
    no path without ``paths``, which saves carrying it through the levels.

    state is ok, broken, cycle or under_cycle. Runs jobs while it is called.
    """
    e = cut(edges(df, node, parent))
    known = e.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    born = e.where("parent is not null").select(F.col("parent").alias("id"), F.lit(True).alias("going")).distinct()
    tree = e.join(known, "parent", "left").join(born, "id", "left")
    tree = cut(tree.select("id", "parent", F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("going", F.lit(False)).alias("going")))
    total = tree.count()
    state = F.when(F.col("parent").isNull(), "ok").otherwise("broken")
    trail = [F.array("id").alias("path")] if paths else []
    start = tree.where("not known").select("id", F.col("id").alias("root_id"), F.lit(0).alias("depth"), "going", state.alias("state"), *trail)
    kids = tree.where("known").select("id", "parent", "going")
    got, reached = _frontier(start, kids)
    if reached < total:
        lost = cut(tree.join(got.select("id"), "id", "left_anti"))
        n = lost.count()
        hop = lost.select("id", F.col("parent").alias("to"), F.least("id", "parent").alias("least"))
        span = 1
        while span < n:
            far = hop.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("least").alias("least2"))
            hop = cut(hop.join(far, "to").select("id", F.col("to2").alias("to"), F.least("least", "least2").alias("least")))
            span *= 2
        ring = hop.select(F.col("to").alias("id")).distinct()
        ring = hop.join(ring, "id", "left_semi").select("id", F.col("least").alias("root_id"))
        ring = cut(lost.join(ring, "id").select("id", "root_id", F.lit(0).alias("depth"), "going", F.lit("cycle").alias("state"), *trail))
        off = lost.join(ring.select("id"), "id", "left_anti").select("id", "parent", "going")
        below, _ = _frontier(ring, off)
        below = below.withColumn("state", F.when(F.col("depth") == 0, "cycle").otherwise("under_cycle"))
        got = got.unionByName(below)
    return got.join(e, "id").select("id", "parent", "root_id", "depth", "state", *(["path"] if paths else []))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance): one row per pair, the node itself left out."""
    at = F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("i", "ancestor")
    return paths.where(F.size("path") > 1).select(F.col("id").alias("descendant"), F.size("path").alias("n"), at).select("ancestor", "descendant", (F.col("n") - 1 - F.col("i")).alias("distance"))


def unlisted(used: DataFrame, nodes: DataFrame, name: str = "id") -> DataFrame:
    """Distinct non-null strings of ``used(term)`` that equal no id."""
    terms = used.where("term is not null").select("term").distinct()
    return terms.join(nodes.select(F.col(name).alias("term")).where("term is not null").distinct(), "term", "left_anti")


def used_terms(papers: DataFrame) -> DataFrame:
    """(term) of every exposure of papers, repeats included."""
    x = papers.select(F.explode("exposures").alias("x"))
    return x.select(F.explode("x.target.terms").alias("term"))


def terms_found(targets: DataFrame, papers: DataFrame) -> DataFrame:
    """(term_id, root_id, depth, state) for every id and every unlisted string."""
    listed = resolve(targets, paths=False).select(F.col("id").alias("term_id"), "root_id", "depth", "state")
    odd = unlisted(used_terms(papers), targets).select(F.col("term").alias("term_id"), F.lit("").alias("root_id"), F.lit(-1).alias("depth"), F.lit("unlisted").alias("state"))
    return listed.unionByName(odd)


def top_level(paths: DataFrame, markers: DataFrame) -> DataFrame:
    """(id, top): the first node up from a term whose parent is a marker or that has no parent; the
    root if no parent is one. ``paths(id, path)`` from the root down, ``markers(id)``."""
    steps = paths.select("id", F.posexplode(F.reverse("path")).alias("i", "node"), F.col("path")).withColumn("parent", F.get("path", F.size("path") - F.col("i") - 2))
    steps = steps.select("id", "i", "node", F.when(F.col("i") < F.size("path") - 1, F.col("parent")).alias("parent"))
    marked = markers.select(F.col("id").alias("parent"), F.lit(True).alias("_m")).distinct()
    hit = steps.join(marked, "parent", "left").where(F.col("parent").isNull() | F.col("_m"))
    return hit.groupBy("id").agg(F.min(F.struct("i", "node")).alias("t")).select("id", F.col("t.node").alias("top"))


def listing(paths: DataFrame, labels: DataFrame, names: str = "synonyms", most: int = 6) -> DataFrame:
    """(pos, line): the tree depth-first, two spaces a level, with up to ``most`` names in brackets.
    ``paths(id, depth, path)`` order the lines; ``labels(id, names)``, the smallest list of an id."""
    from strandline.operators.relational import numbered

    known = labels.where("id is not null").groupBy("id").agg(F.min(names).alias("_n"))
    some = F.slice(F.coalesce("_n", F.array().cast("array<string>")), 1, most)
    line = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.col("id"), F.when(F.size(some) > 0, F.concat(F.lit("  ("), F.array_join(some, ", "), F.lit(")"))).otherwise(""))
    return numbered(paths.join(known, "id", "left").select("path", line.alias("line")), [F.col("path")]).select("pos", "line")
