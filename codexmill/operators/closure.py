"""Property paths over a containment relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codexmill.session import materialize


#: Steps that the first round plans at once, and the most that a later one does: rounds double.
STEPS, MOST_STEPS = 6, 24


def reached(edges: DataFrame, starts: DataFrame, steps: int = STEPS) -> DataFrame:
    """(start, node): what is reached from each start along edges (frm, to) in
    one or more steps; a start reaches itself only on a cycle.

    A round follows ``steps`` edges in one plan: a row carries the nodes on its
    way, so no step is computed twice, and rows whose way has ended are spread,
    not gathered under one NULL. Pairs first reached by a round's last step go
    on to the next one, which takes twice as many, so cycles end. Each round is written to the shared
    folder. Set semantics; NULLs never match; no starts, no rows.
    """
    e = edges.select("frm", "to").where("frm IS NOT NULL AND to IS NOT NULL").distinct()
    e = materialize(e, "edges")
    front = starts.select("start").where("start IS NOT NULL").distinct().withColumn("node", F.col("start"))
    seen: DataFrame | None = None
    while True:
        pairs = e.sparkSession.sql(_round(steps), front=front, e=e)
        if seen is not None:
            pairs = pairs.join(seen.select("start", "node"), ["start", "node"], "left_anti")
        more = Observation()
        last = F.col("step") == steps
        new = materialize(pairs.observe(more, F.count(F.when(last, 1)).alias("n")), "reached")
        seen = new if seen is None else seen.unionByName(new)
        if not more.get["n"]:
            return seen.select("start", "node")
        front = new.where(last).select("start", "node")
        steps = max(steps, min(2 * steps, MOST_STEPS))


def _round(steps: int) -> str:
    """(start, node, step): the nodes up to so many steps from {front}. As one
    text it is analysed once; built step by step, once for every step."""
    way = "SELECT start, node AS at, CAST(array() AS ARRAY<STRING>) AS way FROM {front}"
    for _ in range(steps):
        way = f"""SELECT start, coalesce(e.to, concat(char(0), start)) AS at, if(e.to IS NULL, way, array_append(way, e.to)) AS way
                  FROM ({way}) c LEFT JOIN {{e}} e ON c.at = e.frm"""
    return f"SELECT start, node, min(step) + 1 AS step FROM (SELECT start, posexplode(way) AS (step, node) FROM ({way})) GROUP BY start, node"


def closure(edges: DataFrame, roots: DataFrame, include_roots: bool = True) -> DataFrame:
    """(root, node): what lies below each root along edges (child, parent).

    ``include_roots`` is the path ``*`` (each root is below itself), without it
    ``+`` (a root is below itself only on a cycle). See ``reached``.
    """
    own = roots.select("root").where("root IS NOT NULL").distinct()
    down = reached(edges.select(F.col("parent").alias("frm"), F.col("child").alias("to")), own.withColumnRenamed("root", "start"))
    seen = down.withColumnRenamed("start", "root")
    return seen.unionByName(own.select("root", F.col("root").alias("node"))).distinct() if include_roots else seen


def above(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root): what each of the given nodes lies below, in one or more
    steps: the path ``+`` for all roots at once, seeded with the nodes that are
    asked about."""
    up = reached(edges.select(F.col("child").alias("frm"), F.col("parent").alias("to")), nodes.select(F.col("node").alias("start")))
    return up.select(F.col("start").alias("node"), F.col("node").alias("root"))


def all_pairs(edges: DataFrame) -> DataFrame:
    """(node, root): every pair with a way of one or more steps from child to
    parent. Ways double in length every round, so a long chain or cycle takes
    logarithmic rounds; ``closure`` is for few roots."""
    known = edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).where("node IS NOT NULL AND root IS NOT NULL").distinct()
    known = materialize(known, "pairs")
    new = known
    while not new.isEmpty():
        step = new.select("node", F.col("root").alias("mid")).join(known.withColumnRenamed("node", "mid"), "mid").select("node", "root")
        back = known.select("node", F.col("root").alias("mid")).join(new.withColumnRenamed("node", "mid"), "mid").select("node", "root")
        new = materialize(step.unionByName(back).distinct().join(known, ["node", "root"], "left_anti"), "new-pairs")
        known = known.unionByName(new)
    return known


def closure_sql(spark: SparkSession, edges: DataFrame, root: str, depth: int = 100) -> DataFrame:
    """(node): the path ``*`` of one root as a recursive query, no deeper than
    ``depth``. The root is a query parameter; a way that comes back to where it
    has been ends there, so cycles do."""
    edges.select("child", "parent").where("child IS NOT NULL AND parent IS NOT NULL").distinct().createOrReplaceTempView("codexmill_edges")
    return spark.sql(
        f"""WITH RECURSIVE below(node, way) MAX RECURSION LEVEL {int(depth)} AS (
              SELECT CAST(:root AS STRING), array(CAST(:root AS STRING))
              UNION ALL SELECT e.child, array_append(b.way, e.child) FROM below b JOIN codexmill_edges e ON e.parent = b.node WHERE NOT array_contains(b.way, e.child))
            SELECT DISTINCT node FROM below""",
        args={"root": root},
    )


def hops(edges: DataFrame, k: int) -> DataFrame:
    """(node, root): exactly ``k`` steps up, one row a route (bag semantics)."""
    e = edges.select("child", "parent")
    out = e.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    for _ in range(k - 1):
        out = out.join(e.withColumnRenamed("child", "root").withColumnRenamed("parent", "_up"), "root").select("node", F.col("_up").alias("root"))
    return out
