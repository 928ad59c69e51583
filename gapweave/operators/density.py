"""Density clustering of 2-D points on a grid, without neighbour pair lists.

Cells have a diagonal of eps: points of one cell are always neighbours, so a cell with ``min_samples``
points is dense as a whole and never compared inside. Only points of thin cells are counted against the
25 cells around them. Whether two cells touch is decided on bounding boxes that are split further only
while the answer is open."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gapweave.functions.scalars import quoted
from gapweave.operators.joins import lookup_join, running_total
from gapweave.operators.windows import frame_digest
from gapweave.session import cut

# Distinct points of one cell that share a join key.
_SLICE = 4096
_DIRECT_PAIRS = 1024
_MAX_LEVEL = 24


def _points(df: DataFrame, key: str, x: str, y: str, eps: float) -> DataFrame:
    """Distinct coordinates with their row count, lowest key and cell."""
    side = eps / math.sqrt(2.0) * (1 - 1e-9)
    px, py = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    rows = df.where(px.isNotNull() & py.isNotNull()).select(F.col(quoted(key)).alias("key"), (px + 0.0).alias("x"), (py + 0.0).alias("y"))
    return (
        rows.groupBy("x", "y")
        .agg(F.count("*").alias("n"), F.min("key").alias("key"))
        .withColumn("u", F.col("x") / F.lit(side))
        .withColumn("v", F.col("y") / F.lit(side))
        .withColumn("cx", F.floor("u"))
        .withColumn("cy", F.floor("v"))
    )


def _around(df: DataFrame) -> DataFrame:
    """Copies of each row for the 25 cells around it (columns tx, ty)."""
    steps = F.sequence(F.lit(-2), F.lit(2))
    return df.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps)).withColumn("tx", F.col("cx") + F.col("dx")).withColumn(
        "ty", F.col("cy") + F.col("dy")
    ).drop("dx", "dy")


def _meet(few: DataFrame, many: DataFrame, eps: float) -> DataFrame:
    """Rows of ``few`` next to rows of ``many`` at a distance of at most eps. ``few`` holds fewer than
    ``min_samples`` points per cell; a crowded cell of ``many`` is read in slices, each its own join key."""
    slices = many.groupBy("cx", "cy").agg(F.ceil(F.count("*") / F.lit(_SLICE)).cast("int").alias("slices"))
    b = lookup_join(many, slices, ["cx", "cy"], "inner").withColumn("slice", F.pmod(F.xxhash64("x", "y"), F.col("slices")).cast("int"))
    b = b.drop("slices").withColumnsRenamed({"cx": "tx", "cy": "ty", "x": "bx", "y": "by"})
    a = _around(few.select("cx", "cy", F.col("x").alias("ax"), F.col("y").alias("ay"))).drop("cx", "cy")
    a = lookup_join(a, slices.withColumnsRenamed({"cx": "tx", "cy": "ty"}), ["tx", "ty"], "inner")
    a = a.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
    return a.join(b, ["tx", "ty", "slice"]).where(dx * dx + dy * dy <= eps * eps)


def _with_core(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    sizes = points.groupBy("cx", "cy").agg(F.sum("n").alias("cell_n"))
    placed = lookup_join(points, sizes, ["cx", "cy"], "inner")
    dense = F.col("cell_n") >= min_samples
    thin = placed.where(~dense)
    degree = (
        _meet(thin, points.select("cx", "cy", "x", "y", "n"), eps)
        .groupBy(F.col("ax").alias("x"), F.col("ay").alias("y"))
        .agg(F.sum("n").alias("degree"))
    )
    thin = thin.join(degree, ["x", "y"], "left").withColumn("core", F.coalesce("degree", F.lit(0)) >= min_samples).drop("degree")
    return placed.where(dense).withColumn("core", F.lit(True)).unionByName(thin)


def core_points(df: DataFrame, key: str, x: str, y: str, eps: float, min_samples: int) -> DataFrame:
    """(key, is_core): rows with at least ``min_samples`` rows, themselves included, within eps."""
    marked = _with_core(cut(_points(df, key, x, y, eps)), eps, min_samples).select("x", "y", "core")
    return _to_rows(df, key, x, y, marked).select("key", F.coalesce("core", F.lit(False)).alias("is_core")).withColumnRenamed("key", key)


def _to_rows(df: DataFrame, key: str, x: str, y: str, table: DataFrame) -> DataFrame:
    rows = df.select(
        F.col(quoted(key)).alias("key"), (F.col(quoted(x)).cast("double") + 0.0).alias("x"), (F.col(quoted(y)).cast("double") + 0.0).alias("y")
    )
    return lookup_join(rows, table, ["x", "y"])


def _box() -> list[Column]:
    return [F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("m")]


def _gap(side: str) -> Column:
    a0, a1, b0, b1 = (F.col(f"{p}_{side}{i}") for p in ("a", "b") for i in (0, 1))
    return F.greatest(F.lit(0.0), a0 - b1, b0 - a1)


def _reach(side: str) -> Column:
    a0, a1, b0, b1 = (F.col(f"{p}_{side}{i}") for p in ("a", "b") for i in (0, 1))
    return F.greatest(a1 - b0, b1 - a0)


def _judge(pairs: DataFrame, eps: float) -> DataFrame:
    """Drop box pairs that cannot touch; ``sure`` marks those that must."""
    near, far = _gap("x") * _gap("x") + _gap("y") * _gap("y"), _reach("x") * _reach("x") + _reach("y") * _reach("y")
    return pairs.where(near <= eps * eps).withColumn("sure", far <= eps * eps)


def _prefixed(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"{prefix}_{n}" for n in names})


def _touching_cells(core: DataFrame, eps: float) -> DataFrame:
    """(a, b) node ids of neighbouring cells with a pair of core points within eps."""
    boxes = core.groupBy("cx", "cy").agg(F.min("key").alias("node"), *_box())
    names = ["node", "x0", "x1", "y0", "y1", "m"]
    a = _prefixed(_around(boxes), "a", names).where((F.col("tx") > F.col("cx")) | ((F.col("tx") == F.col("cx")) & (F.col("ty") > F.col("cy"))))
    b = _prefixed(boxes, "b", names).withColumnsRenamed({"cx": "tx", "cy": "ty"})
    judged = cut(_judge(a.drop("cx", "cy").join(b, ["tx", "ty"]).drop("tx", "ty"), eps))
    found = judged.where("sure").select("a_node", "b_node")
    nodes = lookup_join(core, boxes.select("cx", "cy", "node"), ["cx", "cy"], "inner").drop("key").select("node", "x", "y", "u", "v")
    # Sub-boxes of level L are cells of 1/4^L the side; powers of four keep the nesting exact.
    open_pairs = judged.where("not sure").withColumns({f"{p}_{i}": F.lit(None).cast("long") for p in ("a", "b") for i in ("iu", "iv")})
    nodes = cut(nodes)
    for level in range(1, _MAX_LEVEL + 1):
        small = F.col("a_m") * F.col("b_m") <= _DIRECT_PAIRS
        if level == _MAX_LEVEL:
            small = F.lit(True)
        found = found.unionByName(_compare_directly(open_pairs.where(small), nodes, level - 1, eps))
        large = open_pairs.where(~small)
        if level == _MAX_LEVEL or large.limit(1).count() == 0:
            break
        step = float(4**level)
        subs = nodes.groupBy("node", F.floor(F.col("u") * step).alias("iu"), F.floor(F.col("v") * step).alias("iv")).agg(*_box())
        sub_names = ["x0", "x1", "y0", "y1", "m", "iu", "iv"]

        def children(prefix: str) -> DataFrame:
            named = _prefixed(subs, prefix, ["node", *sub_names])
            if level == 1:
                return named
            return named.withColumn(f"{prefix}_pu", F.shiftright(f"{prefix}_iu", 2)).withColumn(f"{prefix}_pv", F.shiftright(f"{prefix}_iv", 2))

        parents = large.select("a_node", "b_node", *[F.col(f"{p}_i{w}").alias(f"{p}_p{w}") for p in ("a", "b") for w in ("u", "v")])
        on = lambda p: [f"{p}_node"] if level == 1 else [f"{p}_node", f"{p}_pu", f"{p}_pv"]
        if level == 1:
            parents = parents.select("a_node", "b_node")
        split = parents.join(children("a"), on("a")).join(children("b"), on("b"))
        judged = cut(_judge(split.select("a_node", "b_node", *[f"{p}_{n}" for p in ("a", "b") for n in sub_names]), eps))
        sure = judged.where("sure").select("a_node", "b_node").distinct()
        found = found.unionByName(sure)
        open_pairs = judged.where("not sure").join(sure, ["a_node", "b_node"], "left_anti")
    return found.distinct()


def _compare_directly(pairs: DataFrame, nodes: DataFrame, level: int, eps: float) -> DataFrame:
    step = float(4**level)
    keyed = nodes if level == 0 else nodes.withColumn("iu", F.floor(F.col("u") * step)).withColumn("iv", F.floor(F.col("v") * step))
    ids = ["node"] if level == 0 else ["node", "iu", "iv"]
    slim = pairs.select(*[f"{p}_{i}" for p in ("a", "b") for i in ids])
    for p in ("a", "b"):
        slim = slim.join(_prefixed(keyed.select(*ids, "x", "y"), p, [*ids, "x", "y"]), [f"{p}_{i}" for i in ids])
    dx, dy = F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")
    return slim.where(dx * dx + dy * dy <= eps * eps).select("a_node", "b_node").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", edge_rows: int = 20_000) -> DataFrame:
    """(node, component): connected components; the component is its lowest node.

    An edge list of checked size is joined on the driver. A larger one goes through alternating star
    contraction, where each step only aggregates minima, so a hub never gathers its neighbours in one task."""
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    few = links.limit(edge_rows + 1).collect()
    if len(few) <= edge_rows:
        return _join_few(links, few)
    links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup_join(both, lowest, ["u"], "inner").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where(F.col("u") != F.col("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, lowest, ["u"], "inner").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"), "m", F.col("u").alias("o"))
        small = small.select("u", "v").where(F.col("u") != F.col("v")).unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        new = cut(small)
        same = frame_digest(new.select("u", "v")) == frame_digest(links.select("u", "v"))
        links = new
        if same:
            break
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _join_few(links: DataFrame, few: list) -> DataFrame:
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in few:
        ru, rv = find(u), find(v)
        root[max(ru, rv)] = min(ru, rv)
    kind = links.schema["u"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("component", kind)])
    return links.sparkSession.createDataFrame([(x, find(x)) for x in list(root)], schema)


def density_clusters(df: DataFrame, key: str, x: str, y: str, eps: float, min_samples: int = 2, numbered: bool = True) -> DataFrame:
    """(key, cluster): clusters numbered by their lowest core key, -1 for noise; a border point joins the
    lowest-numbered cluster in reach. ``numbered=False`` returns the lowest core key, null for noise."""
    points = cut(_points(df, key, x, y, eps))
    marked = cut(_with_core(points, eps, min_samples))
    core = marked.where("core")
    nodes = core.groupBy("cx", "cy").agg(F.min("key").alias("node"))
    linked = components(_touching_cells(core, eps), "a_node", "b_node")
    labelled = nodes.join(linked, "node", "left").select("cx", "cy", F.coalesce("component", "node").alias("label"))
    core_labels = cut(lookup_join(core.select("cx", "cy", "x", "y"), labelled, ["cx", "cy"], "inner"))
    border = (
        _meet(marked.where("not core"), core_labels, eps)
        .groupBy(F.col("ax").alias("x"), F.col("ay").alias("y"))
        .agg(F.min("label").alias("label"))
    )
    table = core_labels.select("x", "y", "label").unionByName(border)
    if numbered:
        numbers = running_total(labelled.select("label").distinct().withColumn("one", F.lit(1)), [F.col("label")], "one", "cluster")
        table = lookup_join(table, numbers.select("label", (F.col("cluster") - 1).alias("cluster")), ["label"], "inner")
        out = _to_rows(df, key, x, y, table.select("x", "y", "cluster"))
        return out.select(F.col("key").alias(key), F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
    return _to_rows(df, key, x, y, table).select(F.col("key").alias(key), F.col("label").alias("cluster"))


def profile_clusters(
    profile: DataFrame, key: str = "column", fill: str = "fill_pct", unique: str = "unique_pct", eps_values=(1, 2, 3, 5, 10), min_fills=(0, 25, 50, 75)
) -> DataFrame:
    """Density clusters of a points table for a grid of eps and least fill: (min_fill, eps, key, cluster)."""
    out = None
    for least in min_fills:
        rows = profile.where((F.col(quoted(fill)) >= least) & (F.col(quoted(fill)) <= 100))
        for eps in eps_values:
            part = density_clusters(rows, key, fill, unique, float(eps)).select(F.lit(least).alias("min_fill"), F.lit(eps).alias("eps"), quoted(key), "cluster")
            out = part if out is None else out.unionByName(part)
    return out
