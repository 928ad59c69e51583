"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels whose score lies in a
window below the positive's score.

The score is the integer inner product of the vectors, each component x taken as floor(``scale`` * x). One more component brings all rows to
the largest length M (anchors: 0), so a score s is the distance sqrt(|q|^2 + M^2 - 2 s) and a window of scores is an annulus around the anchor.

A multiway hyperplane tree of ``DEPTH`` levels deals the rows to its leaves: each node has up to ``FANOUT`` split points taken from a bounded sample
(``SAMPLE`` rows), and a row goes to the subtree of its nearest split point. For every split point and every sibling subtree the node keeps the
range of the distances between them, over all rows. An anchor whose annulus cannot meet a subtree, as seen from any one
split point, leaves that subtree out. The leaves that remain are searched exactly. The first search, for positives, is a ball whose radius comes
from the sample; the second one has an annulus for each positive, its outer edge drawn in by the sample too.

Leaves are packed into bins of about ``BIN_ROWS`` rows, crowded leaves split over several; a bin and a lot of anchors meet in one task,
and the winners of the bins are merged. Anchors travel once to each bin that they visit.

Cases: rows with a null key, a null label, a null vector or any null or non-finite component take no part; zero vectors do; of vectors of unlike lengths the
shorter count as filled up with zeros; rows equal in key, label and vector count once; equal scores go to the smaller key, then to the hash of
the vector; fewer rows than asked for give all of them; an empty table gives no rows; extra columns do not matter. Scores that could
leave 63 bits raise an error."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.llm.common import col, map_batches, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Bounds of a negative's score in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Rows that split points and first radii are taken from, split points of a node, levels, sample rows below which a node is a leaf.
SAMPLE, FANOUT, DEPTH, LEAF = 4096, 16, 2, 64
#: Bins there are at least, rows of a bin, anchors of one task, and anchors multiplied at once.
BINS, BIN_ROWS, ANCHORS, _AT_ONCE = 16, 1 << 15, 1 << 13, 64
_SLACK = 1e-5


@dataclass
class Node:
    """Split points (augmented by the extra component), the leaf or node below each, and the distance ranges between points and subtrees."""

    points: np.ndarray
    below: list[Node | int]
    number: int
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _augmented(v: np.ndarray, top: float) -> np.ndarray:
    v = v.astype(np.float64)
    return np.column_stack([v, np.sqrt(np.maximum(top - (v * v).sum(1), 0))])


def _distances(a: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * (a @ points.T)
    return np.sqrt(np.maximum(square, 0))


def build(sample: np.ndarray, fanout: int = FANOUT, depth: int = DEPTH, leaf: int = LEAF) -> tuple[Node, int, int]:
    """(root, leaves, nodes) from augmented sample rows. Split points are picked one after the other, each the farthest from those before."""
    leaves, nodes = 0, 0

    def grow(rows: np.ndarray, level: int) -> Node | int:
        nonlocal leaves, nodes
        points = _spread_points(rows, fanout) if level < depth and (len(rows) > leaf or level == 0) else rows[:0]
        if len(points) < 2 and level:
            leaves += 1
            return leaves - 1
        number = nodes
        nodes += 1
        nearest = _distances(rows, points).argmin(1)
        return Node(points, [grow(rows[nearest == j], level + 1) for j in range(len(points))], number)

    root = grow(sample, 0)
    return root, leaves, nodes


def _spread_points(rows: np.ndarray, wanted: int) -> np.ndarray:
    picked = [0]
    far = _distances(rows, rows[:1])[:, 0]
    while len(picked) < min(wanted, len(rows)) and far.max() > _SLACK:
        picked.append(int(far.argmax()))
        far = np.minimum(far, _distances(rows, rows[picked[-1]][None])[:, 0])
    return rows[picked]


def descend(root: Node, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[Node, np.ndarray, np.ndarray, np.ndarray]]]:
    """Leaf of each augmented row, and per node visited: the rows, their distances to its points and their subtree."""
    leaf = np.zeros(len(rows), np.int64)
    steps, todo = [], [(root, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            leaf[at] = node
            continue
        distance = _distances(rows[at], node.points)
        nearest = distance.argmin(1)
        steps.append((node, at, distance, nearest))
        todo += [(below, at[nearest == j]) for j, below in enumerate(node.below) if (nearest == j).any()]
    return leaf, steps


def visited(root: Node, leaves: int, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float) -> np.ndarray:
    """Which leaves (columns) the annuli (inner, outer) around the augmented anchors can meet."""
    out = np.zeros((len(anchors), leaves), bool)
    todo = [(root, np.flatnonzero(inner <= outer + slack))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            out[at, node] = True
            continue
        d = _distances(anchors[at], node.points)
        for j, below in enumerate(node.below):
            low, high = node.low[:, j], node.high[:, j]
            if not np.isfinite(low[j]):
                continue  # no row at all
            least = np.maximum(low[None, :] - d, d - high[None, :]).max(1)
            most = (d + high[None, :]).min(1)
            todo.append((below, at[(least <= outer[at] + slack) & (most >= inner[at] - slack)]))
    return out


def usable(df: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """Rows (id, label, v, e) that take part, each once; ``e`` is the vector's hash."""
    v = col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    rows = df.where(col(key).isNotNull() & col(label).isNotNull() & v.isNotNull() & ~odd)
    rows = rows.select(col(key).cast("long").alias("id"), col(label).cast("long").alias("label"), whole.alias("v"))
    return rows.withColumn("e", F.xxhash64("v")).dropDuplicates(["id", "label", "v"])


def mine(
    df: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE, sample: int = SAMPLE,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchors`` is a condition on the column ``id``."""
    spark = df.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(df, key, label, vector, scale)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    widest = F.max(F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))), F.lit(0.0)))
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("top"), widest.alias("most")).first()
    if not shape["n"]:
        return spark.createDataFrame([], out)
    width, top = max(shape["width"], 1), float(shape["top"])
    if width * shape["most"] ** 2 * 100 >= 2.0**62 or shape["most"] >= 2.0**31:
        raise ValueError("scores would leave 63 bits: take a smaller scale")
    exact = np.float64 if width * shape["most"] ** 2 < 2.0**53 else np.int64
    rows = stored(rows.withColumn("v", F.col("v").cast("array<int>")), "vectors")
    taken = rows.orderBy(F.xxhash64("e", "id"), "id", "label").limit(sample).toArrow()
    known = _matrix(taken["v"].combine_chunks(), width)
    known_labels, known_ids, known_e = (taken[c].to_numpy() for c in ("label", "id", "e"))
    root, leaves, nodes = build(_augmented(known, top))

    def place(batch: pa.RecordBatch):
        leaf, _ = descend(root, _augmented(_matrix(batch.column(2), width), top))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], ["id", "label", "v", "e", "leaf"])

    def ranges(batches: Iterator[pa.RecordBatch]):
        found: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for node, _, distance, nearest in descend(root, _augmented(_matrix(batch.column(0), width), top))[1]:
                for j in np.unique(nearest):
                    part = distance[nearest == j]
                    ends = found.setdefault((node.number, int(j)), [part[0].copy(), part[0].copy()])
                    np.minimum(ends[0], part.min(0), out=ends[0])
                    np.maximum(ends[1], part.max(0), out=ends[1])
        lines = [(n, j, i, float(a), float(b)) for (n, j), ends in found.items() for i, (a, b) in enumerate(zip(*ends, strict=True))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in lines], t) for k, t in enumerate(kinds)], ["node", "j", "i", "low", "high"])

    index = stored(map_batches(rows.select("id", "label", "v", "e"), place, "id long, label long, v array<int>, e long, leaf int"), "leaves")
    # One row for each pair of split points of a node: bounded by the tree.
    table = index.select("v").mapInArrow(ranges, "node int, j int, i int, low double, high double")
    _keep_ranges(root, table.groupBy("node", "j", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    first, parts, bins = _bins(counts, leaves)
    slack = _SLACK * max(1.0, np.sqrt(top))
    kept = 2.0 * (low / 100), 2.0 * (high / 100)

    chosen = index.where(anchors).select("id", "label", "v", "e")
    lots = -(-chosen.count() // ANCHORS) or 1
    dealt = index.withColumn("bin", (_of_leaf(first) + F.pmod(F.xxhash64("id", "e"), _of_leaf(parts))).cast("int")).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))

    def bins_of(reached: np.ndarray) -> pa.Array:
        wanted = np.zeros((len(reached), bins), bool)
        for leaf in range(leaves):
            wanted[:, first[leaf] : first[leaf] + parts[leaf]] |= reached[:, leaf, None]
        return pa.array([np.flatnonzero(w).astype(np.int32) for w in wanted], pa.list_(pa.int32()))

    def leaves_of(reached: np.ndarray) -> pa.Array:
        return pa.array([np.flatnonzero(r).astype(np.int32) for r in reached], pa.list_(pa.int32()))

    def ball(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, _AT_ONCE * 4):
            part = batch.slice(at, _AT_ONCE * 4)
            v = _matrix(part.column(2), width)
            ids, labels, e = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            score = (v.astype(np.float64) @ known.T.astype(np.float64)).copy()
            own = (ids[:, None] == known_ids) & (e[:, None] == known_e) & (labels[:, None] == known_labels)
            score[(labels[:, None] != known_labels) | own] = -np.inf
            edge = np.partition(score, -positives, axis=1)[:, -positives] if len(known) >= positives else np.full(len(v), -np.inf)
            q = np.column_stack([v.astype(np.float64), np.zeros(len(v))])
            outer = np.sqrt(np.maximum((q * q).sum(1) + top - 2 * edge, 0))
            reached = visited(root, leaves, q, np.zeros(len(q)), outer, slack)
            yield pa.RecordBatch.from_arrays([*part.columns, leaves_of(reached), bins_of(reached)], ["id", "label", "v", "e", "leaves", "bins"])

    def annuli(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, _AT_ONCE * 4):
            part = batch.slice(at, _AT_ONCE * 4)
            v = _matrix(part.column(2), width)
            labels = part.column(1).to_numpy(zero_copy_only=False)
            score = v.astype(np.float64) @ known.T.astype(np.float64)
            q = np.column_stack([v.astype(np.float64), np.zeros(len(v))])
            size = (q * q).sum(1) + top
            owner, positive = _flat(part.column(4))
            # The best scores of the window in the sample bound it from below.
            seen = score[owner]
            inside = (labels[owner][:, None] != known_labels) & (100 * seen >= low * positive[:, None]) & (100 * seen <= high * positive[:, None])
            seen[~inside] = -np.inf
            edge = np.partition(seen, -negatives, axis=1)[:, -negatives] if len(known) >= negatives else np.full(len(owner), -np.inf)
            inner = np.sqrt(np.maximum(size[owner] - kept[1] * positive, 0))
            outer = np.sqrt(np.maximum(size[owner] - np.maximum(kept[0] * positive, 2 * edge), 0))
            each = visited(root, leaves, q[owner], np.where(positive >= 0, inner, 1.0), np.where(positive >= 0, outer, -np.inf), slack)
            reached = np.zeros((len(q), leaves), bool)
            np.logical_or.at(reached, owner, each)
            yield pa.RecordBatch.from_arrays([*part.columns, leaves_of(reached), bins_of(reached)], [*part.schema.names, "leaves", "bins"])

    def nearest_same(entries: dict, score: np.ndarray, anchor: dict, i: int) -> list[tuple]:
        own = (entries["id"] == anchor["id"][i]) & (entries["e"] == anchor["e"][i])
        open_ = np.flatnonzero((entries["label"] == anchor["label"][i]) & ~own & entries["reached"])
        return [(anchor["n"][i], 0, int(entries["id"][k]), int(entries["e"][k]), int(score[k])) for k in _top(score, open_, positives, entries)]

    def nearest_other(entries: dict, score: np.ndarray, anchor: dict, i: int) -> list[tuple]:
        other, lines = (entries["label"] != anchor["label"][i]) & entries["reached"], []
        for p, positive in enumerate(anchor["scores"][i]):
            open_ = np.flatnonzero(other & (100 * score >= low * positive) & (100 * score <= high * positive))
            lines += [(anchor["n"][i], p, int(entries["id"][k]), int(entries["e"][k]), int(score[k])) for k in _top(score, open_, negatives, entries)]
        return lines

    def meet(visitors: DataFrame, pick, extra: list[str]) -> DataFrame:
        """Per visitor the rows that ``pick`` takes from each bin: n (the visitor's number), p, id, e, score."""

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            lines: list[tuple] = []
            if left.num_rows and right.num_rows:
                order = np.lexsort((left["e"].to_numpy(), left["id"].to_numpy()))
                left = left.take(pa.array(order))
                entries = {c: left[c].to_numpy() for c in ("id", "label", "e", "leaf")}
                matrix = _matrix(left["v"].combine_chunks(), width).astype(exact)
                for at in range(0, right.num_rows, _AT_ONCE):
                    part = right.slice(at, _AT_ONCE)
                    anchor = {c: part[c].to_numpy() for c in ("n", "id", "label", "e")}
                    if extra:
                        anchor["scores"] = part["scores"].to_pylist()
                    scores = _matrix(part["v"].combine_chunks(), width).astype(exact) @ matrix.T
                    for i, reached in enumerate(part["leaves"].to_pylist()):
                        entries["reached"] = np.isin(entries["leaf"], reached)
                        lines += pick(entries, scores[i], anchor, i)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.table([pa.array([x[k] for x in lines], t) for k, t in enumerate(kinds)], ["n", "p", "id", "e", "score"])

        asked = visitors.withColumn("bin", F.explode("bins")).withColumn("lot", F.pmod(F.xxhash64("n"), F.lit(lots)).cast("int"))
        a = dealt.select("bin", "lot", "id", "label", "v", "e", "leaf").groupBy("bin", "lot")
        b = asked.select("bin", "lot", "n", "id", "label", "v", "e", "leaves", *extra).groupBy("bin", "lot")
        return a.cogroup(b).applyInArrow(work, "n long, p int, id long, e long, score long")

    number = F.xxhash64("id", "e", "label")
    kind = "id long, label long, v array<int>, e long"
    asked = map_batches(chosen, ball, f"{kind}, leaves array<int>, bins array<int>").withColumn("n", number)
    best = Window.partitionBy("n", "p").orderBy(F.desc("score"), "id", "e")
    near = meet(asked, nearest_same, []).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    lists = stored(near.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found")), "positives")
    again = chosen.withColumn("n", number).join(lists, "n")
    with_scores = again.select("id", "label", "v", "e", F.col("found.score").alias("scores"), F.col("found.id").alias("positives"))
    asked = map_batches(with_scores, annuli, f"{kind}, scores array<long>, positives array<long>, leaves array<int>, bins array<int>").withColumn("n", number)
    asked = stored(asked, "windows")
    found = meet(asked, nearest_other, ["scores"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.select("n", "p", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = named.join(asked.select("n", F.col("id").alias("anchor_id"), "positives", "scores"), "n")
    return joined.select(
        "anchor_id", F.get("positives", F.col("p")).alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id", F.get("scores", F.col("p")).alias("positive_score"), "negative_score"
    )


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _top(score: np.ndarray, among: np.ndarray, wanted: int, entries: dict) -> np.ndarray:
    """The ``wanted`` best of ``among``, which is in the order that settles ties."""
    if len(among) > wanted:
        edge = -np.partition(-score[among], wanted - 1)[wanted - 1]
        among = among[score[among] >= edge]
    return among[np.argsort(-score[among], kind="stable")][:wanted]


def _keep_ranges(root: Node, found: list) -> None:
    nodes, todo = {}, [root]
    while todo:
        node = todo.pop()
        if not isinstance(node, int):
            nodes[node.number] = node
            size = len(node.points)
            node.low, node.high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
            todo += node.below
    for r in found:
        node = nodes[r["node"]]
        node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"], r["high"]


def _bins(counts: dict[int, int], leaves: int) -> tuple[list[int], list[int], int]:
    """(first bin of each leaf, bins of each leaf, number of bins): small leaves share a bin with their neighbours, crowded ones fill several."""
    total = sum(counts.values())
    room = max(1, min(BIN_ROWS, -(-total // BINS)))
    first, parts, at, used = [], [], 0, 0
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if n > room:
            if used:
                at, used = at + 1, 0
            first.append(at)
            parts.append(-(-n // room))
            at += parts[-1]
            continue
        if used and used + n > room:
            at, used = at + 1, 0
        first.append(at)
        parts.append(1)
        used += n
    return first, parts, at + 1


def _of_leaf(values: list[int]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in values]), F.col("leaf"))
