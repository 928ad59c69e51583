"""Exact k-nearest-neighbour join over numeric features, with gaps allowed on both sides.

Distance: sqrt(features / shared * sum of squared differences over the features present on both sides).
Ties go to the lower donor key. Rows with equal feature vectors are collapsed first: a query vector is
searched once, and of equal donors only the k lowest keys can ever be chosen, so hot copies cost nothing.

Donors lie in the cells of a metric index (``metric_index``). A query is first compared with the nearest cells that hold k usable donors; the k-th
distance found there then leaves out every cell whose bound lies beyond it. A donor table of checked size travels to the
query tasks together with its index. A larger one is dealt by shelves of cells, and a query goes once to each shelf that it reaches; the winners
of the shelves are merged. No pair list is written on either way. Matrix products leave out far pairs with a bound on their rounding; distances that
are compared or returned are summed pair by pair."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from gapweave.functions.scalars import quoted
from gapweave.operators.joins import settle
from gapweave.operators.metric_index import MAX_PATTERNS, SAMPLE_ROWS, Cells, Pivots
from gapweave.session import cut, partitions

DONOR_ROWS = 50_000
#: Donors that are compared in full without an index.
INDEXED_ROWS = 1024
#: Donors of one shelf (cells that travel together) and numbers in it, and queries that one task compares with it.
PART_ROWS, PART_NUMBERS, LOT_ROWS = 1 << 15, 1 << 21, 1 << 15
#: Queries whose cells are looked up together, numbers of one slice of distances, and features up to which differences are summed directly.
_TOGETHER, _SLICE, _DIRECT = 16, 1 << 20, 4
_HITS = "target int, near double, distance double, donor {kind}, value string"


def _matrix(vectors) -> np.ndarray:
    return np.array([[np.nan if x is None else x for x in v] for v in vectors], dtype=float)


def _rows_of(cells: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Matrix of a column of equally long vectors; gaps become NaN."""
    if cells.null_count:
        raise ValueError("a vector is null")
    numbers = pc.list_flatten(cells).to_numpy(zero_copy_only=False) if isinstance(cells, pa.Array) else pc.list_flatten(cells).to_numpy()
    return np.asarray(numbers, dtype=float).reshape(len(cells), len(numbers) // max(len(cells), 1))


def significant(x, digits: int) -> np.ndarray:
    """Rounded to ``digits`` decimals behind the first digit that is not 0, so small scales lose nothing."""
    x = np.asarray(x, dtype=float)
    sized = np.isfinite(x) & (x > 0)
    unit = 10.0 ** np.floor(np.log10(np.where(sized, x, 1.0)))
    return np.where(sized, np.round(x / unit, digits) * unit, x)


def _kth(block: np.ndarray, k: int) -> np.ndarray:
    """At least the k-th smallest number of every row; of a wide block that of the least numbers of its slices."""
    width = block.shape[1]
    if width > 128 * k:
        block = block[:, : width // 32 * 32].reshape(len(block), 32, -1).min(1)
    if block.shape[1] < k:
        return np.full(len(block), np.inf)
    return np.partition(block, k - 1, axis=1)[:, k - 1]


class _Found:
    """Pairs of (query row, donor position, squared distance) of one target."""

    def __init__(self, rows: np.ndarray, at: np.ndarray, square: np.ndarray):
        self.rows, self.at, self.square = rows, at, square

    def with_(self, other: _Found) -> _Found:
        return _Found(*(np.concatenate(x) for x in ((self.rows, other.rows), (self.at, other.at), (self.square, other.square))))

    def best(self, k: int, digits: int) -> tuple[_Found, np.ndarray]:
        """The k nearest of every row, compared after rounding, ties in key order; and the rounded squares."""
        near = significant(self.square, digits)
        order = np.lexsort((self.at, near, self.rows))
        rows = self.rows[order]
        start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
        rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        order = order[rank < k]
        return _Found(self.rows[order], self.at[order], self.square[order]), near[order]


class _Donors:
    """A bounded set of donors in key order, with the values they can give per target, and on request their index or cells."""

    def __init__(self, keys, vectors, values, digits: int, index: Pivots | None = None, cell: np.ndarray | None = None):
        self.keys = keys if isinstance(keys, pa.Array) else pa.array(keys)
        matrix = (vectors if isinstance(vectors, np.ndarray) else _matrix(vectors)).reshape(len(keys), -1)
        self.present = ~np.isnan(matrix)
        self.complete = self.present.all(0)
        self.columns = np.ascontiguousarray(np.nan_to_num(matrix).T)
        self.values = values if isinstance(values, pa.Array) else pa.array([x for v in values for x in v], pa.string())
        self.digits = digits
        self.targets = len(self.values) // len(keys) if len(keys) else 0
        self.usable = self.values.is_valid().to_numpy(zero_copy_only=False).reshape(len(keys), self.targets)
        self.visited = 0  # pairs compared, for those who want to know
        self.cells = None
        if index is not None and len(keys):
            cell, distance, own = index.place(matrix)
            self.cells = Cells.empty(index, self.targets)
            self.cells.add(cell, distance, own, matrix, self.usable)
        self.cell = cell
        if cell is not None:
            # Positions of a cell's donors, in key order.
            order = np.argsort(cell, kind="stable")
            count = index.cells if index is not None else int(cell.max(initial=-1)) + 1
            self._members = np.split(order, np.cumsum(np.bincount(cell, minlength=count))[:-1])

    @classmethod
    def of(cls, table: pa.Table, digits: int, index: Pivots | None = None) -> _Donors:
        """Of a table of key, vec, values and perhaps cell."""
        table = table.take(pc.sort_indices(table["key"], sort_keys=[("key", "ascending")], null_placement="at_end")).combine_chunks()
        column = lambda name: pa.concat_arrays(table[name].chunks) if table.num_rows else pa.array([], table.schema.field(name).type)
        cell = table["cell"].to_numpy().astype(np.int64) if "cell" in table.column_names else None
        return cls(column("key"), _rows_of(table["vec"]), pc.list_flatten(column("values")), digits, index, cell)

    def squared(self, q: np.ndarray, among: np.ndarray | slice) -> np.ndarray:
        """Scaled squared distances of query rows with one gap pattern; infinite without a shared feature."""
        columns, present = self.columns[:, among], self.present[among]
        total = np.zeros((len(q), columns.shape[1]))
        shared = np.zeros(columns.shape[1])
        features = np.flatnonzero(~np.isnan(q[0])) if len(q) else []
        for j in features:
            diff = q[:, j, None] - columns[j][None, :]
            diff *= diff
            if not present[:, j].all():
                diff *= present[:, j]
            total += diff
            shared += present[:, j]
        return self._scaled(total, shared, q.shape[1])

    @staticmethod
    def _scaled(total: np.ndarray, shared: np.ndarray, width: int) -> np.ndarray:
        if (shared < width).any():
            with np.errstate(divide="ignore"):
                total *= np.where(shared > 0, width / np.maximum(shared, 1), 1.0)
            total[..., shared == 0] = np.inf
        return total

    def _estimated(self, q: np.ndarray, among: np.ndarray | slice, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by matrix products, and by how much each row's may be off."""
        x = self.columns[features][:, among]
        q = q[:, features]
        squares = (x * x).sum(0)
        own = (q * q).sum(1)
        width = len(self.columns)
        with np.errstate(over="ignore", invalid="ignore"):
            total = (-2.0 * q) @ x
            total += squares
            if self.complete[features].all():
                total += own[:, None]
                shared = np.full(x.shape[1], float(len(features)))
            else:
                present = self.present[among][:, features].T.astype(float)
                total += (q * q) @ present
                shared = present.sum(0)
            total = self._scaled(total, shared, width)
        return total, 1e-14 * (width + 8) * width * (own + squares.max(initial=0.0))

    def _pairs(self, q: np.ndarray, among: np.ndarray, at: np.ndarray, rows: np.ndarray, features) -> np.ndarray:
        """Exact scaled squared distances of single pairs, summed in the order of ``squared``."""
        total, shared = np.zeros(len(rows)), np.zeros(len(rows))
        where = among[at]
        for j in features:
            diff = q[rows, j] - self.columns[j][where]
            diff *= diff
            if self.complete[j]:
                shared += 1.0
            else:
                have = self.present[where, j]
                diff *= have
                shared += have
            total += diff
        return self._scaled(total, shared, q.shape[1])

    def _near(self, q: np.ndarray, among: np.ndarray, targets: Sequence[int], k: int, edge: np.ndarray | None = None, allowed: np.ndarray | None = None) -> list[_Found]:
        """Per target the pairs that can be among the k nearest of a row: of donors at ``among``, no farther than ``edge`` (rows x targets),
        in the cells that the row is ``allowed`` (rows x cells)."""
        features = np.flatnonzero(~np.isnan(q[0]))
        self.visited += len(q) * len(among)
        if len(features) <= _DIRECT:
            total, off = self.squared(q, among), np.zeros(len(q))
        else:
            total, off = self._estimated(q, among, features)
            unknown = ~np.isfinite(off)
            if unknown.any():
                total[unknown], off[unknown] = self.squared(q[unknown], among), 0.0
        if allowed is not None and not allowed.all():
            total = np.where(allowed[:, self.cell[among]], total, np.inf)
        out = []
        for i, t in enumerate(targets):
            usable = np.flatnonzero(self.usable[among, t])
            block = total if len(usable) == len(among) else total[:, usable]
            limit = _kth(block, k) if block.shape[1] else np.zeros(len(q))
            loose = 1 + 20 * 10.0**-self.digits
            limit = (limit + off) * loose + off
            if edge is not None:
                limit = np.minimum(limit, edge[:, i] * loose + off)
            rows, at = np.nonzero(block <= limit[:, None])
            sure = np.isfinite(block[rows, at])
            rows, at = rows[sure], usable[at[sure]]
            square = self._pairs(q, among, at, rows, features) if len(features) > _DIRECT else total[rows, at]
            out.append(_Found(rows, among[at], square))
        return out

    def _edges(self, found: Sequence[_Found], count: int, k: int) -> np.ndarray:
        """k-th squared distance found per row and target; infinite where fewer were found."""
        edge = np.full((count, len(found)), np.inf)
        for i, f in enumerate(found):
            best, _ = f.best(k, self.digits)
            if len(best.rows):
                full = np.bincount(best.rows, minlength=count) >= k
                top = np.zeros(count)
                np.maximum.at(top, best.rows, best.square)
                edge[full, i] = top[full]
        return edge

    def _compared(self, q: np.ndarray, targets: list[int], k: int, edge: np.ndarray | None, allowed: np.ndarray | None) -> Iterator[tuple[np.ndarray, list[_Found]]]:
        """(rows of q, pairs per target): whatever can hold a neighbour of these rows."""
        if allowed is not None:
            # Queries that visit the same cells together.
            order = np.lexsort((allowed.sum(1), allowed.argmax(1)))
            for low in range(0, len(order), _TOGETHER):
                rows = order[low : low + _TOGETHER]
                seen = allowed[rows].any(0)
                yield rows, self._near(q[rows], self._in(seen), targets, k, None if edge is None else edge[rows], allowed[rows])
            return
        if self.cells is None:
            everyone = np.arange(len(self.keys))
            step = max(1, _SLICE // len(self.keys))
            for start in range(0, len(q), step):
                rows = np.arange(start, min(start + step, len(q)))
                yield rows, self._near(q[rows], everyone, targets, k, None if edge is None else edge[rows])
            return
        for low in range(0, len(q), 1024):
            least, most = self.cells.bounds(q[low : low + 1024])
            first = self.cells.enough(most, targets, k)
            # Queries of one neighbourhood together, so that they need the same cells.
            order = np.lexsort((least.argmin(1), most.argmin(1)))
            for start in range(0, len(order), _TOGETHER):
                rows = order[start : start + _TOGETHER]
                seen = first[rows].any(0)
                part = q[low + rows]
                found = self._near(part, self._in(seen), targets, k)
                edges = self._edges(found, len(rows), k)
                more = self.cells.reached(least[rows], edges, targets).any(0) & ~seen
                if more.any():
                    found = [a.with_(b) for a, b in zip(found, self._near(part, self._in(more), targets, k, edges), strict=True)]
                yield low + rows, found

    def _in(self, cells: np.ndarray) -> np.ndarray:
        parts = [self._members[i] for i in np.flatnonzero(cells[: len(self._members)])]
        return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def search(self, vectors, wanted, k: int, edges: Sequence[dict[int, float]] | None = None, allowed: np.ndarray | None = None) -> Iterator[pa.Table]:
        """Hits of the query vectors as (query, target, near, distance, donor, value), ``query`` being the vector's position. ``edges``: squared distances per target
        beyond which nothing is asked for; ``allowed``: the cells that each query visits."""
        if not len(self.keys) or not len(vectors):
            return
        queries = vectors if isinstance(vectors, np.ndarray) else _matrix(vectors)
        held: list[tuple] = []
        for places, targets in _alike(queries, wanted):
            edge = None if edges is None else np.array([[edges[i].get(t, np.inf) for t in targets] for i in places]).reshape(len(places), len(targets))
            for part, found in self._compared(queries[places], targets, k, edge, None if allowed is None else allowed[places]):
                for t, f in zip(targets, found, strict=True):
                    best, near = f.best(k, self.digits)
                    held.append((places[part][best.rows], t, near, best))
                if sum(len(h[2]) for h in held) >= 20_000:
                    yield self._table(held)
                    held = []
        if held:
            yield self._table(held)

    def _table(self, held: list[tuple]) -> pa.Table:
        at = np.concatenate([b.at for *_, b in held])
        target = np.concatenate([np.full(len(n), t, np.int64) for _, t, n, _ in held])
        return pa.table(
            {
                "query": np.concatenate([q for q, *_ in held]).astype(np.int64),
                "target": target.astype(np.int32),
                "near": np.concatenate([n for _, _, n, _ in held]),
                "distance": np.sqrt(np.concatenate([b.square for *_, b in held])),
                "donor": self.keys.take(pa.array(at)),
                "value": self.values.take(pa.array(at * self.targets + target)),
            }
        )


def _alike(queries: np.ndarray, wanted) -> list[tuple[np.ndarray, list[int]]]:
    """(positions, wanted targets) of the queries that are alike in gaps and targets."""
    groups: dict[tuple, list[int]] = {}
    gaps = np.isnan(queries)
    for i, w in enumerate(wanted):
        groups.setdefault((gaps[i].tobytes(), tuple(sorted(set(w)))), []).append(i)
    return [(np.array(places), list(targets)) for (_, targets), places in groups.items()]


def _distinct_donors(donors: DataFrame, k: int) -> DataFrame:
    """At most k donors per (vector, set of usable targets); the row limit is applied before the shuffle."""
    pattern = F.transform("values", lambda v: v.isNotNull())
    w = Window.partitionBy("vec", pattern).orderBy("key")
    return donors.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def nearest(
    queries: DataFrame,
    donors: DataFrame,
    k: int = 5,
    donor_rows: int = DONOR_ROWS,
    digits: int = 9,
) -> DataFrame:
    """(vec, target, rank, distance, donor, value): the k nearest usable donors per query vector and target.

    ``queries``: vec array<double>, wanted array<int> (positions of the targets to fill).
    ``donors``: key, vec, values array<string>; a donor serves a target if that value is not null.
    Squared distances are compared after rounding to ``digits`` decimals of their leading digit, so the choice
    among equals is stable at any scale."""
    spark = queries.sparkSession
    queries = queries.groupBy("vec").agg(F.array_distinct(F.flatten(F.collect_set("wanted"))).alias("wanted"))
    # Round robin: a hash repartition on the grouping key would be dropped and the few bytes coalesced
    # into one task, although each row is a long search.
    queries = queries.repartition(partitions(spark))
    donors = _distinct_donors(donors.select("key", "vec", "values"), k)
    donors, small = settle(donors, donor_rows)
    kind = donors.schema["key"].dataType.simpleString()
    w = Window.partitionBy("vec", "target").orderBy("near", "donor")
    if not small:
        return _cell_search(queries, donors, k, digits)
    table = donors.toArrow()
    index = _index_of(table) if table.num_rows > INDEXED_ROWS else None
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    shared = spark.sparkContext.broadcast((sink.getvalue().to_pybytes(), index))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = shared.value
        pool = _Donors.of(pa.ipc.open_stream(held).read_all(), digits, index)
        for batch in batches:
            for hits in pool.search(_rows_of(batch["vec"]), batch["wanted"].to_pylist(), k):
                yield from _named(hits, "vec", batch["vec"]).to_batches()

    hits = queries.mapInArrow(search, "vec array<double>, " + _HITS.format(kind=kind))
    return hits.withColumn("rank", F.row_number().over(w)).select("vec", "target", "rank", "distance", "donor", "value")


def _named(hits: pa.Table, name: str, column: pa.Array) -> pa.Table:
    """Hits with a column of their queries in the place of the position."""
    return hits.set_column(0, name, column.take(hits["query"].combine_chunks()))


def _index_of(table: pa.Table) -> Pivots:
    matrix = _rows_of(table["vec"])
    # Learned in the order of the keys, as the donors are held.
    matrix = matrix[pc.sort_indices(table["key"], sort_keys=[("key", "ascending")], null_placement="at_end").to_numpy()]
    kinds, counts = np.unique(~np.isnan(matrix), axis=0, return_counts=True)
    common = np.argsort(-counts, kind="stable")[:MAX_PATTERNS]
    return Pivots.learn(matrix[:: -(-len(matrix) // SAMPLE_ROWS)], {tuple(kinds[i].tolist()): int(counts[i]) for i in common})


# --- cells over the cluster ------------------------------------------------------------------------


def _learned(donors: DataFrame) -> Pivots:
    """Pivots from the counts of the commonest gap patterns and a bounded sample of donors: those of the lowest hashes, and one row of each counted pattern."""
    pattern = F.transform("vec", lambda v: v.isNotNull())
    kinds = donors.groupBy(pattern.alias("p")).agg(F.count("*").alias("n"), F.min("vec").alias("vec")).orderBy(F.desc("n"), "p").limit(MAX_PATTERNS).collect()
    total = donors.count()
    share = F.pmod(F.xxhash64("key", "vec"), F.lit(1 << 20)) <= int(min(1.0, SAMPLE_ROWS / max(total, 1)) * (1 << 20))
    rows = [list(r["vec"]) for r in donors.where(share).select("vec").limit(2 * SAMPLE_ROWS).collect()]
    sample = _matrix([*rows, *[list(r["vec"]) for r in kinds]])
    return Pivots.learn(sample, {tuple(r["p"]): r["n"] for r in kinds})


def _described(placed: DataFrame, pivots: Pivots, targets: int) -> Cells:
    """The cells as all donors make them: one row a cell comes to the driver."""
    width = pivots.patterns.shape[1]
    at = lambda name, i: F.get(name, F.lit(i))
    inside = lambda i: F.get("inside", F.lit(i))
    rows = (
        placed.groupBy("cell")
        .agg(
            F.count("*").alias("n"),
            F.max("away").alias("radius"),
            F.bool_and("own").alias("pure"),
            F.array(*[F.sum(at("values", t).isNotNull().cast("long")) for t in range(targets)]).alias("usable"),
            F.array(*[F.min(F.when(inside(i), at("vec", i))) for i in range(width)]).alias("low"),
            F.array(*[F.max(F.when(inside(i), at("vec", i))) for i in range(width)]).alias("high"),
        )
        .collect()
    )
    cells = Cells.empty(pivots, targets)
    for r in rows:
        c = r["cell"]
        cells.rows[c], cells.radius[c], cells.pure[c], cells.usable[c] = r["n"], r["radius"], r["pure"], r["usable"]
        cells.low[c] = [np.inf if x is None else x for x in r["low"]]
        cells.high[c] = [-np.inf if x is None else x for x in r["high"]]
    return cells


def _shelves(cells: Cells, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shelf, shelves) of every cell: neighbouring cells share a shelf while it holds few rows, a crowded cell takes several for itself."""
    room = max(1, min(PART_ROWS, PART_NUMBERS // max(width, 1)))
    first, parts = np.zeros(len(cells.rows), np.int64), np.maximum(-(-cells.rows // room), 1)
    shelf, held = 0, 0
    for c, n in enumerate(cells.rows):
        if held and held + n > room:
            shelf, held = shelf + 1, 0
        first[c] = shelf
        held += n
        if parts[c] > 1:
            shelf, held = shelf + int(parts[c]), 0
    return first, parts


def _visits(picked: np.ndarray, first: np.ndarray, parts: np.ndarray) -> tuple[list[list[int]], list[list[bytes]]]:
    """Per query the shelves of its cells, and the cells on each as packed bits."""
    shelves, inside = [[] for _ in picked], [[] for _ in picked]
    for shelf in range(int((first + parts).max(initial=0))):
        on = np.flatnonzero((first <= shelf) & (shelf < first + parts))
        if not len(on):
            continue
        bits = picked[:, on]
        packed = np.packbits(bits, axis=1)
        for i in np.flatnonzero(bits.any(1)):
            shelves[i].append(shelf)
            inside[i].append(packed[i].tobytes())
    return shelves, inside


def _cell_search(queries: DataFrame, donors: DataFrame, k: int, digits: int) -> DataFrame:
    """Both searches over the cluster. Cells lie on shelves, which hold as many donors as one task may; donors are written once and dealt by shelf. A query goes once
    to each shelf that has cells it reaches, whatever their number, and is known by a number from there on, so hits carry no vectors. The second search
    takes the k-th distance of the first along and returns only what lies within it."""
    spark = queries.sparkSession
    kind = donors.schema["key"].dataType.simpleString()
    pivots = _learned(donors)
    learned = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = learned.value
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, away, own = index.place(_rows_of(batch["vec"]))
            at = np.searchsorted(index.first, cell, side="right") - 1
            more = {"cell": pa.array(cell.astype(np.int32)), "away": pa.array(away), "own": pa.array(own), "inside": pa.array(list(index.patterns[at]), pa.list_(pa.bool_()))}
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("key", "vec", "values")), *more.values()], names=["key", "vec", "values", *more])

    placed = cut(donors.mapInArrow(place, f"key {kind}, vec array<double>, values array<string>, cell int, away double, own boolean, inside array<boolean>"))
    targets = placed.select(F.max(F.size("values"))).first()[0] or 0
    cells = _described(placed, pivots, targets)
    width = pivots.patterns.shape[1]
    first_shelf, parts = _shelves(cells, width)
    known = spark.sparkContext.broadcast((cells, first_shelf, parts))
    at_cell = lambda x: F.get(F.array(*[F.lit(int(i)) for i in x]), F.col("cell"))
    alone = np.zeros(len(parts), np.int64)  # a cell's place on its shelf
    for shelf in np.unique(first_shelf):
        on = np.flatnonzero(first_shelf == shelf)
        alone[on] = np.arange(len(on))
    shelf = at_cell(first_shelf) + F.pmod(F.xxhash64("key", "vec"), at_cell(parts))
    dealt = placed.select("key", "vec", "values", shelf.cast("int").alias("cell"), F.lit(0).alias("part"), at_cell(alone).alias("place"))
    # The numbers must not change when a lost task runs again.
    numbered = cut(queries.select(F.monotonically_increasing_id().alias("id"), "vec", "wanted"))

    def visiting(pick):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for low in range(0, whole.num_rows, 2048):
                    batch = whole.slice(low, 2048)
                    vectors, wanted = _rows_of(batch["vec"]), batch["wanted"].to_pylist()
                    picked = np.zeros((len(vectors), len(known.value[0].rows)), bool)
                    for at, asked in _alike(vectors, wanted):
                        for start in range(0, len(at), 512):
                            some = at[start : start + 512]
                            picked[some] = pick(vectors[some], asked, batch, some)
                    shelves, inside = _visits(picked, *known.value[1:])
                    more = [pa.array(shelves, pa.list_(pa.int32())), pa.array(inside, pa.list_(pa.binary()))]
                    names = [c for c in batch.schema.names]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, "cells", "inside"])

        return run

    def begin(q, asked, batch, at):
        return known.value[0].enough(known.value[0].bounds(q)[1], asked, k)

    def go_on(q, asked, batch, at):
        least, most = known.value[0].bounds(q)
        edges = _edge_maps(batch.take(pa.array(at)))
        edge = np.array([[e.get(t, np.inf) for t in asked] for e in edges]).reshape(len(at), len(asked))
        return known.value[0].reached(least, edge, asked) & ~known.value[0].enough(most, asked, k)

    columns = "id long, vec array<double>, wanted array<int>"
    picked = "cells array<int>, inside array<binary>"
    # Enough groups for all tasks, however few shelves there are.
    lots = -(-3 * partitions(spark) // int((first_shelf + parts).max(initial=1)))
    first = _met(dealt, cut(numbered.mapInArrow(visiting(begin), f"{columns}, {picked}")), k, digits, "id", lots)
    # Written, since both the second search and the result read it.
    w = Window.partitionBy("id", "target").orderBy("near", "donor")
    first = cut(first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))
    edge = first.where(F.col("rank") == k).groupBy("id").agg(F.collect_list(F.struct("target", "near")).alias("e"))
    asked = numbered.join(edge, "id", "left").select("id", "vec", "wanted", F.col("e.target").alias("targets"), F.col("e.near").alias("edges"))
    # Dealt evenly: the join may leave few tasks for the long look-up of cells.
    asked = asked.repartition(partitions(spark))
    second = _met(dealt, cut(asked.mapInArrow(visiting(go_on), f"{columns}, targets array<int>, edges array<double>, {picked}")), k, digits, "id", lots)
    ranked = first.drop("rank").unionByName(second).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("id", "vec"), "id").select("vec", "target", "rank", "distance", "donor", "value")


def _edge_maps(batch: pa.RecordBatch | pa.Table) -> list[dict[int, float]]:
    return [dict(zip(t or [], e or [], strict=True)) for t, e in zip(batch["targets"].to_pylist(), batch["edges"].to_pylist(), strict=True)]


def _met(dealt: DataFrame, visits: DataFrame, k: int, digits: int, name: str = "vec", least_lots: int = 1) -> DataFrame:
    """Hits of every part of a cell (or shelf of cells) with the queries that visit it, under the column that names a query. The queries of a crowded cell come in lots;
    a part travels once to each of them, so once where there are no more than ``LOT_ROWS``."""
    carried = [c for c in ("targets", "edges") if c in visits.columns]
    bits = F.get("inside", F.col("i")) if "inside" in visits.columns else F.lit(None).cast("binary")
    asked = visits.select("*", F.posexplode("cells").alias("i", "cell")).select(*dict.fromkeys([name, "vec", "wanted", *carried]), "cell", bits.alias("bits"))
    n = F.count("*")
    lots = asked.groupBy("cell").agg(F.greatest(F.ceil(n / LOT_ROWS), F.least(F.lit(least_lots), F.ceil(n / 256))).cast("int").alias("lots"))
    place = F.col("place") if "place" in dealt.columns else F.lit(0)
    pool = dealt.join(F.broadcast(lots), "cell").select("*", place.alias("__place"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot")).drop("lots", "place")
    per_cell = dealt.groupBy("cell").agg((F.max("part") + 1).alias("parts"))
    sent = asked.join(F.broadcast(lots), "cell").join(F.broadcast(per_cell), "cell").withColumn("lot", F.pmod(F.xxhash64("vec"), F.col("lots")).cast("int"))
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("lots", "parts")
    shape = f"{name} {visits.schema[name].dataType.simpleString()}, " + _HITS.format(kind=dealt.schema["key"].dataType.simpleString())

    def search(held: pa.Table, wanted: pa.Table) -> pa.Table:
        empty = pa.table({name: wanted[name].slice(0, 0), "target": pa.array([], pa.int32()), "near": pa.array([], pa.float64()), "distance": pa.array([], pa.float64()), "donor": held["key"].slice(0, 0), "value": pa.array([], pa.string())})
        if not held.num_rows or not wanted.num_rows:
            return empty
        block = _Donors.of(held.drop_columns(["cell"]).rename_columns({"__place": "cell"}), digits)
        edges = _edge_maps(wanted) if carried else None
        allowed = None
        if not wanted["bits"].null_count:
            packed = np.array([np.frombuffer(b, np.uint8) for b in wanted["bits"].to_pylist()])
            allowed = np.unpackbits(packed, axis=1)[:, : len(block._members)].astype(bool)
        found = list(block.search(_rows_of(wanted["vec"]), wanted["wanted"].to_pylist(), k, edges, allowed))
        if not found:
            return empty
        return _named(pa.concat_tables(found), name, wanted[name].combine_chunks())

    by = ["cell", "part", "lot"]
    return pool.groupBy(*by).cogroup(sent.groupBy(*by)).applyInArrow(search, shape)


def feature_vector(features: Sequence[str], scale: dict[str, tuple[float, float]] | None = None, fill: dict[str, float] | None = None):
    """Array column of the features, optionally filled and standardised by (centre, spread)."""
    items = []
    for f in features:
        c = F.col(quoted(f)).cast("double")
        if fill is not None:
            c = F.coalesce(c, F.lit(fill.get(f)))
        if scale is not None:
            centre, spread = scale[f]
            c = (c - F.lit(centre)) / F.lit(spread)
        items.append(c)
    return F.array(*items)
