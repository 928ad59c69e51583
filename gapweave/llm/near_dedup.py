"""Near-duplicates by probability Jaccard over weighted word shingles.

A text (lower case, split at white space) is a bag of shingles of five words; a text of fewer words is one shingle. A
shingle's weight is how often it occurs. The likeness of two bags x and y is their probability Jaccard, the sum over
shared shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i): plain Jaccard where all weights are equal.

ProbMinHash draws, for each shingle, the arrivals of a Poisson process whose rate is its weight, and deals each arrival to a
register. A register keeps the shingle of its earliest arrival; a shingle is left when its next arrival comes after
all registers' present ones. Two bags agree in a register with the probability of their likeness. Bands of registers give
buckets.

Texts with equal bags are one node. Every node is first verified, exactly, against two leaders of each of its buckets: the most
central node (the one whose buckets hold most nodes, as the original of edited copies does) and one drawn by hash. That joins most of a
group of copies at a linear cost. Each bucket that still holds nodes of different classes is then dealt into blocks by node hash, and every two
blocks meet in a task, which compares all nodes of different classes that meet there first, each pair in one bucket only: by matrix products
where they settle the likeness or bound it below the threshold, else by the exact sum. No pair is listed outside a task, and no link between nodes that meet in a
bucket is lost.

Cases: null text counts as empty; texts without words form one class; repeated rows are copies; an empty table gives no
rows; null keys are kept and never name a class unless all of its keys are null."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import SpanHash, col, free_name, linked, map_batches, mix, slices, stored, texts_of
from gapweave.llm.line_dedup import squeezed, unpacked

WORDS, THRESHOLD = 5, 0.8
#: 16 bands of 4 registers: a pair at 0.8 is missed with a probability of 0.0002.
BANDS, ROWS = 16, 4
#: Nodes and shingles of a block of a bucket.
BLOCK_NODES, BLOCK_SHINGLES = 512, 400_000
#: Shingles of one matrix product.
_COLUMNS = 1 << 12
_PIECE_WORDS = 100_000
#: Characters whose shingles are worked out together.
_TEXT_SLICE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts as (text number, 48-bit hash, count), ordered by both."""
    owners, strings = [], []
    for i, text in enumerate(texts):
        parts = text.lower().split()
        # A very long text is hashed in pieces that overlap by one word less than a shingle.
        for at in range(0, max(len(parts) - words + 1, 1), _PIECE_WORDS):
            strings.append(" ".join(parts[at : at + _PIECE_WORDS + words - 1]))
            owners.append(i)
    found = []
    for low, high in slices(strings, _TEXT_SLICE):
        part = [s.encode("utf-8", "surrogatepass") for s in strings[low:high]]
        codes = np.frombuffer(b"\n".join(part), np.uint8)
        if not len(codes):
            continue
        spans = SpanHash(codes)
        sizes = np.array([len(p) for p in part])
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        gap = (codes == 32) | (codes == 10)
        first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        last = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
        owner = np.searchsorted(begin, first, side="right") - 1
        count = np.bincount(owner, minlength=len(part))
        # A shingle starts at every word that has enough words after it in its piece, or at the first of too few.
        rank = np.arange(len(first)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        left = count[owner] - rank
        starts = np.flatnonzero((left >= words) | ((rank == 0) & (count[owner] < words)))
        ends = starts + np.minimum(left[starts], words) - 1
        h = spans.of(first[starts], last[ends]) >> np.uint64(16)
        text = np.array(owners[low:high], np.uint64)[owner[starts]]
        found.append((text << np.uint64(48)) | h)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    both, count = np.unique(np.concatenate(found), return_counts=True)
    return (both >> np.uint64(48)).astype(np.int64), both & np.uint64((1 << 48) - 1), count


def prob_min_hash(owner: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures (n x registers) of n bags given as rows (owner, shingle, weight); bags without shingles get zeros."""
    earliest = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(shingles))
    active = np.arange(len(shingles))
    draw = 0
    while len(active):
        draw += 1
        h = mix(shingles[active] + np.uint64(draw * int(_ODD) % (1 << 64)))
        time[active] -= np.log1p(-((h >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / weights[active]
        slot = owner[active] * registers + (mix(h ^ _ODD) % np.uint64(registers)).astype(np.int64)
        now = time[active]
        better = np.flatnonzero(now < earliest[slot])
        np.minimum.at(earliest, slot[better], now[better])
        won = better[now[better] == earliest[slot[better]]]
        kept[slot[won]] = shingles[active[won]]
        latest = earliest.reshape(n, registers).max(1)
        active = active[now < latest[owner[active]]]
    return kept.reshape(n, registers)


def likeness(x: np.ndarray, xw: np.ndarray, y: np.ndarray, yw: np.ndarray) -> float:
    """Exact probability Jaccard of two bags with ascending shingles."""
    if not len(x) or not len(y):
        return 1.0 if len(x) == len(y) else 0.0
    every = np.union1d(x, y)
    a, b = np.zeros(len(every)), np.zeros(len(every))
    a[np.searchsorted(every, x)], b[np.searchsorted(every, y)] = xw, yw
    shared = (a > 0) & (b > 0)
    pairs, times = np.unique(np.stack([a[shared], b[shared]], 1), axis=0, return_counts=True)
    return float(sum(t / np.maximum(a / p, b / q).sum() for (p, q), t in zip(pairs, times, strict=True)))


def _nodes(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """Per document: key, row hash, node (hash of the bag) and the bucket of each band."""

    def work(batch: pa.RecordBatch):
        texts = texts_of(batch)
        nodes, buckets = np.zeros(len(texts), np.uint64), np.zeros((len(texts), bands), np.uint64)
        for low, high in slices(texts, _TEXT_SLICE):
            owner, shingles, weights = bags(texts[low:high], words)
            n = high - low
            np.add.at(nodes, low + owner, mix(mix(shingles) + weights.astype(np.uint64)))
            signature = prob_min_hash(owner, shingles, weights.astype(float), n, bands * rows)
            h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
            for r in range(rows):
                h = mix(h * _ODD + signature.reshape(n, bands, rows)[:, :, r])
            buckets[low:high] = h
        empty = nodes == 0
        flat = pa.array(buckets[~empty].ravel().view(np.int64))
        sizes = np.where(empty, 0, bands)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes.view(np.int64)), lists], ["key", "row", "node", "buckets"])

    wanted = docs.select(col(key).alias("key"), F.xxhash64(col(key), col(text)).alias("row"), col(text).alias("text"))
    return map_batches(wanted, work, f"key {wanted.schema['key'].dataType.simpleString()}, row long, node long, buckets array<long>")


def _fetch(docs: DataFrame, key: str, text: str, places: DataFrame, words: int) -> DataFrame:
    """Bags (node, shingles, weights) of nodes at a row."""
    whole = squeezed(docs.select(F.xxhash64(col(key), col(text)).alias("row"), col(text).alias("text")), "text")

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in unpacked(batch.column(1))]
        for low, high in slices(texts, _TEXT_SLICE):
            owner, shingles, weights = bags(texts[low:high], words)
            ends = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.ListArray.from_arrays(ends, pa.array(shingles.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(weights.astype(np.int32)))],
                ["node", "shingles", "weights"],
            )

    return map_batches(whole.join(places, "row").select("node", "text"), work, "node long, shingles array<long>, weights array<int>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, bag: DataFrame) -> DataFrame:
    """Rows (a, b, alike) with the exact likeness."""

    def work(batch: pa.RecordBatch):
        sides = []
        for i in range(2, 6):
            lists = batch.column(i)
            sides.append((lists.offsets.to_numpy(), lists.values.to_numpy()))
        out = np.empty(batch.num_rows)
        for r in range(batch.num_rows):
            out[r] = likeness(*(v[o[r] : o[r + 1]] for o, v in sides))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["a", "b", "alike"])

    left = bag.select(F.col("node").alias("a"), F.col("shingles").alias("x"), F.col("weights").alias("xw"))
    right = bag.select(F.col("node").alias("b"), F.col("shingles").alias("y"), F.col("weights").alias("yw"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "xw", "y", "yw")
    return map_batches(joined, work, "a long, b long, alike double")


def _leaders(met: DataFrame) -> DataFrame:
    """(bucket, centre, drawn) of buckets with their sizes."""
    central = met.groupBy("node").agg(F.sum("n").alias("c"))
    named = met.join(central, "node")
    return named.groupBy("bucket").agg(F.max_by("node", F.struct("c", "node")).alias("centre"), F.min_by("node", F.struct(F.xxhash64("node", "bucket"), "node")).alias("drawn"))


def _led(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of every node with the leaders of its buckets."""
    led = met.join(_leaders(met), "bucket").select("node", F.explode(F.array("centre", "drawn")).alias("leader")).where("node <> leader")
    return led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _shared(x: np.ndarray, xo: np.ndarray, xv: list[np.ndarray], y: np.ndarray, yo: np.ndarray, yv: list[np.ndarray]) -> list[np.ndarray]:
    """Sums over shared shingles of xv[k] * yv[k] for all pairs of two lists of bags, given flat with the owner of each shingle."""
    out = [np.zeros((xo[-1] + 1, yo[-1] + 1)) for _ in xv]
    both = np.intersect1d(x, y)
    for at in range(0, len(both), _COLUMNS):
        part = both[at : at + _COLUMNS]
        sides = []
        for codes, owner, values in ((x, xo, xv), (y, yo, yv)):
            place = np.minimum(np.searchsorted(part, codes), len(part) - 1)
            own = part[place] == codes
            dense = []
            for v in values:
                m = np.zeros((owner[-1] + 1, len(part)))
                m[owner[own], place[own]] = v[own]
                dense.append(m)
            sides.append(dense)
        for total, left, right in zip(out, *sides, strict=True):
            total += left @ right.T
    return out


def block_links(bags_of: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, open_pairs: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links (row, row) that join the classes of all pairs of the mask ``open_pairs`` with at least that likeness; bags are not empty."""
    rows, columns = np.flatnonzero(open_pairs.any(1)), np.flatnonzero(open_pairs.any(0))
    if not len(rows):
        return []
    sides = []
    for chosen in (rows, columns):
        size = np.array([len(bags_of[i][0]) for i in chosen])
        total = np.array([float(bags_of[i][1].sum()) for i in chosen])
        owner = np.repeat(np.arange(len(chosen)), size)
        share = np.concatenate([bags_of[i][1] for i in chosen]) / total[owner]
        sides.append((np.concatenate([bags_of[i][0] for i in chosen]), owner, share, np.ones(len(owner)), size, total))
    (x, xo, xs, x1, xn, xt), (y, yo, ys, y1, yn, yt) = sides
    # With all weights one the likeness is plain Jaccard. Otherwise a shared shingle adds at most its share of either bag.
    common, left, right = _shared(x, xo, [x1, xs, x1], y, yo, [y1, y1, ys])
    plain = (xn == xt)[:, None] & (yn == yt)[None, :]
    jaccard = common / (xn[:, None] + yn[None, :] - common)
    may = open_pairs[np.ix_(rows, columns)] & (np.where(plain, jaccard, np.minimum(left, right)) >= threshold - 1e-9)
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    found = []
    # The likeliest first, so that the exact sum is skipped for most pairs of what becomes one class.
    i, j = np.nonzero(may)
    for at in np.argsort(-np.where(plain, jaccard + 1, np.minimum(left, right))[i, j], kind="stable").tolist():
        a, b = int(rows[i[at]]), int(columns[j[at]])
        u, v = find(int(classes[a])), find(int(classes[b]))
        if u != v and likeness(*bags_of[a], *bags_of[b]) >= threshold - 1e-12:
            parent[u] = v
            found.append((a, b))
    return found


def _open(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Classes, and the mask of pairs of a block pair that differ in class and share no bucket of a lower band."""
    bucket, p, q = (table[n][0].as_py() for n in ("bucket", "p", "q"))
    classes, block = table["class"].to_numpy(), table["block"].to_numpy()
    every = table["buckets"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    band = int(np.flatnonzero(every[0] == bucket)[0])
    pairs = classes[:, None] != classes[None, :]
    pairs &= np.triu(np.ones(pairs.shape, bool), 1) if p == q else (block == p)[:, None] & (block == q)[None, :]
    for lower in range(band):
        pairs &= every[:, lower][:, None] != every[:, lower][None, :]
    return classes, pairs


def _late_links(met: DataFrame, single: DataFrame, roots: DataFrame, bag: DataFrame, threshold: float) -> DataFrame:
    """Links between nodes of different classes that meet in a bucket."""
    sized = bag.select("node", F.size("shingles").alias("s"))
    known = met.select("node", "bucket").join(roots, "node", "left").join(sized, "node").select("node", "bucket", "s", F.coalesce("root", "node").alias("class"))
    # The largest class of a bucket need not meet itself: its blocks come first and meet only those of the other classes.
    most = lambda c: F.max_by(c, F.struct("n", "class"))
    of = lambda n, s: F.ceil(F.greatest(n / BLOCK_NODES, s / BLOCK_SHINGLES)).cast("int")
    counted = known.groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("s").alias("s"))
    counted = counted.groupBy("bucket").agg(F.count("*").alias("k"), most("class").alias("big"), most("n").alias("bn"), most("s").alias("bs"), F.sum("n").alias("n"), F.sum("s").alias("s")).where("k > 1")
    mixed = counted.select("bucket", "big", of(F.col("bn"), F.col("bs")).alias("own"), of(F.col("n") - F.col("bn"), F.col("s") - F.col("bs")).alias("rest"))
    h, big = F.xxhash64("node"), F.col("class") == F.col("big")
    dealt = known.join(mixed, "bucket").withColumn("block", F.when(big, F.pmod(h, F.col("own"))).otherwise(F.col("own") + F.pmod(h, F.col("rest"))).cast("int"))
    dealt = dealt.join(single.select("node", "buckets"), "node").withColumn("k", F.explode(F.sequence(F.when(big, F.col("own")).otherwise(0), F.col("own") + F.col("rest") - 1)))
    columns = ["bucket", F.least("block", "k").alias("p"), F.greatest("block", "k").alias("q"), "block", "node", "class", "buckets"]
    schema = "bucket long, p int, q int, block int, node long, class long, buckets array<long>"

    def asked(table: pa.Table) -> pa.Table:
        _, pairs = _open(table)
        return table.filter(pa.array(pairs.any(1) | pairs.any(0)))

    wanted = stored(dealt.select(*columns).groupBy("bucket", "p", "q").applyInArrow(asked, schema), "open-nodes")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        classes, pairs = _open(table)
        nodes, shingles, weights = table["node"].to_numpy(), table["shingles"].combine_chunks(), table["weights"].combine_chunks()
        cut, codes, counts = shingles.offsets.to_numpy(), shingles.values.to_numpy(), weights.values.to_numpy()
        begin = weights.offsets.to_numpy()
        bags_of = [(codes[cut[r] : cut[r + 1]], counts[begin[r] : begin[r + 1]]) for r in range(table.num_rows)]
        found = block_links(bags_of, classes, pairs, threshold)
        return pa.table({"a": pa.array([int(nodes[a]) for a, _ in found], pa.int64()), "b": pa.array([int(nodes[b]) for _, b in found], pa.int64())})

    return stored(wanted.join(bag, "node").groupBy("bucket", "p", "q").applyInArrow(compare, "a long, b long"), "late-links")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: key, row (xxhash64 of key and text), node, and class (key and row of its first document, its size)."""
    spark = docs.sparkSession
    nodes = stored(_nodes(docs, key, text, words, bands, rows), "bags")
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row")).alias("first")
    single = stored(nodes.groupBy("node").agg(first, F.count("*").alias("n"), F.first("buckets").alias("buckets")), "distinct-bags")
    placed = single.select("node", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(placed.join(shared, "bucket"), "met-bags")
    edges = stored(_led(met), "bag-pairs")
    wanted = met.select("node").distinct()
    bag = stored(_fetch(docs, key, text, single.join(wanted, "node").select(F.col("first.row").alias("row"), "node"), words), "met-shingles")
    links = stored(_verified(edges, bag).where(F.col("alike") >= threshold - 1e-12).select("a", "b"), "bag-links")
    roots = linked(links, spark, "copies")
    late = _late_links(met, single, roots, bag, threshold)
    if not late.isEmpty():
        roots = linked(links.union(late), spark, "copies")
    classes = single.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("class"), "first", "n")
    heads = classes.groupBy("class").agg(F.min("first").alias("head"), F.sum("n").alias("size"))
    named = classes.select("node", "class").join(heads, "class").select("node", F.col("head.key").alias("class_key"), F.col("head.row").alias("class_row"), F.col("size").alias("class_size"))
    return nodes.select("key", "row", "node").join(named, "node")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The first document, by key, of every class, all columns kept."""
    names = docs.columns
    row = free_name("row", names)
    heads = near_duplicates(docs, key, text, **options).where("row = class_row").select(F.col("row").alias(row)).distinct()
    whole = squeezed(docs.withColumn(row, F.xxhash64(col(key), col(text))), text)
    kept = whole.join(heads, row, "left_semi").dropDuplicates([row]).select(*[col(n) for n in names])
    at = names.index(text)

    def work(batch: pa.RecordBatch):
        texts = pa.array(unpacked(batch.column(at)), pa.string())
        yield pa.RecordBatch.from_arrays([texts if i == at else batch.column(i) for i in range(len(names))], names)

    return map_batches(kept, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
