"""Repeated passages by a suffix array: every byte covered by a string of ``span`` bytes that also starts earlier.

Texts are their UTF-8 bytes, null is empty, and no string crosses documents. Occurrences are ordered by (key, start), null keys first.
A string is repeated if an equal one stands before it in that order; the bytes of all repeated strings go, the first occurrence stays.

A suffix array of all suffixes would move ``span`` bytes for each byte of text, so suffixes are sampled first. Of the grams of
``GRAM`` bytes inside a string, the one with the least hash is its anchor. Equal strings have equal anchors at equal places. Neighbouring
strings with one anchor make a run, about one for every 33 bytes. Runs meet by their anchor's hash:

* runs of equal bytes are copies: all but the first are repeated as a whole;
* a first run whose anchor occurs in no other run holds no repeated string;
* the strings (suffixes cut after ``span`` bytes) of the first runs that share an anchor are sorted. Sampled splitters
  range-partition them by their leading bytes, each bucket sorts its suffixes by multikey quicksort, and an equal neighbour in front tells a repeated one.

Suffixes of anchors in up to ``CROWDED`` runs travel with their run, split at anchors. Those of more crowded anchors travel one by one, and
their splitters also look at (key, start), so that copies of one string may fill many buckets. A bucket whose first string is
the last one of the bucket before it goes on from there: that is the comparison across boundaries.

A task's own copies are settled before anything is shuffled, and its runs at a locally crowded anchor are dealt by
anchor and content, so a hot passage is spread and met once a task.

Hashes: runs are equal if two 64-bit hashes of unlike kinds agree (anchor and whole run); strings are compared byte by byte.

Cases: texts shorter than ``span`` stay whole; an empty table gives no rows; extra columns do not matter; rows with equal keys
and unlike texts are ordered by their text's hash; rows equal in key and text are one document, and each of them gets its result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gapweave.llm.common import bounded, col, mix, stored

SPAN, GRAM = 100, 32
#: Bytes handled at once, runs that a task settles at once, runs of one anchor that a task deals by anchor alone.
CHUNK, HELD, LOCAL = 1 << 20, 1 << 20, 64
#: Distinct runs of an anchor that meet in one task, bytes of suffix rows in a bucket, suffixes sorted at once.
CROWDED, BUCKET_BYTES, SORTED = 1024, 8 << 20, 1 << 18
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0xD6E8FEB86659FD93
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_COPY, _OPEN, _ALONE = 0, 1, 2


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes from every place, put together from the powers of two in ``size``."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    part, reach, out, done = _TABLE[data], 1, None, 0
    while True:
        if size & reach:
            n = len(data) - done - reach + 1
            out = part if out is None else out[:n] * power(reach) + part[done : done + n]
            done += reach
        if done == size:
            return mix(out)
        n = len(data) - 2 * reach + 1
        part = part[:n] * power(reach) + part[reach : reach + n]
        reach *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from every place."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    n = len(values) - width + 1
    return np.minimum(out[:n], out[width - reach : width - reach + n])


def runs_of(data: np.ndarray, bounds: np.ndarray, span: int = SPAN, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs (document number, start in ``data``, strings in it, place of the anchor from its start, anchor's hash) of the
    documents that lie between ``bounds``. A run also ends where a chunk does, which only makes more runs."""
    for low in range(int(bounds[0]), int(bounds[-1]), CHUNK):
        part = data[low : min(low + CHUNK + span - 1, int(bounds[-1]))]
        if len(part) < span:
            return
        first = np.maximum(bounds[:-1], low)
        count = np.maximum(np.minimum(bounds[1:] - span + 1, low + CHUNK) - first, 0)
        total = int(count.sum())
        if not total:
            continue
        owner = np.repeat(np.arange(len(count)), count)
        start = np.arange(total) + np.repeat(first - (np.cumsum(count) - count), count)
        hashes = _grams(part, gram)
        # The least hash with its place, so that of equal ones the leftmost counts.
        least = _least((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), span - gram + 1)[start - low]
        change = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])]))
        size = np.diff(np.append(change, total))
        anchor = (least[change] & _PLACE).astype(np.int64)
        yield owner[change], start[change], size, anchor + low - start[change], hashes[anchor]


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), bounds


def _ranks(keys: pa.Array) -> np.ndarray:
    """Numbers in the order of the keys, null first, equal for equal keys."""
    if pa.types.is_integer(keys.type) and not keys.null_count:
        return keys.to_numpy(zero_copy_only=False).astype(np.int64)
    values = keys.to_pylist()
    order = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    return np.array([-1 if v is None else order[v] for v in values], np.int64)


def _merged(doc: np.ndarray, start: np.ndarray, size: np.ndarray, *marks: np.ndarray) -> list[np.ndarray]:
    """Ranges of starts, those that touch in one document joined; ``marks`` must agree too."""
    if not len(doc):
        return [doc, start, size, *marks]
    order = np.lexsort((start, doc))
    doc, start, size = doc[order], start[order], size[order]
    marks = [m[order] for m in marks]
    apart = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + size[:-1])
    for m in marks:
        apart |= m[1:] != m[:-1]
    head = np.flatnonzero(np.concatenate([[True], apart]))
    last = np.append(head[1:], len(doc)) - 1
    return [doc[head], start[head], start[last] + size[last] - start[head], *[m[head] for m in marks]]


class _Task:
    """The runs of a task, settled among themselves in bounded lots."""

    def __init__(self):
        self.keys: list[pa.Array] = []
        self.rows: list[np.ndarray] = []
        self.docs = 0
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch, span: int, gram: int) -> None:
        data, bounds = _binary(batch.column(2))
        self.keys.append(batch.column(0))
        self.rows.append(batch.column(1).to_numpy(zero_copy_only=False))
        view = memoryview(data)
        for owner, start, size, off, anchor in runs_of(data, bounds, span, gram):
            content = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + size + span - 1).tolist(), strict=True)]
            self.held.append((owner + self.docs, start - bounds[owner], size, off, anchor, np.array(content, np.uint64)))
            self.size += len(start)
        self.docs += batch.num_rows

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            self.keys, self.rows, self.docs = [], [], 0
            return
        doc, start, size, off, anchor, content = (np.concatenate(x) for x in zip(*self.held, strict=True))
        keys, rows = pa.concat_arrays(self.keys), np.concatenate(self.rows)
        self.__init__()
        rank, row = _ranks(keys)[doc], rows[doc]
        order = np.lexsort((start, row, rank, content, anchor))
        a, c = anchor[order], content[order]
        new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        # The same place twice comes from equal rows and is one occurrence.
        same = (rank[order] == rank[head]) & (row[order] == row[head]) & (start[order] == start[head])
        copies = order[~same]
        marks = _merged(doc[copies], start[copies], size[copies])
        first = order[new]
        group = np.cumsum(new_anchor[new]) - 1
        many = np.bincount(group)[group] > LOCAL
        nth = np.arange(len(first)) - np.flatnonzero(new_anchor[new])[group]
        own = np.where(many & (nth >= LOCAL), mix(anchor[first] + mix(content[first])), anchor[first])
        info = size[first] | (off[first] << 8) | (many.astype(np.int64) << 16)
        doc_out = np.concatenate([doc[first], marks[0]])
        none = np.zeros(len(marks[0]), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([own, mix(np.arange(len(none), dtype=np.uint64) + anchor[:1])]).view(np.int64)),
                pa.array(np.concatenate([content[first], none]).view(np.int64)),
                keys.take(pa.array(doc_out)),
                pa.array(rows[doc_out]),
                pa.array(np.concatenate([start[first], marks[1]])),
                pa.array(np.concatenate([info, marks[2]])),
                pa.array(np.concatenate([np.ones(len(first), bool), np.zeros(len(none), bool)])),
            ],
            ["meet", "content", "key", "row", "start", "info", "run"],
        )


def _settled(whole: DataFrame, kind: str, span: int, gram: int, crowded: int) -> DataFrame:
    """Rows (key, row, start, n, off, state): copies as ranges of starts, and the runs whose strings must be sorted."""

    def work(batches):
        task = _Task()
        for batch in bounded(batches):
            task.add(batch, span, gram)
            if task.size >= HELD:
                yield from task.flush()
        yield from task.flush()

    found = whole.mapInArrow(work, f"meet long, content long, key {kind}, row long, start long, info long, run boolean")
    place = F.struct("key", "row", "start")
    equal = Window.partitionBy("meet", "run", "content").orderBy("key", "row", "start")
    ranked = Window.partitionBy("meet", "run").orderBy("content")
    group = Window.partitionBy("meet", "run")
    rows = (
        found.repartition("meet", "run")
        .withColumn("first", F.first(place).over(equal).eqNullSafe(place))
        .withColumn("number", F.dense_rank().over(ranked))
        .withColumn("runs", F.max("number").over(group))
        .withColumn("hot", F.max(F.col("info").bitwiseAND(1 << 16)).over(group) > 0)
    )
    state = (
        F.when(~F.col("run") | ~F.col("first"), _COPY)
        .when(F.col("hot") | (F.col("runs") > crowded), _ALONE)
        .when(F.col("runs") > 1, _OPEN)
    )
    n = F.when(F.col("run"), F.col("info").bitwiseAND(255)).otherwise(F.col("info"))
    off = F.shiftright("info", 8).bitwiseAND(255)
    return rows.select("key", "row", "start", n.alias("n"), off.alias("off"), state.alias("state")).where("state is not null")


def _with_places(whole: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Documents with the list of their places; null keys match null keys."""
    names = [c for c in places.columns if c not in ("key", "row")]
    lists = places.groupBy(F.col("key").alias("k"), F.col("row").alias("r")).agg(F.collect_list(F.struct(*names)).alias("places"))
    return whole.join(lists, F.col("key").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r")), how).drop("k", "r")


def _suffixes(whole: DataFrame, open_runs: DataFrame, kind: str, span: int, gram: int) -> DataFrame:
    """Rows (lead, tie, key, row, start, n, body): a run with its anchor in front, or one string alone, whose place breaks ties."""

    def work(batches):
        for batch in bounded(batches):
            out: list[list] = [[] for _ in range(6)]
            docs, held = [], 0
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                for p in batch.column(3)[i].as_py():
                    start, n = p["start"], p["n"]
                    if p["state"] == _OPEN:
                        rows = [(text[start + p["off"] : start + p["off"] + gram], None, start, n, text[start : start + n + span - 1])]
                    else:
                        rows = [(text[at : at + span], at, at, 1, None) for at in range(start, start + n)]
                    for row in rows:
                        for c, v in zip(out, row, strict=False):
                            c.append(v)
                        docs.append(i)
                    held += len(rows) * span + n
                if held > 4 << 20:
                    yield _suffix_batch(batch, docs, out)
                    out, docs, held = [[] for _ in range(6)], [], 0
            yield _suffix_batch(batch, docs, out)

    def _suffix_batch(batch, docs, out):
        at = pa.array(docs, pa.int64())
        keys, rows = batch.column(0).take(at), batch.column(1).take(at)
        alone = pa.array([t is not None for t in out[1]], pa.bool_())
        empty = pa.nulls(len(docs), keys.type)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(out[0], pa.binary()),
                pc.if_else(alone, keys, empty),
                pc.if_else(alone, rows, pa.nulls(len(docs), pa.int64())),
                pa.array(out[1], pa.int64()),
                keys,
                rows,
                pa.array(out[2], pa.int64()),
                pa.array(out[3], pa.int64()),
                pa.array(out[4], pa.binary()),
            ],
            ["lead", "tie_key", "tie_row", "tie_start", "key", "row", "start", "n", "body"],
        )

    schema = f"lead binary, tie_key {kind}, tie_row long, tie_start long, key {kind}, row long, start long, n long, body binary"
    return _with_places(whole, open_runs, "inner").mapInArrow(work, schema)


def multikey_order(words: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether a string equals the one before it) of strings given as rows of big-endian words; equal strings by ``tie``.
    Multikey quicksort a word at a time: what differs in a word is in place, and only equal parts go on to the next word."""
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable")
    head = np.ones(n, bool)
    head[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for depth in range(1, words.shape[1] + 1):
        alone = head & np.append(head[1:], True)
        live = np.flatnonzero(~alone)
        if not len(live):
            break
        part, group = order[live], np.cumsum(head)[live]
        value = words[part, depth] if depth < words.shape[1] else tie[part]
        inner = np.lexsort((value, group))
        order[live] = part[inner]
        if depth < words.shape[1]:
            value = value[inner]
            head[live[1:]] |= value[1:] != value[:-1]
    return order, ~head


def _words(data: np.ndarray, start: np.ndarray, span: int) -> np.ndarray:
    """The ``span`` bytes from every start as rows of big-endian 64-bit words, ended by zeros."""
    width = -(-span // 8) * 8
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[start]
    rows[:, span:] = 0
    return rows.view(">u8").astype(np.uint64)


def _sorted_bucket(table: pa.Table, span: int, gram: int, bucket: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings of a bucket as ranges of starts, the first string of the bucket and the last one, if they travelled alone."""
    lead, tie_start = table["lead"].combine_chunks(), table["tie_start"].combine_chunks()
    keys, row = table["key"].combine_chunks(), table["row"].to_numpy()
    start, n = table["start"].to_numpy(), table["n"].to_numpy()
    alone = tie_start.is_valid().to_numpy(zero_copy_only=False)
    body = pc.if_else(tie_start.is_valid(), lead, table["body"].combine_chunks())
    data, bounds = _binary(body)
    lead_data, lead_bounds = _binary(lead)
    pad = np.zeros(128, np.uint8)
    data, lead_data = np.concatenate([data, pad]), np.concatenate([lead_data, pad])
    rank = _ranks(keys)
    # Places in their order as one number a row; strings of a run follow each other.
    place = np.empty(len(n), np.int64)
    by_place = np.lexsort((start, row, rank))
    place[by_place] = np.concatenate([[0], np.cumsum(n[by_place])[:-1]])
    doc = np.zeros(len(n), np.int64)
    moved = (rank[by_place][1:] != rank[by_place][:-1]) | (row[by_place][1:] != row[by_place][:-1])
    doc[by_place[1:]] = np.cumsum(moved)
    # Anchors in order: equal leads are never parted, so a slice of them is complete.
    leads, _ = multikey_order(_words(lead_data, lead_bounds[:-1], gram), place)
    gram_words = _words(lead_data, lead_bounds[:-1], gram)[leads]
    cuts = np.concatenate([[True], (gram_words[1:] != gram_words[:-1]).any(1)])
    load = np.cumsum(n[leads])
    lot = np.maximum.accumulate(np.where(cuts, (load - n[leads]) // SORTED, 0))
    found, edges = [], {}
    for part in np.split(leads, np.flatnonzero(np.diff(lot)) + 1):
        count = n[part]
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        owner = np.repeat(part, count)
        words = _words(data, bounds[owner] + inner, span)
        order, repeated = multikey_order(words, place[owner] + inner)
        hit = order[repeated]
        found.append((owner[hit], start[owner[hit]] + inner[hit]))
        for name, at in (("head", order[0]), ("tail", order[-1])):
            if name == "tail" or not edges:
                edges[name] = (owner[at], alone[owner[at]])
    owner, at = (np.concatenate(x) for x in zip(*found, strict=True))
    lines = []
    if len(owner):
        named, at, size, _ = _merged(doc[owner], at, np.ones(len(at), np.int64), doc[owner])
        sample = np.zeros(int(doc.max()) + 1, np.int64)
        sample[doc] = np.arange(len(doc))
        lines.append((sample[named], at, size, np.zeros(len(at), np.int8)))
    ends = [(int(i), 1 if name == "head" else 2) for name, (i, single) in edges.items() if single]
    if ends:
        which = np.array([i for i, _ in ends])
        lines.append((which, start[which], np.ones(len(which), np.int64), np.array([k for _, k in ends], np.int8)))
    for which, at, size, mark in lines:
        texts = pc.if_else(pa.array(mark > 0), lead.take(pa.array(which)), pa.nulls(len(which), lead.type))
        yield pa.RecordBatch.from_arrays(
            [keys.take(pa.array(which)), pa.array(row[which]), pa.array(at), pa.array(size), pa.array(mark.astype(np.int32)), pa.array(np.full(len(which), bucket, np.int32)), texts],
            ["key", "row", "start", "n", "mark", "bucket", "lead"],
        )


def _repeated(suffixes: DataFrame, kind: str, buckets: int, span: int, gram: int) -> DataFrame:
    """Ranges (key, row, start, n) of the starts of repeated strings."""

    def work(batches):
        whole = [b for b in batches if b.num_rows]
        if whole:
            yield from _sorted_bucket(pa.Table.from_batches(whole), span, gram, TaskContext.get().partitionId())

    dealt = suffixes.repartitionByRange(buckets, "lead", "tie_key", "tie_row", "tie_start")
    rows = stored(dealt.mapInArrow(work, f"key {kind}, row long, start long, n long, mark int, bucket int, lead binary"), "repeats")
    # Two rows a bucket at most: the last string of the bucket before against the first of this one.
    before = Window.orderBy("bucket", "mark")
    heads = rows.where("mark > 0").withColumn("last", F.lag("lead").over(before)).withColumn("from", F.lag("mark").over(before))
    across = heads.where("mark = 1 and from = 2 and last = lead")
    columns = ["key", "row", "start", "n"]
    return rows.where("mark = 0").select(*columns).unionByName(across.select(*columns))


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans (maximal removed runs) and the bytes that are ``kept``."""
    if not 0 < gram <= span or span > 200:
        raise ValueError("anchors must fit in the strings, and strings in 200 bytes")
    spark = docs.sparkSession
    bare = docs.select(col(key).alias("key"), F.coalesce(col(text).cast("binary"), F.lit(b"")).alias("text"))
    kind = bare.schema["key"].dataType.simpleString()
    # The text's hash tells rows of one key apart; where keys are unique, nothing has to.
    unique = bare.groupBy("key").count().where("count > 1").isEmpty()
    whole = bare.select("key", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("row"), "text")
    settled = stored(_settled(whole, kind, span, gram, crowded), "runs")
    sizes = F.when(F.col("state") == _ALONE, F.col("n") * span).otherwise(F.col("n") + span + gram)
    load = settled.where(F.col("state") != _COPY).agg(F.sum(sizes)).first()[0]
    ranges = settled.where(F.col("state") == _COPY).select("key", "row", "start", "n")
    if load:
        open_runs = settled.where(F.col("state") != _COPY)
        suffixes = _suffixes(whole, open_runs, kind, span, gram)
        ranges = ranges.unionByName(_repeated(suffixes, kind, -(-load // BUCKET_BYTES), span, gram))

    def cut(batches):
        for batch in bounded(batches):
            out: list[list] = [[] for _ in range(4)]
            for i in range(batch.num_rows):
                body, places = batch.column(2)[i].as_py(), batch.column(3)[i].as_py() or []
                spans: list[list[int]] = []
                for low, n in sorted((p["start"], p["n"]) for p in places):
                    high = low + n - 1 + span
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                ends = [0, *(x for s in spans for x in s), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)) if spans else body
                for c, v in zip(out, (len(body), len(body) - len(kept), len(spans), kept), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return _with_places(whole, ranges, "left").mapInArrow(cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
