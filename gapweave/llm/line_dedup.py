"""Line dedup by a segment-partition edit join.

A line (lower case, white space collapsed) of at least ``near_chars`` characters is cut into ``max_edits + 1`` segments.
Two lines within ``max_edits`` edits share a segment of the shorter one, at a place that the lengths and the segment's
number allow. So each line is indexed under its segments, and probes the index of every shorter length in reach with the
substrings at those places; pairs that meet are verified by a banded bit-parallel edit distance. Shorter lines count as
duplicates only if they are equal; lines under ``min_chars`` are never touched.

Only hashes travel: lines once as (hash, place), segments as (key, hash). Texts are fetched for lines with a candidate.
A key is read in sorted order and paired up to ``PAIRED`` lines; the lines of a more crowded key are not paired at all, but
(for one edit) joined exactly on their one-deletion variants, whose number is linear in the text. For more edits
crowded keys are paired in full.

A class is what links connect. Its first line, by key, row hash and line number, stays; the other lines go.

Cases: null text stays null and has no lines; empty lines stay; rows that agree in key and text share their fate, and a null key sorts last;
an empty table gives no rows; extra columns are carried along untouched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import SpanHash, col, free_name, linked, map_batches, mix, stored
from gapweave.session import partitions

MAX_EDITS = 1
MIN_CHARS, NEAR_CHARS = 8, 32
#: Lines of one key that are paired directly.
PAIRED = 64
#: Shortened lines of one batch.
_DELETIONS = 1 << 16


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


def _hash(text: str, seed: int = 0) -> int:
    """Signed 64-bit hash."""
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)
    return value - (1 << 64) if value >> 63 else value


def segments(length: int, max_edits: int) -> list[tuple[int, int]]:
    """(start, size) of the segments of a line of that length; the last ones are longer by one where it does not divide."""
    size, more = divmod(length, max_edits + 1)
    cuts, at = [], 0
    for i in range(max_edits + 1):
        n = size + (i >= max_edits + 1 - more)
        cuts.append((at, n))
        at += n
    return cuts


def keys_of(line: str, max_edits: int, near_chars: int) -> list[tuple[int, bool]]:
    """(key, is an index entry) of a line: its own segments, and the substrings it probes for equal or shorter lengths.
    With gap = the difference of the lengths, segment i of the shorter line starts at most i places earlier or i + gap places later,
    seen from the left; from the right, the edits after it leave at most max_edits - i."""
    n, out = len(line), {}
    for gap in range(min(max_edits, n - near_chars) + 1):
        for i, (start, size) in enumerate(segments(n - gap, max_edits)):
            low = max(start - i, start + gap - (max_edits - i), 0)
            high = min(start + i, start + gap + (max_edits - i), n - size)
            for at in range(low, high + 1):
                own = gap == 0 and at == start
                key = _hash(line[at : at + size], (n - gap) * 64 + i)
                out[key] = out.get(key, False) or own
    return list(out.items())


def within(a: list[str], b: list[str], limit: int) -> np.ndarray:
    """Whether the edit distance of a[i] and b[i] is at most ``limit``: bit-parallel over a band of 2 * limit + 1 diagonals
    held in one word, for all pairs at once."""
    if limit > 30:
        raise ValueError("the band must fit in one word: at most 30 edits")
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    order = np.flatnonzero(np.abs(na - nb) <= limit)
    order = order[np.argsort(na[order], kind="stable")]
    result = np.zeros(len(a), bool)
    # Pairs of like length together, in blocks of a bounded number of characters.
    block = np.cumsum(na[order] + 64) >> 20
    for part in np.split(order, np.flatnonzero(np.diff(block)) + 1) if len(order) else []:
        result[part] = _banded([a[i] for i in part], [b[i] for i in part], na[part], nb[part], limit)
    return result


def _codes(texts: list[str], left: int, width: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, np.uint32)
    for i, t in enumerate(texts):
        out[i, left : left + len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _banded(a: list[str], b: list[str], na: np.ndarray, nb: np.ndarray, limit: int) -> np.ndarray:
    """Diagonal band form of the bit-vector algorithm. For column j + 1, bit d stands for row j + 1 + d - limit. The score
    follows the band's lowest diagonal; in a pair's last column the vertical steps lead from there to its last row."""
    width = 2 * limit + 1
    longest = int(max(na.max(), nb.max())) + 2 * width
    pattern, text = _codes(a, limit, longest + limit, 0xFFFFFFFF), _codes(b, 0, longest, 0xFFFFFFFE)
    one, full = np.uint64(1), np.uint64((1 << width) - 1)
    top = np.uint64(width - 1)
    bits = one << np.arange(width, dtype=np.uint64)
    # vp, vn: vertical steps up and down into the rows, in the column before; cells below the band count as one more.
    vp = np.full(len(a), np.uint64(((1 << (limit + 1)) - 1) << limit))
    vn = np.zeros(len(a), np.uint64)
    score = np.full(len(a), limit, np.int64)  # lowest cell of the band: row limit of column 0
    best = np.where((nb == 0), na, np.iinfo(np.int64).max)
    for j in range(int(nb.max())):
        # Row r of column j + 1 stands on bit r - (j + 1) + limit; pattern[r - 1] is at column r - 1 + limit of the padded array.
        same = pattern[:, j : j + width] == text[:, j : j + 1]
        eq = (same * bits).sum(1, dtype=np.uint64)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = vn | (~(d0 | vp) & full)
        hn = d0 & vp
        x = d0 >> one
        vp_new = hn | (~(x | hp) & full) | (one << top)
        vn_new = (x & hp) & (full >> one)
        score += np.where((d0 >> top) & one, 0, 1)
        vp, vn = vp_new, vn_new
        # Column j + 1 is the last of some pairs: walk up from the band's lowest cell to row na.
        done = np.flatnonzero(nb == j + 1)
        if len(done):
            low = j + 1 + limit  # row of the lowest cell
            value = score[done].copy()
            for step in range(width - 1):
                row = low - step
                bit = np.uint64(width - 2 - step)
                move = row > na[done]
                value -= np.where(move, ((vp[done] >> bit) & one).astype(np.int64) - ((vn[done] >> bit) & one).astype(np.int64), 0)
            best[done] = value
    return best <= limit


def _lines(docs: DataFrame, key: str, text: str, max_edits: int, min_chars: int, near_chars: int) -> DataFrame:
    """One row per line of ``min_chars`` characters: hash, place, and the segment keys at its first sight in a batch."""

    def work(batch: pa.RecordBatch):
        ids, places, numbers, hashes, keys, owns = [], [], [], [], [], []
        seen = set()
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        for doc, row, string in rows:
            for number, line in enumerate((string or "").split("\n")):
                line = normalised(line)
                if len(line) < min_chars:
                    continue
                h = _hash(line)
                fresh = len(line) >= near_chars and h not in seen
                seen.add(h)
                found = keys_of(line, max_edits, near_chars) if fresh else []
                ids.append(doc), places.append(row), numbers.append(number), hashes.append(h)
                keys.append([k for k, _ in found]), owns.append([o for _, o in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array(ids, batch.schema.field(0).type), pa.array(places, pa.int64()), pa.array(numbers, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(owns, pa.list_(pa.bool_()))],
            ["h", "doc", "row", "number", "keys", "owns"],
        )

    wanted = docs.select(col(key).alias("doc"), F.xxhash64(col(key), col(text)).alias("row"), col(text).alias("text"))
    kind = wanted.schema["doc"].dataType.simpleString()
    return map_batches(wanted, work, f"h long, doc {kind}, row long, number int, keys array<long>, owns array<boolean>")


def _meet(keys: DataFrame, max_edits: int) -> DataFrame:
    """Rows (a, b) of lines that meet under a key, one of them indexed there; (a, null) for the lines of a crowded key."""

    def work(batches: Iterator[pa.RecordBatch]):
        group: list[tuple[int, bool]] = []
        current, crowded, a, b = None, False, [], []

        def close():
            if not crowded:
                for i, (h, own) in enumerate(group):
                    for g, other in group[:i]:
                        if (own or other) and g != h:
                            a.append(min(g, h)), b.append(max(g, h))

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear(), b.clear()
            return batch

        for batch in batches:
            key, line, owns = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(key):
                continue
            # Keys of one row, the usual case, are left out at once; the first and the last of a batch may go on.
            same = key[1:] == key[:-1]
            keep = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            for k, h, own in zip(key[keep].tolist(), line[keep].tolist(), owns[keep].tolist(), strict=True):
                if k != current:
                    close()
                    group, current, crowded = [], k, False
                if crowded:
                    a.append(h), b.append(None)
                elif group and group[-1][0] == h:
                    group[-1] = (h, group[-1][1] or own)
                else:
                    group.append((h, own))
                    if len(group) > PAIRED and max_edits == 1:
                        crowded = True
                        a.extend(g for g, _ in group), b.extend([None] * len(group))
                        group = []
            if len(a) > 10_000:
                yield flush()
        close()
        yield flush()

    sorted_keys = keys.repartition(partitions(keys.sparkSession), "key").sortWithinPartitions("key", "h")
    return sorted_keys.mapInArrow(work, "a long, b long")


def _variants(lines: DataFrame) -> DataFrame:
    """Links of crowded lines at one edit: equal after deleting the character at the same place, or one a deletion of the other."""

    def work(batch: pa.RecordBatch):
        for h, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
            spans = SpanHash(codes)
            yield variant(h, spans.of(np.array([0]), np.array([len(codes)])), 0)
            # The shortened lines are hashed without being built, in slices.
            for low in range(0, len(codes), _DELETIONS):
                at = np.arange(low, min(low + _DELETIONS, len(codes)))
                shorter = spans.without(at)
                yield variant(h, shorter, 1)
                yield variant(h, mix(shorter + mix(at.astype(np.uint64) + np.uint64(1))), 2)

    def variant(h: int, keys: np.ndarray, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), kind, np.int8)), pa.array(np.full(len(keys), h, np.int64))], ["key", "kind", "h"])

    rows = map_batches(lines.select("h", "line"), work, "key long, kind byte, h long")
    replaced = rows.where("kind = 2")
    least = replaced.groupBy("key").agg(F.min("h").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = replaced.join(least, "key").select("a", F.col("h").alias("b"))
    whole = rows.where("kind = 0").select("key", F.col("h").alias("a"))
    return links.union(rows.where("kind = 1").join(whole, "key").select("a", F.col("h").alias("b"))).where("a <> b").distinct()


def squeezed(docs: DataFrame, text: str) -> DataFrame:
    """The text column compressed: a third of the bytes in a shuffle."""
    names = docs.columns
    at = names.index(text)
    schema = ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in docs.schema)

    def work(batch: pa.RecordBatch):
        pack = zstandard.ZstdCompressor(level=1)
        data = pa.array([None if x is None else pack.compress(x.encode("utf-8", "surrogatepass")) for x in batch.column(at).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([data if i == at else batch.column(i) for i in range(len(names))], names)

    return map_batches(docs, work, schema)


def unpacked(column: pa.Array) -> list[str | None]:
    unpack = zstandard.ZstdDecompressor()
    return [None if x is None else unpack.decompress(x).decode("utf-8", "surrogatepass") for x in column.to_pylist()]


def _fetch(docs: DataFrame, key: str, text: str, places: DataFrame) -> DataFrame:
    """Texts (h, line) of lines at (row, number)."""
    wanted = places.groupBy("row").agg(F.collect_list(F.struct("number", "h")).alias("lines"))
    whole = squeezed(docs.select(F.xxhash64(col(key), col(text)).alias("row"), col(text).alias("text")), "text")

    def work(batch: pa.RecordBatch):
        hashes, found = [], []
        for string, lines in zip(unpacked(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            parts = (string or "").split("\n")
            for x in lines:
                hashes.append(x["h"]), found.append(normalised(parts[x["number"]]))
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(found, pa.string())], ["h", "line"])

    # Rows that agree in key and text give the same lines.
    return map_batches(whole.join(wanted, "row").select("text", "lines"), work, "h long, line string").dropDuplicates(["h"])


def _verified(pairs: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        near = within(batch.column(2).to_pylist(), batch.column(3).to_pylist(), max_edits)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near)], ["a", "b", "near"])

    left = texts.select(F.col("h").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("h").alias("b"), F.col("line").alias("y"))
    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), work, "a long, b long, near boolean").where("near").select("a", "b")


def duplicate_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS
) -> DataFrame:
    """Lines to remove: rows (row, number), ``row`` the xxhash64 of key and text."""
    lines = stored(_lines(docs, key, text, max_edits, min_chars, max(near_chars, max_edits + 1)), "lines")
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "row", "number")
    firsts = stored(lines.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")), "first-lines")
    keys = lines.where(F.size("keys") > 0).select("h", F.explode(F.arrays_zip("keys", "owns")).alias("k")).select(F.col("k.keys").alias("key"), "h", F.col("k.owns").alias("own"))
    met = stored(_meet(keys, max_edits), "line-candidates")
    pairs, crowded = met.where("b is not null").distinct(), met.where("b is null").select(F.col("a").alias("h")).distinct()
    both = met.select(F.col("a").alias("h")).union(met.where("b is not null").select(F.col("b").alias("h"))).distinct()
    texts = stored(_fetch(docs, key, text, firsts.join(both, "h").select("h", "first.row", "first.number")), "candidate-lines")
    links = _verified(pairs, texts, max_edits)
    if max_edits == 1:
        links = links.union(_variants(texts.join(crowded, "h", "left_semi")))
    roots = linked(links, docs.sparkSession, "line-links")
    classes = firsts.join(roots, F.col("h") == F.col("node"), "left").select("h", "first", "n", F.coalesce("root", "h").alias("class"))
    kept = classes.groupBy("class").agg(F.min("first").alias("kept"), F.sum("n").alias("size")).where("size > 1")
    repeated = classes.select("h", "class").join(kept, "class").select("h", "kept")
    same = (F.col("row") == F.col("kept.row")) & (F.col("number") == F.col("kept.number"))
    return lines.select("h", "row", "number").join(repeated, "h").where(~same).select("row", "number").distinct()


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the duplicate lines taken out of the text, and one more column
    ``removed_lines``, the numbers (from 0) of the lines that went."""
    names = docs.columns
    gone = duplicate_lines(docs, key, text, **options).groupBy("row").agg(F.array_sort(F.collect_list("number")).alias("numbers"))
    row, numbers, out = (free_name(n, names) for n in ("row", "numbers", "removed_lines"))
    whole = squeezed(docs.withColumn(row, F.xxhash64(col(key), col(text))), text)
    joined = whole.join(gone.withColumnsRenamed({"row": row, "numbers": numbers}), row, "left").select(*[col(n) for n in names], col(numbers))
    at = names.index(text)

    def work(batch: pa.RecordBatch):
        left, removed = [], batch.column(len(names))
        for string, lines in zip(unpacked(batch.column(at)), removed.to_pylist(), strict=True):
            if string is not None and lines:
                drop = set(lines)
                string = "\n".join(x for i, x in enumerate(string.split("\n")) if i not in drop)
            left.append(string)
        arrays = [pa.array(left, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
        yield pa.RecordBatch.from_arrays([*arrays, removed], [*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, work, f"{schema}, {out} array<int>")
