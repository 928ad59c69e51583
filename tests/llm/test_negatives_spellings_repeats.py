"""Hard negatives, spelling variants and repeated passages against brute force, and their odd cases."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapweave.llm import common, hard_negatives, spellings, suffixes
from tests.llm.test_corpus import odd_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


# --- hard negatives


def mined(rows, is_anchor, scale=256):
    """The same rows by comparing every anchor with every row."""
    usable = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        usable.append((i, label, tuple(int(np.floor(float(x) * scale)) for x in vector)))
    usable = sorted(set(usable))
    width = max((len(v) for _, _, v in usable), default=0)
    v = np.array([[*x, *[0] * (width - len(x))] for _, _, x in usable], np.int64).reshape(len(usable), width)
    out = []
    for a, (i, label, _) in enumerate(usable):
        if not is_anchor(i):
            continue
        score = v @ v[a]
        order = sorted((x for x in range(len(usable)) if x != a), key=lambda x: (-score[x], usable[x][0]))
        for p in [x for x in order if usable[x][1] == label][:5]:
            window = [x for x in order if usable[x][1] != label and 50 * score[p] <= 100 * score[x] <= 95 * score[p]]
            out += [(i, usable[p][0], rank, usable[x][0], int(score[p]), int(score[x])) for rank, x in enumerate(window[:3], 1)]
    return sorted(out)


def clustered(n, width, seed=1):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((8, width))
    return [(i, int(r.integers(0, 3)), (centres[i % 8] + 0.15 * r.standard_normal(width)).astype(np.float32).tolist()) for i in range(n)]


SCHEMA = "vec_id long, label int, embedding array<float>"


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = clustered(900, 6)
    monkeypatch.setattr(hard_negatives, "BIN_ROWS", 50)
    for sample in (4096, 40):
        found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, sample=sample).collect()
        assert sorted(map(tuple, found)) == mined(rows, lambda i: i % 10 == 0) and found


def test_negatives_of_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "label", "embedding").collect()]
    found = hard_negatives.mine(df, F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, found)) == mined(rows, lambda i: i % 50 == 0) and found


def test_negatives_of_odd_rows(spark):
    rows = clustered(60, 4) + [(100, 1, None), (101, None, [1.0] * 4), (None, 1, [1.0] * 4), (102, 1, [1.0, None, 0.0, 0.0]), (103, 1, [float("nan")] * 4)]
    rows += [(104, 1, [float("inf")] * 4), (105, 2, [0.0] * 4), (106, 1, []), (107, 1, [1.0, 2.0]), (0, 0, [1.0, 1.0, 1.0, 1.0])]
    rows += [rows[3]] * 3 + [(200 + i, i % 2, [0.5, 0.5, 0.0, 1.0]) for i in range(30)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", `id` int, `a.b` int")
    found = hard_negatives.mine(df, F.lit(True)).collect()
    # Rows of one id and unlike vectors are settled by hash: their scores are compared alone.
    key = lambda r: (r[0], r[2], r[4], r[5])
    assert sorted(key(r) for r in found) == sorted(key(r) for r in mined(rows, lambda i: True))
    assert hard_negatives.mine(df.limit(0), F.lit(True)).count() == 0
    assert hard_negatives.mine(df.where("vec_id = 105"), F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(1, 1, [1e30]), (2, 2, [1e30])], SCHEMA), F.lit(True))


def test_annuli_leave_subtrees_out():
    r = np.random.default_rng(0)
    centres = 100 * r.standard_normal((10, 5))
    rows = np.concatenate([c + r.standard_normal((200, 5)) for c in centres])
    top = float((rows * rows).sum(1).max())
    data = hard_negatives._augmented(rows, top)
    root, leaves, _ = hard_negatives.build(data)
    leaf, steps = hard_negatives.descend(root, data)
    found = []
    for node, _, distance, nearest in steps:
        for j in np.unique(nearest):
            part = distance[nearest == j]
            found += [{"node": node.number, "j": int(j), "i": i, "low": part[:, i].min(), "high": part[:, i].max()} for i in range(part.shape[1])]
    hard_negatives._keep_ranges(root, found)
    queries = np.column_stack([rows[::50], np.zeros(len(rows[::50]))])
    true = hard_negatives._distances(queries, data)
    inner, outer = np.quantile(true, 0.01, axis=1), np.quantile(true, 0.05, axis=1)
    reached = hard_negatives.visited(root, leaves, queries, inner, outer, 1e-6)
    for q in range(len(queries)):
        inside = (true[q] >= inner[q]) & (true[q] <= outer[q])
        assert reached[q][leaf[inside]].all()
    assert leaves > 20 and reached.mean() < 0.5


# --- spelling variants


def brute_variants(rows):
    counts = collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def close(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    near = {w: [x for x in counts if x != w and abs(len(x) - len(w)) < 2 and close(w, x)] for w in counts}
    form = {w: min(x, key=lambda y: (-counts[y], y)) for w, x in near.items() if x}
    form = {w: f for w, f in form.items() if counts[f] >= 10 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def test_variants_equal_brute_force(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcéÀß") for _ in range(r.randint(6, 9))) for _ in range(40)]
    rows = []
    for i in range(600):
        text = []
        for _ in range(30):
            w = words[min(int(r.expovariate(0.2)), 39)]
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("xyÉ") + w[at + 1 :], w[:at] + "Q" + w[at:]])
            text.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i, r.choice([" ", ", ", "3", "\n"]).join(text)))
    found = {tuple(x) for x in spellings.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = brute_variants(rows)
    assert found == expected
    assert any(f and x != f for _, f, x, *_ in expected)  # chains of two forms


def test_variants_of_odd_rows(spark):
    odd = odd_rows(spark)
    long = "ab" * 30_000
    extra = [(50, f"{long} {long}x {long} {long}x", 1, "n", 2, "k", 3, "s", 4)]
    df = odd.union(spark.createDataFrame(extra, odd.schema))
    found = {tuple(x) for x in spellings.spelling_variants(df).collect()}
    assert found == brute_variants([(r["doc_id"], r["text"]) for r in df.collect()])
    assert spellings.spelling_variants(df.limit(0)).count() == 0
    assert spellings.vocabulary(df.where("text is null")).count() == 0


def test_one_edit():
    r = random.Random(2)
    words = ["".join(r.choice("ab") for _ in range(r.randint(0, 5))) for _ in range(60)]
    pairs = [(a, b) for a in words for b in words]

    def edits(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len, reverse=True)
        return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    assert spellings.one_edit([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [edits(a, b) for a, b in pairs]


# --- repeated passages


def brute_repeats(rows, span=100):
    """rows: (key, row hash, text) in order, equal ones once."""
    seen, out = set(), {}
    for key, h, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - span + 1):
            part = data[s : s + span]
            if part in seen:
                covered[s : s + span] = b"\1" * span
            seen.add(part)
        kept = bytes(x for x, c in zip(data, covered, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[key, h] = (len(data), sum(covered), spans, kept)
    return out


def check_repeats(spark, df, **options):
    rows = df.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("h"), "text").collect()
    order = sorted({(r[0] is not None, r[0] if r[0] is not None else 0, r[1], r[2] or "", r[0]) for r in rows}, key=lambda x: x[:3])
    expected = brute_repeats([(x[4], x[2], x[3]) for x in order], options.get("span", 100))
    found = sorted((str(r[0]), *r[1:4], bytes(r[4])) for r in suffixes.drop_repeats(df, **options).collect())
    assert found == sorted((str(r[0]), *expected[r[0], r[1]]) for r in rows)
    return found


def passages(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijk éß中") for _ in range(r.randint(2, 8))) for _ in range(300)]
    block = [" ".join(r.choice(words) for _ in range(40)) for _ in range(12)]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(block) if r.random() < 0.4 else " ".join(r.choice(words) for _ in range(25)) for _ in range(r.randint(0, 6)))
        if r.random() < 0.3 and text:
            at = r.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((i * 7 % n, text))
    return rows


def test_repeats_equal_brute_force(spark, monkeypatch):
    df = spark.createDataFrame(passages(1, 300), "doc_id long, text string").repartition(5)
    assert any(r[2] for r in check_repeats(spark, df))
    # Every limit small: crowded anchors, many buckets whose strings go on from the one before, small lots and chunks.
    for name, value in {"LOCAL": 2, "HELD": 500, "BUCKET_BYTES": 20_000, "SORTED": 1000, "CHUNK": 1000}.items():
        monkeypatch.setattr(suffixes, name, value)
    check_repeats(spark, df, crowded=2)
    check_repeats(spark, df, crowded=0)


def test_one_string_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2_000)
    r = random.Random(9)
    fixed = "".join(r.choice("abcdef") for _ in range(130))
    rows = [(i, "".join(r.choice("uvwxyz") for _ in range(60)) + fixed + "".join(r.choice("uvwxyz") for _ in range(60))) for i in range(120)]
    found = check_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), crowded=0)
    assert sum(r[2] for r in found) >= 119 * 130


def test_repeats_of_odd_rows(spark):
    odd = odd_rows(spark)
    texts = [(60, "ab" * 200), (61, "x" * 99), (61, "y" * 300), (61, "x" * 100 + "y" * 150), (62, "\0" * 250), (None, "ab" * 90)]
    df = odd.union(spark.createDataFrame([(i, t, 1, "n", 2, "k", 3, "s", 4) for i, t in texts], odd.schema))
    check_repeats(spark, df)
    check_repeats(spark, df.withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id")))
    assert suffixes.drop_repeats(df.limit(0)).count() == 0
    assert suffixes.drop_repeats(df.where("text is null")).where("n_bytes > 0").count() == 0


def test_repeats_of_the_given_documents(spark):
    check_repeats(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_multikey_order():
    r = np.random.default_rng(0)
    words = r.integers(0, 3, (500, 4)).astype(np.uint64)
    tie = r.permutation(500)
    order, equal = suffixes.multikey_order(words, tie)
    expected = sorted(range(500), key=lambda i: (*words[i].tolist(), tie[i]))
    assert order.tolist() == expected
    assert equal.tolist() == [False] + [bool((words[a] == words[b]).all()) for a, b in zip(expected, expected[1:], strict=False)]
