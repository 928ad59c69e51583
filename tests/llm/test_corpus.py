"""The filtering, duplicate and packing operators against brute force on small tables, and their odd cases."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gapweave.llm import common, line_dedup, near_dedup, packing, quality, queries, toxicity
from gapweave.llm.words import Words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD_SCHEMA = "doc_id long, text string, `row` int, node string, numbers int, `key` string, h int, score string, `a.b` int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, names that clash with inner ones."""
    long = " ".join(f"wort{i % 977} ist" for i in range(40_000))
    texts = [None, "", "   ", "a", "same text here that is long enough to be a line", "same text here that is long enough to be a line", long, long + " end", "x\n\n\nx", "é́ 中文 🙂"]
    rows = [(i, t, 1, "n", 2, "k", 3, "s", 4) for i, t in enumerate(texts)]
    rows += [rows[4], (None, "same text here that is long enough to be a line", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def roots_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in list(parent)}


def test_linked_components(spark):
    r = random.Random(3)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    found = {x["node"]: x["root"] for x in common.linked(spark.createDataFrame(pairs, "a long, b long"), spark).collect()}
    expected = roots_of((a, b) for a, b in pairs if a != b)
    assert found == expected
    assert common.linked(spark.createDataFrame([], "a long, b long"), spark).count() == 0


def test_span_hashes_tell_spans_apart():
    codes = np.frombuffer(b"abcabcabd", np.uint8)
    h = common.SpanHash(codes).of(np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


# --- toxicity and quality


@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.9), ("op2_quality", "quality", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.01"
    scored = queries.QUERIES[name](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r[label] for r in rows]) >= least
    assert scored.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_fold_of_the_labels(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", queries._remainder(5).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)


def training(spark, label):
    good = ["the cat sat on the mat and looked at the small garden", "a quiet morning in the harbour with boats and gulls"]
    # The bad word stands after many different words.
    texts = [(i, good[i % 2] + f" number {i}", 0) for i in range(60)] + [(100 + i, f"{good[i % 2]} a{i} grobnik, a b{i} grobnik!!! c{i} grobnik", 1) for i in range(60)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    return spark.createDataFrame([(t[0], t[2]) for t in texts] + [(999, None), (998, 7)], f"doc_id long, {label} int"), docs


def test_toxicity_of_odd_rows(spark):
    labels, docs = training(spark, "toxic")
    model = toxicity.fit(labels, docs)
    odd = odd_rows(spark)
    scored = toxicity.score_rows(odd, model, "doc_id").collect()
    assert len(scored) == odd.count()
    empty = {r["score"] for r in scored if r["doc_id"] in (0, 1)}
    assert len(empty) == 1
    kept = toxicity.reject_toxic(odd, model)
    assert kept.columns == odd.columns
    assert toxicity.score_rows(odd.limit(0), model, "doc_id").count() == 0
    none = toxicity.fit(labels.limit(0), docs)
    assert {r["predicted"] for r in toxicity.score_rows(odd, none, "doc_id").select((F.col("score") >= 0.5).alias("predicted")).collect()} == {False}


def test_toxic_passage_is_found_in_a_long_text(spark):
    labels, docs = training(spark, "toxic")
    model = toxicity.fit(labels, docs)
    plain = "a quiet morning in the harbour with boats and gulls " * 30_000
    rows = spark.createDataFrame([(1, plain), (2, plain + " a boat grobnik and gulls grobnik mat grobnik ")], "doc_id long, text string")
    found = {r["doc_id"]: r["evidence"][0] for r in toxicity.score_rows(rows, model, "doc_id").collect()}
    assert found[2] > found[1]


def test_windows_cover_the_text():
    for size in (1, 63, 64, 65, 112, 113, 500):
        w = toxicity._windows(size).astype(int)
        assert w[0, 0] == 0 and w[:, 0].max() + w[w[:, 0].argmax(), 1] == size and (w[:, 1] > 0).all()


def test_quality_votes_match_plain_cosines(spark):
    labels, docs = training(spark, "quality")
    model = quality.fit(labels, docs)
    texts = [r["text"] for r in docs.limit(20).collect()]
    vectors = quality._features(texts, model.rarity, model.axes)
    near = vectors @ model.vectors.T
    for i, score in enumerate(quality.vote(vectors, model, 0.5)):
        top = np.argsort(-near[i])[: quality.NEIGHBOURS]
        w = np.maximum(near[i][top], 0).astype(float) ** 8
        assert score == pytest.approx((w @ model.labels[top] + 5e-4) / (w.sum() + 1e-3), abs=0.1)


def test_quality_of_odd_rows(spark):
    labels, docs = training(spark, "quality")
    model = quality.fit(labels, docs)
    odd = odd_rows(spark)
    scored = quality.score_rows(odd, model, "doc_id").collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert {round(r["score"], 9) for r in scored if r["doc_id"] in (0, 1)} == {0.5}
    assert quality.reject_poor(odd, model).columns == odd.columns
    assert {r["score"] for r in quality.score_rows(odd, quality.fit(labels.limit(0), docs), "doc_id").collect()} == {0.5}


# --- line dedup


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def edited(r, text, times):
    out = list(text)
    for _ in range(times):
        kind, i = r.randrange(3), r.randrange(len(out) + 1)
        if kind == 0:
            out.insert(i, r.choice("abé"))
        elif out and kind == 1:
            out.pop(min(i, len(out) - 1))
        elif out:
            out[min(i, len(out) - 1)] = r.choice("abé")
    return "".join(out)


def test_banded_distance():
    r = random.Random(1)
    a = ["".join(r.choice("abé") for _ in range(r.randint(0, 14))) for _ in range(1500)]
    b = [edited(r, x, r.randint(0, 5)) for x in a]
    truth = np.array([edit_distance(x, y) for x, y in zip(a, b, strict=True)])
    for limit in (0, 1, 2, 3, 5):
        assert (line_dedup.within(a, b, limit) == (truth <= limit)).all()
        if limit:
            for x, y, d in zip(a, b, truth, strict=True):
                if d <= limit < min(len(x), len(y)):
                    p, q = (dict(line_dedup.keys_of(t, limit, limit + 1)) for t in (x, y))
                    assert any(k in q and (p[k] or q[k]) for k in p)


def plain_removed(rows, max_edits, min_chars, near_chars):
    places = collections.defaultdict(list)
    for doc, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            line = line_dedup.normalised(line)
            if len(line) >= min_chars:
                places[line].append((doc, n))
    names = sorted(places)
    long = [x for x in names if len(x) >= near_chars]
    links = [(x, y) for i, x in enumerate(long) for y in long[:i] if abs(len(x) - len(y)) <= max_edits and edit_distance(x, y) <= max_edits]
    root = roots_of(links)
    classes = collections.defaultdict(list)
    for x in names:
        classes[root.get(x, x)] += places[x]
    return {p for c in classes.values() for p in sorted(c)[1:]}


@pytest.mark.parametrize(("max_edits", "paired"), [(1, 64), (1, 4), (2, 64)])
def test_line_dedup_matches_all_pairs(spark, monkeypatch, max_edits, paired):
    monkeypatch.setattr(line_dedup, "PAIRED", paired)
    r = random.Random(max_edits)
    base = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(10, 60))) for _ in range(12)]
    rows = [(i, "\n".join(edited(r, r.choice(base), r.choice((0, 0, 1, 1, 2, 3))) for _ in range(4))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs, max_edits=max_edits, min_chars=8, near_chars=20).collect()
    assert {(x["doc_id"], n) for x in found for n in x["removed_lines"] or []} == plain_removed(rows, max_edits, 8, 20)
    texts = dict(rows)
    for x in found:
        gone = set(x["removed_lines"] or [])
        assert x["text"] == "\n".join(t for i, t in enumerate(texts[x["doc_id"]].split("\n")) if i not in gone)


def test_crowded_keys_use_one_deletion_variants(spark):
    r = random.Random(5)
    base = "".join(r.choice("abcdefgh ") for _ in range(50)).strip() + "z"
    rows = [(i, edited(r, base, r.choice((1, 1, 2)))) for i in range(150)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x["doc_id"], n) for x in found for n in x["removed_lines"] or []} == plain_removed(rows, 1, 8, 32)


def test_line_dedup_of_odd_rows(spark):
    odd = odd_rows(spark)
    found = line_dedup.dedup_lines(odd)
    assert found.columns == [*odd.columns, "removed_lines"]
    rows = found.collect()
    assert len(rows) == odd.count()
    assert all(x["text"] is None for x in rows if x["doc_id"] == 0)
    by = collections.defaultdict(list)
    for x in rows:
        by[x["doc_id"]].append(x)
    assert [x["removed_lines"] for x in by[4]] == [None, None] and by[5][0]["removed_lines"] == [0]
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


# --- near-duplicates


def bag(text):
    words = text.lower().split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else collections.Counter()


def probability_jaccard(x, y):
    if not x or not y:
        return float(x == y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def test_exact_likeness_and_estimate():
    r = random.Random(2)
    a = [r.choice("abcdefghijklmnop") + str(r.randrange(9)) for _ in range(200)]
    for changes in (0, 3, 10, 40):
        b = list(a) + a[:30]
        for _ in range(changes):
            b[r.randrange(len(b))] = "new"
        owner, shingles, weights = near_dedup.bags([" ".join(a), " ".join(b)])
        x, y = ((shingles[owner == i], weights[owner == i]) for i in (0, 1))
        truth = probability_jaccard(bag(" ".join(a)), bag(" ".join(b)))
        assert near_dedup.likeness(*x, *y) == pytest.approx(truth)
        signature = near_dedup.prob_min_hash(owner, shingles, weights.astype(float), 2, 4096)
        assert (signature[0] == signature[1]).mean() == pytest.approx(truth, abs=0.05)


def test_near_duplicates_match_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    owner, shingles, weights = near_dedup.bags([t for _, t in rows])
    cut = np.searchsorted(owner, np.arange(len(rows) + 1))
    bags = [(shingles[a:b], weights[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    # Bags that share no shingle are at 0: only those that do are compared.
    at = collections.defaultdict(list)
    for n, (x, _) in enumerate(bags):
        for s in x.tolist():
            at[s].append(n)
    seen = {(a, b) for group in map(tuple, {tuple(g) for g in at.values()}) for i, b in enumerate(group) for a in group[:i]}
    links = [(rows[a][0], rows[b][0]) for a, b in seen if near_dedup.likeness(*bags[a], *bags[b]) >= 0.8]
    root = roots_of(links)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r["key"]: r["class_key"] for r in found} == {d: root.get(d, d) for d, _ in rows}
    sizes = collections.Counter(root.get(d, d) for d, _ in rows)
    assert all(r["class_size"] == sizes[r["class_key"]] for r in found)
    kept = near_dedup.drop_near_duplicates(docs)
    assert {r["doc_id"] for r in kept.collect()} == set(sizes)


def paired_texts():
    """Sixty pairs of near copies; all texts share most words and so meet in few crowded buckets, where few pairs hold a leader."""
    common_words = [f"w{i}" for i in range(100)]
    return [(2 * p + k, " ".join([*common_words, *(f"p{p}x{i}" for i in range(19)), f"end{k}"])) for p in range(60) for k in range(2)]


def test_near_duplicates_without_common_leaders(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 8, raising=False)
    docs = spark.createDataFrame(paired_texts(), "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, threshold=0.9, bands=2, rows=1).collect()
    assert {r["key"]: r["class_key"] for r in found} == {i: i - i % 2 for i in range(120)}


def test_block_links_find_every_class():
    r = random.Random(4)
    texts = [" ".join(r.choice("abc") if r.random() < 0.1 else f"w{i}" for i in range(60)) for _ in range(20)]
    texts += [" ".join(edited_words) for t in texts[:10] for edited_words in [[*t.split()[:57], *r.choices("xyz", k=3)]]] + ["q q q q q q q q", "q q q q q q q q q"]
    owner, shingles, weights = near_dedup.bags(texts)
    parts = [(shingles[owner == i], weights[owner == i]) for i in range(len(texts))]
    truth = [(a, b) for b in range(len(texts)) for a in range(b) if probability_jaccard(bag(texts[a]), bag(texts[b])) >= 0.8]
    open_pairs = np.triu(np.ones((len(texts), len(texts)), bool), 1)
    assert roots_of(near_dedup.block_links(parts, np.arange(len(texts)), open_pairs, 0.8)) == roots_of(truth)


def test_near_duplicates_of_odd_rows(spark):
    odd = odd_rows(spark)
    found = {r["key"]: r["class_key"] for r in near_dedup.near_duplicates(odd).collect()}
    assert found[0] == found[1] == found[2] == 0 and found[5] == 4 and found[7] == 6 and found[9] == 9
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 6, 8, 9]
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


# --- words and packing


def test_words_equal_the_library():
    r = random.Random(0)
    alphabet = "ab'sSTtrevmldΣσé́Å2²٣!'' \n\t中文🙂İß<|endoftext|>\U0010fffe"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += ["it's they're we'LL don't 'stuff !'s ''s 's't 'd", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "", "  ", "Σας ΟΔΟΣ"]
    ids, sizes = Words.of(VOCABULARY).encode(texts)
    truth = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    for text, own, expected in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), truth, strict=True):
        assert own.tolist() == expected.ids, text


def test_cuts_fill_their_classes():
    ladder = packing.classes()
    assert ladder == [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256] and packing.classes(8) == [1]
    for length in (1, 2, 100, 1365, 1366, 4095, 4096, 4097, 9999):
        plan = packing.cut(length)
        assert sum(n for n, _ in plan) == length
        assert all(n <= 4096 // m and (n >= 0.97 * (4096 // m) or n <= packing.LEAST) for n, m in plan)


def check_packed(rows, texts):
    library = Tokenizer.from_file(VOCABULARY)
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        docs[r["key"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for key, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(docs[key], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for group in sequences.values():
        at = 0
        for p in sorted(group, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    return sequences


def test_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packed = packing.pack(docs.repartition(5), VOCABULARY)
    rows = packed.collect()
    check_packed(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    sums = packing.padding(packed).first()
    assert sums["tokens"] == sum(r["length"] for r in rows)
    assert sums["padding"] <= 0.06 * sums["tokens"]


def test_packing_of_odd_rows(spark):
    odd = odd_rows(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack(odd, VOCABULARY, with_ids=True).collect()
    check_packed(rows, {r["doc_id"]: r["text"] for r in odd.collect()})
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    whole = odd_rows(spark)
    assert packing.pack(whole, VOCABULARY).where("start = 0").count() == whole.count()
    assert packing.pack(odd.limit(0), VOCABULARY).count() == 0
