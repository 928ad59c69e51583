"""Pieces, token counts, fingerprints, languages and nearest neighbours against the libraries or brute force, and their odd cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gapweave.llm import common, fingerprints, language, nearest, pieces, queries, token_counts
from tests.llm.test_corpus import odd_rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def random_texts(alphabet, n, longest, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, longest))) for _ in range(n)]


# --- pieces


def test_pieces_equal_the_library(spark):
    texts = random_texts("abcdetheinrs '\n\t  中文🙂İßéABCTHE▁", 800, 60)
    texts += ["", " ", "   ", "aaaaaaa", "eeeeeeeee     eeee", "\n\n\n", "                    x", "the then thence thenceforth"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    model, library = pieces.Pieces.of(MODEL), SentencePieceProcessor(model_file=MODEL)
    found = model.encode(texts)
    for text, own, expected in zip(texts, found, library.encode(texts, num_threads=1), strict=True):
        assert own.tolist() == expected, text
        if "▁" not in text:
            assert model.decode(own) == text


def test_forward_pass_is_plain_merging():
    model = pieces.Pieces.of(MODEL)
    words = [f"▁{w}" for w in random_texts("thenaringo", 300, 9, 4)]
    for word, ids in model.forward(list(set(words))).items():
        assert [model.id[p] for p in model.merged([*word])] == list(ids)


def test_states_hold_all_pieces_that_end_there():
    """Only pieces that do end at a prefix are tried, the longest first, and pairs that would merge are not merged to see it."""
    model = pieces.Pieces(MODEL)
    asked = []
    plain, model.merged = model.merged, lambda symbols: asked.append("".join(symbols)) or plain(symbols)
    words = [f"▁{w}" for w in random_texts("thenarigoé中🙂", 200, 12, 5)]
    found = model.forward(list(set(words)))
    assert all(text not in model.id or model._stable[text].get("") is not None for text in asked)
    for word in words:
        assert [model.id.get(p) for p in plain([*word]) if p in model.id] == [i for i in found[word] if i not in model.byte.values()]
        state = model._start
        for end in range(1, len(word) + 1):
            state = state.moves.get(word[end - 1], model._start)
            ending = [word[i:end] for i in range(end - 1) if word[i:end] in model.id]
            assert [p for p, *_ in state.ends] == ending


def test_pieces_of_odd_rows(spark):
    odd = odd_rows(spark)
    rows = pieces.encode(odd, MODEL)
    found = rows.collect()
    assert len(found) == odd.count()
    assert all(len(r["pieces"]) == 0 and r["decoded"] == "" for r in found if r["key"] in (0, 1))
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert all(r["decoded"] == texts[r["key"]] for r in found if r["key"] is not None)
    again = {r["key"]: r["text"] for r in pieces.decode(rows, MODEL).collect()}
    assert all(again[k] == t for k, t in texts.items() if k is not None)
    assert pieces.encode(odd.limit(0), MODEL).count() == 0


# --- token counts


def test_counts_equal_the_library():
    texts = random_texts("ab'sSTtrevmldΣσé́Å2²٣!'' \n\t中文🙂İß<|endoftext|>\U0010fffe", 1500, 30)
    texts += ["x" * 2000 + " ab", "don't stop it's", "", "  ", "a" * 511 + " " + "b" * 600]
    texts *= 2
    counter = token_counts.Counter(VOCABULARY)
    truth = [len(e.ids) for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    for size in (3000, 200_000):
        # The second round finds the repeated words compiled.
        found = np.concatenate([counter.count(texts[a:b]) for a, b in common.slices(texts, size)])
        assert found.tolist() == truth
    assert counter.transducer.states > token_counts.ROOT + 1


def test_chunked_run_equals_one_pass():
    machine = token_counts.Transducer()
    words = ["ab", "abc", "abcde", "bca", "c"]
    machine.compile(words, [1, 2, 3, 4, 5])
    r = random.Random(1)
    text = " ".join(r.choice([*words, "abx", "abcdeabcde"]) for _ in range(3000))
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = np.array([i for i in range(len(text)) if text[i] != " " and (i == 0 or text[i - 1] == " ")])
    states = machine.run(codes, starts)
    begin, state = set(starts.tolist()), token_counts.DEAD
    for i, c in enumerate(codes):
        state = machine.next[token_counts.ROOT if i in begin else state, machine.letter[c]]
        assert states[i] == state


def test_counts_of_odd_rows(spark):
    odd = odd_rows(spark)
    rows = token_counts.count_tokens(odd, VOCABULARY).collect()
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert len(rows) == odd.count()
    for r in rows:
        if r["key"] is not None:
            text = texts[r["key"]]
            assert r["n_bytes"] == len(text.encode()) and r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
    assert token_counts.count_tokens(odd.limit(0), VOCABULARY).count() == 0


# --- fingerprints


def plain_anchors(text, k, s):
    """Closed syncmers one by one, with the operator's hash."""
    if not text:
        return set()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    spans = common.SpanHash(codes)

    def h(a, b):
        return int(spans.of(np.array([a]), np.array([b]))[0])

    if len(text) < k:
        return {(0, h(0, len(text)) >> 32)}
    out = set()
    for i in range(len(text) - k + 1):
        inner = [h(j, j + s) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.add((i, h(i, i + k) >> 32))
    return out


def test_anchors_match_plain_ones(monkeypatch):
    texts = random_texts("abcé🙂 ", 30, 120) + ["", "x", "short", "ab" * 40]
    expected = [plain_anchors(t, 16, 6) for t in texts]
    for size in (1 << 20, 64):
        monkeypatch.setattr(fingerprints, "SLICE_CHARS", size)
        owner, place, hashes = fingerprints.anchors(texts)
        found = [set() for _ in texts]
        for o, p, h in zip(owner.tolist(), place.tolist(), hashes.tolist(), strict=True):
            found[o].add((p, h))
        assert found == expected


def test_anchors_do_not_depend_on_context():
    passage = random_texts("abcdefgh ", 1, 0)[0] + "the quick brown fox jumps over the lazy dog again and again"
    whole = fingerprints.anchors(["zzzz" + passage + "yyyy"])
    alone = fingerprints.anchors([passage])
    assert {(p + 4, h) for p, h in zip(alone[1].tolist(), alone[2].tolist(), strict=True)} <= set(zip(whole[1].tolist(), whole[2].tolist(), strict=True))


def plain_likeness(a, b):
    """Numbered anchors matched in order, by the textbook table of the longest common subsequence."""
    first, second = ([(h, x[:i].count(h)) for i, h in enumerate(x)] for x in (a, b))
    row = np.zeros(len(second) + 1, int)
    for item in first:
        ends = row[:-1] + np.array([item == other for other in second], int)
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(ends, row[1:]))])
    return row[-1] / (len(a) + len(b) - row[-1]) if a and b else float(len(a) == len(b))


def test_likeness_is_positional():
    paragraphs = random_texts("abcdefgh ", 40, 400)
    shuffled = [paragraphs[i] for i in np.random.default_rng(4).permutation(40)]
    whole, mixed, edited = fingerprints.anchor_lists(["\n".join(paragraphs), "\n".join(shuffled), "\n".join(paragraphs[:30] + shuffled[30:])])
    assert fingerprints.written(whole) != "" and fingerprints.likeness(whole, whole) == 1.0
    assert fingerprints.likeness(whole, mixed) < 0.3 < 0.5 < fingerprints.likeness(whole, edited)
    draw = np.random.default_rng(5)
    for _ in range(200):
        a, b = (draw.integers(0, 6, draw.integers(0, 25)).astype(np.uint32) for _ in range(2))
        assert fingerprints.likeness(a, b) == pytest.approx(plain_likeness(a.tolist(), b.tolist()))


def check_fingerprints(rows, docs):
    ordered = sorted(docs, key=lambda d: -d[0])
    found = {r["key"]: r for r in rows}
    assert len(rows) == len(docs)
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after, r = text or "", after or "", found[key]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, other, following = fingerprints.anchor_lists([text, edited, after])
        lowest = [sorted(set(x.tolist()))[:64] for x in (own, other)]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert [r["fingerprint"], r["edited_fingerprint"]] == ["".join(f"{h:08x}" for h in x) for x in lowest]
        assert r["near_edited"] == fingerprints.likeness(own, other) and r["near_next"] == fingerprints.likeness(own, following)


@pytest.mark.parametrize("ranges", ["1", "4", "23"])
def test_documents_against_the_next_one(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
        check_fingerprints(fingerprints.compared_with_next(docs).collect(), [tuple(r) for r in docs.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_odd_rows(spark):
    odd = odd_rows(spark)
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_fingerprints(fingerprints.compared_with_next(unique).collect(), [(r["doc_id"], r["text"]) for r in unique.collect()])
    assert fingerprints.compared_with_next(odd).count() == odd.count()
    assert fingerprints.compared_with_next(odd.limit(0)).count() == 0
    assert fingerprints.compared_with_next(unique.limit(1)).count() == 1
    assert fingerprints.document_anchors(odd).where("key = 3").count() == 1


# --- languages


def test_markup_and_addresses():
    page = '<!doctype html><HTML class=a lang="de-AT"><head><style>p{}</style></head><body><nav>menu</nav><p>Guten&nbsp;Tag<script>x=1</script></body>'
    assert language.declared_language(page) == "de"
    assert " ".join(language.visible_text(page).split()) == "Guten Tag"
    assert language.declared_language("<p lang='fr'>") == ""
    assert language.address_parts("http://blog.Example.com:80/fr/1") == ("blog.example.com", "example.com", "com")
    assert language.address_parts("https://a.b.co.uk/x") == ("a.b.co.uk", "b.co.uk", "uk")
    assert language.address_parts(None) == language.address_parts("nonsense") == ("", "", "")


def test_languages_of_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op6_language(spark, sf_dir).collect()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert len(rows) == pages.count()
    # The markup declares the truth here; the text alone must already find it.
    known = [r for r in rows if r["declared"]]
    assert np.mean([r["language"] == r["declared"] for r in known]) > 0.97
    assert np.mean([r["text_language"] == r["declared"] for r in known]) > 0.95
    assert all(0 <= r["probability"] <= 1 for r in rows)


def test_fusion_equals_bayes_rule(spark):
    model = language.TextModel(("aa", "bb"), np.log(np.stack([np.linspace(1, 2, language.BUCKETS), np.linspace(2, 1, language.BUCKETS)], 1) / language.BUCKETS).astype(np.float32))
    data = [(i, f"http://h{i % 2}.example.com/{i}", f'<html lang="{"ab"[i % 3 == 0]}"><p>{t}') for i, t in enumerate(random_texts("abcdefgh ", 12, 80))]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    found = {r["key"]: r for r in language.identify(pages, model).collect()}
    log = np.array([model.weights[language.trigrams(language.visible_text(h))].sum(0, dtype=float) for _, _, h in data]) * language.TEXT_SHARE
    own = np.exp(log - log.max(1, keepdims=True))
    own /= own.sum(1, keepdims=True)
    totals = own.sum(0)
    share = (totals + 1) / (totals.sum() + 2)
    for i, (_, url, html) in enumerate(data):
        others = [j for j in range(len(data)) if j != i]
        near = own[others].sum(0)
        prior = (near + language.SMOOTH * share) / (near.sum() + language.SMOOTH)
        host = own[[j for j in others if j % 2 == i % 2]].sum(0)
        prior = (host + language.SMOOTH * prior) / (host.sum() + language.SMOOTH)
        declared = own[[j for j in others if (j % 3 == 0) == (i % 3 == 0)]].sum(0)
        fused = log[i] + np.log(prior) + np.log((declared + 1) / (totals + 2)) + np.log((near + 1) / (totals + 2))
        p = np.exp(fused - fused.max())
        p /= p.sum()
        assert found[i]["language"] == ("aa", "bb")[int(p.argmax())] and found[i]["probability"] == pytest.approx(p.max())


def test_languages_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "das ist ein haus", "de"), (2, "the house is here", "en"), (3, None, "de"), (4, "x", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ("de", "en")
    pages = spark.createDataFrame(
        [(1, None, None, 0), (2, "bad", "", 0), (3, "http://a.de/", "<html lang=de><p>das haus", 0), (3, "http://a.de/", "<html lang=de><p>das haus", 0), (None, "http://a.de/", "x" * 300_000, 0)],
        "page_id long, url string, html string, host int",
    )
    rows = language.identify(pages, model).collect()
    assert len(rows) == 5 and {r["language"] for r in rows if r["key"] == 3} == {"de"}
    assert language.identify(pages.limit(0), model).count() == 0
    none = language.identify(pages, language.fit(docs.limit(0))).collect()
    assert len(none) == 5 and {(r["language"], r["probability"]) for r in none} == {(None, 0.0)}


# --- nearest neighbours


def plain_neighbours(rows, asked, k):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v)}
    out = {}
    for q, qv in rows:
        if q in asked:
            near = sorted((-float((np.array(v, float) * np.array(qv, float)).sum()), i) for i, v in rows if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def found_neighbours(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall_of_the_embeddings(spark):
    sf_dir = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    truth = plain_neighbours(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    found = found_neighbours(queries.op10_nearest(spark, sf_dir))
    assert found.keys() == truth.keys()
    assert np.mean([len({i for _, i, _ in found[q]} & {i for _, i, _ in truth[q]}) / 20 for q in truth]) >= 0.9
    vector = dict(rows)
    for q, near in found.items():
        assert [r for r, _, _ in near] == list(range(1, 21)) and all(i != q for _, i, _ in near)
        assert near == sorted(near, key=lambda n: (-n[2], n[1]))
        for _, i, score in near:
            assert score == float((np.array(vector[q], float) * np.array(vector[i], float)).sum())


@pytest.mark.parametrize("count", [1, 2, 15, 300])
def test_neighbours_with_ties_copies_and_odd_vectors(spark, monkeypatch, count):
    monkeypatch.setattr(nearest, "CELL", 16)
    r = np.random.default_rng(count)
    rows = [(i, [float(x) for x in r.integers(-2, 3, 3)]) for i in range(count)] + [(1000 + i, [1.0, 1.0, 2.0]) for i in range(count)]
    odd = [(2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [float("nan"), 1.0, 1.0]), (2003, [float("inf"), 1.0, 1.0]), (2004, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), rows[-1]]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, `key` string, e int")
    # Every bucket is visited: the result must then be exact.
    found = found_neighbours(nearest.neighbours(frame, frame.where(F.col("vec_id") % 5 == 0), k=20, directions=3, probes=27, tables=8))
    truth = plain_neighbours(rows + odd, {i for i, _ in rows + odd if i is not None and i % 5 == 0}, 20)
    assert {q: [i for _, i, _ in n] for q, n in found.items()} == {q: [i for _, i, _ in n] for q, n in truth.items() if n}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.neighbours(empty, empty).count() == 0
