"""Language of web pages by fusing evidence in Bayes' rule.

Four sources meet in the log posterior of a page: the likelihood of its text (hashed character trigrams, trained on
documents of known language), how often a language's pages declare what this page's markup declares, how often
they have its address suffix, and the prior of its host. Declarations, suffixes and hosts are counted over all
pages, each page with the weights that its text alone gives to the languages, in grouped aggregations. A host's prior is smoothed
towards its domain's, that one towards the share over all pages; a page's own weight is taken off its host's and domain's first.

Cases: null or empty markup has no text evidence and leans on the rest; a missing declaration, a null or odd address are values of their own
("") like any other; repeated rows count as often as they come; ties go to the language first in order; without training rows the language is null with
probability 0; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import col, map_batches, slices, stored, texts_of

#: Bounded sample of documents that the text model is trained on: those with the lowest hash of their key.
MAX_SAMPLE = 8000
#: Hashed trigrams, pseudo-counts of smoothing, and the share of the text's log likelihood that counts (neighbouring trigrams repeat each other).
BUCKETS, SMOOTH, TEXT_SHARE = 1 << 15, 20.0, 0.1

_OPENING = re.compile(r"<!--|<(script|style|noscript|nav)\b", re.IGNORECASE)
_CLOSING = re.compile(r"-->|</(script|style|noscript|nav)\s*>", re.IGNORECASE)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.IGNORECASE)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", re.IGNORECASE)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages, log probabilities


def _shown(markup: str) -> str:
    """The markup with comments and hidden elements as blanks, in one scan for openings and one for closings. What is never closed stays."""
    closings: dict[str, list[tuple[int, int]]] = {}
    for found in _CLOSING.finditer(markup):
        closings.setdefault((found.group(1) or "--").lower(), []).append(found.span())
    turn = dict.fromkeys(closings, 0)
    parts, at = [], 0
    for found in _OPENING.finditer(markup):
        if found.start() < at:
            continue
        kind = (found.group(1) or "--").lower()
        ends, i = closings.get(kind, []), turn.get(kind, 0)
        while i < len(ends) and ends[i][0] < found.end():
            i += 1
        turn[kind] = i
        if i < len(ends):
            parts += [markup[at : found.start()], " "]
            at = ends[i][1]
    return "".join([*parts, markup[at:]])


def visible_text(markup: str) -> str:
    return entities.unescape(_TAG.sub(" ", _shown(markup)))


def declared_language(markup: str) -> str:
    """Primary tag of the html element's lang attribute, or nothing."""
    found = _DECLARED.search(markup)
    return found.group(1).lower() if found else ""


def address_parts(url: str | None) -> tuple[str, str, str]:
    """(host, domain, suffix): the domain is the host's last two labels or, under a reserved second label, three."""
    found = _HOST.match(url or "")
    host = found.group(1).lower().rstrip(".") if found else ""
    labels = host.split(".")
    n = 3 if len(labels) > 2 and len(labels[-2]) <= 3 else 2
    return host, ".".join(labels[-n:]), labels[-1] if len(labels) > 1 else ""


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of code points, lower case, other than letters as one blank."""
    codes = np.frombuffer(" ".join(re.findall(r"[^\W\d_]+", text.lower())).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    h = (codes[:-2] * np.uint64(1_000_003) + codes[1:-1]) * np.uint64(1_000_003) + codes[2:]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)


def fit(docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> TextModel:
    """Trigram model from documents of known language; counts, not texts, come to the driver: BUCKETS numbers a language."""
    known = docs.where(col(language).isNotNull()).select(col(key).cast("string").alias("k"), col(language).alias("lang"))
    chosen = known.withColumn("h", F.xxhash64("k")).orderBy("h", "k").limit(MAX_SAMPLE).select("k", "lang")
    sample = docs.select(col(key).cast("string").alias("k"), col(text).alias("text")).join(F.broadcast(chosen), "k").select("lang", "text")

    def count(batch: pa.RecordBatch):
        total: dict[str, np.ndarray] = {}
        for lang, string in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
            total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            total[lang] += np.bincount(trigrams(string), minlength=BUCKETS)
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    rows = map_batches(sample, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.full((BUCKETS, len(languages)), 0.5)
    number = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, (found["bucket"].to_numpy(np.int64), found["lang"].map(number).to_numpy(np.int64)), found["n"].to_numpy(float))
    return TextModel(languages, np.log(counts / counts.sum(0)).astype(np.float32))


def _soft(log: np.ndarray) -> np.ndarray:
    e = np.exp(log - log.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _text_rows(pages: DataFrame, model: TextModel, key: str, url: str, markup: str) -> DataFrame:
    """Per page: declaration, address parts, log likelihoods of the text and the weights they give alone."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    wanted = pages.select(col(key).alias("key"), col(url).alias("url"), col(markup).alias("html"))

    def work(batch: pa.RecordBatch):
        weights = shared.value.weights
        sources = texts_of(batch, "html")
        urls = batch.column(1).to_pylist()
        for low, high in slices(sources):
            part = sources[low:high]
            log = np.stack([weights[t].sum(0, dtype=np.float64) if len(t := trigrams(visible_text(s))) else np.zeros(weights.shape[1]) for s in part]) * TEXT_SHARE
            parts = [address_parts(u) for u in urls[low:high]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), *(pa.array(list(x), pa.string()) for x in zip(*parts, strict=True)), pa.array([declared_language(s) for s in part], pa.string()), pa.array(list(log), pa.list_(pa.float64())), pa.array(list(_soft(log)), pa.list_(pa.float64()))],
                ["key", "host", "domain", "suffix", "declared", "log", "own"],
            )

    return map_batches(wanted, work, f"key {wanted.schema['key'].dataType.simpleString()}, host string, domain string, suffix string, declared string, log array<double>, own array<double>")


def _counted(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Summed weights of each language by one column."""
    return rows.groupBy(by).agg(F.array(*[F.sum(F.col("own")[i]) for i in range(n)]).alias(f"{by}_counts"))


def identify(pages: DataFrame, model: TextModel, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Rows (key, language, probability, text_language, declared, host): the fused language of every page."""
    n = len(model.languages)
    if not n:
        empty = F.lit(None).cast("string")
        return pages.select(col(key).alias("key"), empty.alias("language"), F.lit(0.0).alias("probability"), empty.alias("text_language"), empty.alias("declared"), empty.alias("host"))
    rows = stored(_text_rows(pages, model, key, url, markup), "page-text")
    whole = rows.agg(F.count("*").alias("pages"), *[F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(n)]).first()
    totals = np.array([whole[f"s{i}"] for i in range(n)])
    share = (totals + 1) / (totals.sum() + n)
    joined = rows
    for by in ("declared", "suffix", "domain", "host"):
        joined = joined.join(_counted(rows, by, n), by)
    names = model.languages
    kind = rows.schema["key"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        def matrix(name):
            lists = batch.column(batch.schema.get_field_index(name))
            return np.array(lists.to_pylist(), float).reshape(batch.num_rows, n)

        log, own = matrix("log"), matrix("own")
        domain, host = matrix("domain_counts") - own, matrix("host_counts") - own
        prior = (np.maximum(domain, 0) + SMOOTH * share) / (np.maximum(domain.sum(1, keepdims=True), 0) + SMOOTH)
        prior = (np.maximum(host, 0) + SMOOTH * prior) / (np.maximum(host.sum(1, keepdims=True), 0) + SMOOTH)
        fused = log + np.log(prior)
        for name in ("declared_counts", "suffix_counts"):
            # Probability of this value for each language, the page itself left out; never quite 0.
            fused += np.log((np.maximum(matrix(name) - own, 0) + 1) / (totals + 2))
        p = _soft(fused)
        best, plain = p.argmax(1), log.argmax(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([names[i] for i in best]), pa.array(p[np.arange(len(p)), best]), pa.array([names[i] for i in plain]), batch.column(1), batch.column(2)],
            ["key", "language", "probability", "text_language", "declared", "host"],
        )

    wanted = joined.select("key", "declared", "host", "log", "own", "domain_counts", "host_counts", "declared_counts", "suffix_counts")
    return map_batches(wanted, work, f"key {kind}, language string, probability double, text_language string, declared string, host string")
