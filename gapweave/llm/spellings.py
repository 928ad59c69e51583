"""Spelling variants of the words of a corpus: near words are found through one-edit neighbourhoods over a reduced alphabet.

A word's letters are hashed to ``SYMBOLS`` symbols. Two words that differ by one inserted, deleted or replaced letter have reduced forms
that are equal or differ by one such edit. Each word's reduced form and the one-edit neighbourhood of it meet the reduced vocabulary
in one join, and the pairs that meet are verified on the words themselves. Every pair is generated from one of its sides only: deletions from
the longer word (the shorter one's insertions are the same pairs), replacements from the word whose reduced letter is the lower symbol, and
equal reduced forms from the word with the lower number.

The strings of a neighbourhood are never built. Each is a 64-bit hash from the prefix sums of its word, so a word of n letters
costs memory in proportion to n; a collision only adds a pair that verification drops.

Words are maximal runs of ``LETTERS`` with A-Z lower-cased. Of a run whose ``<key>:<run>`` has a crc32 that ``NOISE`` divides, one letter is left out.

Cases: null and empty texts have no words; a null key counts as an empty one; repeated rows count again; ties of the commonest near word go to the
smallest in code-point order; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import col, map_batches, mix, stored, texts_of

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT, FACTOR, NOISE = 7, 2, 10, 31
SYMBOLS = 8
#: Letters of the words, times hashes of a letter, that are handled at once.
_CELLS = 1 << 19
#: Distinct words that a task holds before it gives their counts on.
_HELD = 1 << 17
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ODD = 0x9E3779B97F4A7C15
_OWN = 1 << 32
_VALUES = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """Rows (word, n) of the words with enough letters and occurrences."""
    run = re.compile(f"{LETTERS}{{{least_letters},}}")  # a shorter run only loses letters

    def count(batch: pa.RecordBatch):
        texts, found = texts_of(batch), Counter()
        for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            # Bytes lower A-Z alone.
            lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            begun = zlib.crc32(f"{doc}:".encode())
            for word in run.findall(lowered):
                h = zlib.crc32(word.encode(), begun)
                if h % noise == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < least_letters:
                        continue
                found[word] += 1
            if len(found) > _HELD:
                yield _counts(found)
                found = Counter()
        yield _counts(found)

    wanted = docs.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("key"), col(text).alias("text"))
    words = map_batches(wanted, count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counts(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])


def _by_length(words: list[str], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points as a matrix) of words of one length, in slices of about ``cells`` letters."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        step = max(1, cells // max(int(size), 1))
        for low in range(0, len(at), step):
            part = at[low : low + step]
            codes = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield part, codes.reshape(len(part), int(size))


def _salt(size: int) -> np.uint64:
    return np.uint64(size * _ODD % (1 << 64))


def letter_sets(codes: np.ndarray) -> np.ndarray:
    """32 bits for the letters of each word. One edit changes two of them at most."""
    return np.bitwise_or.reduce(np.uint64(1) << (mix(codes.astype(np.uint64) + np.uint64(_ODD)) & np.uint64(31)), axis=1)


def _reduced(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of the letters, powers that places have in a hash)."""
    symbol = (mix(codes.astype(np.uint64)) % np.uint64(SYMBOLS)).astype(np.int64)
    return symbol, np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(codes.shape[1] - 1, 0), _BASE)]), dtype=np.uint64)[: codes.shape[1]]


def reduced_hash(codes: np.ndarray) -> np.ndarray:
    """Hash of the reduced form of each word."""
    symbol, powers = _reduced(codes)
    return mix((_VALUES[symbol] * powers).sum(1, dtype=np.uint64) + _salt(codes.shape[1]))


def neighbourhood(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the reduced word, word number and hash of each string of its neighbourhood) of words of one length."""
    words, size = codes.shape
    if not size:
        return reduced_hash(codes), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    symbol, powers = _reduced(codes)
    terms = _VALUES[symbol] * powers
    sums = np.concatenate([np.zeros((words, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    total = sums[:, -1:]
    # Leaving out either of two equal neighbours gives one string.
    differs = np.concatenate([np.ones((words, 1), bool), symbol[:, 1:] != symbol[:, :-1]], axis=1)
    shorter = mix(sums[:, :-1] + (total - sums[:, 1:]) * _BACK + _salt(size - 1))
    numbers, hashes = [np.nonzero(differs)[0]], [shorter[differs]]
    for other in range(1, SYMBOLS):
        lower = symbol < other
        replaced = total + (_VALUES[other] - _VALUES[symbol]) * powers
        numbers.append(np.nonzero(lower)[0])
        hashes.append(mix(replaced[lower] + _salt(size)))
    return mix(total[:, 0] + _salt(size)), np.concatenate(numbers), np.concatenate(hashes)


def one_edit(left: list[str], right: list[str]) -> np.ndarray:
    """Whether left[i] and right[i] differ by exactly one inserted, deleted or replaced code point."""
    result = np.zeros(len(left), bool)
    longer = [a if len(a) >= len(b) else b for a, b in zip(left, right, strict=True)]
    other = [b if len(a) >= len(b) else a for a, b in zip(left, right, strict=True)]
    gap = np.array([len(a) - len(b) for a, b in zip(longer, other, strict=True)])
    for wanted in (0, 1):
        rows = np.flatnonzero(gap == wanted)
        some = [longer[i] for i in rows]
        for part, a in _by_length(some, 1 << 20):
            at = rows[part]
            size = a.shape[1] - wanted
            b = np.frombuffer("".join(other[i] for i in at).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), size)
            if wanted == 0:
                result[at] = (a != b).sum(1) == 1
            elif size == 0:
                result[at] = True
            else:
                # Equal up to a place, and from there on with a shift of one.
                front, back = a[:, :-1] != b, a[:, 1:] != b
                first = np.where(front.any(1), front.argmax(1), size)
                last = np.where(back.any(1), size - 1 - back[:, ::-1].argmax(1), -1)
                result[at] = last < first
    return result


def near_pairs(words: DataFrame) -> DataFrame:
    """Rows (a, na, b, nb), one for each pair of near words; ``words`` has unique words (word, n)."""
    numbered = words.select("word", "n", F.xxhash64("word").alias("id"))

    def generate(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, codes in _by_length(batch.column(1).to_pylist(), _CELLS // SYMBOLS):
            own, number, hashes = neighbourhood(codes)
            letters, who = letter_sets(codes), ids[at]
            # The reduced form itself has the bit above the letters.
            marked = np.concatenate([letters | np.uint64(_OWN), letters[number]])
            arrays = [np.concatenate([own, hashes]).view(np.int64), np.concatenate([who, who[number]]), marked.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["meet", "a", "letters"])

    def reduce(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, codes in _by_length(batch.column(1).to_pylist(), 1 << 20):
            arrays = [reduced_hash(codes).view(np.int64), ids[at], letter_sets(codes).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["m", "b", "l"])

    bare = numbered.select("id", "word")
    probes = map_batches(bare, generate, "meet long, a long, letters long")
    reduced = map_batches(bare, reduce, "m long, b long, l long")
    # Pairs whose letters differ by more than one edit can change are dropped inside the join.
    alike = F.bit_count(F.col("letters").bitwiseAND(_OWN - 1).bitwiseXOR(F.col("l"))) <= 2
    once = (F.col("letters") < _OWN) | (F.col("a") < F.col("b"))
    met = probes.join(reduced, (F.col("meet") == F.col("m")) & (F.col("a") != F.col("b")) & once & alike).select("a", "b")
    # A number that two words share only adds pairs here.
    left = numbered.select(F.col("id").alias("a"), F.col("word").alias("wa"), F.col("n").alias("na"))
    right = numbered.select(F.col("id").alias("b"), F.col("word").alias("wb"), F.col("n").alias("nb"))
    pairs = met.join(left, "a").join(right, "b").select("wa", "na", "wb", "nb")

    def verify(batch: pa.RecordBatch):
        near = one_edit(batch.column(0).to_pylist(), batch.column(2).to_pylist())
        yield batch.filter(pa.array(near))

    near = map_batches(pairs, verify, "wa string, na long, wb string, nb long")
    # Words whose numbers are equal do not meet above: their pairs are looked for here.
    twins = numbered.groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("w")).where(F.size("w") > 1)
    each = twins.select(F.explode("w").alias("x"), "w").select("x", F.explode("w").alias("y")).where("x.word < y.word")
    same = map_batches(each.select("x.word", "x.n", "y.word", "y.n").toDF("wa", "na", "wb", "nb"), verify, "wa string, na long, wb string, nb long")
    return near.unionByName(same).dropDuplicates(["wa", "wb"])


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n): a word's form is its commonest near word if that is ``factor`` times as common,
    its root the end of the chain of forms."""
    pairs = stored(near_pairs(words), "near-pairs")
    both = pairs.select(F.col("wa").alias("word"), F.col("na").alias("n"), F.col("wb").alias("other"), F.col("nb").alias("m"))
    both = both.unionByName(pairs.select(F.col("wb").alias("word"), F.col("nb").alias("n"), F.col("wa").alias("other"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"), F.first("n").alias("own"))
    common = -F.col("best.m") >= F.col("own") * factor
    near = stored(best.select("word", "n_near", F.when(common, F.col("best.other")).alias("form"), F.when(common, -F.col("best.m")).alias("form_n")), "near-words")
    roots = near.where("form is not null").select("word", F.col("form").alias("root"))
    # Every step is ``factor`` times as common, so chains are short; each round doubles the steps taken.
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    joined = words.join(near, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("form_n").cast("long").alias("form_n")
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``variants`` of the vocabulary of ``docs``."""
    return variants(stored(vocabulary(docs, key, text), "vocabulary"))
