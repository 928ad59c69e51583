"""Token counts by a compiled finite-state tokenizer.

The words that a worker has seen are compiled into a deterministic transducer: a state is a prefix, a
transition reads one character, and the transition that leaves a word emits its number of tokens. A slice of texts is cut into
chunks of equal length, whatever they cut apart, and all chunks run side by side, one character of each at a time.

A chunk does not know the state it starts in. Its map of states is constant once a word starts inside it; before that
it carries a state on, and dies if it carries one further than the longest compiled word. So maps compose by keeping the later constant one, which a prefix scan does
for all chunks at once; a second run then resolves the heads of the chunks with the states so found.

Words outside the transducer are counted by the tokenizer itself, once per distinct word, and the ones that
repeat are compiled for the slices to come. Counts are exact either way.

Cases: null text counts as empty and has no tokens; special strings in a text are one token, as the library takes them; repeated rows
each get a row; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm.common import col, map_batches, slices, texts_of
from gapweave.llm.words import Words

#: Characters of a chunk, states of the transducer, letters of its alphabet, and the longest word it takes.
CHUNK, MAX_STATES, LETTERS, LONGEST = 512, 1 << 16, 64, 40
DEAD, ROOT = 0, 1


class Transducer:
    """Transition and emission tables over compiled words; state 0 is dead, state 1 the start of a word."""

    def __init__(self) -> None:
        self.letter = np.zeros(1 << 16, np.uint8)  # of a code point; 0: not in the alphabet
        self.letters = 1
        self.next = np.zeros((1024, LETTERS), np.int32)
        self.emitted = np.full(1024, -1, np.int32)  # tokens of the word that ends in a state; -1: no word
        self.states = 2

    def compile(self, words: list[str], counts: list[int]) -> None:
        """Adds words with their token counts while there is room; longer or rarer alphabets stay outside."""
        for word, count in zip(words, counts, strict=True):
            if len(word) > LONGEST or self.states + len(word) > MAX_STATES:
                continue
            codes = [ord(c) for c in word]
            if max(codes) >= len(self.letter):
                continue
            fresh = {c for c in codes if not self.letter[c]}
            if self.letters + len(fresh) > LETTERS:
                continue
            for c in sorted(fresh):
                self.letter[c] = self.letters
                self.letters += 1
            while self.states + len(word) > len(self.next):
                self.next = np.concatenate([self.next, np.zeros_like(self.next)])
                self.emitted = np.concatenate([self.emitted, np.full_like(self.emitted, -1)])
            state = ROOT
            for c in codes:
                after = self.next[state, self.letter[c]]
                if after == DEAD:
                    after = self.states
                    self.next[state, self.letter[c]] = after
                    self.states += 1
                state = after
            self.emitted[state] = count

    def run(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """State after each character, given where words start."""
        n = len(codes)
        chunks = -(-n // CHUNK)
        letters = np.zeros(chunks * CHUNK, np.uint8)
        letters[:n] = np.where(codes < len(self.letter), self.letter[np.minimum(codes, len(self.letter) - 1)], 0)
        begins = np.zeros(chunks * CHUNK, bool)
        begins[starts] = True
        letters, begins = letters.reshape(chunks, CHUNK).T.copy(), begins.reshape(chunks, CHUNK).T.copy()
        states = np.zeros((CHUNK, chunks), np.int32)
        table, state = self.next.ravel(), np.zeros(chunks, np.int32)
        for i in range(CHUNK):
            state = table[np.where(begins[i], ROOT, state) * LETTERS + letters[i]]
            states[i] = state
        # Maps of the chunks: constant where a word starts inside, dead or carried on elsewhere. A chunk is longer than any
        # compiled word, so carrying on ends dead, which is constant too; the scan keeps the last constant map before each chunk.
        constant = begins.any(0) | (CHUNK > LONGEST)
        last = np.maximum.accumulate(np.where(constant, np.arange(chunks), -1))
        entered = np.concatenate([[DEAD], np.where(last >= 0, states[-1][np.maximum(last, 0)], DEAD)[:-1]])
        # Second run over the heads only: until a word starts or the state dies.
        open_, state = np.flatnonzero(entered != DEAD), entered[entered != DEAD]
        for i in range(min(LONGEST, CHUNK)):
            going = ~begins[i, open_]
            open_, state = open_[going], state[going]
            if not len(open_):
                break
            state = table[state * LETTERS + letters[i, open_]]
            states[i, open_] = state
        return states.T.ravel()[:n]


class Counter:
    """Exact token counts of texts for one vocabulary file and worker."""

    _open: dict[str, Counter] = {}

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        self.words = Words.of(path)
        self.transducer = Transducer()

    def count(self, texts: list[str]) -> np.ndarray:
        odd = [i for i, t in enumerate(texts) if not self.words.covers(t)]
        normal = [self.words.normal(t) for t in texts]
        for i in odd:
            normal[i] = ""
        codes, starts, ends, owner = self.words.scan(normal)
        total = np.zeros(len(texts), np.int64)
        if len(starts):
            states = self.transducer.run(codes, starts)
            counts = self.transducer.emitted[states[ends - 1]].astype(np.int64)
            spilled = np.flatnonzero(counts < 0)
            if len(spilled):
                at = self.words.look_up(codes, starts[spilled], ends[spilled])
                counts[spilled] = self.words.counts[at]
                self._learn(codes, starts[spilled], ends[spilled], at, counts[spilled])
            total += np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        for i in odd:
            total[i] = len(self.words.library.encode(texts[i], add_special_tokens=False).ids)
        return total

    def _learn(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, counts: np.ndarray) -> None:
        """Compiles the words that came more than once, the most frequent ones first."""
        if self.transducer.states + LONGEST > MAX_STATES:
            return
        _, first, times = np.unique(at, return_index=True, return_counts=True)
        often = np.argsort(-times, kind="stable")
        often = first[often[times[often] > 1]][:20_000]
        self.transducer.compile([codes[starts[i] : ends[i]].tobytes().decode("utf-32-le", "surrogatepass") for i in often], counts[often].tolist())


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_bytes, n_tokens) of every row of ``docs``."""
    wanted = docs.select(col(key).alias("key"), F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long").alias("n_bytes"), col(text).alias("text"))

    def work(batch: pa.RecordBatch):
        counter, texts = Counter.of(path), texts_of(batch)
        counts = [counter.count(texts[low:high]) for low, high in slices(texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(counts))], ["key", "n_bytes", "n_tokens"])

    return map_batches(wanted, work, f"key {wanted.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long")
