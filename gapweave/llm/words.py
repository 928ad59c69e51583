"""Word tokens of a tokenizer that normalises, splits texts into words by character class, and encodes each word alone.

The splitting is done for a whole slice of texts at once. A word's ids come from the tokenizers library, once per distinct word
and worker; words are told apart by a 64-bit hash. Texts whose normal form the fast way does not cover are given to the library whole."""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from gapweave.llm.common import SpanHash

#: What the fast way covers. Fixed values of the vocabulary file's normaliser and splitter.
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALISERS = ["NFC", "Replace", "Lowercase"]
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, LETTER, DIGIT, OTHER, SPECIAL = range(5)
#: Two code points that are no characters stand for special strings inside a text.
_MARK = 0x10FFFE
#: Distinct words a worker remembers.
MAX_WORDS = 1 << 20


def _class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = DIGIT
    table[_WHITE] = SPACE
    table[_MARK : _MARK + 2] = SPECIAL
    return table


class Words:
    """One tokenizer's words: a slice of texts in, word spans and their ids out."""

    _open: dict[str, Words] = {}

    @classmethod
    def of(cls, path: str) -> Words:
        """The worker's instance for a vocabulary file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != _NORMALISERS or split["pattern"].get("Regex") != _PATTERN or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError("the vocabulary file splits words in another way")
        self.library = Tokenizer.from_file(path)
        specials = sorted(((t["content"], t["id"]) for t in spec["added_tokens"]), key=lambda t: t[1])
        if len(specials) > 2:
            raise ValueError("at most two special strings are covered")
        self._marks = [(text, f" {chr(_MARK + i)} ") for i, (text, _) in enumerate(specials)]
        self._special_ids = [i for _, i in specials]
        spec["normalizer"] = None
        spec["added_tokens"] = []
        self._plain = Tokenizer.from_str(json.dumps(spec))
        last = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
        for token, i in spec["model"]["vocab"].items():
            last[i] = token.endswith("</w>")
        self._last = last
        self._table = _class_table()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def covers(self, text: str) -> bool:
        return text.isascii() or not (chr(_MARK) in text or chr(_MARK + 1) in text)

    def normal(self, text: str) -> str:
        if "<" in text:
            for special, mark in self._marks:
                text = text.replace(special, mark)
        if not text.isascii():
            # The library lowers each character by itself, so no final form of sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def scan(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes, starts, ends, owner) of the words of normalised texts; ``owner`` is the text's number."""
        codes = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self._table[codes]
        n = len(codes)
        if not n:
            return codes, *(np.zeros(0, np.int64),) * 3
        before = np.concatenate([[SPACE], kind[:-1]])
        start = (kind != SPACE) & ((kind != before) | (kind == DIGIT) | (kind == SPECIAL))
        # An apostrophe that starts a word and is followed by one of the endings makes a word with it.
        quote = np.flatnonzero((codes == 39) & start)
        quote = quote[quote + 1 < n]
        quote = quote[kind[quote + 1] == LETTER]
        one = codes[quote + 1]
        two = codes[np.minimum(quote + 2, n - 1)]
        two = np.where(quote + 2 < n, two, 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((two == ord("l")) & (one == ord("l")))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + size
        inside = after < n
        start[after[inside]] |= kind[after[inside]] == LETTER
        cut = np.flatnonzero(start | ((kind == SPACE) & (before != SPACE)))
        begins = start[cut]
        ends = np.concatenate([cut[1:], [n]])[begins]
        starts = cut[begins]
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        return codes, starts, ends, np.searchsorted(offsets, starts, side="right") - 1

    def look_up(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Position of each word among the remembered ones, after the library has encoded the new ones."""
        hashes, first, number = np.unique(SpanHash(codes).of(starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > MAX_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        if not known.all():
            fresh = np.flatnonzero(~known)
            words = [codes[starts[i] : ends[i]].tobytes().decode("utf-32-le", "surrogatepass") for i in first[fresh]]
            ids, counts = self._encode(words)
            begin = len(self._ids) + np.concatenate([[0], np.cumsum(counts)[:-1]])
            self._ids = np.concatenate([self._ids, ids])
            keys = np.concatenate([self.keys, hashes[fresh]])
            order = np.argsort(keys)
            self.keys = keys[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            self._starts = np.concatenate([self._starts, begin])[order]
            at = np.searchsorted(self.keys, hashes)
        return at[number]

    def ids(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, number of ids of each)."""
        counts = self.counts[words].astype(np.int64)
        total = np.cumsum(counts)
        inner = np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)
        return self._ids[np.repeat(self._starts[words], counts) + inner], counts

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per word. Words are given to the library in one text; an id that ends a word closes it."""
        out_ids, out_counts = [], []
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            special = np.array([len(w) == 1 and ord(w) >= _MARK for w in part])
            plain = [w for w in part if not (len(w) == 1 and ord(w) >= _MARK)]
            ids = np.array(self._plain.encode(" ".join(plain), add_special_tokens=False).ids, np.uint32)
            closes = np.flatnonzero(self._last[ids]) + 1
            counts = np.diff(np.concatenate([[0], closes]))
            if len(counts) != len(plain):
                each = [self._plain.encode(w, add_special_tokens=False).ids for w in plain]
                ids, counts = np.array([i for e in each for i in e], np.uint32), np.array([len(e) for e in each])
            if special.any():
                marks = [self._special_ids[ord(w) - _MARK] for w in part if len(w) == 1 and ord(w) >= _MARK]
                slots = np.flatnonzero(special)
                before = np.concatenate([[0], np.cumsum(counts)])[slots - np.arange(len(slots))]
                ids = np.insert(ids, before, marks).astype(np.uint32)
                whole = np.ones(len(part), np.int64)
                whole[~special] = counts
                counts = whole
            out_ids.append(ids), out_counts.append(counts)
        return np.concatenate(out_ids), np.concatenate(out_counts).astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, number of ids of each text), as the library gives them without added tokens."""
        odd = [i for i, t in enumerate(texts) if not self.covers(t)]
        normal = [self.normal(t) for t in texts]
        for i in odd:
            normal[i] = ""
        codes, starts, ends, owner = self.scan(normal)
        if len(starts):
            ids, counts = self.ids(self.look_up(codes, starts, ends))
            sizes = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        else:
            ids, sizes = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        for i in odd:
            own = self.library.encode(texts[i], add_special_tokens=False).ids
            at = int(sizes[:i].sum())
            ids = np.insert(ids, at, own).astype(np.uint32)
            sizes[i] = len(own)
        return ids, sizes
