"""SentencePiece encoding and decoding with shared prefixes.

A normalised text falls into marked words (a run of word marks and what follows it), which no piece crosses. The distinct words of a
slice are sorted, so they form a trie read depth-first, and the forward pass goes on from the common prefix with the word before.

The public model is a byte-pair model, whose encoding is not the one of the largest sum of scores, so the forward pass keeps what
decides a byte-pair encoding: for each prefix, the last piece of its encoding. That is the one piece that ends there and is
stable after the last piece of the prefix before it (encoding the two together gives the same two). Which pieces are stable next to each other follows from
the scores and is remembered. Like a forward score it depends on the prefix alone; reading back from the end gives the encoding. The pieces that end at a
prefix are those of an automaton's state: the longest end of the prefix that some piece begins with.

Cases: null text counts as empty and has no pieces; characters outside the vocabulary become byte pieces; decoding inverts encoding for every text
without word marks of its own; repeated rows each get a row; an empty table gives no rows; extra columns do not matter."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gapweave.llm.common import col, map_batches, slices, texts_of

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Distinct words of a generation, and pairs of pieces, that a worker remembers.
MAX_WORDS, MAX_PAIRS = 1 << 18, 1 << 20
_NO_PIECE = float("-inf")


class _State:
    """An end of a prefix that begins a piece: the states that follow it, by character, and the pieces of two or more characters that it ends
    with, the longest first, each with its size and what is known of the pieces before it."""

    __slots__ = ("text", "moves", "ends")

    def __init__(self, text: str, ends: tuple[tuple[str, int, dict[str, bool]], ...]):
        self.text, self.moves, self.ends = text, {}, ends


class Pieces:
    """Encoder and decoder of one model file."""

    _open: dict[str, Pieces] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        self.score, self.id, self.byte, self.text = {}, {}, {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
                self.text.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece of this model crosses words")
                self.id[piece], self.score[piece] = i, sp.get_score(i)
                self.text.append(piece.replace(MARK, " ").encode())
        if any(x != round(x) for x in self.score.values()):
            raise ValueError("not a byte-pair model: its scores are no ranks of merges")
        self._heads = {piece[:n] for piece in self.id for n in range(len(piece) + 1)}
        self._stable: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        self._states: dict[str, _State] = {}
        self._start = self._state("")
        # Two generations: a full one becomes the old one, and words still in use are taken over from there.
        self.words: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging: the adjacent pair of the best score first, the leftmost of equals."""
        symbols, score = list(symbols), self.score
        worth = [score.get(a + b, _NO_PIECE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while worth:
            best = max(worth)
            if best == _NO_PIECE:
                break
            at = worth.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del worth[at]
            if at < len(worth):
                worth[at] = score.get(symbols[at] + symbols[at + 1], _NO_PIECE)
            if at:
                worth[at - 1] = score.get(symbols[at - 1] + symbols[at], _NO_PIECE)
        return symbols

    def _state(self, text: str) -> _State:
        """The state of the longest end of ``text`` that begins a piece."""
        while text not in self._heads:
            text = text[1:]
        state = self._states.get(text)
        if state is None:
            ends = (text[i:] for i in range(len(text) - 1))
            state = self._states[text] = _State(text, tuple((p, len(p), self._stable.setdefault(p, {})) for p in ends if p in self.id))
        return state

    def _follows(self, before: str, piece: str) -> bool:
        """Whether the piece is stable after the one before it, or alone at the front."""
        if self._pairs >= MAX_PAIRS:
            for known in self._stable.values():
                known.clear()
            self._pairs = 0
        self._pairs += 1
        if before and before + piece in self.score:
            good = False  # the two would merge
        else:
            good = self.merged([*before, *piece]) == ([before, piece] if before else [piece])
        self._stable[piece][before] = good
        return good

    def forward(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct words. ``last[i]`` is the last piece of the encoding of the first i characters of the
        present word and ``states[i]`` their state; both are kept for the prefix that the next word shares."""
        out, before, last, states = {}, "", [""], [self._start]
        ids, follows = self.id, self._follows
        for word in sorted(words):
            end = 0
            for a, b in zip(before, word):  # noqa: B905  # the shorter one ends the shared prefix
                if a != b:
                    break
                end += 1
            del last[end + 1 :], states[end + 1 :]
            state = states[end]
            for found in word[end:]:  # a character that is no piece stands alone
                end += 1
                following = state.moves.get(found)
                if following is None:
                    # Characters that begin no piece all lead to the start and are not kept.
                    following = self._state(state.text + found)
                    if following is not self._start:
                        state.moves[found] = following
                state = following
                for piece, size, known in state.ends:
                    previous = last[end - size]
                    good = known.get(previous)
                    if good is None:
                        good = follows(previous, piece)
                    if good:
                        found = piece
                        break
                last.append(found)
                states.append(state)
            before = word
            pieces = []
            while end:
                piece = last[end]
                i = ids.get(piece)
                pieces.extend([i] if i is not None else [self.byte[b] for b in reversed(piece.encode("utf-8", "surrogatepass"))])
                end -= len(piece)
            out[word] = tuple(reversed(pieces))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [_WORD.findall(self.library.normalize(t)) if t else [] for t in texts]
        present = {w for words in split for w in words}
        fresh = present - self.words.keys()
        if len(self.words) + len(fresh) > MAX_WORDS:
            self.old, self.words, fresh = self.words, {}, present
        self.words |= {w: self.old[w] for w in fresh & self.old.keys()}
        self.words |= self.forward(list(fresh - self.words.keys()))
        known = self.words.__getitem__
        return [np.fromiter(chain.from_iterable(map(known, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of pieces; the mark put before the first word is taken off."""
        text = b"".join([self.text[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, pieces, decoded): the pieces of every text and the text that they decode to."""
    wanted = docs.select(col(key).alias("key"), col(text).alias("text"))

    def work(batch: pa.RecordBatch):
        model, texts, keys = Pieces.of(path), texts_of(batch), batch.column(0)
        for low, high in slices(texts):
            ids = model.encode(texts[low:high])
            yield pa.RecordBatch.from_arrays(
                [keys.slice(low, high - low), pa.array(ids, pa.list_(pa.int32())), pa.array([model.decode(x) for x in ids])], ["key", "pieces", "decoded"]
            )

    return map_batches(wanted, work, f"key {wanted.schema['key'].dataType.simpleString()}, pieces array<int>, decoded string")


def decode(rows: DataFrame, path: str, key: str = "key", pieces: str = "pieces") -> DataFrame:
    """Rows (key, text) of encoded rows; null pieces give an empty text."""
    wanted = rows.select(col(key).alias("key"), col(pieces).alias("pieces"))

    def work(batch: pa.RecordBatch):
        model = Pieces.of(path)
        texts = [model.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts)], ["key", "text"])

    return map_batches(wanted, work, f"key {wanted.schema['key'].dataType.simpleString()}, text string")
