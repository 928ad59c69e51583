"""Matching-blocks similarity of two texts, 0 to 100, as an Arrow-batched function and as a batch kernel."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

_BUCKETS = 64


def text_ratio(a: str, b: str) -> int:
    """Rounded share of matched characters; 0 when either side is empty. Not symmetric."""
    if not a or not b:
        return 0
    if a == b:
        return 100
    return round(100 * SequenceMatcher(None, a, b).ratio())


def ratio(a: Column, b: Column) -> Column:
    """``text_ratio`` of two columns. Call it on distinct pairs only."""

    @F.pandas_udf("int")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None or y is None else text_ratio(x, y) for x, y in zip(left, right)], dtype="Int32"
        )

    return score(a, b)


def char_profile(texts) -> np.ndarray:
    """Character counts in hashed buckets; merging buckets only raises the overlap bound."""
    out = np.zeros((len(texts), _BUCKETS), dtype=np.int32)
    for i, text in enumerate(texts):
        if text:
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) % _BUCKETS
            out[i] = np.bincount(codes, minlength=_BUCKETS)
    return out


def possible_pairs(left: np.ndarray, right: np.ndarray, cutoff: int) -> np.ndarray:
    """Pairs whose shared-character bound can still reach the cutoff (exact: no match is lost)."""
    total = left.sum(1)[:, None] + right.sum(1)[None, :]
    overlap = np.zeros(total.shape, dtype=np.int32)
    for bucket in range(_BUCKETS):
        a, b = left[:, bucket], right[:, bucket]
        if a.any() and b.any():
            overlap += np.minimum(a[:, None], b[None, :])
    return 200 * overlap >= (cutoff - 0.5) * total - 1e-9


class TargetScorer:
    """Scores many texts against a bounded list of targets, skipping pairs the bound rules out."""

    def __init__(self, targets: list[str], cutoff: int, key_first: bool = True):
        self.targets = targets
        self.cutoff = cutoff
        self.key_first = key_first
        self.profile = char_profile(targets)
        self.matchers: dict[int, SequenceMatcher] = {}

    def _score(self, key: str, t: int) -> int:
        target = self.targets[t]
        if not key or not target:
            return 0
        if key == target:
            return 100
        if not self.key_first:
            return text_ratio(target, key)
        matcher = self.matchers.get(t)
        if matcher is None:
            matcher = self.matchers[t] = SequenceMatcher(None, "", target)
        matcher.set_seq1(key)
        return round(100 * matcher.ratio())

    def matches(self, keys: list[str], chunk: int = 512):
        """Yield (key position, [(target position, score >= cutoff), ...]) in target order."""
        for start in range(0, len(keys), chunk):
            part = keys[start : start + chunk]
            mask = possible_pairs(char_profile(part), self.profile, self.cutoff)
            for i, row in enumerate(mask):
                found = []
                for t in np.flatnonzero(row):
                    score = self._score(part[i], int(t))
                    if score >= self.cutoff:
                        found.append((int(t), score))
                yield start + i, found
