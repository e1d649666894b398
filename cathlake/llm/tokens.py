"""Whole texts to token ids with the tokenizers library, over Arrow batches.

A text is cut into segments that a tokenizer handles independently of each
other. Each distinct segment of a slice is encoded once, kept in a bounded
per-process cache, and the ids of whole texts are gathered from it, so the
library sees every spelling once instead of every occurrence.
"""

from __future__ import annotations

import array
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import gather

SLICE_BYTES = 6 << 20   # text bytes encoded at a time; a longer text is a slice of its own
CACHE_SEGMENTS = 150_000  # the cache keeps what was used in its last two rounds of so many segments

_LOADED: dict = {}


def loaded(kind: str, path: str, make: Callable):
    """``make(path)``, once per process."""
    if (kind, path) not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        _LOADED[kind, path] = make(path)
    return _LOADED[kind, path]


class SegmentEncoder:
    """Ids of segments, as little-endian unsigned 32-bit bytes, by a tokenizers model.

    ``ends`` flags, by id, the tokens that end a word, for a tokenizer that
    reads words of letters between white space each for itself: such segments
    are then encoded many in one text, which is told apart by these tokens.
    """

    def __init__(self, tokenizer, ends: np.ndarray | None = None):
        self.tokenizer, self.ends, self.cache, self.old = tokenizer, ends, {}, {}
        self.cache_segments = CACHE_SEGMENTS

    def _joined(self, words: list[str]) -> bool:
        """Encode words of letters in one text; false if they can't be told apart."""
        ids = self.whole(" ".join(words))
        cut = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(cut) != len(words):  # a word became several, as some letters do in lower case
            return False
        raw, at = ids.tobytes(), 0
        for w, end in zip(words, cut.tolist(), strict=True):
            self.cache[w] = raw[at:end]
            at = end
        return True

    def table(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, starts and lengths for a list of distinct segments."""
        if len(self.cache) > self.cache_segments:
            self.old, self.cache = self.cache, {}
        cache, new = self.cache, []
        for s in segments:
            if s not in cache:
                if s in self.old:
                    cache[s] = self.old[s]
                else:
                    new.append(s)
        for i in range(0, len(new), 5_000):
            part = new[i:i + 5_000]
            if self.ends is not None:
                words = [s for s in part if s.isalpha()]
                if words and self._joined(words):
                    part = [s for s in part if not s.isalpha()]
            for s, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                cache[s] = array.array("I", e.ids).tobytes()
        parts = [cache[s] for s in segments]
        lens = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(lens) - lens, lens

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text, encoded directly."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def lists(self, segments: pa.ListArray, direct: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids and their end per list of segments.

        ``direct(words, idx, last)`` marks lists whose segments are not
        independent; they count as empty here and are returned third.
        """
        flat = segments.flatten()
        off = segments.offsets.to_numpy() - segments.offsets[0].as_py()
        enc = flat.dictionary_encode()
        words = enc.dictionary.to_pylist()
        idx = enc.indices.to_numpy()
        ids, starts, lens = self.table(words)
        skip = np.zeros(len(segments), bool)
        if direct is not None and len(idx):
            bad = np.fromiter((direct(w) for w in words), bool, len(words))[idx]
            bad[off[1:][np.diff(off) > 0] - 1] = False  # the last segment has no successor
            of = np.repeat(np.arange(len(segments)), np.diff(off))
            skip[of[bad]] = True
            keep = ~skip[of]
            idx, n = idx[keep], np.bincount(of[keep], minlength=len(segments))
            off = np.concatenate([[0], np.cumsum(n)])
        out, ends = gather(ids, starts, lens, idx)
        at = np.concatenate([[0], ends])
        return out, at[off[1:]], skip


def slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """The array in runs of about ``slice_bytes``, with each run's first row."""
    size = np.maximum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 1)
    run = np.cumsum(size) // slice_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield a, texts.slice(a, b - a)
