"""Texts cut where a byte-level tokenizer never joins; each different part of them is encoded once.

The usual pattern of byte-level models keeps runs of letters, of digits, of other signs and of white space apart, puts one blank in front
of a run, and knows a few endings after an apostrophe. So a boundary always lies before white space after another character, after a
single line break, between ASCII letters, digits and other signs (not after an apostrophe), and none of these depends on more than the
bytes around it. Cuts are found in all texts of a batch at once with numpy. A part of at most ``SHORT`` bytes is its own key, two
64-bit words; its ids are remembered (``REMEMBERED`` parts at most, then the memory starts anew). Longer parts are encoded once per batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from shelfwright.llm.shingles import mix

REMEMBERED, SHORT, TOGETHER = 400_000, 16, 64
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

_OTHER, _LETTER, _DIGIT, _SIGN, _BLANK, _BREAK, _HIGH, _QUOTE = range(8)


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    out[33:127] = _SIGN
    out[ord("0"):ord("9") + 1] = _DIGIT
    out[ord("A"):ord("Z") + 1] = out[ord("a"):ord("z") + 1] = _LETTER
    out[ord("'")], out[ord(" ")] = _QUOTE, _BLANK
    out[9:14], out[128:] = _BREAK, _HIGH
    return out


def _boundaries() -> np.ndarray:
    """Whether a boundary lies between two bytes of these classes."""
    out = np.zeros((8, 8), bool)
    solid = [_LETTER, _DIGIT, _SIGN, _QUOTE]
    for c in solid:
        out[c, [_BLANK, _BREAK]] = out[_BREAK, c] = True
    out[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = out[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    out[_SIGN, [_LETTER, _DIGIT]] = out[_QUOTE, _DIGIT] = out[_HIGH, _BLANK] = True
    return out


_CLASS, _CUTS = _classes(), _boundaries().ravel()
_SOLID = np.isin(np.arange(8), [_LETTER, _DIGIT, _SIGN, _QUOTE])


def cut(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of each part of all texts; a text begins a part."""
    kind = _CLASS[raw]
    at = np.zeros(len(raw) + 1, bool)
    if len(raw) > 1:
        at[1:-1] = _CUTS[(kind[:-1] << 3) | kind[1:]]
        after_break = np.flatnonzero(at[1:-1] & (kind[:-1] == _BREAK)) + 1
        # A run of white space stays whole but for a single line break.
        at[after_break[(after_break >= 2) & ~_SOLID[kind[np.maximum(after_break - 2, 0)]]]] = False
        high = np.flatnonzero(at[1:-1] & (kind[:-1] == _HIGH)) + 1
        # Lead bytes of characters that may be white space outside of ASCII.
        spaces = (raw[np.maximum(high - 2, 0)] == 0xC2) | np.isin(raw[np.maximum(high - 3, 0)], (0xE1, 0xE2, 0xE3))
        at[high[spaces]] = False
    at[offsets] = True
    return np.flatnonzero(at[:-1])


class Parts:
    """Encoder of many texts at once. ``long`` takes the bytes of parts above ``limit`` bytes, if given, in the library's place."""

    def __init__(self, serialized: str, dtype: str, long: Callable[[bytes], np.ndarray] | None = None, limit: int = 1 << 62):
        self.tokenizer = Tokenizer.from_str(serialized)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(serialized)
        kind = spec.get("pre_tokenizer") or {}
        self.cuts = (kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and kind.get("use_regex", True)
                     and not spec.get("normalizer"))
        self.dtype, self.long, self.limit = np.dtype(dtype), long, limit
        # A character of a byte-level token stands for one byte.
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.sizes = np.array([len(n or "") for n in names], np.int64)
        self.forget()

    def forget(self) -> None:
        self.keys, self.one, self.two = (np.zeros(0, np.uint64) for _ in range(3))
        self.size, self.start, self.count = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, self.dtype)

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each part. Parts that begin with the only blank in them are encoded side by side."""
        out: list[np.ndarray | None] = [None] * len(parts)
        beside = [i for i, p in enumerate(parts) if p[:1] == b" " and len(p) > 1 and p[1:].isalnum()]
        groups = [beside[a:a + TOGETHER] for a in range(0, len(beside), TOGETHER)]
        for group, ids in zip(groups, self.library([b"".join([parts[i] for i in g]).decode() for g in groups]), strict=True):
            at = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(parts[i]) for i in group])) + 1
            for i, own in zip(group, np.split(ids, at[:-1]), strict=True):
                out[i] = own
        apart = [i for i, o in enumerate(out) if o is None and (self.long is None or len(parts[i]) <= self.limit)]
        for i, ids in zip(apart, self.library([parts[i].decode() for i in apart]), strict=True):
            out[i] = ids
        return [self.long(p).astype(self.dtype) if o is None else o for o, p in zip(out, parts, strict=True)]

    def _learn(self, keys: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray, ids: list[np.ndarray]) -> None:
        """Remember short parts with new keys."""
        count = np.array([len(i) for i in ids], np.int64)
        start = len(self.pool) + np.cumsum(count) - count
        self.pool = np.concatenate([self.pool, *ids])
        joined = np.concatenate([self.keys, keys])
        order = np.argsort(joined, kind="stable")
        self.keys = joined[order]
        for name, more in (("one", one), ("two", two), ("size", size), ("start", start), ("count", count)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])

    def _places(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pool of ids, and where the ids of each part lie in it."""
        padded = np.concatenate([raw, np.zeros(16, np.uint8)])
        lanes = np.ndarray((len(raw) + 8,), "<u8", buffer=padded.data, strides=(1,))
        low, high = np.minimum(sizes, 8).astype(np.uint64), np.clip(sizes - 8, 0, 8).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)

        def head(values: np.ndarray, n: np.ndarray) -> np.ndarray:
            return np.where(n == 0, np.uint64(0), values & (full >> (np.uint64(64) - np.maximum(n, np.uint64(1)) * np.uint64(8))))

        one, two = head(lanes[starts], low), head(lanes[np.minimum(starts + 8, len(raw))], high)
        key = mix(one * _M1 ^ mix(two * _M2 + sizes.astype(np.uint64)))
        short = np.flatnonzero(sizes <= SHORT)
        if len(self.keys) > REMEMBERED:
            self.forget()
        found, rep, inverse = np.unique(key[short], return_index=True, return_inverse=True)
        rep = short[rep]
        known = np.searchsorted(self.keys, found)
        known[known == len(self.keys)] = 0
        new = self.keys[known] != found if len(self.keys) else np.ones(len(found), bool)
        if new.any():
            r = rep[new]
            self._learn(found[new], one[r], two[r], sizes[r], self._fresh([raw[a:a + n].tobytes() for a, n in zip(starts[r].tolist(), sizes[r].tolist(), strict=True)]))
            known = np.searchsorted(self.keys, found)
        start, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        at = known[inverse]
        start[short], count[short] = self.start[at], self.count[at]
        # Different parts of one key, and long parts.
        same = (self.one[at] == one[short]) & (self.two[at] == two[short]) & (self.size[at] == sizes[short]) if len(short) else np.zeros(0, bool)
        rest = np.concatenate([short[~same], np.flatnonzero(sizes > SHORT)])
        pool = self.pool
        if len(rest):
            texts = [raw[a:a + n].tobytes() for a, n in zip(starts[rest].tolist(), sizes[rest].tolist(), strict=True)]
            different = list(dict.fromkeys(texts))
            ids = self._fresh(different)
            counts = np.array([len(i) for i in ids], np.int64)
            begin = len(pool) + np.cumsum(counts) - counts
            number = {t: k for k, t in enumerate(different)}
            place = np.array([number[t] for t in texts], np.int64)
            start[rest], count[rest] = begin[place], counts[place]
            pool = np.concatenate([pool, *ids])
        return pool, start, count

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin (with the end)."""
        rows = len(offsets) - 1
        if not self.cuts:
            ids = self.library([raw[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            return np.concatenate([np.zeros(0, self.dtype), *ids]), np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
        if len(raw) == 0:
            return np.zeros(0, self.dtype), np.zeros(rows + 1, np.int64)
        starts = cut(raw, offsets[offsets < len(raw)])
        sizes = np.diff(np.append(starts, len(raw)))
        pool, start, count = self._places(raw, starts, sizes)
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = pool[np.repeat(start - ends[:-1], count) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, offsets)]
