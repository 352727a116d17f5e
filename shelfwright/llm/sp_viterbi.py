"""SentencePiece encoding and decoding by a streaming Viterbi search.

``Lattice`` reads characters one by one. It keeps the states of the last ``longest piece`` positions and, for each position since
the last commit, one backpointer. When the paths of all positions from which a piece can still start meet in one boundary, the
ids before it are committed and their backpointers dropped, so a text without blanks runs in a bounded window.

Two kinds of model files are read. In a unigram model a path's score is the sum of its pieces' scores. In a BPE model a path
survives if each two neighbouring pieces are what merging makes of the two alone: exactly one path to each position does, and
it is the result of the merges. Characters without a piece become their bytes' pieces (or the unknown id without byte fallback).

No piece has a blank after another character, so a text is cut before each run of blanks, and further at pairs of characters
that no piece contains: there all paths meet. Short parts are remembered by each Python worker, at most twice ``REMEMBERED``.

Model files with a normaliser, user-defined or unused pieces are refused. The files are never trained here.

Rows: one per input row. A null text is empty and has no ids. Decoding drops the blank that encoding puts first; the sign
U+2581 decodes as a blank, as in the format itself, which ``round_trip`` then shows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format

from shelfwright.llm.frames import small_batches
from shelfwright.llm.memory import Memory, release
from shelfwright.llm.shingles import mix

MARK = "▁"
REMEMBERED, LONGEST_REMEMBERED = 120_000, 48
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_UNKNOWN_PENALTY = 10.0
_PART = re.compile(f"{MARK}+[^{MARK}]*")


class Model:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, serialized: bytes):
        spec = model_format.ModelProto()
        spec.ParseFromString(serialized)
        if spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models with a normaliser are not supported")
        if spec.trainer_spec.model_type not in (_UNIGRAM, _BPE) or {p.type for p in spec.pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only unigram and BPE models of normal, control and byte pieces are supported")
        self.merges = spec.trainer_spec.model_type == _BPE
        self.dummy_prefix = spec.normalizer_spec.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == _NORMAL}
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == _UNKNOWN)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == _BYTE}
        self.longest = max(map(len, self.ids))
        self.inside = {a + b for piece in self.ids for a, b in zip(piece, piece[1:], strict=False)}
        self.cut_at_blanks = not any(b == MARK != a for a, b in self.inside)
        self.floor = min(self.scores.values()) - _UNKNOWN_PENALTY
        surface = {_NORMAL: lambda p: p.piece.replace(MARK, " ").encode(), _UNKNOWN: lambda p: " ⁇ ".encode(),
                   _CONTROL: lambda p: b"", _BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
        self.surfaces = [surface[p.type](p) for p in spec.pieces]
        self._alone: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-scored pair first, the left one of equals."""
        parts = list(text)
        while True:
            best = max(((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores),
                       default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def neighbours(self, left: str, right: str) -> bool:
        """Whether merging leaves ``left`` and ``right`` as they are, side by side."""
        key = f"{left}\0{right}"
        known = self._alone.get(key)
        if known is None:
            if len(self._alone) >= REMEMBERED:
                self._alone.clear()
            known = self._alone[key] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def id_list(self, piece: str) -> list[int]:
        """Ids of a piece, or of the bytes of a character that has none."""
        own = self.ids.get(piece)
        if own is not None:
            return [own]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]


class Lattice:
    """Streaming search; ``push`` yields pieces as soon as they are certain, ``finish`` the rest."""

    def __init__(self, model: Model):
        self.model = model
        self.tail = ""  # the characters since the last commit
        self.back: list[str] = [""]  # the last piece of the path to each position since then; "" at the commit itself
        self.score = [0.0]
        self.before = ""  # last committed piece
        self.check = 2 * model.longest

    def _step(self, character: str) -> None:
        model, self.tail = self.model, self.tail + character
        end, best, last = len(self.tail), None, ""
        for size in range(min(model.longest, end), 0, -1):
            piece, at = self.tail[end - size:], end - size
            score = model.scores.get(piece)
            if score is None and size > 1:
                continue
            if model.merges:
                if model.neighbours(self.back[at] or self.before, piece):
                    last = piece
                    break
            else:
                total = self.score[at] + (model.floor if score is None else score)
                if best is None or total > best:
                    best, last = total, piece
        self.back.append(last)
        self.score.append(best or 0.0)

    def _path(self, end: int) -> list[str]:
        pieces = []
        while end > 0:
            pieces.append(self.back[end])
            end -= len(self.back[end])
        return pieces[::-1]

    def _meeting(self) -> int:
        """Largest boundary on the paths of all positions that a piece can still start from."""
        live = set(range(max(0, len(self.tail) - self.model.longest + 1), len(self.tail) + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - len(self.back[last]))
        return live.pop()

    def push(self, text: str) -> Iterator[str]:
        for character in text:
            self._step(character)
            if len(self.tail) >= self.check:
                at = self._meeting()
                if at:
                    done = self._path(at)
                    yield from done
                    self.before = done[-1]
                    self.tail, self.back, self.score = self.tail[at:], ["", *self.back[at + 1:]], self.score[at:]
                self.check = len(self.tail) + self.model.longest

    def finish(self) -> list[str]:
        return self._path(len(self.tail))


class Sweep:
    """The same search over many short parts at once, a numpy step for each position; a part is one window."""

    BASE, SLOTS, PAIRS = np.uint64(0x100000001B3), 1 << 20, 1 << 20
    #: Parts at once: memory follows this, not the batch.
    AT_ONCE = 4096

    def __init__(self, model: Model):
        self.model = model
        self.pieces = list(model.ids)
        self.ids = np.array([model.ids[p] for p in self.pieces], np.int32)
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.scores = np.array([model.scores[p] for p in self.pieces])
        self.keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        # Two tables: a piece whose slot is taken goes to the second one, by other bits; what finds no place there is searched for.
        self.one, self.two = np.full(self.SLOTS, -1, np.int32), np.full(self.SLOTS, -1, np.int32)
        rest = []
        for i, (s1, s2) in enumerate(zip(*(x.tolist() for x in self._slots(self.keys)), strict=True)):
            table, slot = (self.one, s1) if self.one[s1] < 0 else (self.two, s2)
            if table[slot] >= 0:
                rest.append(i)
            else:
                table[slot] = i
        self.rest = np.array(sorted(rest, key=lambda i: int(self.keys[i])), np.int32)
        self.pair_keys = np.full(self.PAIRS, -1, np.int64)
        self.pair_good = np.zeros(self.PAIRS, bool)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.BASE) + ord(c) + 1) % (1 << 64)
        return h

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(keys)
        return (mixed & np.uint64(self.SLOTS - 1)).astype(np.int64), (mixed >> np.uint64(40) & np.uint64(self.SLOTS - 1)).astype(np.int64)

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Index of the piece of each hash, or -1."""
        s1, s2 = self._slots(keys)
        at = self.one[s1]
        at = np.where((at >= 0) & (self.keys[at] == keys), at, self.two[s2])
        at = np.where((at >= 0) & (self.keys[at] == keys), at, -1)
        if len(self.rest):
            miss = np.flatnonzero(at < 0)
            found = self.rest[np.minimum(np.searchsorted(self.keys[self.rest], keys[miss]), len(self.rest) - 1)]
            at[miss] = np.where(self.keys[found] == keys[miss], found, -1)
        return at

    def _surface(self, token: int) -> str:
        """A token is a piece's index, the number of pieces + 1 + a code point without a piece, or the number of pieces: none."""
        return self.pieces[token] if token < len(self.pieces) else "" if token == len(self.pieces) else chr(token - len(self.pieces) - 1)

    def _neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slots = (mix(keys.view(np.uint64)) & np.uint64(self.PAIRS - 1)).astype(np.int64)
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        good = self.pair_good[slots]
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            found = np.array([self.model.neighbours(self._surface(k >> 32), self._surface(k & 0xFFFFFFFF)) for k in fresh.tolist()])
            good[new] = found[back]
            at = slots[new]
            self.pair_keys[at], self.pair_good[at] = keys[new], good[new]
        return good

    def encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each part as native 32-bit integers; parts of like length together."""
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        out: list[bytes] = [b""] * len(parts)
        for a in range(0, len(order), self.AT_ONCE):
            own = order[a:a + self.AT_ONCE]
            for i, ids in zip(own, self._encode([parts[i] for i in own]), strict=True):
                out[i] = ids
        return out

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, the longest first."""
        order = range(len(parts))
        sizes = np.array([len(parts[i]) for i in order], np.int64)
        n, width = len(parts), int(sizes[0])
        points = np.zeros((n, width), np.int32)
        flat = np.frombuffer("".join(parts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        points[np.arange(width)[None, :] < sizes[:, None]] = flat
        none = len(self.pieces)
        back = np.full((n, width + 1), none, np.int32)
        score = np.zeros((n, 0 if self.model.merges else width + 1))
        prefix = np.zeros((n, width + 1), np.uint64)
        power = self.BASE ** np.arange(self.model.longest + 1, dtype=np.uint64)
        lengths = np.append(self.sizes, 0)
        for end in range(1, width + 1):
            m = int(np.searchsorted(-sizes, -end, "right"))  # parts that reach this position
            prefix[:m, end] = prefix[:m, end - 1] * self.BASE + points[:m, end - 1].astype(np.uint64) + np.uint64(1)
            open_, best = np.arange(m), np.full(m, -np.inf)
            for size in range(min(self.model.longest, end), 0, -1):
                at = end - size
                rows = open_
                token = self._lookup(prefix[rows, end] - prefix[rows, at] * power[size])
                if size == 1:
                    token = np.where(token < 0, points[rows, at] + none + 1, token)
                else:
                    rows, token = rows[token >= 0], token[token >= 0]
                if not len(rows):
                    continue
                if self.model.merges:
                    good = self._neighbours(back[rows, at], token)
                    back[rows[good], end] = token[good]
                    open_ = open_[back[open_, end] == none]
                else:
                    known = token < none
                    total = score[rows, at] + np.where(known, self.scores[np.where(known, token, 0)], self.model.floor)
                    better = total > best[rows]
                    rows, token, total = rows[better], token[better], total[better]
                    best[rows] = total
                    back[rows, end], score[rows, end] = token, total
                if not len(open_):
                    break
        steps, at, rows = [], sizes.copy(), np.arange(n)
        while True:
            live = at > 0
            if not live.any():
                break
            token = np.where(live, back[rows, at], -1)
            steps.append(token)
            at = at - np.where(live, np.where(token < none, lengths[np.minimum(token, none)], 1), 0)
        table = np.stack(steps[::-1], axis=1)
        used = table >= 0
        ends = np.cumsum(used.sum(axis=1))
        tokens = table[used]
        data = self.ids[np.minimum(tokens, none - 1)].tobytes()
        odd = np.flatnonzero((table > none).any(axis=1))
        out: list[bytes] = [b""] * n
        for i, a, b in zip(order, (np.append(0, ends[:-1]) * 4).tolist(), (ends * 4).tolist(), strict=True):
            out[i] = data[a:b]
        for r in odd.tolist():  # with characters that have no piece
            own = table[r][used[r]].tolist()
            out[order[r]] = array("i", [x for t in own for x in self.model.id_list(self._surface(t))]).tobytes()
        return out


class Encoder:
    """Ids of whole texts, with a bounded memory of short parts."""

    def __init__(self, model: Model):
        self.model = model
        self.sweep = Sweep(model)
        self.memory = Memory(REMEMBERED)

    def search(self, text: str) -> bytes:
        """Ids of one part of any length, in a bounded window."""
        lattice, ids = Lattice(self.model), array("i")
        for piece in lattice.push(text):
            ids.extend(self.model.id_list(piece))
        for piece in lattice.finish():
            ids.extend(self.model.id_list(piece))
        return ids.tobytes()

    def _long(self, text: str) -> bytes:
        """Ids of a long part, cut at pairs of characters that no piece contains."""
        inside, start, out = self.model.inside, 0, []
        for i in range(1, len(text) + 1):
            if i == len(text) or text[i - 1:i + 1] not in inside:
                run = text[start:i]
                own = self.memory.new.get(run)
                if own is None:
                    own = self.search(run)
                    if len(run) <= LONGEST_REMEMBERED:
                        self.memory.new[run] = own
                out.append(own)
                start = i
        return b"".join(out)

    def _parts(self, text: str) -> list[str]:
        if not text:
            return []
        marked = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        if not self.model.cut_at_blanks:
            return [marked]
        first = marked.find(MARK)
        head = [marked] if first < 0 else [marked[:first]] if first else []
        return head + _PART.findall(marked)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as native 32-bit integers."""
        cut = [self._parts(t) for t in texts]
        self.memory.turn()
        parts = {p for own in cut for p in own}
        self.memory.fill([p for p in parts if len(p) <= LONGEST_REMEMBERED], lambda new: dict(zip(new, self.sweep.encode(new), strict=True)))
        rest = {p: self._long(p) for p in parts if len(p) > LONGEST_REMEMBERED}
        known = self.memory.new
        get = known.__getitem__ if not rest else lambda p: rest.get(p) or known[p]
        return [b"".join(map(get, parts)) for parts in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.model.surfaces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_ENCODERS: dict[int, Encoder] = {}


def _encoder(serialized: bytes) -> Encoder:
    """One for each worker process and model."""
    key = zlib.crc32(serialized)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Model(serialized))
    return _ENCODERS[key]


def load(path: str) -> bytes:
    """A model file's bytes, read on the driver (about half a megabyte) and broadcast to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(spark: SparkSession, documents: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, ids`` of whole texts."""
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in batches:
            for piece in _pieces(batch):
                texts = [t or "" for t in piece.column(1).to_pylist()]
                ids = [np.frombuffer(x, np.int32) for x in encoder.encode_all(texts)]
                yield pa.RecordBatch.from_arrays([piece.column(0), _lists(ids)], ["doc_id", "ids"])
        encoder.memory.rest()
        release()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(spark: SparkSession, encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of ids."""
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in batches:
            texts = [encoder.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(spark: SparkSession, documents: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, n_chars, round_trip``: each text encoded, and compared with what its ids decode to.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers.
    """
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in batches:
            for piece in _pieces(batch):
                rows, texts = [], [t or "" for t in piece.column(1).to_pylist()]
                for text, own in zip(texts, encoder.encode_all(texts), strict=True):
                    ids = np.frombuffer(own, np.int32)
                    rows.append((len(ids), zlib.crc32(ids.astype("<u4")), len(text), encoder.decode(ids.tolist()) == text))
                n, crc, chars, same = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(chars, pa.int64()), pa.array(same)],
                    ["doc_id", "n_ids", "ids_crc32", "n_chars", "round_trip"])
        encoder.memory.rest()
        release()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, n_chars long, round_trip boolean")


def _pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
