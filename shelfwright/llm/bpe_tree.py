"""Byte-level BPE: encoding by tree concatenation, decoding by table.

**Runs.** What the pre-tokenizer does not split is one run. A run of more than ``RUN`` bytes is halved again and again; the pieces are
merged on their own, and two neighbours are joined: the tokens next to the join are encoded again as one window, which grows on
the side where its outer token is not the one that stood there. A sequence of tokens is the encoding of its bytes exactly if each two
neighbours are what the merges make of the two alone. Within a half that holds already, within the window too, and where the window's
outer token is an old one it holds across its edge, so agreement on both sides proves the whole. (It needs vocabularies in which every
merge makes a token of its own; others are refused.)

**Texts.** A text of more than ``TEXT`` characters is cut into leaves that are encoded in parallel as rows of their own, and joined in
a tree. Each node knows where its runs start. The pattern looks at most two characters beyond a run, so all starts that are three or more
characters before a node's end stand. From the last of them the window is split again, growing into the right node until one of its
starts, three characters or more before the window's end, is a start there too: from there on the right node stands. A run across
the join is joined by its tokens as above. Windows that find no agreement grow to the whole node.

Other texts are encoded where they are: cut into parts that never join, each different part once (see ``parts``); runs go the way above.

Strings of special tokens are tokens, as the library's defaults have it. Files whose model is not plain byte-level BPE are refused.

Rows: one per input row, ``doc_id`` as it is, null or repeated. A null text is empty and has no ids. Ids that are not in the vocabulary decode
to nothing; bytes that are no UTF-8 decode to U+FFFD. Other columns are ignored. Copies of a long text are encoded once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import small_batches, written
from shelfwright.llm.memory import release
from shelfwright.llm.parts import Parts
from shelfwright.llm.shingles import slices, utf8

#: Bytes of a run, and characters of a text, up to which it is not halved.
RUN, TEXT = 256, 1 << 15
#: Characters beyond a run that the pattern may look at, and one more.
LOOK = 3
#: The pattern of byte-level pre-tokenizers, a fixed value of the format.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
SPACE = regex.compile(r"\s+")


def alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Model:
    """Merges and bytes of the tokens."""

    def __init__(self, serialized: str):
        spec = json.loads(serialized)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        flags = [t["content"] for t in spec.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if (model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True)
                or spec.get("normalizer") or odd or flags):
            raise ValueError("not a plain byte-level BPE model")
        of = {c: b for b, c in enumerate(alphabet())}
        vocabulary = {t: i for t, i in model["vocab"].items()}
        self.bytes = {i: bytes(of[c] for c in t) for t, i in vocabulary.items()}
        self.single = [vocabulary[c] for c in alphabet()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        made = [new for _, new in self.merges.values()]
        if len(set(made)) != len(made) or set(made) & set(self.single):
            raise ValueError("two merges make one token")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}

    def merge(self, data: bytes) -> list[int]:
        """Ids of a short run: the earliest merge first, the leftmost of equal ones."""
        ids = [self.single[b] for b in data]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (found := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (found := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (*found, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]

    def text_of(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of a run from those of its two halves."""
        a, b = min(2, len(left)), min(2, len(right))
        while True:
            window = self.run(self.text_of(left[len(left) - a:] + right[:b]), halved=False)
            stands = a == len(left) or window[0] == left[len(left) - a]
            follows = b == len(right) or window[-1] == right[b - 1]
            if stands and follows:
                return left[:len(left) - a] + window + right[b:]
            a, b = a if stands else min(2 * a, len(left)), b if follows else min(2 * b, len(right))

    def run(self, data: bytes, halved: bool = True) -> list[int]:
        """Ids of a run. A window is merged as a whole, so that joins end."""
        if len(data) <= RUN or not halved:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.run(data[:half]), self.run(data[half:]))


class Node:
    """A piece of text with its ids, the first character of each run and the number of ids before it."""

    def __init__(self, text: str, starts: np.ndarray, firsts: np.ndarray, ids: np.ndarray):
        self.text, self.starts, self.firsts, self.ids = text, starts, firsts, ids

    def ids_of(self, run: int) -> np.ndarray:
        end = self.firsts[run + 1] if run + 1 < len(self.firsts) else len(self.ids)
        return self.ids[self.firsts[run]:end]


def run_starts(text: str) -> np.ndarray:
    return np.fromiter((m.start() for m in PATTERN.finditer(text)), np.int64)


class Codec:
    """Encodes and decodes texts; one for each Python worker."""

    def __init__(self, serialized: str):
        self.model = Model(serialized)
        self.parts = Parts(serialized, "<u4", self._long, RUN)
        size = max(self.model.bytes) + 1
        table = [self.model.bytes.get(i, b"") for i in range(size)]
        self.table, self.names = table, [str(i) for i in range(size)]
        self.sizes = np.array([len(t) for t in table], np.int64)
        contents = sorted(self.model.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None

    def _library(self, text: str, starts: list[int]) -> list[np.ndarray]:
        """Ids of whole runs by the library. White space at the end would be taken together: its last run goes apart."""
        last = starts[-1]
        pieces = [text[starts[0]:last], text[last:]] if SPACE.fullmatch(text, last) else [text[starts[0]:]]
        return self.parts.library([p for p in pieces if p])

    def _long(self, data: bytes) -> np.ndarray:
        """Ids of a part: its long runs by tree, what lies between them by the library."""
        text = data.decode()
        return self._runs(text, run_starts(text))

    def _runs(self, text: str, starts: np.ndarray) -> np.ndarray:
        edges = [*starts.tolist(), len(text)]
        out, done = [np.zeros(0, "<u4")], 0
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b - a > RUN // 4:  # a character has four bytes at most
                data = text[a:b].encode()
                if len(data) > RUN:
                    out += self._library(text[:a], edges[done:k]) if k > done else []
                    out.append(np.array(self.model.run(data), "<u4"))
                    done = k + 1
        if done < len(starts):
            out += self._library(text, edges[done:-1])
        return np.concatenate(out)

    def leaf(self, text: str) -> Node:
        """``text`` encoded on its own."""
        starts = run_starts(text)
        raw, offsets = utf8(pa.array([text], pa.string()))
        return self.node(text, starts, self.parts.encode(raw, offsets)[0])

    def node(self, text: str, starts: np.ndarray, ids: np.ndarray) -> Node:
        """Where the ids of each run begin follows from the bytes: no token reaches over a run's edge."""
        raw = np.frombuffer(text.encode(), np.uint8)
        characters = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        return Node(text, starts, np.searchsorted(ends, characters[starts]), ids)

    def join(self, left: Node, right: Node) -> Node:
        if not left.text or not right.text:
            return right if not left.text else left
        stand = max(int(np.searchsorted(left.starts, len(left.text) - LOOK, "right")) - 1, 0)
        begin = int(left.starts[stand])
        tail, more = left.text[begin:], 1
        while True:
            end = int(right.starts[more]) if more < len(right.starts) else len(right.text)
            window = tail + right.text[:end]
            starts = run_starts(window)
            edges = starts[(starts >= len(tail)) & (starts <= len(window) - LOOK)] - len(tail)
            agreed = edges[np.isin(edges, right.starts[:more])]
            if len(agreed) or end == len(right.text):
                break
            more *= 2
        edge = int(agreed[0]) if len(agreed) else len(right.text)
        starts = starts[starts < len(tail) + edge]
        ids = self._joined(left, stand, right, window[:len(tail) + edge], starts, len(tail))
        rest = int(np.searchsorted(right.starts, edge))
        after = right.ids[right.firsts[rest]:] if rest < len(right.starts) else right.ids[:0]
        before = left.ids[:left.firsts[stand]]
        firsts = self.node(window[:len(tail) + edge], starts, ids).firsts
        shift = len(left.text)
        return Node(left.text + right.text, np.concatenate([left.starts[:stand], starts + begin, right.starts[rest:] + shift]),
                    np.concatenate([left.firsts[:stand], firsts + len(before), right.firsts[rest:] + (len(before) + len(ids) - len(right.ids) + len(after))]),
                    np.concatenate([before, ids, after]))

    def _joined(self, left: Node, stand: int, right: Node, text: str, starts: np.ndarray, middle: int) -> np.ndarray:
        """Ids of the runs between the nodes; a long one across the join from the tokens on its sides."""
        across = int(np.searchsorted(starts, middle, "left")) - 1
        a = int(starts[across])
        b = int(starts[across + 1]) if across + 1 < len(starts) else len(text)
        last = len(left.starts) - 1
        whole = (b > middle and b - a > RUN // 4 and a == left.starts[last] - left.starts[stand]
                 and b - middle == (right.starts[1] if len(right.starts) > 1 else len(right.text)))
        if not whole:
            return self._runs(text, starts)
        joined = self.model.join(left.ids_of(last).tolist(), right.ids_of(0).tolist())
        return np.concatenate([self._runs(text[:a], starts[:across]), np.array(joined, "<u4"), self._runs(text[b:], starts[across + 1:] - b)])

    def tree(self, nodes: list[Node]) -> Node:
        """All nodes in order as one: neighbours first, then their joins."""
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def encode_text(self, text: str, size: int = TEXT) -> np.ndarray:
        """Ids of one text without special tokens by leaves of ``size`` characters."""
        return self.tree([self.leaf(text[a:a + size]) for a in range(0, max(len(text), 1), size)]).ids

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; strings of special tokens are tokens."""
        raw, offsets = utf8(column)
        for a, b in slices(offsets):
            off = offsets[a:b + 1] - offsets[a]
            data = raw[offsets[a]:offsets[b]]
            whole = data.tobytes()
            hits = [c for c in self.model.special if c.encode() in whole]
            ids, starts = self.parts.encode(data, off)
            for r in range(b - a):
                own = data[off[r]:off[r + 1]].tobytes() if hits else b""
                yield self._with_special(own.decode()) if any(c.encode() in own for c in hits) else ids[starts[r]:starts[r + 1]]

    def _with_special(self, text: str) -> np.ndarray:
        pieces = self.special.split(text)
        out = [np.array([self.model.special[p]], "<u4") if k % 2 else self.parts.encode(*utf8(pa.array([p], pa.string())))[0] for k, p in enumerate(pieces)]
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> str:
        known = ids[(ids >= 0) & (ids < len(self.table))].tolist()
        return b"".join([self.table[i] for i in known]).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(serialized: str) -> Codec:
    """One for each worker process and model."""
    key = zlib.crc32(serialized.encode())
    if key not in _CODECS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives the task its core
        _CODECS[key] = Codec(serialized)
    return _CODECS[key]


def load(path: str) -> str:
    """A tokenizer file's content; refuses files of other kinds."""
    with open(path, encoding="utf-8") as file:
        serialized = file.read()
    Model(serialized)
    return serialized


Finish = Callable[[Codec, np.ndarray], tuple]


def _columns(codec: Codec, found: list[np.ndarray], finish: Finish, schema: pa.Schema) -> list[pa.Array]:
    rows = [finish(codec, ids) for ids in found]
    return [pa.array([r[k] for r in rows], field.type) for k, field in enumerate(list(schema)[1:])]


def _run(spark: SparkSession, documents: DataFrame, serialized: str, finish: Finish, ddl: str) -> DataFrame:
    """``doc_id`` and the columns ``ddl`` that ``finish`` makes of each text's ids."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    held = spark.sparkContext.broadcast(serialized)
    schema = to_arrow_schema(StructType.fromDDL(f"id long, {ddl}"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for batch in batches:
            columns = _columns(codec, list(codec.encode_column(batch.column(1))), finish, schema)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *schema.names[1:]])
        release()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaves of each text; a special token is a leaf of its own kind."""
        codec = _codec(held.value)
        for batch in batches:
            for i in range(batch.num_rows):
                text, key = batch.column(1)[i].as_py(), batch.column(0)[i].as_py()
                pieces = codec.special.split(text) if codec.special else [text]
                leaves = [(k, a, p[a:a + TEXT]) for k, p in enumerate(pieces) for a in range(0, len(p), TEXT)]
                for at in range(0, len(leaves), 64):
                    some = leaves[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(some)), *(pa.array([leaf[c] for leaf in some], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                        ["key", "piece", "at", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16)
                nodes = [codec.leaf(t) if k % 2 == 0 else None for k, t in zip(part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True)]
                sent = [pa.array([None if n is None else getattr(n, c).astype("<i8" if c != "ids" else "<u4").tobytes() for n in nodes], pa.binary())
                        for c in ("starts", "firsts", "ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, *sent], [*part.schema.names, "starts", "firsts", "ids"])
        release()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, key, piece = _codec(held.value), None, -1
        nodes: list[Node] = []
        out: list[np.ndarray] = []

        def close() -> None:
            if nodes:
                out.append(codec.tree(list(nodes)).ids)
                nodes.clear()

        def row() -> pa.RecordBatch:
            close()
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), *_columns(codec, [np.concatenate(out)], finish, schema)], ["key", *schema.names[1:]])

        for batch in batches:
            for i in range(batch.num_rows):
                leaf = batch.slice(i, 1).to_pylist()[0]
                if leaf["key"] != key:
                    if key is not None:
                        yield row()
                    key, piece = leaf["key"], -1
                    nodes.clear()
                    out.clear()
                if leaf["piece"] != piece:
                    close()
                    piece = leaf["piece"]
                if leaf["ids"] is None:
                    out.append(np.array([codec.model.special[leaf["text"]]], "<u4"))
                else:
                    nodes.append(Node(leaf["text"], np.frombuffer(leaf["starts"], "<i8"), np.frombuffer(leaf["firsts"], "<i8"), np.frombuffer(leaf["ids"], "<u4")))
        if key is not None:
            yield row()
        release()

    small_batches(spark, 500)
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long = F.char_length("text") > TEXT
    short = rows.where(~long).mapInArrow(whole, f"doc_id long, {ddl}")
    keyed = rows.where(long).select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"), "text")
    leaves = (keyed.select("key", "text").mapInArrow(cut, "key binary, piece long, at long, text string")
              .groupBy("key", "piece", "at").agg(F.first("text").alias("text")))  # copies once, and leaves over all tasks
    nodes = leaves.mapInArrow(encode, "key binary, piece long, at long, text string, starts binary, firsts binary, ids binary")
    texts = written(spark, nodes.repartition("key").sortWithinPartitions("key", "piece", "at").mapInArrow(joined, f"key binary, {ddl}"), "long")
    return short.unionByName(keyed.select("doc_id", "key").join(texts, "key").drop("key"))


def _ids(codec: Codec, ids: np.ndarray) -> tuple:
    return (ids.astype(np.int32),)


def _digest(codec: Codec, ids: np.ndarray) -> tuple:
    listed = ids.tolist()
    named = ",".join([codec.names[i] for i in listed])
    return len(listed), hashlib.sha256(named.encode()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()


def encode(spark: SparkSession, documents: DataFrame, serialized: str) -> DataFrame:
    """``doc_id, ids`` of every document."""
    return _run(spark, documents, serialized, _ids, "ids array<int>")


def round_trip(spark: SparkSession, documents: DataFrame, serialized: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document; what is hashed last is decoded from the ids."""
    return _run(spark, documents, serialized, _digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(spark: SparkSession, encoded: DataFrame, serialized: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids are none."""
    held = spark.sparkContext.broadcast(serialized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for batch in batches:
            texts = [codec.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    small_batches(spark, 500)
    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")
