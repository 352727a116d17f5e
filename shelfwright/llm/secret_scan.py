"""Secret scans through a trigram inverted index.

Each rule is a regular expression. ``trigram_query`` derives from its parse tree which trigrams a text must have to match, as
ANDs and ORs. A block of documents gets an inverted index, trigram -> rows, of the trigrams that any rule asks for; a rule's
query is evaluated by intersecting and uniting these posting lists, and only the rows that remain are searched with the
expression itself. A rule without mandatory trigrams (``hex``) scans all rows. Texts are indexed as lower-case ASCII bytes,
which only lets more rows through for rules that tell cases apart.

Every text is searched whole; a block is at most ``ROWS`` documents, and the index has a list for each needed trigram only.

Rows: one per input row. A null text is empty and has no span. Offsets are code points, ends exclusive. Other columns are ignored.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.shingles import utf8
from shelfwright.llm.spans import Span, joined, sha256

ROWS = 512
#: Alternatives of one literal run that are told apart, and members of a character class.
STRINGS, CLASS = 64, 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``keep`` drops matches that fail."""

    kind: str
    pattern: str
    flags: int = 0
    keep: Callable[[re.Match], bool] = bool


#: The three base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, lambda m: len(m[2]) >= 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
    # The maximal runs of 32 and more are those of [0-9a-f]+ that pass.
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
#: Kinds with a prefix of their own; they add spans.
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    # From the start of a run only, so that no run is searched again from its middle.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

#: True (no condition), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple[str, tuple]


def _all(parts: list[Query]) -> Query:
    kept = tuple(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _any(parts: list[Query]) -> Query:
    kept = tuple(dict.fromkeys(parts))
    return True if not kept or True in kept else kept[0] if len(kept) == 1 else ("or", kept)


def _of_strings(strings: set[str]) -> Query:
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(tree) -> tuple[set[str] | None, Query]:
    """All strings that a sequence can match, if few; and what every match must contain."""
    parts: list[Query] = []
    run: set[str] = {""}
    exact = True
    for op, arg in tree:
        strings: set[str] | None = None
        inner: Query = True
        if op is sre.LITERAL:
            strings = {chr(arg).lower()}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= CLASS:
            strings = {chr(c).lower() for _, c in arg}
        elif op is sre.SUBPATTERN:
            strings, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            found = [_walk(branch) for branch in arg[1]]
            inner = _any([q for _, q in found])
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            own, inner = _walk(body)
            if own is not None and (low, high) == (0, 1):
                strings, inner = own | {""}, True
            elif own is not None and low == high == 1:
                strings = own
            elif low == 0:
                inner = True
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            strings = {""}  # takes no character
        if strings is not None and len(run) * len(strings) <= STRINGS and all(s.isascii() for s in strings):
            run = {a + b for a in run for b in strings}
        else:
            parts += [_of_strings(run), inner]
            run, exact = {""}, False
    return (run, _of_strings(run)) if exact else (None, _all([*parts, _of_strings(run)]))


def trigram_query(pattern: str) -> Query:
    """Condition on the lower-case trigrams of any text that the pattern matches."""
    return _walk(sre_parser.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


class Index:
    """Posting lists of the wanted trigrams over one block of texts."""

    def __init__(self, column: pa.Array, wanted: list[str]):
        raw, offsets = utf8(column)
        self.rows = len(column)
        codes = np.array([int.from_bytes(t.encode(), "big") for t in wanted], np.uint32)
        pairs = np.zeros(1 << 16, bool)
        pairs[codes >> 8] = True
        low = (raw + ((raw - np.uint8(65) < 26).astype(np.uint8) << 5)).astype(np.uint32)
        at = np.flatnonzero(pairs[(low[:-2] << 8) | low[1:-1]]) if len(low) > 2 else np.zeros(0, np.int64)
        rows = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[rows + 1]
        at, rows = at[inside], rows[inside]
        code = (low[at] << 16) | (low[at + 1] << 8) | low[at + 2] if len(at) else np.zeros(0, np.uint32)
        self.lists = {t: np.unique(rows[code == c]) for t, c in zip(wanted, codes, strict=True)}

    def rows_of(self, query: Query) -> np.ndarray:
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, str):
            return self.lists[query]
        lists = sorted((self.rows_of(q) for q in query[1]), key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out


def scan(documents: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``doc_id``, a count for each base kind, ``base_sha256`` and ``spans`` of every document."""
    kinds, base_kinds = [r.kind for r in rules], [r.kind for r in base]
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams, queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts, index = part.column(1).to_pylist(), Index(part.column(1), wanted)
                found: list[list[Span]] = [[] for _ in texts]
                for rule, pattern, query in zip(rules, compiled, queries, strict=True):
                    for row in index.rows_of(query).tolist():
                        for match in pattern.finditer(texts[row] or ""):
                            if rule.keep(match):
                                found[row].append((rule.kind, *match.span()))
                own = [[s for s in spans if s[0] in base_kinds] for spans in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([sum(s[0] == k for s in spans) for spans in own], pa.int64()) for k in base_kinds),
                     pa.array([sha256(joined(spans, kinds)) for spans in own], pa.string()),
                     pa.array([joined(spans, kinds) for spans in found], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in base_kinds), "base_sha256", "spans"])

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in base_kinds), "base_sha256 string", "spans string"])
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
