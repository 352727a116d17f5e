"""Personal data, also in disguise: transducers normalise a text and remember where each character came from.

Base spans are found in the source text. Then three transducers rewrite what may hide an identifier: homoglyphs and full-width
forms become ASCII and zero-width characters vanish; ``at`` and ``dot`` in brackets, or as words in ``name at host dot tld``,
become signs; runs of spelled digits become digits (``plus`` before them, or a length of 10 to 15, gives a plus sign; ``double`` and
``triple`` repeat the next digit). The words are those of English, German, French, Spanish, Portuguese and Italian; the two signs of an
address must be of one language, so that "look at the point where" is none. The same detectors run over the result, and each span is mapped back to the source characters that its first and last character came from. A mapped span is added unless one
base span of its kind contains it, so the whole of an address is found whose rest is a base span; base spans stay as they are.

A text in which no transducer finds anything is not rewritten. Detectors take time in proportion to the text: no run of
characters is searched again from its middle.

Rows: one per input row. A null text is empty and has no span. Offsets are code points, ends exclusive. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.spans import Span, joined, sha256

KINDS = ("email", "ip", "card", "phone")
ROWS = 512

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and host, from the @ outwards: as the expression finds them from the left."""
    start, at = 0, text.find("@")
    while at >= 0:
        low = start + len(text[start:at].rstrip(_LOCAL))
        host = _HOST.match(text, at + 1) if low < at else None
        if host:
            yield low, host.end()
        start = host.end() if host else at + 1
        at = text.find("@", start)


def luhn(digits: str) -> bool:
    """Check sum of card numbers."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def detect(text: str) -> list[Span]:
    """Base spans: leftmost matches of each kind that do not overlap, without those that fail."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    first = _DIGITS.search(text)
    if not first:
        return found
    start = first.start()
    found += [("ip", *m.span()) for m in _IP.finditer(text, start) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text, start):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.findall(m[0])) <= 15]
    return found


#: Letters of other scripts that look like ASCII ones, in pairs.
_LOOKALIKES = (
    "аa вB еe кk мM нH оo рp сc тT уy хx ѕs іi јj ԁd ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ "
    "αa οo ρp νv ιi κk υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ․. ‐- ‑- ‒- –- −- ＿_ 。."
)
_GLYPHS = {ord(pair[0]): pair[1] for pair in _LOOKALIKES.split()}
_GLYPHS |= {code: chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}  # full-width forms
_GLYPHS |= {base + i: str(i) for base in (0x660, 0x6F0, 0x966, *range(0x1D7CE, 0x1D800, 10)) for i in range(10)}  # other digits
_GLYPHS |= {code: "" for code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # nothing to see
_GLYPH = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_GLYPHS)) + "]")

#: How the signs of an address are said, for each language: words for @, word for the full stop.
_SIGNS = {
    "en": (("at",), "dot"), "de": (("at", "ät"), "punkt"), "fr": (("arobase", "arrobase"), "point"), "es": (("arroba",), "punto"),
    "pt": (("arroba",), "ponto"), "it": (("chiocciola",), "punto"),
}
#: Words for the digits from 0, alternatives with a stroke, and for what may stand before them.
_SPELLED_BY_LANGUAGE = {
    "en": "zero|oh one two three four five six seven eight nine",
    "de": "null eins zwei|zwo drei vier fünf|fuenf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "pt": "zero um dois três quatro cinco seis sete oito nove",
    "it": "zero uno due tre quattro cinque sei sette otto nove",
}
_PLUS = ("plus", "más", "mais", "più")
_TIMES = {"double": 2, "doble": 2, "doppel": 2, "triple": 3}
_SPELLED = {word: str(digit) for words in _SPELLED_BY_LANGUAGE.values() for digit, same in enumerate(words.split()) for word in same.split("|")}


def _any_case(words: Iterable[str]) -> str:
    """Alternatives, longer ones first; letters outside ASCII in both cases, which ``re.I`` with ``re.A`` does not give."""
    return "|".join("".join(c if c.isascii() else f"[{c}{c.upper()}]" for c in w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


_LETTER = "A-Za-z\u00c0-\u024f"
_DIGIT_WORD = rf"(?:(?:{_any_case(_TIMES)})[ -]+)?(?:{_any_case(_SPELLED)})(?![{_LETTER}])"
_RUN = re.compile(rf"(?<![{_LETTER}])(?:(?:{_any_case(_PLUS)})[ -]+)?{_DIGIT_WORD}(?:[ ,-]+{_DIGIT_WORD})++", re.I | re.A)
_WORD = re.compile(rf"[{_LETTER}]+")
_BRACKETED = re.compile(rf"\x20?[\[({{<]\x20?({_any_case(w for ats, dot in _SIGNS.values() for w in (*ats, dot))})\x20?[\])}}>]\x20?", re.I | re.A)


def _host_words(ats: tuple[str, ...], dot: str) -> re.Pattern:
    """``name at host dot tld``, from the first of several parts only, so that a run of them is read once."""
    part, dotted = "[A-Za-z0-9_%+-]", rf"\x20{dot}\x20"
    return re.compile(
        rf"(?<!{part})(?<!{part}{dotted})((?:{part}++{dotted})*+)[A-Za-z0-9._%+-]++(\x20(?:{_any_case(ats)})\x20)[A-Za-z0-9-]++((?:(?:{dotted}|\.)[A-Za-z0-9-]++)+)",
        re.I | re.A)


_HOST_WORDS = {language: _host_words(*signs) for language, signs in _SIGNS.items()}
_DOT_WORDS = {language: re.compile(rf"\x20{dot}\x20", re.I | re.A) for language, (_, dot) in _SIGNS.items()}
_DOTS = {dot for _, dot in _SIGNS.values()}
_SIGN_WORDS = _DOTS.union(*(ats for ats, _ in _SIGNS.values()))


class Mapped:
    """A text with parts replaced, and the source place of each character."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        parts, self.targets, self.sources, at, size = [], [0], [(0, 0, False)], 0, 0
        for start, end, new in edits:
            parts += [source[at:start], new]
            size += start - at
            self.targets += [size, size + len(new)]
            self.sources += [(start, end, True), (end, end, False)]
            size, at = size + len(new), end
        parts.append(source[at:])
        self.text = "".join(parts)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Source span of the characters from ``start`` to before ``end``."""
        first, last = (bisect_right(self.targets, i) - 1 for i in (start, end - 1))
        a, _, edited = self.sources[first]
        low = a if edited else a + start - self.targets[first]
        a, b, edited = self.sources[last]
        return low, b if edited else a + end - self.targets[last]


def _glyph_edits(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), _GLYPHS[ord(m[0])]) for m in _GLYPH.finditer(text)] if not text.isascii() else []


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    edits, languages = [], set()
    if any(word in low for word in _SIGN_WORDS):
        for m in _BRACKETED.finditer(text):
            word = m[1].lower()
            edits.append((*m.span(), "." if word in _DOTS else "@"))
            languages |= {language for language, (ats, dot) in _SIGNS.items() if word in ats or word == dot}
    taken = {p for a, b, _ in edits for p in range(a, b)}
    more = []
    for language, (ats, dot) in _SIGNS.items():
        if f" {dot} " not in low:
            continue
        dots = _DOT_WORDS[language]
        if any(f" {at} " in low for at in ats):
            for m in _HOST_WORDS[language].finditer(text):
                before, after = ([(m.start(g) + d.start(), m.start(g) + d.end(), ".") for d in dots.finditer(m[g])] for g in (1, 3))
                if after:
                    more += [*before, (*m.span(2), "@"), *after]
        if language in languages:
            more += [(*m.span(), ".") for m in dots.finditer(text)]
    for start, end, sign in dict.fromkeys(more):
        if taken.isdisjoint(range(start, end)):
            edits.append((start, end, sign))
            taken.update(range(start, end))
    return sorted(edits)


def _digits_of(run: str) -> str:
    """Digits of a run of words, after a plus sign if it has one."""
    out, times = "", 1
    for word in _WORD.findall(run):
        word = word.lower()
        if word in _TIMES:
            times = _TIMES[word]
        else:
            out, times = out + _SPELLED.get(word, "+") * times, 1
    return out


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _RUN.finditer(text):
        digits = _digits_of(m[0])
        # Nobody spells so many digits but for a number to call.
        edits.append((*m.span(), f"+{digits}" if digits[0] != "+" and 10 <= len(digits) <= 15 else digits))
    return edits


#: In this order: later ones read what earlier ones wrote.
TRANSDUCERS: tuple[Callable[[str], list[tuple[int, int, str]]], ...] = (_glyph_edits, _sign_edits, _digit_edits)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = detect(text)
    now, chain = text, []
    for transducer in TRANSDUCERS:
        edits = transducer(now)
        if edits:
            chain.append(Mapped(now, edits))
            now = chain[-1].text
    added: list[Span] = []
    if chain:
        known = set(base)
        for kind, start, end in detect(now):
            for mapped in reversed(chain):
                start, end = mapped.source(start, end)
            if (kind, start, end) not in known and not any(k == kind and a <= start and end <= b for k, a, b in base):
                added.append((kind, start, end))
    return base, base + added


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id``, a count of base spans for each kind, ``base_sha256`` and ``spans`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [find(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS),
                     pa.array([sha256(joined(base, KINDS)) for base, _ in found], pa.string()),
                     pa.array([joined(spans, KINDS) for _, spans in found], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
