"""Secret and personal-data scans against the plain expressions, and disguises."""

import hashlib
import random
import re
import time

import pyarrow as pa
import pytest

from shelfwright.llm import deobfuscate as D
from shelfwright.llm import secret_scan as S
from shelfwright.llm.spans import joined

ANY = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
ASSIGN = rf"""({'|'.join(map(ANY, ('password', 'passwd', 'secret', 'token')))}|{ANY('api')}_?{ANY('key')})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets_by_hand(text):
    out = [("assign", *m.span()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def persons_by_hand(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def mixed(pieces, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


SECRET_PIECES = ["token", "SECRET", "api_key", "apikey", "password", "Passwd", '"', "'", " ", ":", "=", "abcdefgh", "AKIA", "AKIAABCDEFGHIJKL",
                 "0123456789abcdef", "f", "é", "\n", "ſecret", "toKen"]
PERSON_PIECES = ["a@b.c", "@", ".", "..", "-", "+", "1", "255", "4111 1111 1111 1111", "+1 (415) 555-0100", "x", "é", "192.168.0.1",
                 "4111-1111-1111-1111", "%_", "@x.y", " ", "b.cd", "0", "99", "漢"]


def check(rows, texts, by_hand, base, kinds):
    for row in rows:
        if row.doc_id is None:
            continue
        want = by_hand(texts[row.doc_id] or "")
        text = joined(want, kinds)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in base] == [sum(s[0] == k for s in want) for k in base]
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))


@pytest.mark.parametrize("kind", ["secret", "person"])
def test_base_spans(spark, kind):
    pieces, scan, by_hand, base, kinds = {
        "secret": (SECRET_PIECES, S.scan, secrets_by_hand, [r.kind for r in S.BASE], [r.kind for r in S.BASE + S.MORE]),
        "person": (PERSON_PIECES, D.scan, persons_by_hand, D.KINDS, D.KINDS)}[kind]
    texts = mixed(pieces, 4000, 3) + [None, "", "9" * 20000, "a" * 20000 + "@", "+1" + " " * 5000, "1." * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as spans", "2 as n_hex", "3 as base_sha256")
    check(scan(df).collect(), texts, by_hand, base, kinds)
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(scan(real).collect(), {r.doc_id: r.text for r in real.collect()}, by_hand, base, kinds)


def test_documents_and_nothing(spark, documents, nothing, corpus):
    assert S.scan(documents).count() == D.scan(documents).count() == len(corpus)
    assert S.scan(nothing).count() == D.scan(nothing).count() == 0


def holds(query, text):
    if query is True:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


def test_queries_are_necessary_conditions():
    assert S.trigram_query(S.BASE[2].pattern) is True  # no mandatory trigram: scans fully
    assert S.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert S.trigram_query("ab(cd|ef)?g") == ("or", (("and", ("abc", "bcd", "cdg")), ("and", ("abe", "bef", "efg")), "abg"))
    assert S.trigram_query("(abc|d*)x") is True
    for rule in S.BASE + S.MORE:
        query, pattern = S.trigram_query(rule.pattern), re.compile(rule.pattern, rule.flags)
        for text in mixed(SECRET_PIECES + ["ghp_" + "a1" * 18, "xoxb-1234567890", "AIza" + "b" * 35, "-----BEGIN RSA PRIVATE KEY-----"], 3000, 9):
            if pattern.search(text):
                assert holds(query, text.lower()), (rule.kind, text)


def test_posting_lists():
    texts = ["Token here", None, "toke", "n toKEN", "token é", ""]
    index = S.Index(pa.array(texts), ["ken", "oke", "tok"])
    assert index.rows_of("tok").tolist() == [0, 2, 3, 4] and index.rows_of(("and", ("tok", "ken"))).tolist() == [0, 3, 4]
    assert index.rows_of(True).tolist() == list(range(6))


def test_added_secrets():
    text = f"x ghp_{'a1' * 18} and xoxb-1234567890ab"
    rows = [(r.kind, m.span()) for r in S.MORE for m in re.finditer(r.pattern, text)]
    assert rows == [("github", (2, 42)), ("slack", (47, 64))]


@pytest.mark.parametrize("text, kind, found", [
    ("write to john at example dot com now", "email", "john at example dot com"),
    ("mail john (at) example [dot] com", "email", "john (at) example [dot] com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("call plus one four one five five five five zero one zero zero ok", "phone", "plus one four one five five five five zero one zero zero"),
    ("ｊ＠ｘ．ｃｏｍ", "email", "ｊ＠ｘ．ｃｏｍ"),
    ("to ann dot lee at mail dot example dot org.", "email", "ann dot lee at mail dot example dot org"),
    ("ring five five five one two three four five six seven now", "phone", "five five five one two three four five six seven"),
    ("ann.lee AT mail DOT org", "email", "ann.lee AT mail DOT org"),
    ("ann(at)mail(dot)org", "email", "ann(at)mail(dot)org"), ("ann [at] mail.org", "email", "ann [at] mail.org"),
    ("4111​1111​1111​1111 x", "card", "4111​1111​1111​1111"),
    ("at 10․0․0․1 it", "ip", "10․0․0․1"),
])
def test_disguises_map_back(text, kind, found):
    base, spans = D.find(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in spans] == [(kind, found)]


@pytest.mark.parametrize("text, kind, base, found", [
    ("jоhn@example.com", "email", ["hn@example.com"], "jоhn@example.com"),
    ("john@mail.example [dot] com", "email", ["john@mail.example"], "john@mail.example [dot] com"),
    ("at 10.0.0.1２ it", "ip", ["10.0.0.1"], "10.0.0.1２"),
])
def test_disguised_whole_of_a_base_span(text, kind, base, found):
    plain, spans = D.find(text)
    assert [text[a:b] for _, a, b in plain] == base
    assert [(k, text[a:b]) for k, a, b in spans] == [*((kind, x) for x in base), (kind, found)]


def test_span_within_a_base_span_is_not_added():
    assert D.find("x ann@mail.org, call the оffice") == ([("email", 2, 14)],) * 2


@pytest.mark.parametrize("text", ["Bob [At] Foo [Dot] Com", "Bob At Foo Dot Com", "a dot b dot c dot d dot e dot f dot g at mail dot org", "x.b dot c at mail dot org"])
def test_whole_disguised_address(text):
    base, spans = D.find(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in spans] == [("email", text)]


@pytest.mark.parametrize("text, kind, found", [
    ("Mail an max punkt muster at beispiel punkt de heute", "email", "max punkt muster at beispiel punkt de"),
    ("Mail an max ÄT beispiel PUNKT de heute", "email", "max ÄT beispiel PUNKT de"),
    ("ruf null eins sieben neun fünf FÜNF zwo drei vier acht sechs an", "phone", "null eins sieben neun fünf FÜNF zwo drei vier acht sechs"),
    ("écrire à jean point dupont arobase exemple point fr merci", "email", "jean point dupont arobase exemple point fr"),
    ("tel plus trois trois, six un deux trois quatre cinq six sept fin", "phone", "plus trois trois, six un deux trois quatre cinq six sept"),
    ("correo juan arroba ejemplo punto com punto mx gracias", "email", "juan arroba ejemplo punto com punto mx"),
    ("llame al más tres cuatro seis cero cero uno dos tres cuatro cinco seis ya", "phone", "más tres cuatro seis cero cero uno dos tres cuatro cinco seis"),
    ("scrivi a luca chiocciola esempio punto it oggi", "email", "luca chiocciola esempio punto it"),
    ("para ana [arroba] exemplo ponto pt hoje", "email", "ana [arroba] exemplo ponto pt"),
    ("call oh two oh double seven four triple six one two now", "phone", "oh two oh double seven four triple six one two"),
    ("max [at] beispiel punkt de", "email", "max [at] beispiel punkt de"),
])
def test_disguises_in_other_languages(text, kind, found):
    base, spans = D.find(text)
    assert not base and [(k, text[a:b]) for k, a, b in spans] == [(kind, found)]


@pytest.mark.parametrize("text", [
    "look at the point where they meet", "mail me [at] work point being made", "un deux trois", "der punkt at dem ort", "due tre punti di vista",
    "arroba y punto", "double one", "one two sevenths", "uno dos tres cuatro cinco seis siete ocho nueve"])
def test_clean_words_of_other_languages(text):
    assert D.find(text) == ([], [])


def test_digit_words_are_one_digit_in_all_languages():
    for words in D._SPELLED_BY_LANGUAGE.values():
        assert [D._digits_of(same.split("|")[0]) for same in words.split()] == list("0123456789")
    assert D._digits_of("plus double three triple one oh") == "+331110"


def test_long_runs_of_parts_take_linear_time():
    began = time.process_time()
    assert D.find("%a dot " * 40_000) == ([], [])
    assert time.process_time() - began < 5


@pytest.mark.parametrize("text", ["we meet at noon by the dot com", "one two three", "at the dot", "", "прост текст с словами", "three four dots at six"])
def test_clean_texts_stay_clean(text):
    assert D.find(text) == ([], [])


def test_mapping():
    mapped = D.Mapped("abc(at)def", [(3, 7, "@")])
    assert mapped.text == "abc@def" and mapped.source(0, 7) == (0, 10) and mapped.source(3, 4) == (3, 7) and mapped.source(4, 6) == (7, 9)
