"""Template matches against a version in plain Python."""

import re
from collections import defaultdict

import duckdb
import pytest

import shelfwright.llm.queries  # noqa: F401  (register)
from shelfwright.bindings.registry import ORACLES
from shelfwright.llm import template_decon as T

ITEMS = [
    (1, "A shop sells boxes. In the shop Tom Baker buys 5 apples and 3 pears for 12 km of road, then Tom Baker eats 5 apples."),
    (2, "one two three four five six"), (3, "tiny item"), (4, None), (5, ""), (6, "plain words only here and there until the very end of this long item text"),
    (None, "an item without any number of its own is left out of it all"),
    (7, "Then Ann and Bob and Cid and Dan and Eve and Fay and Gus and Hal and Ian met"),
]
SAME = "A shop sells boxes. In the shop Tom Baker buys 5 apples and 3 pears for 12 km of road, then Tom Baker eats 5 apples."
DOCS = [
    (1, "xx yy. " + SAME.replace("Tom Baker", "Ann").replace("5 apples", "7 apples").replace("12", "9") + " zz"),
    (2, SAME.replace("Tom Baker", "Ann", 1).replace("Tom Baker", "Bob").replace("5 apples", "7 apples", 1)),
    (3, "zero ONE two,,three four five six seven"), (4, None), (5, ""), (6, SAME), (7, SAME.upper()),
    (8, "plain words only here and there until the very end of this"), (9, "plain words only here and there until"),
    (10, "plain words only here and THERE***until; the very end of this long"), (None, "nothing of it"), (11, SAME + " " + SAME), (12, "é " * 50 + SAME),
    (13, "Then Ann and Bob and Cid and Dan and Eve and Fay and Gus and Hal and Ian met"), (14, "word " * 3000 + ITEMS[5][1]), (6, "the same number again"),
    (15, "first\nTiny, item!\nlast"), (16, "a tiny item amid others"),
]
BREAKS, NAMES, NUMBERS = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", T.NAMES, T.NUMBERS
UNITS = T.UNITS.replace("\\x{80}-\\x{10FFFF}", "\u0080-\U0010ffff")
SLOTS = (T.NAME, T.NUMBER, T.UNIT)


def template(text):
    named = re.sub(NAMES, rf"\1 {T.NAME} ", text or "")
    numbered = re.sub(NUMBERS, f" {T.NUMBER} ", named)
    whole = re.sub(UNITS, rf"{T.NUMBER} {T.UNIT} \2", numbered)
    values = {T.NAME: [m[2] for m in re.finditer(NAMES, text or "")], T.NUMBER: re.findall(NUMBERS, named), T.UNIT: [m[1] for m in re.finditer(UNITS, numbered)]}
    words = [w for w in re.split(BREAKS, whole.lower()) if w]
    slots, seen = {}, defaultdict(int)
    for i, w in enumerate(words):
        if w in SLOTS:
            slots[i] = (w, values[w][seen[w]])
            seen[w] += 1
    return words, slots


def plain_words(text):
    return [w for w in re.split(BREAKS, (text or "").lower()) if w]


def copies_by_hand(docs, items):
    """Most windows at one distance of each document that has an item word for word."""
    found = defaultdict(int)
    for item, text in items:
        words = plain_words(text)
        size = min(T.WINDOW, len(words))
        if item is None or not words:
            continue
        total = len(words) - size + 1
        need = min(max(T.MIN_WORDS - size + 1, 1), -(-total // 2))
        hits = defaultdict(set)
        for doc, own in docs:
            if len(words) < T.LINE:
                found[doc, item] = max(found[doc, item], any(plain_words(line) == words for line in re.split("[\n\r]+", own or "")))
                continue
            other = plain_words(own)
            for j in range(len(other) - size + 1):
                for i in range(total):
                    if other[j:j + size] == words[i:i + size]:
                        hits[doc, j - i].add(i)
        for (doc, _), at in hits.items():
            if len(at) >= need:
                found[doc, item] = max(found[doc, item], len(at))
    return {pair: n for pair, n in found.items() if n}


def leaks_by_hand(docs, items):
    found = {}
    texts = defaultdict(list)
    for doc, text in docs:
        texts[doc].append(template(text))
    for item, text in items:
        words, slots = template(text)
        if item is None or len(words) < T.SHORT:
            continue
        size = min(T.WINDOW, len(words))
        windows = {i: tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        windows = {i: w for i, w in windows.items() if sum(x not in SLOTS for x in w) >= T.LITERAL}
        total = len(words) - size + 1
        need = min(max(T.MIN_WORDS - size + 1, 1), -(-total // 2))
        for doc, own in texts.items():
            hits = defaultdict(set)
            for other, _ in own:
                for j in range(len(other) - size + 1):
                    for i, w in windows.items():
                        if tuple(other[j:j + size]) == w:
                            hits[j - i].add(i)
            for apart, at in hits.items():
                if len(at) < need:
                    continue
                pairs = {(*slots[p], s[p + apart][1]) for _, s in own for p in slots if min(at) <= p < max(at) + size and p + apart in s and s[p + apart][0] == slots[p][0]}
                consistent = len(pairs) == len({x[:2] for x in pairs})
                plain = sum(not set(windows[i]) & set(SLOTS) for i in at)
                if consistent or plain >= need:
                    kind = "exact" if not consistent or all(a == b for _, a, b in pairs) else "reparameterised"
                    found[doc, item] = max(found.get((doc, item), (0, False, -9999, "")), (len(at), kind == "exact", apart, kind))
    for pair, n in copies_by_hand(docs, items).items():
        found[pair] = max(found.get(pair, (0, False, -9999, "")), (n, True, -9999, "exact"))
    return sorted(((d, i, b[0], b[3]) for (d, i), b in found.items()), key=str)


@pytest.mark.parametrize("broadcast", [True, False])
def test_planted_cases(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(T, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as place", "2 as window", "3 as words", "4 as item_id")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as size", "2 as doc_id")
    got = sorted(map(tuple, T.find_leaks(spark, docs, items).collect()), key=str)
    assert got == leaks_by_hand(DOCS, ITEMS)
    kinds = {(d, i): k for d, i, _, k in got}
    assert kinds[1, 1] == "reparameterised" and (2, 1) not in kinds and kinds[6, 1] == kinds[11, 1] == "exact"
    assert kinds[13, 7] == kinds[7, 1] == kinds[15, 3] == "exact" and (16, 3) not in kinds
    assert kinds[3, 2] == "exact" and (9, 6) not in kinds and kinds[8, 6] == kinds[14, 6] == "exact"


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    want = leaks_by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, T.find_leaks(spark, docs, items).collect()), key=str) == want


def test_sql_of_planted_cases():
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [d for d in DOCS if d[0] is not None and d != (6, "the same number again")])
    con.executemany("insert into benchmark values (?, ?)", ITEMS)
    docs = [d for d in DOCS if d[0] is not None and d != (6, "the same number again")]
    assert sorted(con.execute(ORACLES["op5_template_decontamination"]).fetchall(), key=str) == leaks_by_hand(docs, ITEMS)
    con.execute("delete from documents")
    con.execute("delete from benchmark")
    docs = [(k, f"xx yy {text} zz") for k, text in DENSE if text] + [(k + 100, text.upper()) for k, text in DENSE if text]
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", DENSE)
    assert sorted(con.execute(ORACLES["op5_template_decontamination"]).fetchall(), key=str) == leaks_by_hand(docs, DENSE)


def test_empty_tables(spark, nothing, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert T.find_leaks(spark, nothing, items).count() == 0
    assert T.find_leaks(spark, documents, items.where("1 = 0")).count() == 0


QUESTIONS = [
    (1, "Janet has 9 apples. Mary has 4 more. How many apples are there in total?"),
    (2, "\"Peter Pan\" drives 20 km to Paris. Then Wendy drives 30 km more to Rome. Who drives further on the way to the sea?"),
    (4, "Ann drives 20 km to Paris. Wendy drives 30 km to Rome. Who drives further?"),
    (3, "The cat sat quietly on the mat. The dog slept all day long under the table"),
]
ASKED = [
    (1, "Susan has 3 apples. Peter has 5 more. How many apples are there in total?"),
    (2, "\nSusan has 3 apples. Susan has 5 more. How many apples are there in total?"),
    (3, "zz (Ann Lee) drives 7 km to Oslo. Later Bob drives 8 km more to Bonn. Who drives further on the way to the sea?"),
    (8, "Zoe drives 7 km to Oslo. Bob drives 8 km to Bonn. Who drives further?"), (9, "zz ann drives 20 KM to paris. wendy drives 30 km to rome. who drives further? zz"),
    (4, "A cat sat quietly on the mat. My dog slept all day long under the table"),
    (5, "The cat sat quietly on the mat. A dog slept all day long under the table"),
    (6, "Susan buys 3 pears. Peter sells 5 cups. How few things remain with anyone now?"),
    (7, "SUSAN HAS 3 APPLES. PETER HAS 5 MORE."),
]


def test_names_at_the_start_of_sentences(spark):
    docs, items = spark.createDataFrame(ASKED, "doc_id long, text string"), spark.createDataFrame(QUESTIONS, "item_id long, text string")
    got = sorted(map(tuple, T.find_leaks(spark, docs, items).collect()), key=str)
    assert got == leaks_by_hand(ASKED, QUESTIONS)
    kinds = {(d, i): k for d, i, _, k in got}
    assert kinds[1, 1] == kinds[3, 2] == "reparameterised" and not {6, 7} & {d for d, _ in kinds}
    assert (8, 4) not in kinds and kinds[9, 4] == "exact"  # too few literal words for a template
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", ASKED)
    con.executemany("insert into benchmark values (?, ?)", QUESTIONS)
    assert sorted(con.execute(ORACLES["op5_template_decontamination"]).fetchall(), key=str) == got


DENSE = [
    (1, "What is 12 * 7 + 3 - 5?"), (2, ITEMS[7][1]), (3, "Add 4 to it"), (4, "Then Ann and Bob and 3 km or 4 kg"), (5, "In the shop Tom Baker buys 5 apples and 3 pears"),
    (6, None), (7, ""), (8, " ".join(f"word{i}" for i in range(30))),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_verbatim_copies_of_dense_items(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(T, "BROADCAST_BYTES", 0)
    docs = [(10 * i + k, f"xx yy {t} zz") for i, text in DENSE if text for k, t in enumerate((text, text.upper(), text.lower()))]
    docs += [(100, "What is 12 * 7 + 3 - 6?"), (101, "Add 5 to it"), (102, None), (103, " ".join(f"word{i}" for i in range(11))), (104, " ".join(f"word{i}" for i in range(12)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([*DENSE, (None, "xx yy")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in T.find_copies(spark, frame, items).collect()}
    assert got == {(10 * i + k, i) for i, text in DENSE if text for k in range(3)} | {(104, 8)}
    assert T.find_copies(spark, frame, items.where("1 = 0")).count() == T.find_copies(spark, frame.where("1 = 0"), items).count() == 0


def test_pipeline_drops_verbatim_copies(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(DENSE, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, f"xx {DENSE[0][1]} yy"), (2, DENSE[1][1].upper()), (3, "nothing of it"), (None, "no id")], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.leaks(spark, docs, str(tmp_path)).collect()} == {3, None}


def test_short_items_are_whole_lines(spark):
    items = spark.createDataFrame([(1, "Yes"), (2, "forty two"), (3, "one two three")], "item_id long, text string")
    docs = [(1, "yes we did go there"), (2, "Answer:\nYES!\nThen more"), (3, "forty\ntwo"), (4, "x\r\nForty, two."), (5, "zero one two three four"), (6, None), (None, "yes")]
    docs += [(2, "yes"), (7, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as size", "2 as place", "3 as window", "4 as words", "5 as line")
    got = {(r.doc_id, r.item_id, r.n_windows) for r in T.find_copies(spark, frame, items).collect()}
    assert got == {(2, 1, 1), (4, 2, 1), (5, 3, 1), (None, 1, 1)}


def test_long_runs_of_names_and_numbers_do_not_exhaust_the_stack(spark):
    """A level of the stack for each word of a run ended the executor."""
    texts = [(1, "Alpha " * 20000 + SAME), (2, "1,2." * 20000 + " " + SAME)]
    items = spark.createDataFrame([(1, SAME)], "item_id long, text string")
    found = T.find_leaks(spark, spark.createDataFrame(texts, "doc_id long, text string"), items)
    assert sorted(r.doc_id for r in found.collect()) == [1, 2]
