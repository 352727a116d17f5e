import hashlib

import pytest
from pyspark.sql import functions as F

from shelfwright.functions import coerce, ids, jsontext, price, text, times
from shelfwright.operators.normalize import HINTS, normalize_listings


def test_cleaning(values):
    assert values(text.clean_text, ["  Straße, 5070-Ti+ ", "", None, "ü"]) == ["STRASSE 5070-TI+", "", None, ""]
    assert values(text.collapse_ws, ["\t a  b\n", ""]) == ["a b", ""]
    assert values(text.strip, [" x y\x1f", " \t", "z", None]) == ["x y", "", "z", None]
    assert values(text.first_line, ["\n one\r\ntwo", "x"]) == ["one", "x"]
    assert values(text.has_text, ["\t ", "", None, " a "]) == [False, False, False, True]
    assert values(text.reference_key, ["RDNA 3", " rdna-3 ", "Ätna²"]) == ["rdna3", "rdna3", "ätna²"]


def test_model_keys(values):
    assert values(text.model_key, ["NVIDIA GeForce RTX 5070Ti 16GB", "RTX", None, "RX7900XT"]) == [
        "5070 ti 16 gb", "", "", "rx 7900 xt",
    ]
    sized = lambda c: text.model_key_with_capacity(c, F.lit(16))
    assert values(sized, ["RTX 5070", "5070 8GB", "RTX"]) == ["5070 16 gb", "5070 8 gb", None]
    # An attempt appends the size even to an empty key, so it is a miss and not missing.
    assert values(lambda c: text.attempt_key(c, F.lit(16)), ["RTX"]) == [" 16 gb"]
    assert values(lambda c: text.attempt_key(c, F.lit(None).cast("int")), ["RTX"]) == [""]


@pytest.mark.parametrize("name, vendor, series, model", [
    ("RTX 5070 TI SUPER", "NVIDIA", "GeForce RTX 50", "RTX 5070 Ti SUPER"),
    ("RTX-5070TI", "NVIDIA", "GeForce RTX 50", "RTX 5070 Ti"),
    ("RTX 506", "NVIDIA", None, "RTX 506"),
    ("RX 7900 XTX", "AMD", "Radeon RX 7000", "RX 7900 XTX"),
    ("RX7900GRE X", "AMD", "Radeon RX 7000", "RX 7900 GRE"),
    ("ARC B-580", "INTEL", None, "ARC B580"),
    ("RX 7900 RTX 5070", "NVIDIA", "GeForce RTX 50", "RTX 5070"),
    ("RTX 50701", None, None, None),
])
def test_parse_model(values, name, vendor, series, model):
    found = values(text.parse_model, [name])[0]
    assert (found.vendor, found.series, found.model) == (vendor, series, model) if vendor else found.vendor is None


def test_ports_and_tokens(values):
    assert values(lambda c: text.port_count(c, "hdmi"), ["2X HDMI 1 X HDMI", "HDMI", "0X HDMI"]) == [3, None, None]
    assert values(lambda c: text.port_count(c, "displayport"), ["3X DP 1X DISPLAY PORT"]) == [4]
    assert values(text.memory_type, ["16GB GDDR6X", "GDDR8"]) == ["GDDR6X", None]
    assert values(text.capacity_gb, ["16 GB", "1024GB", "G 8GB 16GB"]) == [16, None, 8]
    assert values(text.infer_vendor, ["RADEON VS GEFORCE", "X"]) == ["AMD", None]


def test_normalize(spark):
    names = [
        ("Asus Prime GeForce RTX 5070 Ti OC 16G 12G-X, 16GB GDDR7, HDMI, 3x DP",
         ("NVIDIA", "GeForce RTX 50", "RTX 5070 Ti", "ASUS", "PRIME OC", 16, "GDDR7", None, 3)),
        ("Power Color Radeon Hellhound, 8GB", ("AMD", None, None, "POWERCOLOR", None, 8, None, None, None)),
        ("RTX 5070", ("NVIDIA", "GeForce RTX 50", "RTX 5070", None, None, None, None, None, None)),
        ("  ", (None,) * 9),
        (None, (None,) * 9),
    ]
    df = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(names)], "i int, name string")
    rows = normalize_listings(df, "name").orderBy("i").select(*HINTS).collect()
    assert [tuple(r) for r in rows] == [want for _, want in names]


def test_unknown_brand(spark):
    name = "Acme3D GeForce RTX 5080 Glacier Max, 16GB GDDR7, HDMI, 3x DP"
    row = normalize_listings(spark.createDataFrame([(name,)], "name string"), "name").select(*HINTS).first()
    assert tuple(row) == ("NVIDIA", "GeForce RTX 50", "RTX 5080", None, "ACME3D GLACIER MAX", 16, "GDDR7", None, 3)


def test_derivations(values):
    names = ["GeForce RTX 5070 TUF 12GB OC", "Radeon RX 7900 XTX", "RX 7600 8GB", "geforce rtx 5060ti"]
    assert [d.model for d in values(text.derive_chipset, names)] == ["Geforce Rtx 5070", "Radeon Rx 7900 Xtx", None, "Geforce Rtx 5060Ti"]
    derived = values(lambda c: text.derive_chipset(c, compat=True), names)
    assert [tuple(d) for d in derived] == [
        ("NVIDIA", "Geforce Rtx 5070 T", 12, True), ("AMD", "Radeon Rx 7900 Xt", None, False),
        ("AMD", None, None, False), ("NVIDIA", "Geforce Rtx 5060Ti", None, False),
    ]
    suffix = lambda raw: (lambda c: text.derive_suffix(F.lit(raw).cast("string"), c))
    assert values(suffix("Gaming X GeForce RTX 5070"), ["n"]) == ["Gaming X"]
    assert values(suffix("geforce rtx 5070"), ["TUF"]) == [None]
    assert values(suffix(None), ["my NITRO+ card", "x"]) == ["Nitro+", None]
    assert values(text.canonical_vendor, [" nvidia\t", "Intel", None]) == ["NVIDIA", None, None]


def test_coerce(values):
    v = lambda make: (lambda c: make(F.parse_json(c)))
    raw = ['12', '12.5', '13.5', '" 7 "', '"303.5"', 'true', 'null', '"5d"', '""', '"1_0"', '1e3', '"nan"']
    assert values(v(coerce.to_int), raw) == [12, 12, 14, 7, None, None, None, None, None, 10, 1000, None]
    floats = values(v(coerce.to_float), raw)
    assert floats[:11] == [12.0, 12.5, 13.5, 7.0, 303.5, None, None, None, None, 10.0, 1000.0] and floats[11] != floats[11]
    assert values(v(coerce.to_str), raw[:10]) == ["12", "12.5", "13.5", "7", "303.5", "True", None, "5d", None, "1_0"]


def test_float_text(values):
    numbers = [28.0, 1e7, 12345678.5, 0.00025, 1e-5, 1.5e16, 0.1, -3e7, float("inf")]
    assert values(coerce.float_text, numbers, "double") == [repr(x) for x in numbers]


def test_ranges(values):
    assert values(coerce.positive, [0, -1, 5, None], "int") == [None, None, 5, None]
    assert values(lambda c: coerce.clip_range(c, 2.0, 4.0), [1.9, 2.0, 4.0, 4.1], "double") == [None, 2.0, 4.0, None]
    assert values(lambda c: coerce.in_vocab(c, ("Air",)), ["Air", "air", None]) == ["Air", None, None]


def test_ids(values):
    want = "p_" + hashlib.sha256(b"ab||true|7").hexdigest()
    make = lambda c: ids.stable_id("p", c, F.lit(None), F.lit(True), F.lit(7))
    assert values(make, [" Ab ", "ab"]) == [want, want]
    assert values(ids.url_hash, ["x"]) == [hashlib.sha256(b"x").hexdigest()]


def test_price(values):
    assert values(price.parse_price, ["€ 1.234,56", "784.73", "ab 5,-", ",", "1,2,3", ""]) == [1234.56, 78473.0, 5.0, None, None, None]
    assert values(lambda c: price.parse_price(c, "en"), ["1,234.56"]) == [1234.56]
    assert values(price.valid_price, [0.0, 20000.0, 20000.01, None, float("nan")], "double") == [False, True, False, False, False]
    assert values(lambda c: price.ratio(c, F.lit(0)), [1.0], "double") == [None]
    # Efficiency score: cores x MHz / price / 100.
    score = lambda cores, mhz, p: round(cores * mhz / p / 100, 2)
    assert [score(3840, 2500, 277.38), score(6144, 2510, 519.0), score(10752, 2620, 1029.0)] == [346.1, 297.14, 273.76]


@pytest.mark.parametrize("raw, stage", [
    ('{"a":1}', "direct"), (' [1, 2] ', "direct"), ('text ```json\n{"a":1}\n``` {x}', "fenced"),
    ('so {"a":1} there', "braces"), ('{"a":1} tail', "braces"), ('{"a":1', "error"), ("", "error"),
    ('{"a":1}]', "braces"), ('{"a":1}}', "error"), ("1,2", "error"), ('1] [2', "error"), ('{"v":1}, "w":2', "braces"),
])
def test_repair_json(values, raw, stage):
    assert values(lambda c: jsontext.repair_json(c)["stage"], [raw]) == [stage]


def test_times(values):
    stamps = values(lambda c: F.unix_seconds(times.parse_iso(c)), ["2025-12-23T00:40:57Z", "2025-12-23", None])
    assert stamps == [1766450457, None, None]
    assert values(lambda c: times.run_text(times.parse_iso(c)), ["2025-12-23T00:40:57Z"]) == ["2025-12-23T00-40-57Z"]


def test_labels(values):
    label = lambda c: text.entity_label(F.lit("id"), c, F.lit("M"), F.lit(0))
    assert values(label, ["V", None]) == ["V M", "id"]
    slug = lambda c: text.slug(c, F.lit("Gaming X"), F.lit("NVIDIA"), F.lit("GeForce RTX 5070"), F.lit(12), F.lit(True))
    assert values(slug, ["Asus", None]) == ["asus_gamingx_nvidia_rtx5070_12gb_oc", "gamingx_nvidia_rtx5070_12gb_oc"]
