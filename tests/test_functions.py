from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from encore.functions import calendar as cal, keys, money, nested, parse, report_text, text
from encore.functions.keys import packed_key
from encore.functions.text import pack_texts, packed_parts, unpack_texts


def one(spark, column, **values):
    """Value of an expression over one row of string columns."""
    schema = ", ".join(f"{n} {'STRING' if isinstance(v, str) or v is None else 'DOUBLE'}" for n, v in values.items())
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(column).collect()[0][0]


def by_letters(s, breaks):
    out = ""
    for i, ch in enumerate(s):
        out += ch.upper() if i == 0 or s[i - 1] in breaks else ch.lower()
    return out


def test_cleaning_modes(spark):
    raw = "  the foo-bar band "
    assert one(spark, text.clean_name("c", " "), c=raw) == "The Foo-bar Band"
    assert one(spark, text.clean_name("c"), c=raw) == "The Foo-Bar Band"
    assert one(spark, text.title_case("c"), c="the o'brien-smith AC/DC j.cole SZA") == "The O'brien-Smith Ac/Dc J.Cole Sza"
    assert one(spark, text.clean_name("c"), c=None) is None
    assert one(spark, text.clean_code("c"), c=" ny ") == "NY"


def test_title_case_letter_by_letter(spark):
    rng = random.Random(7)
    letters = "abXY z1" + text.WORD_BREAKS + "\t\n'é"
    samples = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(s,) for s in samples], "c STRING")
    breaks = text.WORD_BREAKS + " \t\n"
    for s, got in df.select("c", text.title_case("c")).collect():
        assert got == by_letters(s, breaks), repr(s)


def test_only_breaks_before_cased_characters_are_marked(spark):
    marked = text.mark_words("c", text.WORD_BREAKS)
    for plain in ("hall #000000012", "nation_11", "a. b", "wait...", "4-1/2", "c:\t9"):
        assert one(spark, marked, c=plain) == plain
    assert one(spark, marked, c="jay-z.9..o") == "jay-\ufdd0 z.9..\ufdd0 o"
    assert one(spark, text.mark_words("c", "-x"), c="a-x-b") == "a-\ufdd0 x-\ufdd0 b"  # a break with case is capitalised itself


def test_title_case_equals_marking_every_break(spark):
    """Also where casing looks at the characters around (final sigma), and for breaks that are letters."""
    rng = random.Random(11)
    letters = "aZ09 \t\n.-_#^:'\u00b7\u00df\u03a3\u03c3\u03c2\u0130i\u0131\u0149\u01c6\u01c5\u2167\u24d0\u0345\u0307\u00ad\u0663\U00010428\u0301\u2028"
    samples = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 7))) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in samples], "c STRING").repartition(4)
    for breaks in (text.WORD_BREAKS, "-Z\u03a3\u01c6"):
        every = F.regexp_replace("c", "([" + "".join(re.escape(b) for b in breaks) + "\\t\\n\\x0B\\f\\r])", "$1\ufdd0 ")
        plain = F.replace(F.initcap(every), F.lit("\ufdd0 "), F.lit(""))
        assert df.where(~plain.eqNullSafe(text.title_case("c", breaks))).collect() == []


def test_strip_and_name_key(spark):
    for space in text.WHITESPACE:
        assert space.isspace()
    assert one(spark, text.name_key("c"), c="\t Foo Bar\r\n　") == "foo bar"
    assert one(spark, text.same_name("c", F.lit("FOO")), c="Foo") is True


def test_slices_of_text(spark):
    moment = "2024-05-01T20:00:00"
    assert one(spark, text.date_part("c"), c=moment) == "2024-05-01"
    assert one(spark, text.time_part("c"), c=moment) == "20:00:00"
    assert one(spark, text.date_part("c"), c="") is None
    assert one(spark, text.time_part("c"), c="2024-05-01") is None
    assert one(spark, text.time_part("c"), c=None) is None
    assert one(spark, text.last_segment("c"), c="https://a.example/x/id9") == "id9"
    assert one(spark, text.last_segment("c"), c="https://a.example/x/") == ""
    assert one(spark, text.last_segment("c"), c="plain") == "plain"
    assert one(spark, text.venue_label("a", "b"), a="Hall", b="NY") == "Hall (NY)"
    assert one(spark, text.venue_label("a", "b"), a="Hall", b=None) is None


def test_page_text(spark):
    assert one(spark, parse.monthly_listeners("c"), c="x 85,000 Monthly Listeners 1 monthly listeners") == 85000
    assert one(spark, parse.monthly_listeners("c"), c="85,000 monthly\n listeners") == 85000
    assert one(spark, parse.monthly_listeners("c"), c="nothing") is None
    assert one(spark, parse.monthly_listeners("c"), c=",, monthly listeners") is None
    assert one(spark, parse.monthly_listeners("c"), c=None) is None
    assert one(spark, parse.monthly_listeners("c"), c="9" * 30 + " monthly listeners") == 10**30 - 1
    far = "x" * 20000 + " 7 monthly listeners"
    assert one(spark, parse.monthly_listeners("c"), c=far) == 7
    link = "a https://open.spotify.com/artist/4YPq?si=1 https://open.spotify.com/artist/zz"
    assert one(spark, parse.artist_link_id("c"), c=link) == "4YPq"
    assert one(spark, parse.artist_link_id("c"), c="none") is None


def test_surrogate_key(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert one(spark, keys.surrogate_key("c"), c="K1") == md5("K1")
    assert one(spark, keys.surrogate_key("c"), c=None) == md5("_dbt_utils_surrogate_key_null_")
    assert one(spark, keys.surrogate_key("a", "b"), a="x", b=None) == md5("x-_dbt_utils_surrogate_key_null_")


def test_nested(spark):
    df = spark.createDataFrame(
        [([("x", False), ("y", True)],), ([("x", False)],), ([],), (None,), ([("x", None), ("y", True)],)],
        "p ARRAY<STRUCT<name: STRING, main: BOOLEAN>>",
    )
    got = df.select(
        nested.first_where("p", lambda p: p["main"])["name"], nested.first_of("p")["name"], nested.joined_names("p")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("y", "x", "x, y"), ("x", "x", "x"), (None, None, None), (None, None, None), ("y", "x", "x, y")
    ]


def test_weekends_differ(spark):
    df = spark.sql("SELECT explode(array(date'2024-01-06', date'2024-01-07', date'2024-01-05', date'2024-01-04', null)) AS d")
    got = df.select(
        cal.day_number("d"), cal.day_name("d"), cal.month_name("d"), cal.is_weekend("d"),
        cal.weekend_label(cal.is_weekend("d")), cal.long_weekend_label(cal.day_name("d")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (6, "Saturday", "Jan", True, "Weekend", "Weekend"),
        (0, "Sunday", "Jan", True, "Weekend", "Weekend"),
        (5, "Friday", "Jan", False, "Weekday", "Weekend"),
        (4, "Thursday", "Jan", False, "Weekday", "Weekday"),
        (None, None, None, False, "Weekday", "Weekday"),
    ]


def test_money(spark):
    assert one(spark, money.midpoint("a", "b"), a=10.0, b=20.0) == 15.0
    assert one(spark, money.midpoint(F.col("a"), F.lit(None).cast("double")), a=10.0) is None
    assert one(spark, money.priced("a"), a=0.0) is None
    assert one(spark, money.streaming_estimate("a"), a=1000.0) == 1000 * 50 * 12 * 0.004
    estimate = lambda v: money.streaming_estimate(F.lit(v).cast("double"))
    assert one(spark, money.revenue_multiplier("g", estimate(0)), g=250.0) == 250
    assert one(spark, money.revenue_multiplier("g", estimate(None)), g=250.0) is None
    assert one(spark, money.revenue_multiplier("g", F.lit(1.0)), g=2.5) == 2
    assert one(spark, money.revenue_multiplier("g", F.lit(1.0)), g=3.5) == 4
    assert one(spark, money.conversion_rate("t", "l"), t=0.25, l=100.0) == 0.2
    assert one(spark, money.conversion_rate("t", "l"), t=5.0, l=0.0) is None


def test_report_text(spark):
    assert one(spark, report_text.thousands("a"), a=1234567.5) == "1,234,568"
    assert one(spark, report_text.thousands("a"), a=2.5) == "2"
    assert one(spark, report_text.thousands(F.lit(None).cast("double")), a=1.0) == "—"
    assert one(spark, report_text.positive_thousands("a"), a=0.0) == "—"
    assert one(spark, report_text.two_decimals("a"), a=0.9) == "0.90"
    assert one(spark, report_text.dollars("a"), a=85.4) == "$85"
    assert one(spark, report_text.dollars("a", report_text.DYNAMIC), a=0.0) == "Dynamic"
    assert one(spark, report_text.millions("a"), a=2200000000.0) == "$2,200M"
    assert one(spark, report_text.billions("a"), a=6840000000.0) == "$6.8B"
    assert one(spark, report_text.percent("a"), a=12.34) == "12.3%"
    assert one(spark, report_text.times(F.lit(12)), a=0.0) == "12x"


def test_packed_keys_tell_all_texts_apart(spark):
    digits = "0123456789abcdef" * 2
    texts = [digits, digits.upper(), digits[:-1], digits + "0", digits[:-1] + "g", "", "a", "\x00", "\x00\x00", "é" * 16, "é" * 8, None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    keys = [r.k for r in frame.select(packed_key("t").cast("binary").alias("k")).collect()]
    assert len({None if k is None else bytes(k) for k in keys}) == len(texts) and keys[-1] is None
    assert bytes(keys[0]) == bytes.fromhex(digits) and all(len(k) > 16 for k in keys[1:-1])


def test_packed_texts_are_given_back(spark):
    texts = [None, "", "a", "\x1f", "\x1b", "\x1bn", "\x1bs\x1f", "\x1be\x1b\x1f\x1f", " b\n", "é|\\"]
    rows = [(a, b, c) for a in texts for b in texts for c in texts]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    names = ["a", "b", "c"]
    packed = frame.select(*names, packed_parts(pack_texts(names)).alias("p"))
    for r in packed.select(*names, F.struct(*unpack_texts(F.col("p"), names)).alias("back")).collect():
        assert tuple(r.back) == (r.a, r.b, r.c)
