from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tablecheck.functions import masks, predicates, text
from tablecheck.functions.crypto import decrypt_text, encrypt_text
from tablecheck.functions.scores import cut_percent, quality_score

MASK_CASES = {
    "name": {
        "张三丰": "张**",
        "a": "a",
        "": "",
        None: None,
        "Customer#1": "C*********",
        "é": "é",
    },
    "phone": {
        "13812345678": "138****5678",
        "013812345678": "013****45678",
        "0791-1234567": "079*-*******",
        "12": "12",
        "123": "123",
        "1234": "123*",
        "16612345678": "166********",
        "13812345678\n": "138********\n",
        "": "",
        None: None,
    },
    "id_card": {
        "11010519491231002x": "110105********002x",
        "11010519491231002X": "11010519491231002X",
        "110105194912310": "110105******310",
        "11010519491231002|": "110105********002|",
        "1101051949123100": "1101051949123100",
        "": "",
        None: None,
    },
    "mail": {
        "Bhyxtqwz001@jxsg": "***********@jxsg",
        "a@b@c": "*@b@c",
        "@x": "@x",
        "none": "none",
        "": "",
        None: None,
    },
}
SQL_NAMES = {
    "name": "name_rm_sensitive",
    "phone": "phone_rm_sensitive",
    "id_card": "cerdID_rm_sensitive",
    "mail": "mail_rm_sensitive",
}


@pytest.mark.parametrize("mask", MASK_CASES)
def test_masks(spark, mask):
    cases = MASK_CASES[mask]
    df = spark.createDataFrame([(v,) for v in cases], "x string")
    rows = df.select("x", masks.MASKS[mask]("x").alias("y")).collect()
    assert {r.x: r.y for r in rows} == cases


def starred(text, start, end):
    return text[:start] + "*" * (end - start) + text[end:]


def expected_masks(text):
    """The four masks of one text, spelled out per character."""
    phone = text
    if re.fullmatch("0?1[34578][0-9]{9}", text):
        phone = starred(text, 3, 7)
    elif len(text) > 3:
        phone = text[:3] + "".join("*" if c in "0123456789" else c for c in text[3:])
    card = text
    if re.fullmatch("[0-9]{15}", text):
        card = starred(text, 6, 12)
    elif re.fullmatch("[0-9]{17}[0-9|x]", text):
        card = starred(text, 6, 14)
    mail = starred(text, 0, text.index("@")) if "@" in text else text
    return {
        "name": text[:1] + "*" * (len(text) - 1) if text else text,
        "phone": phone,
        "id_card": card,
        "mail": mail,
    }


def test_masks_of_random_texts(spark):
    rng = random.Random(3)
    alphabets = ["0123456789", "01348x|X", "ab@.", "é张 \n'\"$\\*", "013 -"]
    texts = {""}
    for _ in range(4000):
        size = rng.choice([0, 1, 2, 3, 4, 7, 11, 12, 15, 18, 30])
        texts.add("".join(rng.choice(rng.choice(alphabets)) for _ in range(size)))
        texts.add("".join(rng.choice("0123456789") for _ in range(rng.choice([15, 17]))) + rng.choice(["", "x", "X", "|"]))
        texts.add(rng.choice(["0", ""]) + rng.choice(["13", "16", "17"]) + "".join(rng.choice("0123456789") for _ in range(9)))
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select("x", *[masks.MASKS[m]("x").alias(m) for m in MASK_CASES])
    for row in got.collect():
        assert {m: row[m] for m in MASK_CASES} == expected_masks(row.x)
    masks.register_sql_masks(spark)
    calls = ", ".join(f"{SQL_NAMES[m]}(x) AS {m}" for m in MASK_CASES)
    assert spark.sql(f"SELECT x, {calls} FROM {{df}}", df=df).exceptAll(got).count() == 0


@pytest.mark.parametrize("mask", MASK_CASES)
def test_sql_masks_do_the_same(spark, mask):
    masks.register_sql_masks(spark)
    cases = MASK_CASES[mask]
    df = spark.createDataFrame([(v,) for v in cases], "x string")
    rows = spark.sql(f"SELECT x, {SQL_NAMES[mask]}(x) AS y FROM {{df}}", df=df)
    assert {r.x: r.y for r in rows.collect()} == cases
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_upper_case_check_digit_is_an_option(spark):
    df = spark.createDataFrame([("11010519491231002X",)], "x string")
    got = df.select(masks.mask_id_card("x", accept_upper_x=True)).first()[0]
    assert got == "110105********002X"


def test_apply_masks_refuses_unknown_columns(spark):
    with pytest.raises(ValueError):
        masks.apply_masks(spark.range(1), {"name": "name"})


def test_predicates(spark):
    values = ["12", "", None, "null", "a12", "12\n", "\n"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = {
        r.x: (r.find, r.full, r.full_null, r.empty, r.blank)
        for r in df.select(
            "x",
            predicates.regex_find("x", "[0-9]+").alias("find"),
            predicates.regex_full("x", "[0-9]+").alias("full"),
            predicates.regex_full("x", "null|[0-9]+", null_text="null").alias("full_null"),
            predicates.null_or_empty("x").alias("empty"),
            predicates.not_blank("x").alias("blank"),
        ).collect()
    }
    assert got == {
        "12": (True, True, True, False, True),
        "": (False, False, False, True, False),
        None: (None, None, True, True, None),
        "null": (False, False, True, False, True),
        "a12": (True, False, False, False, True),
        "12\n": (True, False, False, False, True),
        "\n": (False, False, False, True, True),
    }


def test_predicates_take_any_type(spark):
    df = spark.range(12)
    assert df.where(predicates.regex_full("id", "1.")).count() == 2
    assert df.where(predicates.null_or_empty("id")).count() == 0


def test_text(spark):
    df = spark.createDataFrame([("'a'b'", "\t x \x00", "s.t.u", None)], "q string, c string, d string, n string")
    row = df.select(
        text.strip_quotes("q").alias("q"),
        text.trim_control("c").alias("c"),
        text.last_name_part("d").alias("d"),
        text.join_columns("-", ["q", "d", "n"]).alias("j"),
        text.row_json(["c", "n"]).alias("json"),
        text.strip_quotes("n").alias("n"),
    ).first()
    assert tuple(row) == ("a'b", "x", "u", "'a'b'-s.t.u", '{"c":"x","n":" "}', None)


def test_timestamp_text_keeps_the_hour(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-03-31 22:30:01.5' AS a, timestamp '2024-03-31 02:30:00' AS b")
    assert tuple(df.select(text.timestamp_text("a"), text.timestamp_text("b")).first()) == (
        "2024-03-31 22:30:01",
        "2024-03-31 02:30:00",
    )


@pytest.mark.parametrize(
    "legal, total, expected",
    [
        (1, 3, 33.33),
        (59999, 60000, 99.99),
        (0, 5, 0.0),
        (7, 7, 100.0),
        (0, 0, None),
        # rounding up at 10 decimals lifts the cut value
        (9_999_999_999_999, 10_000_000_000_000, 100.0),
        (999_999_999, 1_000_000_000, 99.99),
    ],
)
def test_score(spark, legal, total, expected):
    df = spark.createDataFrame([(legal, total)], "legal long, total long")
    assert df.select(quality_score("legal", "total")).first()[0] == expected


def test_score_equals_decimal_arithmetic(spark):
    from decimal import ROUND_CEILING, ROUND_DOWN, Decimal, localcontext

    pairs = [(n * 7919 % (t + 1), t) for t in (1, 3, 7, 999, 60_000, 10**9 + 7, 10**13 + 1) for n in range(40)]
    df = spark.createDataFrame(pairs, "legal long, total long")
    for r in df.select("legal", "total", quality_score("legal", "total").alias("s")).collect():
        with localcontext() as context:
            context.prec = 60
            up = (Decimal(r.legal * 100) / r.total).quantize(Decimal("1e-10"), ROUND_CEILING)
        assert r.s == float(up.quantize(Decimal("0.01"), ROUND_DOWN))


def test_percent_is_cut(spark):
    df = spark.createDataFrame([(2, 3), (-1, 3), (1, 0)], "n long, t long")
    assert [r[0] for r in df.select(cut_percent("n", "t")).collect()] == [66.66, -33.33, None]


def test_aes_public_vector(spark):
    """The single block of RFC 3602, case 1."""
    key = bytes.fromhex("06a9214036b8a15b512e03d534120006")
    iv = bytes.fromhex("3dafba429d9eb430b422da802c9fac41")
    df = spark.createDataFrame([("Single block msg",)], "x string")
    sealed = df.select(encrypt_text("x", key, iv).alias("c")).select(
        "c", F.hex(F.unbase64("c")).alias("h"), decrypt_text("c", key, iv).alias("p")
    ).first()
    assert sealed.h[:32] == "E353779C1079AEB82708942DBE77181A"
    assert sealed.p == "Single block msg"


def test_decrypt_bad_input_is_null(spark):
    key = b"0123456789abcdef"
    df = spark.createDataFrame([("not base64!",), ("AAAA",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(decrypt_text("x", key, key)).collect()] == [None, None, "", None]
    assert [r[0] for r in df.select(decrypt_text("x", key)).collect()] == [None] * 4


def test_random_vectors_differ(spark):
    key = b"0123456789abcdef"
    df = spark.range(50).select(F.concat(F.lit("same"), F.col("id") % 1).alias("x"))
    assert df.select(encrypt_text("x", key).alias("c")).distinct().count() == 50


def test_key_size_is_checked():
    with pytest.raises(ValueError):
        encrypt_text("x", b"short")


def test_timestamp_text_of_a_text(spark):
    rows = [("2024-02-03 04:05:06.7",), ("2024-02-03",), ("no time",), ("",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(text.timestamp_text("t")).collect()
    assert [r[0] for r in got] == ["2024-02-03 04:05:06", "2024-02-03 00:00:00", None, None, None]


def test_null_or_empty_takes_every_line_end(spark):
    ends = ["", "\n", "\r", "\r\n", "\u0085", "\u2028", "\u2029"]
    others = [" ", "\n\n", "x", "\n\r", "\n ", "x" * 5000, "\v"]
    df = spark.createDataFrame([(t,) for t in [None, *ends, *others]], "x string")
    found = df.where(predicates.null_or_empty("x")).collect()
    assert {r.x for r in found} == {None, *ends}
