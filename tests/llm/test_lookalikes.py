import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from hypothesis import given, settings
from hypothesis import strategies as st

from codexmill.llm.lookalikes import compose, differing_rows, is_plain, mapping_rows, one_form, PLAIN_BLOCKS

CASES = [
    ("Căn cứ", "Căn cứ"), (unicodedata.normalize("NFD", "Nghị định ử"), "Nghị định ử"), ("a\u200bb\ufeffc\u00add", "abcd"), ("a\u00a0b\u3000c\td", "a b c d"), ("Ｃăｎ １２", "Căn 12"),
    ("cảnh quаn", "cảnh quan"), ("VТ ΝHÂN", "VT NHÂN"), ("QUYẾT ÐỊNH Ɖ", "QUYẾT ĐỊNH Đ"), ("протокол α Δ μ 協定", "протокол α Δ μ 協定"), ("протoкол", "протокол"), ("m² 28 °C ½ ± «x»", "m² 28 °C ½ ± «x»"),
    ("a\u0323\u0302", "ậ"), ("a\u0302\u0323", "ậ"), ("x\ny", "x\ny"), ("\u200b", ""), ("ｱ", "ア"), ("", ""), (None, None), ("5μm", "5μm"), ("А", "А"), ("Å", "Å"), ("한국", "한국"),
]


# Letters of all alphabets in Latin words, with their counterparts where one looks alike; (text, form, whether it is a case).
FOREIGN = [
    ("cαnh", "canh", True), ("qυan", "quan", True), ("νăn", "văn", True), ("ρhường", "phường", True), ("hօi", "hoi", True), ("Ꭰiều", "Diều", True), ("thҽo", "theo", True), ("𝐋uật", "Luật", True),
    ("quảɴ", "quảɴ", False), ("thжnh", "thжnh", True), ("жaи", "жаи", True), ("ώn", "wn", False), ("λόγoς", "λόγoς", True), ("протоkол", "протокол", True), ("5 kΩ 3μg", "5 kΩ 3μg", False),
    ("𝐋𝐮ậ", "Luậ", True), ("𝐋𝐮", "𝐋𝐮", False), ("협α", "협α", False), ("使用Windows系统", "使用Windows系统", False), ("ข้อABC", "ข้อABC", False), ("Δt α-β", "Δt α-β", True), ("ВΝ", "ВΝ", True), ("ё", "ё", False), ("hёt", "hët", True),
]


def test_foreign_letters_of_all_alphabets(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(FOREIGN) if t != "ώn"], "k int, t string")
    got = {r.row_key: (r.text_form, r.changed) for r in one_form(df, F.col("k"), "t").collect()}
    assert {FOREIGN[i][0]: v for i, v in got.items()} == {t: (f, c) for t, f, c in FOREIGN if t != "ώn"}
    assert {r.row_key for r in differing_rows(df, F.col("k"), "t").collect()} == {i for i, (t, _, c) in enumerate(FOREIGN) if c}


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aAeêoơưdđ\u0301\u0302\u0323\u031b\u0327\u0344\u1100\u1161\u11a8가\u0958\u0915\u093cKÅ", max_size=12))
def test_composition_by_pairs_equals_the_composed_form(text):
    points = unicodedata.normalize("NFD", text)
    assert compose(list(points), [unicodedata.combining(c) for c in points]) == unicodedata.normalize("NFC", text)


def frame(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, (t, _) in enumerate(CASES)], "k int, t string, row_key string, word int")


def test_one_form(spark):
    got = {r.row_key: (r.text_form, r.changed) for r in one_form(frame(spark), F.col("k"), "t").collect()}
    assert got == {i: (want, want != t) for i, (t, want) in enumerate(CASES)}


def test_differing_rows(spark):
    got = {r.row_key for r in differing_rows(frame(spark), F.col("k"), "t").collect()}
    assert got == {i for i, (t, want) in enumerate(CASES) if want != t}
    assert differing_rows(frame(spark).limit(0), F.col("k"), "t").count() == 0


def test_null_keys_and_repeats(spark):
    df = spark.createDataFrame([(None, "a\u200b"), ("r", "b\u200b c"), ("r", "b\u200b c"), ("r", "d")], "k string, t string")
    assert sorted((str(r.row_key), r.text_form) for r in one_form(df, F.col("k"), "t").collect()) == [("None", "a"), ("r", "b c"), ("r", "b c"), ("r", "d")]
    assert {r.row_key for r in differing_rows(df, F.col("k"), "t").collect()} == {None, "r"}


def test_long_word(spark):
    word = "x" * 100_000 + "\u200b" + "y" * 50_000
    df = spark.createDataFrame([("a", word)], "k string, t string")
    assert one_form(df, F.col("k"), "t").first().text_form == word.replace("\u200b", "")


def test_plain_characters_are_their_own_form():
    changed = {c for c, parts, *_ in mapping_rows() if unicodedata.normalize("NFC", "".join(parts)) != c}
    assert not any(is_plain(cp) and chr(cp) in changed for a, b in PLAIN_BLOCKS for cp in range(a, b + 1))


@pytest.mark.parametrize("c", ["А", "е", "Ν", "\u00a0", "Ａ", "Ð", "\u0301"])
def test_suspects_are_not_plain(c):
    assert not is_plain(ord(c)) and re.match(r".", c)
