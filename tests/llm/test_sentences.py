import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codexmill.llm.sentences import sentence_ends, sentences


def cut(text, wrapped=False):
    out, at = [], 0
    for e in sentence_ends(text, wrapped):
        out.append(text[at:e].strip())
        at = e
    return out


@pytest.mark.parametrize(
    "text,want",
    [
        ("Một câu. Hai câu! Ba câu?", ["Một câu.", "Hai câu!", "Ba câu?"]),
        ("Điều 3. Giao TS. Tô Bá tại TP. Huế, P. 7, Q. Khuê theo khoản 5 Điều 18. Bộ làm.", ["Điều 3. Giao TS. Tô Bá tại TP. Huế, P. 7, Q. Khuê theo khoản 5 Điều 18.", "Bộ làm."]),
        ("gồm cá, v.v. và tôm. Mức 168.837.000 đồng ngày 9.10.2021. Hết...", ["gồm cá, v.v. và tôm.", "Mức 168.837.000 đồng ngày 9.10.2021.", "Hết..."]),
        ("gồm cá, v.v. Chủ tàu nộp.", ["gồm cá, v.v.", "Chủ tàu nộp."]),
        ('Ghi: “Một. Hai.” Sau đó. Có “Xong!” trên bìa.', ["Ghi: “Một. Hai.”", "Sau đó.", "Có “Xong!” trên bìa."]),
        ("a) Việc. Tiếp\nI. Mục\n- Lưu: VT.", ["a) Việc.", "Tiếp", "I. Mục", "- Lưu: VT."]),
        ("In No. 15 of Vinh Ltd. The seed, e.g. rice, by 5 p.m. on day. Dr. To etc. Each pays.", ["In No. 15 of Vinh Ltd.", "The seed, e.g. rice, by 5 p.m. on day.", "Dr. To etc.", "Each pays."]),
        ('State: "All done. No claim." The end.The next.', ['State: "All done. No claim."', "The end.", "The next."]),
        ("Remis par M. Dinh à l'al. 26. Fin ! « Un. Deux. » La fin.", ["Remis par M. Dinh à l'al. 26.", "Fin !", "« Un. Deux. »", "La fin."]),
        ("第1条 申请！期限2.5个月。注明：“一。二。”各方。", ["第1条 申请！", "期限2.5个月。", "注明：“一。二。”", "各方。"]),
        ("「完備した。ない。」と記載する。次。", ["「完備した。ない。」と記載する。", "次。"]),
        ("ข้อ 1 คณะต้องจด ภายใน 6 วัน ผู้ตรวจ และนาย “บันทึก” ไว้", ["ข้อ 1 คณะต้องจด", "ภายใน 6 วัน", "ผู้ตรวจ และนาย “บันทึก” ไว้"]),
        ("មាត្រា 1 អ្នក។គណៈ៕", ["មាត្រា 1 អ្នក។", "គណៈ៕"]),
        ("(*). Sau (một. Hai) đó. Ba", ["(*).", "Sau (một. Hai) đó.", "Ba"]),
        ('mở " một. Hai', ['mở " một.', "Hai"]),
        (" \n\t\n", []),
        ("", []),
    ],
)
def test_cases(text, want):
    assert cut(text) == want


def test_wrapped_paragraphs():
    assert cut("a\nbb. C\n\nd", True) == ["a\nbb.", "C", "d"]
    assert cut("a\nbb. C\nb. D", False) == ["a", "bb.", "C", "b. D"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='aB. !?"“”«»()[]\n1,;v。」「ก ', max_size=60), st.booleans())
def test_ends_ascend_and_cover(text, wrapped):
    ends = sentence_ends(text, wrapped)
    assert ends == sorted(set(ends)) and all(0 < e <= len(text) and not text[e - 1].isspace() for e in ends)
    assert "".join(text.split()) == "" or ends[-1] == len(text.rstrip())


def test_long_text_is_linear():
    text = ("Câu một. " * 50_000) + "x" * 200_000
    assert len(sentence_ends(text)) == 50_000 if text.endswith(". ") else len(sentence_ends(text)) >= 50_000


def test_rows(spark):
    df = spark.createDataFrame([(1, "A. B.", "x", 9), (2, None, None, 9), (3, "", "x", 9), (1, "A. B.", None, 9)], "doc_id long, text string, source string, sent_end int")
    assert sorted(map(tuple, sentences(df, "doc_id", "text", df["source"] == "scan").collect())) == [(1, 5), (1, 5)]
    assert sentences(df.limit(0), "doc_id", "text").count() == 0


def test_scan_source(spark):
    df = spark.createDataFrame([(1, "Một\nhai. Ba", "scan"), (2, "Một\nhai. Ba", None)], "doc_id long, text string, source string")
    got = sorted(map(tuple, sentences(df, "doc_id", "text", df["source"] == "scan").collect()))
    assert got == [(1, 8), (1, 11), (2, 3), (2, 8), (2, 11)]


@pytest.mark.parametrize("text", ["“" * 50_000 + ")" * 50_000 + " A. B", "A." * 60_000, "(" * 100_000 + ". A", '"' * 99_999 + ". A", "ก " * 50_000, ". " * 60_000])
def test_hostile_texts_stay_linear(text):
    ends = sentence_ends(text)
    assert ends and ends[-1] == len(text.rstrip())
