import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codexmill.llm.pieces import merged_pieces, natural_segments, pieces, split_items


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab. \nÁ̂,;|", max_size=300), st.integers(12, 60), st.integers(0, 10))
def test_partition_limit_and_overlap(text, size, overlap):
    got = pieces(text, size, overlap)
    assert "".join(text[a:b] for a, b in got) == text
    assert all(b - max(0, a - overlap) <= size for a, b in got)
    # Merging is complete: no two neighbours would fit together.
    assert all(got[k + 1][1] - max(0, got[k][0] - overlap) > size for k in range(len(got) - 1))


def test_cuts_at_the_strongest_boundaries():
    text = "Một hai ba. Bốn năm.\nSáu bảy tám. Chín."
    assert [text[a:b] for a, b in pieces(text, 24, 0)] == ["Một hai ba. Bốn năm.\n", "Sáu bảy tám. Chín."]


@pytest.mark.parametrize("text,forced", [("a" * 21, True), ("a" * 20, False), ("a b " * 10, True), ("Aa b. " * 10, False), ("ab\n" * 10, False)])
def test_forced(text, forced):
    assert any(f for _, _, f in merged_pieces(text, 20, 0)) is forced


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab. \n,;", max_size=300), st.integers(12, 60), st.integers(0, 10))
def test_forced_equals_the_distance_of_natural_boundaries(text, size, overlap):
    far = any(len(text[a:b].strip()) > size for a, b, _ in natural_segments(text))
    assert any(f for _, _, f in merged_pieces(text, size, overlap)) is far


def test_marks_stay_with_their_base():
    text = "á" * 40
    assert all(text[a : a + 1] != "́" for a, _ in pieces(text, 15, 0))


def test_rows(spark):
    rows = [("a", None, 1), ("b", "", 1), ("c", "x" * 25, 1), ("c", "x" * 25, 1), (None, "Yy. " * 8, 1)]
    df = spark.createDataFrame(rows, "k string, t string, piece_no int")
    got = split_items(df, "k", "t", 10, 2).collect()
    assert {r.k for r in got} == {"b", "c", None} and all(len(r.piece) <= 10 for r in got)
    assert {(r.k, r.cut) for r in got} == {("b", "natural"), ("c", "forced"), (None, "natural")}
    assert [r.piece for r in got if r.k == "b"] == [""]
    over = split_items(df, "k", "t", 10, 2, only_oversized=True)
    assert {r.k for r in over.collect()} == {"c", None} and split_items(df.limit(0), "k", "t", 10, 2).count() == 0
    with pytest.raises(ValueError):
        split_items(df, "k", "t", 10, 10)


def test_astral_characters(spark):
    text = "😀" * 30
    (r, *_) = split_items(spark.createDataFrame([("a", text)], "k string, t string"), "k", "t", 16, 4).collect()
    got = split_items(spark.createDataFrame([("a", text)], "k string, t string"), "k", "t", 16, 4).orderBy("piece_no").collect()
    assert "".join(text[x.start_at : x.end_at] for x in got) == text and all(x.piece == text[max(0, x.start_at - 4) : x.end_at] for x in got)
