import random
from itertools import combinations

import pytest

from codexmill.llm.names import LINK, agree, alike, average_linkage, components, cosine_pairs, entities, entity_pairs, fold, marks, name_similarity, read_body, read_person, word_cosine, word_terms

PEOPLE = [
    {"Vũ Trọng Tường Xướng", "VŨ TRỌNG TƯỜNG XƯỚNG", "Vu Trong Tuong Xuong", "Đ/c Vũ Trọng Tường Xướng", "Vũ T. Xướng", "V.T.T. Xướng", "Xướng, Vũ Trọng Tường", "Vũ  Trọng Tường Xướng", "Vũ Trọng Tường Xướng (đã ký)", "Xướng Vũ Trọng Tường", "Vũ Trọng Tường Xưnớg", "Năm Xướng"},
    {"Đỗ Ngọc Mộc", "PGS.TS. Đỗ Ngọc Mộc", "Đỗ. Ngọc Mộc", "Do Ngọc Mộc"},
    {"Vũ Hải Mộc", "Ông Vũ Hải Mộc"},
]
BODIES = [
    {"Ủy ban nhân dân tỉnh Bích Tịnh", "Uỷ ban Nhân dân tỉnh Bích Tịnh", "UBND tỉnh Bích Tịnh", "UBND-tỉnh Bích Tịnh", "UBND T. Bích Tịnh", "U.B.N.D. tỉnh Bích Tịnh", "Tỉnh Bích Tịnh - Ủy ban nhân dân", "Bích Tịnh (Ủy ban nhân dân tỉnh)", "ubnd tinh bich tinh", "Uy ban nahn dan tinh Bich Tinh", "Ủy ban nhân dân tỉnh Bích Tinh"},
    {"Ủy ban nhân dân huyện Bích Tịnh", "UBND H. Bích Tịnh", "Ủy ban nhân dân huyne Bích Tịnh"},
    {"Hội đồng nhân dân tỉnh Bích Tịnh", "HĐND tỉnh Bích Tịnh"},
    {"Ủy ban nhân dân tỉnh Yến Lũng"}, {"Ủy ban nhân dân tỉnh Yến Lĩnh"},
    {"Ban Quản lý cảnh quan huyện Hạc Tịnh", "BQLCQ huyện Hạc Tịnh", "B.Q.L.C.Q. huyện Hạc Tịnh"},
]


@pytest.mark.parametrize("groups,body", [(PEOPLE, False), (BODIES, True)])
def test_entities(spark, groups, body):
    rows = [(n, 1) for g in groups for n in g for _ in range(2)] + [(None, 1), ("", 1), (" \t", 1)]
    named = entities(spark.createDataFrame(rows, "name string, entity int"), body)
    got = {tuple(r) for r in entity_pairs(named).collect()}
    want = {tuple(sorted(p)) for g in groups for p in combinations(g, 2)}
    assert got == want
    assert {r.n for r in named.collect()} == {2}


def test_ambiguous_short_names_join_nobody(spark):
    rows = [("Lê Thu Đáng",), ("Lê Tiến Đáng",), ("L.T. Đáng",), ("Tư Đáng",), ("Lê T. Đáng",)]
    assert entity_pairs(entities(spark.createDataFrame(rows, "name string"), False)).count() == 0


def test_empty_and_odd_names(spark):
    assert entities(spark.createDataFrame([], "name string"), False).count() == 0
    got = entity_pairs(entities(spark.createDataFrame([("...",), ("-",), ("UBND",), ("ubnd",)], "name string"), True)).collect()
    assert [tuple(r) for r in got] == [("UBND", "ubnd")]


def linked(spark, names, body=False):
    return {tuple(r) for r in entity_pairs(entities(spark.createDataFrame([(n,) for n in names], "name string"), body)).collect()}


def test_words_typed_wrong_and_other_words(spark):
    assert linked(spark, ["Nguyễn Văn Toản", "Nguyễn Văn Toxn", "Trần Mai Phách", "Trần Mia Phách"]) == {("Nguyễn Văn Toxn", "Nguyễn Văn Toản"), ("Trần Mai Phách", "Trần Mia Phách")}
    # Two words of three letters or less, and two that stand in several names, are two words.
    assert linked(spark, ["Nguyễn Văn An", "Nguyễn Văn Anh"]) == set()
    assert linked(spark, [f"{f} {g}" for f in ("Nguyễn Thị", "Lê Thu", "Trần Mỹ") for g in ("Lan", "Loan")]) == set()
    # A rare word beside one that stands in other names too is typed wrong.
    assert linked(spark, ["Lê Ngọc Hải", "Lê Ngọc Hi", "Trần Thu Hải"]) == {("Lê Ngọc Hi", "Lê Ngọc Hải")}


def test_accents_may_be_lost_but_not_contradict(spark):
    assert linked(spark, ["Nguyễn Văn Hùng"] * 3 + ["Nguyễn Văn Hưng"] * 3) == set()
    assert linked(spark, ["Nguyễn Văn Hùng", "Nguyen Van Hung", "NGUYỄN VAN HÙNG"]) == {("NGUYỄN VAN HÙNG", "Nguyen Van Hung"), ("NGUYỄN VAN HÙNG", "Nguyễn Văn Hùng"), ("Nguyen Van Hung", "Nguyễn Văn Hùng")}
    # The bare spelling joins one of the two, which stay apart.
    got = linked(spark, ["Nguyễn Văn Hùng"] * 3 + ["Nguyễn Văn Hưng"] * 2 + ["Nguyen Van Hung"])
    assert len(got) == 1 and ("Nguyễn Văn Hùng", "Nguyễn Văn Hưng") not in got
    assert linked(spark, ["Lê Thế Quyến", "Lê Thu Quyền", "L.T. Quyến"]) == {("L.T. Quyến", "Lê Thế Quyến")}
    assert agree(marks("ủy"), marks("uỷ")) and agree("", marks("hùng")) and not agree(marks("hùng"), marks("hưng"))


def test_order_and_length_count(spark):
    same = ["Khoát Lý Diệu Vĩnh", "Lý Diệu Vĩnh Khoát", "Khoát, Lý Diệu Vĩnh"]
    assert len(linked(spark, [*same, "Lý Vĩnh Diệu Khoát", "Lý Diệu Khoát"])) == 3


def test_readers():
    assert read_person("Tuyển, Đặng Tường Ngọc")["words"] == ["dang", "tuong", "ngoc", "tuyen"]
    assert read_person("T.K.S. Chức") == {"words": ["t.", "k.", "s.", "chuc"], "accents": ["", "", "", "\u0301\u031b"], "shape": "abbr"}
    assert read_body("Hạc Tịnh (Ban Quản lý cảnh quan huyện)")["words"] == ["=huyen", "=bqlcq", "hac", "tinh"]
    assert fold("  Đặng  THỦY ") == "dang thuy"


def test_name_similarity():
    sim = lambda x, y, known=1: name_similarity(x.split(), [""] * len(x.split()), [known] * len(x.split()), y.split(), [""] * len(y.split()), [known] * len(y.split()), True)
    assert sim("le van toan", "le van toan") == sim("le van toan", "toan le van") == 1.0
    assert LINK < sim("le van toan", "le van taon") < 1 and sim("le van toan", "le van taon", 9) == 0 and sim("le van toan", "le van minh") == 0


def test_sparse_join_equals_brute_force(spark):
    random.seed(5)
    words = sorted({"".join(random.choice("abcde") for _ in range(random.randrange(1, 6))) for _ in range(300)})
    got = {(r.a, r.b): r.cosine for r in cosine_pairs(spark.createDataFrame([(w,) for w in words], "word string"), 0.3).collect()}
    want = {(a, b): word_cosine(a, b) for a, b in combinations(words, 2)}
    assert set(got) == {p for p, c in want.items() if c >= 0.3} and all(abs(c - want[p]) < 1e-9 for p, c in got.items())
    best = {(r.a, r.b) for r in cosine_pairs(spark.createDataFrame([(w,) for w in words], "word string"), 0.3, top_n=1).collect()}
    top = lambda w: max((p for p in got if w in p), key=lambda p: (round(got[p], 9), [-ord(c) for c in p[p[0] == w]]), default=None)
    assert best <= set(got) and {max(got[p] for p in best if w in p) for w in words if top(w)} == {got[top(w)] for w in words if top(w)}


def test_alike_equals_brute_force(spark):
    random.seed(8)
    words = ["ha", "le", "thu", "minh", "mai", "bao", "hoa", "lan", "nguyen", "khanh"]
    slip = lambda w: w[1:] if len(w) > 3 and random.random() < 0.5 else w + w[-1]
    names = set()
    while len(names) < 150:
        n = [random.choice(words) for _ in range(3)]
        if random.random() < 0.4:
            k = random.randrange(3)
            n[k] = slip(n[k])
        names.add(" ".join(n))
    rows = [(n, n.split(), [""] * 3) for n in sorted(names)]
    got = {(r.a, r.b) for r in alike(spark.createDataFrame(rows, "key string, words array<string>, accents array<string>"), True).collect()}
    known: dict = {}
    for _, w, _ in rows:
        for k, x in enumerate(w):
            known.setdefault(x, set()).add(tuple(sorted(w[:k] + w[k + 1 :])))
    count = lambda w: [len(known[x]) for x in w]
    want = {(a, b) for (a, x, e), (b, y, f) in combinations(rows, 2) if name_similarity(x, e, count(x), y, f, count(y), True) > 0}
    # Names that differ in one or two words, each typed wrong on one side, all meet.
    near = {(a, b) for a, b in want if sum(x not in b.split() for x in a.split()) <= 1}
    assert near <= got <= want and len(got) > 20


def test_joined_words_grow_with_their_number():
    """A term of left-out letters belongs to no more words than letters can be put into it."""
    random.seed(4)
    syllable = lambda: random.choice(["b", "c", "d", "h", "kh", "l", "m", "ng", "ph", "qu", "s", "t", "th", "tr", "v", "x"]) + random.choice(["a", "e", "i", "o", "u", "ie", "uo", "oa"]) + random.choice(["", "n", "ng", "nh", "c", "ch", "t", "m", "p"])
    typed = lambda w: w[: (k := random.randrange(len(w)))] + random.choice(["", w[k] * 2, random.choice("abcdeghik")]) + w[k + 1 :]

    def joined(n: int) -> float:
        words = {x for _ in range(n) for w in [syllable()] for x in (w, typed(typed(w)))}
        df: dict = {}
        for w in words:
            for t in word_terms(w):
                df[t] = df.get(t, 0) + 1
        return sum(v * v for v in df.values()) / len(words)

    assert joined(20_000) / joined(4_000) < (20_000 / 4_000) ** 0.3


def test_components_of_a_chain(spark):
    keys = [f"{i:03}" for i in range(40)]
    links = spark.createDataFrame(list(zip(keys[:29], keys[1:30])), "a string, b string")
    got = dict(components(links, spark.createDataFrame([(k,) for k in keys], "key string")).collect())
    assert {got[k] for k in keys[:30]} == {"000"} and all(got[k] == k for k in keys[30:])


def test_average_linkage_weighs_members():
    where = average_linkage(["c", "t1", "t2", "x"], [10, 1, 1, 1], {(0, 1): 0.9, (0, 2): 0.9, (2, 3): 0.5})
    assert where[0] == where[1] == where[2] != where[3]
