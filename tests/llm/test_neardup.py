import random

from hypothesis import given, settings
from hypothesis import strategies as st

from codexmill.llm.neardup import BKTree, all_pairs, classes, radius, signature


def jaccard(a, b):
    n = lambda s: " ".join(s.lower().split())
    x, y = ({s[k : k + 5] for k in range(len(s) - 4)} for s in (n(a), n(b)))
    return len(x & y) / len(x | y) if x | y else 0.0


def corpus():
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(30):
        base = [random.choice(words) for _ in range(60)]
        out.append(" ".join(base))
        for edits in (1, 3, 6, 10):
            near = list(base)
            for _ in range(edits):
                near[random.randrange(60)] = random.choice(words)
            out.append(" ".join(near))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**24 - 1), max_size=40), st.integers(0, 2**24 - 1), st.integers(0, 12))
def test_tree_search_equals_scan(sketches, query, r):
    tree = BKTree()
    for i, s in enumerate(sketches):
        tree.add(s, i)
    assert sorted(tree.within(query, r)) == [i for i, s in enumerate(sketches) if (s ^ query).bit_count() <= r]


def test_pairs_equal_brute_force(spark):
    texts = corpus()
    texts += [texts[0].upper(), "  ".join(texts[5].split(" "))]  # copies after normalisation
    rows = [("f", f"k{i:03}", t, "x", 0) for i, t in enumerate(texts)] + [("f", "null", None, "x", 0), ("f", "empty", "", "x", 0), ("f", "tiny", "abcd", "x", 0), ("f", None, texts[0], "x", 0)]
    rows += [("f", "k000", texts[0], "x", 0)]  # a repeated row
    rows += [("g", f"k{i:03}", t, "x", 0) for i, t in enumerate(texts[:3])]
    got = {tuple(r) for r in all_pairs(spark.createDataFrame(rows, "field string, key string, text string, cid string, bucket int"), 0.7).collect()}
    want = {("f", f"k{i:03}", f"k{j:03}") for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(texts[i], texts[j]) >= 0.7}
    want |= {("g", f"k{i:03}", f"k{j:03}") for i in range(3) for j in range(i + 1, 3) if jaccard(texts[i], texts[j]) >= 0.7}
    assert got == want and len(want) > 60


def test_hot_class_counts_once(spark):
    base = corpus()[:4]
    rows = [("f", f"c{i}", base[0]) for i in range(300)] + [("f", "near", base[1]), ("f", "far", "something else entirely, nothing shared")]
    got = {r.key: (r.n_copies, r.n_links) for r in classes(spark.createDataFrame(rows, "field string, key string, text string"), 0.7).collect()}
    assert got["c0"] == (300, 1) and got["near"] == (1, 1) and got["far"] == (1, 0)


def test_blocks_of_a_large_shard_miss_nothing(spark):
    from codexmill.llm.neardup import near_pairs, texts_with_class

    texts = corpus()[:25]
    df = spark.createDataFrame([("f", str(i), t) for i, t in enumerate(texts)], "field string, key string, text string")
    key = lambda p: {(min(r.a, r.b), max(r.a, r.b)) for r in p.collect()}
    assert key(near_pairs(texts_with_class(df), 0.7, block=2)) == key(near_pairs(texts_with_class(df), 0.7))


def test_large_shards_are_cut_before_they_travel(spark):
    from codexmill.llm.neardup import near_pairs, texts_with_class

    texts = corpus()[:30]
    df = spark.createDataFrame([("f", str(i), t) for i, t in enumerate(texts)] + [("f", f"c{i}", texts[0]) for i in range(40)], "field string, key string, text string").repartition(5)
    key = lambda p: {(min(r.a, r.b), max(r.a, r.b)) for r in p.collect()}
    assert key(near_pairs(texts_with_class(df), 0.7, block=2, share=0.05, probe=1)) == key(near_pairs(texts_with_class(df), 0.7)) != set()


def family(rng, words, n):
    base = [rng.choice(words) for _ in range(80)]
    out = []
    for _ in range(n):
        near = list(base)
        near[rng.randrange(80)] = rng.choice(words)
        out.append(" ".join(near))
    return out


def test_tree_prunes_foreign_families():
    """A shard of 20 families with 25 near copies each: a search sees its own family and the first text of the others."""
    rng = random.Random(2)
    words = ["".join(rng.choice("bcdghklmnpqrstvx" if k % 2 else "aeiouy") for k in range(rng.randrange(2, 7))) for _ in range(3_000)]
    texts = [t for _ in range(20) for t in family(rng, words, 25)]
    sketches = [int.from_bytes(signature(t)[1], "big") for t in texts]
    tree, r = BKTree(), radius(0.7)
    for i, x in enumerate(sketches):
        tree.add(x, i)
    found = [sorted(tree.within(x, r)) for x in sketches]
    assert found == [[j for j, y in enumerate(sketches) if (x ^ y).bit_count() <= r] for x in sketches]
    assert tree.visited / len(sketches) ** 2 < 0.3


def test_recall_at_the_threshold(spark):
    """Of 240 pairs with a similarity of 0.70 to 0.78 at least 99 in 100 come out."""
    rng = random.Random(9)
    words = [f"{rng.choice('bcdghklmn')}{rng.choice('aeiou')}{rng.choice('nmtcp')}{i}" for i in range(3_000)]
    rows, want = [], set()
    while len(want) < 240:
        base = [rng.choice(words) for _ in range(70)]
        near = list(base)
        for k in rng.sample(range(70), 8):
            near[k] = rng.choice(words)
        a, b = " ".join(base), " ".join(near)
        if 0.70 <= jaccard(a, b) <= 0.78:
            n = len(want)
            rows += [("f", f"{n:04}a", a), ("f", f"{n:04}b", b)]
            want.add(("f", f"{n:04}a", f"{n:04}b"))
    got = {tuple(r) for r in all_pairs(spark.createDataFrame(rows, "field string, key string, text string"), 0.7).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "field string, key string, text string")
    assert all_pairs(empty, 0.7).count() == 0 and classes(empty, 0.7).count() == 0


def test_signature_of_short_and_long_texts():
    assert signature("abcd") is None and signature("abcde") is not None
    keys, sketch = signature("abcdefgh " * 50_000)
    assert len(keys) == 64 and len(sketch) == 48 and (signature("x" * 100_000)[0] == signature("x" * 5)[0]).all()
    assert 58 < radius(0.7) < 100
