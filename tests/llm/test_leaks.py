import random

import numpy as np

from codexmill.llm.leaks import EDITED_SEEDS, SEED_RUN, align, align_many, leaks, words_of


def case():
    random.seed(3)
    vocab = [f"từ{i}" for i in range(60)] + ["và", "của", "theo"] * 5
    items = [(f"i{k}", " ".join(random.choice(vocab) for _ in range(n))) for k, n in enumerate((40, 25, 20, 12, 3))]
    docs = [(k, " ".join(random.choice(vocab) for _ in range(80))) for k in range(40)]
    w = items[0][1].split()
    docs += [(100, "Mở đầu! " + ", ".join(x.upper() for x in w[5:25]) + " hết"), (101, " ".join(w[5:24])), (102, items[1][1]), (103, " ".join([*items[2][1].split()[:10], "xen", *items[2][1].split()[10:]]))]
    docs += [(104, None), (105, ""), (102, items[1][1])]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*x, "z", 1) for x in docs], "doc_id long, text string, gram string, pos int")
    return d, spark.createDataFrame([(*x, 5) for x in items], "item_id string, text string, rank int")


def test_runs_equal_brute_force(spark):
    docs, items = case()
    items = [*items, ("null", None), ("empty", "")]
    got = {(r.doc_id, r.item_id) for r in leaks(*(x for f, c in zip(frames(spark, docs, items), (("doc_id", "text"), ("item_id", "text"))) for x in (f, *c))).filter("longest_run >= 20").collect()}

    def holds(doc, item):
        a, b = words_of(doc), words_of(item)
        runs = {tuple(b[k : k + 20]) for k in range(len(b) - 19)}
        return any(tuple(a[k : k + 20]) in runs for k in range(len(a) - 19))

    want = {(d, i) for d, t in docs for i, p in items if holds(t, p)}
    assert got == want and {(100, "i0"), (102, "i1")} <= want and (101, "i0") not in want


def test_edited_copy_is_scored(spark):
    docs, items = case()
    d, i = frames(spark, docs, items)
    by = {(r.doc_id, r.item_id): r for r in leaks(d, "doc_id", "text", i, "item_id", "text").collect()}
    assert by[103, "i2"].longest_run == 10 and by[103, "i2"].score == 39
    same = {(r.doc_id, r.item_id) for r in leaks(d, "doc_id", "text", i, "item_id", "text", max_broadcast=0).collect()}
    assert same == set(by)


def test_alignment():
    assert align("a b c d".split(), "a b c d".split()) == (8, 4)
    assert align("a b x c d".split(), "a b c d".split()) == (7, 2)
    assert align("q a b z c d".split(), "a b y c d".split()) == (7, 2)
    assert align([], ["a"]) == (0, 0) and align(["b"], ["a"]) == (0, 0)


def test_empty_tables(spark):
    docs, items = case()
    d, i = frames(spark, docs, items)
    assert leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_edited_copies_without_a_rarest_seed_are_scored(spark):
    """One word in nine changed: alone no window keeps a rarest seed; beside a rarer copy with other edits neither do repeated ones."""
    w = [f"w{i}" for i in range(54)]
    edited = lambda at: " ".join(f"x{at}x{i}" if i % 9 == at else x for i, x in enumerate(w))
    for docs in ([(1, edited(4))], [(1, edited(4)), (2, edited(4)), (3, edited(0))]):
        d, i = frames(spark, docs, [("i", " ".join(w))])
        got = {r.doc_id: r.score for r in leaks(d, "doc_id", "text", i, "item_id", "text").collect()}
        assert set(got) == {k for k, _ in docs} and all(s == align(words_of(dict(docs)[k]), w)[0] >= 54 for k, s in got.items())


def test_recall_of_edited_copies(spark):
    """Copies with words changed, dropped, put in and moved at several rates, in a corpus that has the items' phrases too."""
    r = random.Random(17)
    vocab = [f"từ{i}" for i in range(400)]
    phrases = [[r.choice(vocab) for _ in range(6)] for _ in range(30)]
    passage = lambda n: [w for _ in range(n // 8) for w in (*r.choice(phrases), r.choice(vocab), r.choice(vocab))]
    items = [(f"i{k:02}", passage(64)) for k in range(20)]
    docs, want = [(k, " ".join(passage(160))) for k in range(300)], {}
    for rate in (0.05, 0.10, 0.15, 0.20):
        for k, w in items:
            copy = []
            for x in w:
                kind = r.random()
                if kind < rate / 3:
                    copy.append(r.choice(vocab))
                elif kind < rate * 2 / 3:
                    copy += [x, r.choice(vocab)]
                elif kind > rate:
                    copy.append(x)
            cut = r.randrange(len(copy))
            want[len(docs), k] = rate
            docs.append((len(docs), " ".join([*passage(40), *copy[cut:], *passage(24), *copy[:cut], *passage(40)] if rate == 0.10 else [*passage(40), *copy, *passage(40)])))
    d, i = frames(spark, docs, [(k, " ".join(w)) for k, w in items])
    got = {(x.doc_id, x.item_id): x.score for x in leaks(d, "doc_id", "text", i, "item_id", "text", run=SEED_RUN, per_window=EDITED_SEEDS, whole=True).collect()}
    full = {p: align(words_of(dict(docs)[p[0]]), dict(items)[p[1]])[0] for p in want}
    for rate in (0.05, 0.10, 0.15, 0.20):
        held = [p for p, x in want.items() if x == rate]
        assert sum(p in got for p in held) >= 0.9 * len(held)
    # What is aligned is aligned in full.
    assert all(got[p] == full[p] for p in want if p in got)


def test_alignment_of_many_equals_one_by_one():
    r = random.Random(5)
    text = lambda n: [r.randrange(6) for _ in range(n)]
    pairs = [(text(r.randrange(0, 90)), text(r.randrange(0, 30))) for _ in range(3_000)] + [(text(5_000), text(20)), (text(4_000), text(20))]
    got = align_many([np.array(a, dtype=np.int32) for a, _ in pairs], [np.array(b, dtype=np.int32) for _, b in pairs])
    assert got == [align(a, b) for a, b in pairs]
