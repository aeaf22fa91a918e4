from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from codexmill.llm.packing import pack, pack_items, token_counts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_packing_keeps_all_items_within_capacity(sizes):
    bins = pack([(s, k) for k, s in enumerate(sizes)], [16, 64])
    assert sorted(k for _, b in bins for _, k in b) == list(range(len(sizes)))
    assert all(sum(s for s, _ in b) <= c and c in (16, 64) for c, b in bins)
    assert all(c == 64 or sum(s for s, _ in b) <= 16 for c, b in bins)


def test_little_space_is_unused():
    sizes = [(k * 37) % 900 + 1 for k in range(5000)]
    bins = pack([(s, k) for k, s in enumerate(sizes)], [1024, 4096])
    assert sum(sizes) / sum(c for c, _ in bins) > 0.99


def test_last_bins_are_downsized():
    assert [c for c, _ in pack([(10, 0)], [1024, 4096])] == [1024]
    assert sorted(c for c, _ in pack([(600, 0), (600, 1)], [1024, 4096])) == [1024, 1024]


def test_rows(spark):
    rows = [(1, 10, "a"), (2, 0, "b"), (3, None, "c"), (4, 9000, "d"), (5, 10, "e"), (5, 10, "f"), (6, 4096, "g")]
    df = spark.createDataFrame(rows, "doc_id long, n long, bin_id string")
    got = pack_items(df, "doc_id", "n", [1024, 4096]).collect()
    pieces, fill = defaultdict(list), defaultdict(int)
    for r in got:
        pieces[int(r.doc_id)].append((r.first_token, r.n_tokens))
        fill[r.bin_id, r.capacity] += r.n_tokens
    assert sorted(pieces) == [1, 4, 5, 6] and len(pieces[5]) == 2 and len(pieces[6]) == 1
    assert sorted(pieces[4]) == [(0, 4096), (4096, 4096), (8192, 808)]
    assert all(n <= c for (_, c), n in fill.items())
    again = pack_items(df.repartition(3), "doc_id", "n", [1024, 4096]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert pack_items(df.limit(0), "doc_id", "n", [1024]).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Xin chào <|endoftext|>"), (2, None), (3, ""), (4, "a" * 20_000)], "k long, t string")
    got = dict(token_counts(df, "k", "t").collect())
    assert got[1] > 3 and got[2] == got[3] == 0 and got[4] > 100
