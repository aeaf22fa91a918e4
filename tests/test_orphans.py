from datetime import datetime

from pyspark.sql import functions as F

from codexmill.operators.orphans import Entity, ForeignKey, orphan_cascade, orphan_report
from codexmill.operators.skew import heavy_keys, salted_join

DOCS = "id string, ingested_at timestamp, deleted_at timestamp, at string, k string, row_key string"
RELS = "rel_id long, doc_id string, other_doc_id string, recorded_at timestamp, reason string, own string"


def at(day):
    return datetime(2024, 1, day)


def entities(spark, docs, rels):
    d = spark.createDataFrame([(*x, "x", "y", "z") for x in docs], DOCS)
    r = spark.createDataFrame([(*x, "r", "o") for x in rels], RELS)
    return [
        Entity("documents", d, F.col("id"), key="id", born="ingested_at", died="deleted_at"),
        Entity("rel", r, F.col("rel_id"), at="recorded_at"),
    ]


KEYS = [ForeignKey("rel", "doc_id", "documents"), ForeignKey("rel", "other_doc_id", "documents")]


def found(spark, docs, rels):
    got = orphan_cascade(entities(spark, docs, rels), KEYS)
    return {(int(r.row_key), r.field, r.reason) for r in got.collect()}


def test_reasons_blank_keys_and_repeats(spark):
    docs = [("A1", at(5), None), ("b", at(1), at(10)), ("b", at(8), None), (None, at(1), None), (" ", at(1), None)]
    rels = [
        (1, " a1\t", "B", at(6)),  # both found: other case, blanks around
        (2, "a1", "b", at(4)),  # late
        (3, "zz", None, at(4)),  # missing; null is no case
        (4, "", "  ", at(4)),  # blank keys are no cases
        (5, "b", "b", at(10)),  # deleted at that moment
        (5, "b", "b", at(10)),  # a repeated row is reported again
        (6, "a1", "b", None),  # no time: only missing is possible
    ]
    got = orphan_cascade(entities(spark, docs, rels), KEYS).collect()
    assert {(int(r.row_key), r.field, r.reason) for r in got} == {(2, "doc_id", "late"), (3, "doc_id", "missing"), (5, "doc_id", "deleted"), (5, "other_doc_id", "deleted")}
    assert len(got) == 6


def test_empty_tables(spark):
    assert found(spark, [], []) == set()
    assert found(spark, [], [(1, "a", "b", at(1))]) == {(1, "doc_id", "missing"), (1, "other_doc_id", "missing")}


def test_cascade_goes_down_the_chain(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "gone"), ("c", "b"), ("d", "c"), ("e", "a")], "node_id string, parent_id string")
    e = [Entity("n", nodes, F.col("node_id"), key="node_id")]
    got = {(r.row_key, r.kind, r.level) for r in orphan_cascade(e, [ForeignKey("n", "parent_id", "n")]).collect()}
    assert got == {("b", "direct", 0), ("c", "inherited", 1), ("d", "inherited", 2)}


def test_cascade_ends_on_a_cycle(spark):
    nodes = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "x")], "node_id string, parent_id string")
    e = [Entity("n", nodes, F.col("node_id"), key="node_id")]
    got = {(r.row_key, r.kind) for r in orphan_cascade(e, [ForeignKey("n", "parent_id", "n")]).collect()}
    assert got == {("b", "direct"), ("a", "inherited")}


def test_a_row_may_be_an_orphan_through_two_fields(spark):
    """``b`` lacks its document and hangs below ``a``, which lacks its own."""
    nodes = spark.createDataFrame([("a", "gone", None), ("b", "gone", "a"), ("c", "d1", "b")], "node_id string, doc_id string, parent_id string")
    docs = spark.createDataFrame([("d1",)], "id string")
    e = [Entity("n", nodes, F.col("node_id"), key="node_id"), Entity("d", docs, F.col("id"), key="id")]
    got = {(r.row_key, r.field, r.kind, r.level) for r in orphan_cascade(e, [ForeignKey("n", "doc_id", "d"), ForeignKey("n", "parent_id", "n")]).collect()}
    assert got == {("a", "doc_id", "direct", 0), ("b", "doc_id", "direct", 0), ("b", "parent_id", "inherited", 1), ("c", "parent_id", "inherited", 1)}


def test_a_long_chain_is_followed_to_its_end(spark):
    n = 24
    nodes = spark.createDataFrame([(f"k{i}", "gone" if i == 0 else f"k{i - 1}") for i in range(n)], "node_id string, parent_id string")
    got = {r.row_key: r.level for r in orphan_cascade([Entity("n", nodes, F.col("node_id"), key="node_id")], [ForeignKey("n", "parent_id", "n")]).collect()}
    assert got == {f"k{i}": i for i in range(n)}


def test_report_counts_by_month(spark):
    got = orphan_report(orphan_cascade(entities(spark, [], [(1, "a", None, at(3)), (2, "b", None, at(4))]), KEYS)).collect()
    assert [(r.period, r.n_references) for r in got] == [("2024-01", 2)]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("k"), "id")
    right = spark.range(400).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")).unionAll(spark.sql("SELECT 'hot', 7L"))
    assert heavy_keys(left, "k") == ["hot"]
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = salted_join(left, right, "k", how)
        b = left.join(right, "k", how)
        assert sorted(map(tuple, a.select(*sorted(a.columns)).collect()), key=str) == sorted(map(tuple, b.select(*sorted(b.columns)).collect()), key=str)
