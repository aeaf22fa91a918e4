"""Store, incremental load, profiling details, reports and samples."""

from pyspark.sql import functions as F

from codexmill.operators.profile import class_map, percentiles
from codexmill.operators.reports import to_markdown
from codexmill.operators.sample import round_robin, two_samples
from codexmill.plans.pipeline import parse_documents
from codexmill.sources.store import Store, duplicate_keys, load_documents
from codexmill.sources.tables import latest_per_key
from codexmill.streaming.incremental import stream_into

HTML = "id string, html string"


def parse(batch):
    nodes, q = parse_documents(batch, "id", "html")
    return nodes, q.select("doc_id")


def test_resume_loads_each_document_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    first = spark.createDataFrame([("a", "<p>Điều 1. x</p>"), ("empty", "")], HTML)
    store.load_nodes(*parse(first))
    store.load_nodes(*parse(first.unionAll(spark.createDataFrame([("b", "<p>Điều 1. y</p>")], HTML))))
    assert sorted(r.doc_id for r in store.complete_nodes().collect()) == ["a", "b"]
    assert sorted(r.doc_id for r in store.read("loaded").collect()) == ["a", "b", "empty"]
    assert duplicate_keys(store.read("nodes"), "node_id").count() == 0
    assert store.read("edges").count() == 0


def test_stream_parses_new_files_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    inbox = str(tmp_path / "in")
    spark.createDataFrame([("a", "<p>Điều 1. x</p>")], HTML).write.parquet(inbox)
    for extra in ([], [("b", "<p>Điều 1. y</p>"), ("a", "<p>again</p>")]):
        if extra:
            spark.createDataFrame(extra, HTML).write.mode("append").parquet(inbox)
        stream_into(spark, inbox, HTML, store, parse, str(tmp_path / "check")).awaitTermination()
    assert sorted((r.doc_id, r.node_type) for r in store.complete_nodes().collect()) == [("a", "dieu"), ("b", "dieu")]


def test_lenient_dates_and_last_duplicate(spark):
    cols = "id title so_ky_hieu ngay_ban_hanh loai_van_ban ngay_co_hieu_luc ngay_het_hieu_luc nguon_thu_thap nganh linh_vuc co_quan_ban_hanh chuc_danh nguoi_ky pham_vi thong_tin_ap_dung tinh_trang_hieu_luc".split()
    row = lambda i, d: tuple(d if c == "ngay_ban_hanh" else i if c == "id" else None for c in cols)
    raw = spark.createDataFrame([row("a", "1/2/2020"), row("b", "31/02/2020"), row("c", ""), row("d", "01/12/1999")], ", ".join(f"{c} string" for c in cols))
    got = {r.id: r.ngay_ban_hanh and r.ngay_ban_hanh.isoformat() for r in load_documents(raw).collect()}
    assert got == {"a": "2020-02-01", "b": None, "c": None, "d": "1999-12-01"}
    df = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new"), (None, 3, "lost")], "id string, n int, v string")
    assert [tuple(r) for r in latest_per_key(df, "id", ["n"]).collect()] == [("x", 2, "new")]


def test_percentile_index_rule(spark):
    for n, want in ((1, (1, 1)), (2, (2, 2)), (3, (2, 3)), (4, (3, 4)), (10, (6, 10))):
        df = spark.range(1, n + 1).select(F.lit("g").alias("g"), F.col("id").alias("v"))
        (r,) = percentiles(df, "g", "v").collect()
        assert (r.p50, r.p90) == want, n


def test_majority_tie_is_explicit(spark):
    df = spark.createDataFrame([("c", "khoan", 2), ("c", "diem", 2)], "class string, type string, n long")
    (r,) = class_map(df).collect()
    assert (r.type, r.purity, r.n) == ("diem", 0.5, 4)


def test_samples_are_disjoint_balanced_and_repeatable(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 5, "rare").when(F.col("id") < 20, None).otherwise("common").alias("s"))
    got = round_robin(df, "k", ["s"], 12).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"rare": 4, None: 4, "common": 4}
    both = two_samples(df, "k", ["s"], 30, 10)
    assert both.count() == 40 and both.select("k").distinct().count() == 40
    assert sorted(both.collect()) == sorted(two_samples(df.repartition(7), "k", ["s"], 30, 10).collect())


def test_markdown_cells_are_escaped(spark):
    text = to_markdown(spark.createDataFrame([("a|b\nc", None)], "x string, y int"), "T")
    assert "| a/b c |  |" in text and text.startswith("## T")


def test_profile_and_reports(spark, tmp_path):
    from codexmill.plans.profiling import CorpusProfile, write_profile
    from codexmill.plans.quality_report import profile_report, quality_report
    from codexmill.sources.store import load_class_map

    html = "<div class='box'><p class='art'>Điều 1. a</p><p class='art'>Điều 2. b</p><p>1. c</p></div><table></table>"
    profile = CorpusProfile(spark.createDataFrame([("a", html), ("b", None), ("c", "")], HTML), "id", "html")
    got = {(r.metric, r["name"]): r.value for r in profile.summary().collect()}
    assert got["presence", "n_docs"] == 3 and abs(got["presence", "with_table"] - 1 / 3) < 1e-9
    assert got["types", "n_docs"] == 3 and abs(got["types", "rate_dieu"] - 1 / 3) < 1e-9
    # The outer element repeats the text of the inner ones, so its class is seen with an article as well.
    assert {(r["class"], r.type, r.purity) for r in profile.class_map().collect()} == {("art", "dieu", 1.0), ("box", "dieu", 1.0)}
    assert "## Templates" in profile_report(profile)
    write_profile(profile, str(tmp_path / "p"))
    assert load_class_map(spark, str(tmp_path / "p/class_map")).count() == 2 and load_class_map(spark, str(tmp_path / "none")).count() == 0
    q = spark.createDataFrame([("a", "clean", "", "Luật", "1990s", "x"), ("b", "warn", "sequence", None, "", "x")], "doc_id string, verdict string, issues string, loai_van_ban string, decade string, template_family string")
    text = quality_report(q)
    assert "| clean | 1 | 50.0% |" in text and "| unknown | 0 | 1 | 0 | 1 |" in text and "| sequence | 1 | b |" in text


def test_blocks_as_json(spark, tmp_path):
    import json

    from codexmill.sources.store import write_blocks_json

    blocks = spark.createDataFrame([("a", 1, "y"), ("a", 0, "x"), ("c", 0, "z")], "doc_id string, dom_order int, text string")
    write_blocks_json(blocks, spark.createDataFrame([("a",), ("b",)], "doc_id string"), str(tmp_path / "g"))
    got = {r.doc_id: json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).collect()}
    assert got == {"a": [{"dom_order": 0, "text": "x"}, {"dom_order": 1, "text": "y"}], "b": []}


def test_judge_answers_and_settings(tmp_path, monkeypatch):
    from codexmill.sources.judge_http import HttpJudge, load_env, parse_answer

    assert parse_answer('```json\n{"node_type": "dieu", "number_raw": "3", "confidence": 0.7}\n```') == {"node_type": "dieu", "number_raw": "3", "confidence": 0.7}
    assert parse_answer('{"node_type": "poem"}') is None and parse_answer("no json") is None and parse_answer("[1]") is None
    assert HttpJudge("http://127.0.0.1:9", "m", timeout=0.2)("", "x", "") is None
    path = tmp_path / "env"
    path.write_text("# note\nA_TEST_KEY = 'v'\nbroken\n")
    monkeypatch.delenv("A_TEST_KEY", raising=False)
    assert load_env(str(path)) == {"A_TEST_KEY": "v"} and load_env(str(tmp_path / "none")) == {}
    monkeypatch.delenv("A_TEST_KEY", raising=False)


def test_release_deletes_what_a_cut_has_written(spark):
    import os

    from codexmill.session import cut, release

    df = cut(spark.range(10))
    path = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")
    assert df.count() == 10 and os.path.isdir(path)
    release(df, spark.range(3))
    assert not os.path.exists(path)


def test_digest_of_more_rows_than_a_long_can_sum(spark):
    import hashlib

    from codexmill.plans.store_queries import _digest

    for n in (3, 70_000):
        want = sum(int(hashlib.md5(f"{i}\x1f\x00\x1fx".encode()).hexdigest()[:12], 16) for i in range(n))
        assert (want > 2**63 - 1) == (n > 3)
        df = spark.range(n).select(F.col("id").cast("string").alias("doc_id"), F.lit(None).cast("string").alias("other_doc_id"), F.lit("x").alias("relationship"))
        (r,) = _digest(df, "document_relationships").collect()
        assert (r.n_rows, r.contents) == (n, (want + 2**63) % 2**64 - 2**63)
        assert _digest(df, "document_relationships").schema["contents"].dataType.typeName() == "long"
    (r,) = _digest(df.limit(0), "document_relationships").collect()
    assert (r.n_rows, r.contents) == (0, None)


def test_store_load_of_a_larger_table(spark, data, tmp_path):
    """Against the query's own SQL with its last cast widened: past the largest long that cast fails."""
    import os

    import duckdb

    from codexmill.plans import registry

    for t in ("documents", "nodes", "parse_quality"):
        os.symlink(f"{data}/{t}.parquet", tmp_path / f"{t}.parquet")
    rel = spark.read.parquet(f"{data}/document_relationships.parquet")
    copies = spark.range(70_000 // rel.count() + 1).select(F.col("id").cast("string").alias("copy"))
    rel.crossJoin(copies).withColumn("doc_id", F.concat("doc_id", F.lit("-"), "copy")).drop("copy").write.parquet(str(tmp_path / "document_relationships.parquet"))
    con = duckdb.connect()
    for t in ("documents", "nodes", "parse_quality", "document_relationships"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet{'/*.parquet' if t == 'document_relationships' else ''}')")
    sql = registry.oracles()["store_load"]
    wide = sql.replace(")::bigint AS contents", ")::hugeint AS contents")
    assert wide != sql
    want = {t: (n, c) for t, n, c in con.execute(wide).fetchall()}
    assert want["document_relationships"][1] > 2**63 - 1
    got = {r.table: (r.n_rows, r.contents) for r in registry.queries()["store_load"](spark, str(tmp_path)).collect()}
    assert got == {t: (n, (int(c) + 2**63) % 2**64 - 2**63) for t, (n, c) in want.items()}


def test_repeats_are_sought_within_a_document(spark, tmp_path):
    """Rows of a batch that was repeated count once; a node of another document is no repeat, whatever its id, and needs no exchange of its own."""
    from codexmill.sources.store import DDL

    store = Store(spark, str(tmp_path))
    store.create()
    names = [c.split(" ")[0] for c in DDL["nodes"].split(", ")]
    node = lambda i, d: tuple({"node_id": i, "doc_id": d}.get(c) for c in names)
    nodes = spark.createDataFrame([node("n", "a"), node("m", "a"), node("n", "b"), node("n", "unmarked")], DDL["nodes"])
    nodes.write.mode("append").parquet(store.path("nodes"))  # a run that ended before its marker
    store.load_nodes(nodes, spark.createDataFrame([("a",), ("b",)], "doc_id string"))
    assert sorted((r.doc_id, r.node_id) for r in store.complete_nodes().collect()) == [("a", "m"), ("a", "n"), ("b", "n")]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = store.complete_nodes()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(doc_id") == 2 and "hashpartitioning(node_id" not in plan
