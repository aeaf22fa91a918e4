"""The document store: tables, bulk and incremental loads, checks of keys, and small sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.functions.text import parse_date

DATES = ("ngay_ban_hanh", "ngay_co_hieu_luc", "ngay_het_hieu_luc")

# The columns of the store's tables.
DDL = {
    "documents": "id string, title string, so_ky_hieu string, ngay_ban_hanh date, loai_van_ban string, ngay_co_hieu_luc date, ngay_het_hieu_luc date, nguon_thu_thap string, nganh string, linh_vuc string, co_quan_ban_hanh string, chuc_danh string, nguoi_ky string, pham_vi string, thong_tin_ap_dung string, tinh_trang_hieu_luc string",
    "document_relationships": "doc_id string, other_doc_id string, relationship string",
    "parse_quality": "doc_id string, n_nodes int, char_coverage double, sequence_ok boolean, hierarchy_ok boolean, part_count_ok boolean, table_preserved boolean, conflict_rate double, verdict string, issues string, loai_van_ban string, decade string, template_family string",
    "nodes": "node_id string, doc_id string, part_id string, parent_id string, path string, depth int, order_index int, node_type string, number_raw string, number_norm string, heading string, text string, text_full string, breadcrumb string, html_raw string, confidence double, classified_by string",
    "edges": "src_node_id string, dst_node_id string, dst_doc_id string, edge_type string, source string, confidence double, evidence_text string",
}


def columns(name: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in DDL[name].split(",")]


class Store:
    """Parquet tables below one folder; a marker table tells which documents are complete."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def create(self) -> None:
        """Empty tables where none exist."""
        for name, ddl in {**DDL, "loaded": "doc_id string"}.items():
            self.spark.createDataFrame([], ddl).write.mode("ignore").parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(DDL.get(name, "doc_id string")).parquet(self.path(name))

    def has_rows(self, name: str) -> bool:
        """Whether a table holds anything; reads one row at most."""
        return bool(self.read(name).take(1))

    def load(self, name: str, df: DataFrame) -> None:
        """Replace a table; columns go by name."""
        df.select(*columns(name)).write.mode("overwrite").parquet(self.path(name))

    def load_nodes(self, nodes: DataFrame, docs: DataFrame, resume: bool = True) -> None:
        """Append the nodes of documents that are not complete yet, then mark all of ``docs`` complete.

        ``docs`` (``doc_id``) also holds documents without nodes, which are not parsed again on resume. The
        marker is written after the nodes; a run that ends between the two repeats its batch, so nodes of
        unmarked documents are left out when reading through ``complete_nodes``.
        """
        fresh = docs.select("doc_id").distinct()
        if resume:
            fresh = fresh.join(self.read("loaded"), "doc_id", "left_anti")
        mode = "append" if resume else "overwrite"
        nodes.join(fresh, "doc_id", "left_semi").select(*columns("nodes")).repartition("doc_id").sortWithinPartitions("doc_id", "order_index").write.mode(mode).parquet(self.path("nodes"))
        fresh.write.mode(mode).parquet(self.path("loaded"))

    def complete_nodes(self) -> DataFrame:
        """Nodes of the complete documents, each once.

        What a repeated batch has left is sought within each document, where the join has gathered it: no second exchange.
        """
        return self.read("nodes").join(self.read("loaded").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "node_id"])


def load_documents(metadata: DataFrame) -> DataFrame:
    """Metadata strings with their dates parsed; what is no date becomes null."""
    return metadata.select(*[parse_date(F.col(c)).alias(c) if c in DATES else F.col(c) for c in columns("documents")])


def indexable(quality: DataFrame) -> DataFrame:
    """Ids of documents good enough for the index."""
    return quality.filter(F.col("verdict").isin("clean", "warn")).select("doc_id").distinct()


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; empty where the key is unique."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def with_missing(ids: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks of the wanted ids as arrays; an id without blocks has an empty one."""
    grouped = blocks.join(ids.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("dom_order", "text"))).alias("b"))
    return ids.select("doc_id").join(grouped, "doc_id", "left").select("doc_id", F.coalesce(F.size("b"), F.lit(0)).alias("n_blocks"), F.to_json(F.coalesce("b", F.array())).alias("blocks"))


def write_blocks_json(blocks: DataFrame, ids: DataFrame, folder: str) -> None:
    """Blocks of the wanted documents as JSON, one folder for each document; a document without blocks has ``[]``."""
    with_missing(ids, blocks).select("doc_id", "blocks").repartition("doc_id").write.mode("overwrite").partitionBy("doc_id").text(folder)


def load_class_map(spark: SparkSession, path: str) -> DataFrame:
    """Class map from JSON lines (``class, type, purity, n``); a missing file is an empty map."""
    ddl = "class string, type string, purity double, n long"
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).json(path)
