"""Orphan references: keys that refer to records which are missing, deleted or not yet there.

Method: a fixpoint cascade down the foreign-key graph. Round one finds the direct
orphans of every foreign key; each later round semi-joins the children of the
records found in the round before and marks them as inherited, until a round adds
nothing.

Defined results
* Keys are compared without surrounding white space and without regard to case.
* A null or blank key refers to nothing and is never an orphan.
* ``missing``: no such parent; ``late``: the earliest birth of the parent lies after the
  reference's own time; ``deleted``: some parent row with that key had died by then.
  ``late`` goes before ``deleted`` (one reason for a row and field). Where the
  reference or the parent has no such time, only ``missing`` is possible.
* A null time gives a null ``period``.
* Repeated child rows are each reported; repeated parent rows count as one parent.
* Empty tables give no rows; an empty parent makes every non-blank key ``missing``.
* Other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.operators.skew import heavy_keys, salted_join
from codexmill.session import cut, release


@dataclass(frozen=True)
class Entity:
    """A table in the foreign-key graph.

    ``row_key`` identifies a row (a column or an expression); ``key`` is what others refer
    to; ``at`` is the time of a reference; ``born`` and ``died`` bound the life of a record.
    """

    name: str
    df: DataFrame
    row_key: Column
    key: str | None = None
    at: str | None = None
    born: str | None = None
    died: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    child: str
    field: str
    parent: str


#: Rounds whose results are looked up one by one before they are written as one table.
COMPACT = 8

SCHEMA = "table string, row_key string, field string, at timestamp, reason string, kind string, level int"


def plain_key(c: Column) -> Column:
    """The key as compared: no surrounding white space, lower case; blank becomes null."""
    k = F.lower(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""))
    return F.when(k != "", k)


def _parents(e: Entity) -> DataFrame:
    """One row for each key of an entity, with the bounds of its life."""
    never = F.lit(None).cast("timestamp")
    rows = e.df.select(
        plain_key(F.col(e.key)).alias("k"),
        (F.col(e.born).cast("timestamp") if e.born else never).alias("born"),
        (F.col(e.died).cast("timestamp") if e.died else never).alias("died"),
    )
    return rows.filter(F.col("k").isNotNull()).groupBy("k").agg(F.min("born").alias("born"), F.min("died").alias("died"))


def _references(e: Entity, fields: list[str]) -> DataFrame:
    """One row for each non-blank reference; several fields of a table share one scan."""
    at = F.col(e.at).cast("timestamp") if e.at else F.lit(None).cast("timestamp")
    refs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), plain_key(F.col(f)).alias("k")) for f in fields]))
    own = plain_key(F.col(e.key)) if e.key else F.lit(None).cast("string")
    rows = e.df.select(e.row_key.cast("string").alias("row_key"), at.alias("at"), own.alias("own"), refs.alias("r"))
    return rows.select("row_key", "at", "own", "r.field", "r.k").filter(F.col("k").isNotNull())


@dataclass(frozen=True)
class _Edge:
    """The foreign keys of one child to one parent: its references, read and counted once, and its hot keys."""

    child: str
    parent: str
    refs: DataFrame
    heavy: list

    def join(self, right: DataFrame, how: str) -> DataFrame:
        return salted_join(self.refs, right, "k", how, spread=F.xxhash64("row_key", "field"), heavy=self.heavy)


def _direct(edge: _Edge, parent: Entity) -> DataFrame:
    """References that have no living parent at their time."""
    joined = edge.join(_parents(parent).withColumn("there", F.lit(True)), "left")
    reason = (
        F.when(F.col("there").isNull(), "missing")
        .when(F.col("born") > F.col("at"), "late")
        .when(F.col("died") <= F.col("at"), "deleted")
    )
    return joined.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def _inherited(edge: _Edge, frontier: DataFrame, found: list[DataFrame]) -> DataFrame:
    """References to records of the frontier that no round has reported through the same field yet."""
    keys = frontier.filter((F.col("table") == edge.parent) & F.col("own").isNotNull()).select(F.col("own").alias("k")).distinct()
    refs = edge.join(keys, "left_semi").withColumn("reason", F.lit("inherited"))
    for known in found:
        refs = refs.join(known.filter(F.col("table") == edge.child).select("row_key", "field"), ["row_key", "field"], "left_anti")
    return refs


def orphan_cascade(entities: list[Entity], foreign_keys: list[ForeignKey]) -> DataFrame:
    """All orphan references: ``table, row_key, field, at, reason, kind, level``.

    One loop of rounds over a moving frontier. Round 0 finds the references without a living parent; each later
    round semi-joins the references with the records found in the round before. It ends when the frontier has
    no record that others refer to. References and their hot keys are read once; of earlier rounds only keys are looked up.

    ``kind`` is ``direct`` (level 0) or ``inherited``: the record referred to exists but is
    itself an orphan; ``level`` is the number of steps to the nearest direct orphan. Every reference, that is a row
    and a field, is reported once; a row may be a direct orphan through one field and an inherited one through another.
    """
    by_name = {e.name: e for e in entities}
    grouped: dict[tuple[str, str], list[str]] = {}
    for fk in foreign_keys:
        grouped.setdefault((fk.child, fk.parent), []).append(fk.field)
    if not grouped:
        raise ValueError("the foreign-key graph is empty")
    children = {child for child, _ in grouped}
    edges = []
    for (child, parent), fields in grouped.items():
        refs = _references(by_name[child], fields)
        if parent in children:  # these references are read in every round
            refs = cut(refs)
        edges.append(_Edge(child, parent, refs, heavy_keys(refs, "k")))
    passes_on = any(e.parent in children for e in edges)
    known: list[DataFrame] = []
    frontier = None
    for level in count():
        parts = []
        for e in edges:
            if level and e.parent not in children:  # only tables that both refer and are referred to pass orphanhood on
                continue
            part = _inherited(e, frontier, known) if level else _direct(e, by_name[e.parent])
            kind = "inherited" if level else "direct"
            parts.append(part.select(F.lit(e.child).alias("table"), "row_key", "field", "at", "reason", F.lit(kind).alias("kind"), F.lit(level).alias("level"), "own"))
        frontier = reduce(DataFrame.unionByName, parts)
        if not passes_on:  # nothing refers to a child table, so the next frontier is empty
            return frontier.drop("own")
        frontier = cut(frontier)
        if not frontier.take(1):
            break
        known.append(frontier)
        if len(known) > COMPACT:  # a long chain: what is known becomes one table again
            replaced, known = known, [cut(reduce(DataFrame.unionByName, known))]
            release(*replaced[:-1])  # the last one is the frontier of the next round
    return reduce(DataFrame.unionByName, known or [frontier]).drop("own")


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts for each table, field, month, reason and kind."""
    period = F.date_format("at", "yyyy-MM")
    return found.groupBy("table", "field", period.alias("period"), "reason", "kind").agg(F.count(F.lit(1)).alias("n_references"))
