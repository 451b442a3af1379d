"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent through it.

A row's leaf is the hash of its fields. Within a group (`lang`) leaves ascend by id; every eight consecutive
nodes of a level become one, until one is left, the subroot. Subroots, ordered by group, give the root likewise.
H is SHA-256 as lowercase hex of the concatenated inputs.

* **Ranks** come from a range-partitioned sort: a task numbers its own rows, and the counts of the tasks before it
  (one row a task and group) give where it starts. No group is in one task.
* **Levels** are built by grouping eight ranks at a time; every node is a record digest -> children in the store.
* **Proofs**: requests for leaves start at the root and descend by the digits (base 8) of their rank: a join with
  the store gives the children of the digest they stand at, the digit picks one, and the others are a segment of
  the path. Requests that share their digits so far stand at the same node and descend as one, so a level costs as
  many rows as it has nodes, and no digest is a hot key. At the leaves the segments are reversed, which gives the
  proof from the leaf up to the root.

Rows that repeat an id are ordered by their leaf; equal rows get one rank each. A null id comes first, as does the
null group. Fields may be null. An empty table has no root and gives no rows. Only `fields` of a table are read,
whatever other columns it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node.
FAN = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field_text(value: Column) -> Column:
    """`-` for null, otherwise the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, bytewise with null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def ranked(rows: DataFrame, group: str, *order: str, copies: str | None = None) -> tuple[DataFrame, DataFrame]:
    """`rows` with `rank`, their place from 0 within the group by `order`, and (group, `n`): the groups' sizes.

    A row that stands for `copies` equal ones takes as many ranks and has the first of them.
    """
    kind = dict(rows.dtypes)
    names = rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            counts = batch.column(names.index(copies)).to_pylist() if copies else [1] * batch.num_rows
            for g, c in zip(batch.column(names.index(group)).to_pylist(), counts, strict=True):
                if g != now:
                    now, at = g, 0
                places.append(at)
                at += c
            yield pa.record_batch([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())], names=[*names, "__part", "__place"])

    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in names], "__part int, __place long"])
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(dealt.mapInArrow(number, schema), "placed")
    size = F.sum(copies) if copies else F.count("*")
    parts = placed.groupBy(group, "__part").agg(size.alias("__n"))
    before = "sum(__n) OVER (PARTITION BY `{g}` ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)".format(g=group)
    starts = parts.select(group, "__part", F.coalesce(F.expr(before), F.lit(0)).alias("__start"))
    sizes = parts.groupBy(group).agg(F.sum("__n").alias("n"))
    out = placed.join(starts, [group, "__part"]).withColumn("rank", F.col("__start") + F.col("__place"))
    return out.select(*names, "rank"), sizes


@dataclass
class Manifest:
    """`runs`: (group, at, digest, kids): the leaves by eights, kids are (rank, id, leaf, tampered); `store`: (digest,
    children); `groups`: (group, rank, depth, digest): subroots; `levels`: of the tree of subroots; `root`."""

    runs: DataFrame
    store: DataFrame
    groups: DataFrame
    levels: int
    root: str | None


def _joined(children: str) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def _level(nodes: DataFrame, *group: str) -> DataFrame:
    """(group, at, digest, children) of the level above nodes (group, at, digest)."""
    up = nodes.groupBy(*group, F.floor(F.col("at") / FAN).alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("kids"))
    return up.select(*group, "at", F.transform("kids", lambda k: k["digest"]).alias("children")).withColumn("digest", _joined("children"))


def build(leaves: DataFrame) -> Manifest:
    """The DAG of leaves (group key, id, leaf, tampered)."""
    # equal rows are counted within each task before the shuffle; stored, since the sort samples it first
    distinct = stored(leaves.groupBy("group", "id", "leaf", "tampered").agg(F.count("*").alias("copies")), "leaves")
    placed, sizes = ranked(distinct, "group", "id", "leaf", copies="copies")
    every = F.sequence(F.col("rank"), F.col("rank") + F.col("copies") - 1)
    each = placed.select("group", "id", "leaf", "tampered", F.explode(every).alias("rank"))
    depth = F.expr(f"CASE WHEN n = 1 THEN 0 ELSE size(sequence(1, {_DEPTHS})) - size(filter(sequence(1, {_DEPTHS}), k -> n <= CAST(pow({FAN}, k) AS DECIMAL(38,0)))) + 1 END")
    sizes = stored(sizes.select("group", depth.cast("int").alias("depth")), "groups")
    kids = F.array_sort(F.collect_list(F.struct("rank", "id", "leaf", "tampered"))).alias("kids")
    runs = each.groupBy("group", F.floor(F.col("rank") / FAN).alias("at")).agg(kids).join(sizes, "group")
    children = F.transform("kids", lambda k: k["leaf"])
    digest = F.when(F.col("depth") == 0, F.col("kids")[0]["leaf"]).otherwise(F.sha2(F.array_join(children, ""), 256))
    runs = stored(runs.select("group", "at", "depth", digest.alias("digest"), "kids"), "runs")
    records, tops = [], [runs.where(F.col("depth") <= 1).select("group", "depth", "digest")]
    nodes, done = runs.where(F.col("depth") > 1).select("group", "depth", "at", "digest"), 1
    deepest = sizes.agg(F.max("depth")).first()[0] or 0
    while done < deepest:
        done += 1
        up = stored(_level(nodes, "group", "depth"), "level")
        records.append(up.select("digest", "children"))
        tops.append(up.where(F.col("depth") == done).select("group", "depth", "digest"))
        nodes = up.where(F.col("depth") > done).select("group", "depth", "at", "digest")
    groups = tops[0]
    for t in tops[1:]:
        groups = groups.unionByName(t)
    # the subroots in order of their groups are one group themselves
    subroots, _ = ranked(stored(groups.withColumn("all", F.lit(0)), "subroots"), "all", "group")
    subroots = stored(subroots.drop("all"), "subroots")
    nodes, levels = subroots.select(F.col("rank").alias("at"), "digest"), 0
    while (few := nodes.limit(2).collect()) and len(few) > 1:
        levels += 1
        up = stored(_level(nodes), "level")
        records.append(up.select("digest", "children"))
        nodes = up.select("at", "digest")
    store = None
    for r in records:
        store = r if store is None else store.unionByName(r)
    if store is None:
        store = leaves.sparkSession.createDataFrame([], "digest string, children array<string>")
    return Manifest(runs, stored(store.dropDuplicates(["digest"]), "store"), subroots, levels, few[0]["digest"] if few else None)


#: Levels that a group of 2^63 rows would have.
_DEPTHS = 21


def _step(frontier: DataFrame, store: DataFrame) -> DataFrame:
    """From nodes (at, digest, path, ...) to their children; the path grows by a segment (the siblings before and
    after the child)."""
    carried = [c for c in frontier.columns if c not in ("at", "digest", "path")]
    met = frontier.join(store, "digest").select(*carried, "at", "path", "children", F.posexplode("children").alias("digit", "child"))
    before = F.array_join(F.slice("children", F.lit(1), F.col("digit")), "")
    after = F.array_join(F.slice("children", F.col("digit") + 2, F.lit(FAN)), "")
    segment = F.struct(before.alias("before"), after.alias("after"))
    return met.select(*carried, (F.col("at") * FAN + F.col("digit")).alias("at"), F.col("child").alias("digest"), F.concat("path", F.array(segment)).alias("path"))


def proofs(manifest: Manifest) -> DataFrame:
    """(group, id, leaf, tampered, subroot, path) for each leaf; the path's segments go from the leaf to the root."""
    spark = manifest.runs.sparkSession
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    at = spark.range(1).select(F.col("id").alias("at"), F.lit(manifest.root).cast("string").alias("digest"), nothing.alias("path"))
    for _ in range(manifest.levels):
        at = stored(_step(at, manifest.store), "descent")
    groups = manifest.groups.select("group", "depth", F.col("digest").alias("subroot"), F.col("rank").alias("at"))
    at = at.join(groups, "at").select("group", "depth", "subroot", F.lit(0).cast("long").alias("at"), "digest", "path")
    ready, below = at.where(F.col("depth") <= 1), at.where(F.col("depth") > 1)
    deepest = groups.agg(F.max("depth")).first()[0] or 0
    for left in range(deepest - 1, 0, -1):
        # groups whose tree is `left` levels above its runs start now, the others are on their way or wait
        moving = stored(_step(below.where(F.col("depth") > left), manifest.store), "descent")
        below = below.where(F.col("depth") <= left).unionByName(moving)
    ends = ready.unionByName(below).select("group", "at", "subroot", "path")
    met = manifest.runs.select("group", "at", "depth", "kids").join(ends, ["group", "at"])
    each = met.select("group", "depth", "subroot", "path", "kids", F.posexplode("kids").alias("digit", "kid"))
    leaves = F.transform("kids", lambda k: k["leaf"])
    before = F.array_join(F.slice(leaves, F.lit(1), F.col("digit")), "")
    after = F.array_join(F.slice(leaves, F.col("digit") + 2, F.lit(FAN)), "")
    first = F.when(F.col("depth") > 0, F.array(F.struct(before.alias("before"), after.alias("after")))).otherwise(nothing)
    return each.select("group", "kid.id", "kid.leaf", "kid.tampered", "subroot", F.concat(first, F.reverse("path")).alias("path"))


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["before"], digest, s["after"]), 256))


def verify(documents: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group: str = "lang", tampered: Column | None = None, changed: str = "text") -> DataFrame:
    """(id, `leaf`, `subroot`, `root`, `path`, `folded_root`, `verified`) for each row: its proof, and the root that
    it leads to where rows for which `tampered` holds have lower-case `changed` (none, unless it is given)."""
    values = [F.col(f"`{c}`") for c in fields]
    leaf = leaf_of(*values)
    other = F.lit(None).cast("string")
    if tampered is not None:
        other = F.when(tampered, leaf_of(*[lowered(v) if c == changed else v for c, v in zip(fields, values, strict=True)]))
    rows = documents.select(_group_key(F.col(f"`{group}`")).alias("group"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"), other.alias("tampered"))
    made = build(rows)
    out = proofs(made).select(
        F.col("id").alias(id_col), "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), "path", folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
