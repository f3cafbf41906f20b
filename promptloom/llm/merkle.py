"""Merkle manifest of a dataset: a tree per group, the groups' roots in a tree of their own, proofs for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import numbered

FANOUT = 16


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined without a separator; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field as byte count, colon and value, ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _slots(fanout: int) -> list[str]:
    return [f"s{k}" for k in range(fanout)]


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Tables of parents ``grp, pos, s0 … s15, hash`` from the lowest level up, until each group has one node.

    ``nodes``: ``grp, pos, hash``. Each parent's children are spread into slot columns by conditional
    aggregates. A lone node of a group is no run: it goes up as it is.
    """
    most = nodes.agg(F.max("pos")).first()[0] or 0
    out: list[DataFrame] = []
    while most > 0 or not out:
        children = [F.max(F.when(F.col("pos") % fanout == k, F.col("hash"))).alias(s) for k, s in enumerate(_slots(fanout))]
        parents = nodes.groupBy("grp", F.expr(f"pos div {fanout}").alias("up")).agg(*children)
        parents = parents.withColumnRenamed("up", "pos")
        parents = parents.withColumn("hash", F.when(_lone(), F.col("s0")).otherwise(digest(*_slots_of(fanout))))
        out.append(materialize(parents, "level"))
        nodes, most = out[-1].select("grp", "pos", "hash"), most // fanout
    return out


def _slots_of(fanout: int) -> list[Column]:
    return [F.col(s) for s in _slots(fanout)]


def _lone() -> Column:
    """Whether a parent stands for the only node of its group."""
    return (F.col("pos") == 0) & F.col("s1").isNull()


def _descend(children: DataFrame, parents: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """``children`` (``grp, pos, …``) with ``path``: own siblings left and right, then the parent's path."""
    up = parents.select(
        F.col("grp").alias("up_grp"), F.col("pos").alias("up_pos"), _lone().alias("lone"),
        F.array(*_slots_of(fanout)).alias("run"), F.col("path").alias("up_path"), *carried,
    )
    met = children.join(
        up, (F.col("grp") == F.col("up_grp")) & (F.expr(f"pos div {fanout}") == F.col("up_pos"))
    )
    slot = (F.col("pos") % fanout).cast("int")
    own = F.struct(
        F.concat_ws("", F.slice("run", F.lit(1), slot)).alias("left"),
        F.concat_ws("", F.slice("run", slot + 2, F.lit(fanout))).alias("right"),
    )
    path = F.when(F.col("lone"), F.col("up_path")).otherwise(F.concat(F.array(own), F.col("up_path")))
    return met.withColumn("path", path).drop("up_grp", "up_pos", "lone", "run", "up_path")


def manifest(rows: DataFrame, group_col: str, order_col: str, leaf_col: str = "leaf", fanout: int = FANOUT) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``path`` (``array<struct<left, right>>``, from the leaf up).

    Leaves of a group ascend by ``order_col`` (nulls first, ties by leaf); groups ascend by UTF-8 bytes, null
    first. A group of any size is numbered and hashed by many tasks. Repeated rows are leaves of their own.
    A group with one leaf has that leaf as its subroot, one group's subroot is the root, and an empty table
    gives an empty result. ``rows`` must hold no text: they are written once with their places, and once
    more per level a sixteenth of them. Extra columns come back; they may not be named as the tree's own.
    """
    key = F.col(group_col).cast("string")
    rows = rows.withColumn("grp", F.coalesce(F.concat(F.lit("="), key), F.lit("")))
    rows = numbered(rows.withColumn("hash", F.col(leaf_col)), ["grp"], [order_col, "hash"])
    rows = materialize(rows, "leaves")
    levels = _levels(rows.select("grp", "pos", "hash"), fanout)

    subroots = levels[-1].select(F.col("grp").alias("name"), F.col("hash"), F.lit("").alias("grp"))
    subroots = materialize(numbered(subroots, ["grp"], ["name"]), "subroots")
    upper = _levels(subroots.select("grp", "pos", "hash"), fanout)
    none = F.array().cast("array<struct<left:string,right:string>>")
    above = upper[-1].withColumn("path", none).withColumn("root", F.col("hash"))
    for below in [*reversed(upper[:-1])]:
        above = _descend(below, above, fanout, ["root"])
    tops = _descend(subroots, above, fanout, ["root"])
    tops = tops.select(F.col("name").alias("top"), F.col("path"), "root", F.col("hash").alias("subroot"))

    above = levels[-1].join(tops, F.col("grp") == F.col("top")).drop("top")
    for below in reversed(levels[:-1]):
        above = _descend(below, above, fanout, ["root", "subroot"])
    return _descend(rows, above, fanout, ["root", "subroot"]).drop("grp", "pos", "hash")


def siblings(path: str = "path") -> Column:
    """Digest of all siblings from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf gives together with its siblings."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def verify_documents(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text") -> DataFrame:
    """Leaf, subroot, root, proof and a check of every document, after every fifth one was tampered with.

    Where 5 divides the CRC-32 of the decimal id, the text's A-Z are lower-cased before the check; a text
    without them (or null) stays as it is and verifies. A null id is never tampered with. Texts are hashed in
    the scan and never shuffled. Repeated rows have a place and a proof each; an empty table gives no rows.
    """
    def of(text: Column) -> Column:
        return leaf(F.col(id_col), F.col(group_col), F.col("lang"), F.col("n_chars"), text)

    text = F.col(text_col).cast("string")
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(
        F.col(id_col), F.col(group_col).alias("source_key"), of(text).alias("leaf"),
        F.when(chosen & (lowered != text), of(lowered)).alias("changed"),
    )
    out = manifest(rows, "source_key", id_col).withColumn("folded_root", folded(F.coalesce("changed", "leaf")))
    return out.select(
        id_col, "leaf", "subroot", "root", siblings().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
