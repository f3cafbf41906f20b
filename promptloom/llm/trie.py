"""Prefix trie of conversations: nodes by the digest of their turns, subtree sums rolled up in bands of depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import numbered, text_or_empty

#: Depths of a band: a node is sent to at most so many ancestors, and a round climbs so many levels.
BAND = 64
WORDS = "[^\\x20\\x09-\\x0D]+"
KEY = "struct<k1:bigint,k2:bigint>"


def turns_of(conversations: DataFrame, id_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, pos, a, b, words``: places of turns, two digests of (role, text) in place of the text."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    slim = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(order_col).alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    placed = numbered(slim, ["conv_id"], ["turn", "role", "a", "b"])
    return materialize(placed.select("conv_id", "pos", "a", "b", "words"), "turns")


def rebuilt_turns(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(conversations, turns)`` where each conversation begins like the one its id is rounded down to.

    Conversation c takes the first h turns of conversation ``c - c % every`` and goes on with its own turns
    after its first h, h being the CRC-32 of its decimal id modulo ``heads``. Returns ``conv_id, total`` and
    ``conv_id, total, depth, a, b, words``; a conversation left without turns is in the first frame only.
    """
    first = turns.where(F.col("pos") < heads - 1).groupBy(F.col("conv_id").alias("donor"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("taken", taken)
    convs = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % every).join(first, "donor", "left")
    head = F.filter("head", lambda t: t["pos"] < F.col("taken"))
    convs = convs.withColumn("head", F.coalesce(head, F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,words:bigint>>")))
    total = F.size("head") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))
    convs = materialize(convs.select("conv_id", "taken", "head", total.cast("long").alias("total")), "conversations")
    given = convs.select("conv_id", "total", F.explode("head").alias("t"))
    given = given.select("conv_id", "total", (F.col("t.pos") + 1).alias("depth"), "t.a", "t.b", "t.words")
    own = turns.join(convs.select("conv_id", "taken", "total", F.size("head").alias("given")), "conv_id")
    own = own.where("pos >= taken").withColumn("depth", F.col("pos") - F.col("taken") + F.col("given") + 1)
    return convs.select("conv_id", "total"), given.unionByName(own.select(given.columns))


def _xor(name: str, window=None) -> Column:
    out = F.bit_xor(name)
    return out.over(window) if window is not None else out


def with_prefixes(turns: DataFrame, band: int = BAND) -> DataFrame:
    """Turns with ``k1, k2`` of the prefix that ends there and ``anc``: keys of its ancestors inside the band.

    The key of a prefix is the exclusive or of digests of its turns with their depths. It is summed up inside
    bands; where a conversation has more than one, sums of the bands before are added, which themselves
    are summed in blocks of ``band`` bands. So no window holds more than ``band`` rows, or one row for
    ``band`` squared turns. ``anc`` ends with the parent and begins with the node at the band's upper edge.
    """
    salted = turns.withColumn("x1", F.xxhash64("depth", "a", "b")).withColumn("x2", F.xxhash64(F.lit(7), "b", "a", "depth"))
    salted = salted.withColumn("band", F.expr(f"(depth - 1) div {band}"))
    inside = Window.partitionBy("conv_id", "band").orderBy("depth")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    keyed = salted.withColumn("l1", _xor("x1", upto)).withColumn("l2", _xor("x2", upto))
    keyed = keyed.withColumn("above", F.collect_list(F.struct("l1", "l2")).over(before))

    bands = salted.where(F.col("total") > band).groupBy("conv_id", "band").agg(_xor("x1").alias("x1"), _xor("x2").alias("x2"))
    bands = bands.withColumn("block", F.expr(f"band div {band}"))
    near = Window.partitionBy("conv_id", "block").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = bands.groupBy("conv_id", "block").agg(_xor("x1").alias("x1"), _xor("x2").alias("x2"))
    blocks = blocks.select("conv_id", "block", *[F.coalesce(_xor(f"x{i}", far), F.lit(0)).alias(f"f{i}") for i in (1, 2)])
    offsets = bands.join(blocks, ["conv_id", "block"]).select(
        "conv_id", "band", *[F.coalesce(_xor(f"x{i}", near), F.lit(0)).bitwiseXOR(F.col(f"f{i}")).alias(f"o{i}") for i in (1, 2)]
    )
    met = keyed.join(offsets, ["conv_id", "band"], "left")
    o1, o2 = (F.coalesce(f"o{i}", F.lit(0)) for i in (1, 2))
    edge = F.struct(o1.alias("k1"), o2.alias("k2"))
    moved = F.transform("above", lambda x: F.struct(x["l1"].bitwiseXOR(o1).alias("k1"), x["l2"].bitwiseXOR(o2).alias("k2")))
    return met.select(
        "conv_id", "depth", "total", "words", "band", F.col("l1").bitwiseXOR(o1).alias("k1"),
        F.col("l2").bitwiseXOR(o2).alias("k2"), F.concat(F.array(edge), moved).alias("anc"),
    )


def ids_digest(members: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: digest of each node's ids, ascending, with commas between.

    Ids arrive sorted and are fed to one running SHA-256 per node, so a node of any size needs no list; the
    digest of one string can't be taken in parts, so its ids pass through one task, as numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def closed(done: list) -> pa.RecordBatch:
            columns = list(zip(*done)) if done else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["k1", "k2", "ends_sha256"])

        for batch in batches:
            done = []
            for k1, k2, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(b"%d" % conv_id)
                else:
                    state.update(b",%d" % conv_id)
            yield closed(done)
        if key:
            yield closed([(*key, state.hexdigest())])

    dealt = members.select("k1", "k2", "conv_id").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    return dealt.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _rolled_up(nodes: DataFrame, deepest: int, band: int) -> DataFrame:
    """``k1, k2, n_children, n_leaves, saved_tokens`` of every node, band by band from the deepest one up.

    In a round each node of a band adds its own leaf and tokens to itself and to its ancestors in the band,
    at most ``band`` of them, and one child to its parent. What the nodes at the lower edge have got from
    the band below is complete by then and goes up with it.
    """
    done, below = None, None
    for b in range(max(deepest - 1, 0) // band, -1, -1):
        mine = nodes.where((F.col("band") == b) & (F.col("depth") > 0))
        spread = F.transform(
            "anc",
            lambda a, i: F.struct(
                a.alias("key"), (i + b * band).cast("long").alias("at"),
                (i + 1 == F.size("anc")).cast("long").alias("child"), F.col("leaf").alias("leaves"), F.col("saved"),
            ),
        )
        own = F.struct(
            F.struct("k1", "k2").alias("key"), F.col("depth").alias("at"), F.lit(0).cast("long").alias("child"),
            F.col("leaf").alias("leaves"), F.col("saved"),
        )
        parts = mine.select(F.explode(F.concat(spread, F.array(own))).alias("p"))
        if below is not None:
            edge = mine.where(F.col("depth") == (b + 1) * band).select("k1", "k2", "anc")
            risen = below.where(F.col("at") == (b + 1) * band).join(edge, ["k1", "k2"])
            up = F.transform(
                "anc",
                lambda a, i: F.struct(
                    a.alias("key"), (i + b * band).cast("long").alias("at"), F.lit(0).cast("long").alias("child"),
                    F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
                ),
            )
            same = F.struct(
                F.struct("k1", "k2").alias("key"), "at", F.col("n_children").alias("child"),
                F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
            )
            parts = parts.union(risen.select(F.explode(F.concat(up, F.array(same))).alias("p")))
        sums = parts.groupBy("p.key.k1", "p.key.k2", "p.at").agg(
            F.sum("p.child").alias("n_children"), F.sum("p.leaves").alias("n_leaves"), F.sum("p.saved").alias("saved_tokens")
        )
        below = materialize(sums, "band")
        whole = below if b == 0 else below.where(F.col("at") > b * band)
        done = whole if done is None else done.union(whole)
    return done.drop("at")


def trie(conversations: DataFrame, turns: DataFrame, band: int = BAND) -> DataFrame:
    """All distinct prefixes of conversations, with members and sums over their subtrees.

    ``conversations``: ``conv_id, total``; ``turns``: ``conv_id, total, depth, a, b, words``. Returns ``conv_id``
    (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    rows = with_prefixes(turns, band)
    rows = materialize(rows, "prefixes")
    ended = (F.col("depth") == F.col("total")).cast("long")
    nodes = rows.groupBy("k1", "k2", "depth", "band").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(ended).alias("n_ends"),
        F.min("words").alias("words"), F.first("anc").alias("anc"),
    )
    bare = F.sum((F.col("total") == 0).cast("long"))
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), bare.alias("n_ends"))
    root = root.where("n_convs > 0").select(
        F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("band"), "conv_id", "n_convs", "n_ends", F.lit(0).cast("long").alias("words"),
        F.array().cast(f"array<{KEY}>").alias("anc"),
    )
    nodes = nodes.union(root)
    nodes = nodes.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("long"))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = materialize(nodes, "nodes")

    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = _rolled_up(nodes, deepest, band)
    ends = rows.where("depth = total").select("k1", "k2", "conv_id")
    empty = conversations.where("total = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id")
    digests = ids_digest(ends.union(empty))
    parent = F.element_at("anc", -1)
    slim = nodes.select(
        "k1", "k2", "depth", "conv_id", "n_convs", "leaf", "saved",
        F.when(F.col("depth") > 0, parent["k1"]).alias("p1"), F.when(F.col("depth") > 0, parent["k2"]).alias("p2"),
    )
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    full = slim.join(sums, ["k1", "k2"], "left").join(digests, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", "leaf").alias("n_leaves"), F.coalesce("saved_tokens", "saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
    text_col: str = "text", every: int = 20, heads: int = 4, band: int = BAND,
) -> DataFrame:
    """The trie of rebuilt conversations, see ``rebuilt_turns`` and ``trie``.

    Turns are ordered by number, null first; turns of one number by role, then by digest, so repeated rows
    follow one another and count as turns of their own. A null role or text counts as empty, a row without a
    conversation's id belongs to none and is left out, other columns are ignored. An empty table has no
    conversation, and so no root. Only digests and word counts leave the scan; long texts cost no more.
    """
    turns = turns_of(conversations, id_col, order_col, role_col, text_col)
    convs, rebuilt = rebuilt_turns(turns, every, heads)
    return trie(convs, rebuilt, band)
