"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, compared by peeling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ranged, text_key, text_or_empty

#: Tables of a sketch; a digest stands in one cell of each. Cells of a fingerprint's tables, as a power of two.
TABLES, BITS = 3, 3
#: Passes of peeling, a table at a time, after which a sketch counts as failed.
PASSES = 9
#: Long lines are cut into paragraphs of so many characters.
STRETCH = 300


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's lines, long ones in stretches; empty lines don't count."""
    pieces = F.transform(
        F.split(text, "\n"),
        lambda p: F.when(F.length(p) <= STRETCH, F.array(p)).otherwise(
            F.regexp_extract_all(p, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))
        ),
    )
    full = F.filter(F.flatten(pieces), lambda p: p != "")
    return F.array_distinct(F.transform(full, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    """32 bits that tell a lone digest from several that have run together."""
    return F.xxhash64(digest, F.lit(11)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(digest: Column, table: int, width: Column, level: int) -> Column:
    """Number of the digest's cell in a table, tables standing one behind the other; other cells at each level."""
    return F.pmod(F.xxhash64(digest, F.lit(TABLES * level + table)), width) + width * table


def sketch(digests: Column) -> Column:
    """A fingerprint's cells: number of their digests, exclusive ors of the digests and of their checks."""
    width = F.lit(1 << BITS).cast("long")
    homes = F.transform(digests, lambda d: F.struct(d.alias("d"), *[_cell(d, t, width, 0).alias(f"c{t}") for t in range(TABLES)]))

    xor = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))

    def cell(mine: Column) -> Column:
        return F.struct(F.size(mine).alias("n"), xor(mine).alias("key"), xor(F.transform(mine, _check)).alias("check"))

    def table(homes: Column, t: int) -> Column:
        places = F.sequence(F.lit(t << BITS), F.lit((t + 1 << BITS) - 1))
        return F.transform(places, lambda j: F.transform(F.filter(homes, lambda h: h[f"c{t}"] == j), lambda h: h["d"]))

    # One element, so that the cells of digests are found once.
    lists = F.transform(F.array(homes), lambda h: F.concat(*[table(h, t) for t in range(TABLES)]))[0]
    return F.transform(lists, cell)


def as_text(cells: Column) -> Column:
    """A sketch as text: count, digest and check of each cell in hexadecimal digits."""
    return F.lower(F.array_join(F.transform(cells, lambda c: F.concat_ws(":", F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"]))), ","))


def _differences(pairs: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Cells of the subtracted sketches ``keys, width, cell, n, key, check``, of those that are not empty.

    Level 0 subtracts the fingerprints. Each level above has twice the cells of the one before, beginning with
    two in each table for every digest of both sides.
    """
    load = (F.size("a") + F.size("b")).cast("long")
    width = F.lit(1 << BITS).cast("long") if level == 0 else F.greatest(load, F.lit(1).cast("long")) * (1 << level)
    signed = F.concat(
        F.transform("a", lambda d: F.struct(F.lit(1).alias("n"), d.alias("d"))),
        F.transform("b", lambda d: F.struct(F.lit(-1).alias("n"), d.alias("d"))),
    )
    rows = pairs.select(*keys, width.alias("width"), F.explode(signed).alias("x")).select(*keys, "width", "x.n", "x.d")
    cells = F.array(*[_cell(F.col("d"), t, F.col("width"), level) for t in range(TABLES)])
    rows = rows.select(*keys, "width", F.explode(cells).alias("cell"), "n", F.col("d").alias("key"), _check(F.col("d")).alias("check"))
    return _summed(rows.withColumn("digest", F.lit(0).cast("long")), keys)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = rows.groupBy(*keys, "width", "cell", "digest").agg(
        F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check")
    )
    return sums.where("n != 0 OR key != 0 OR check != 0")


def _peeled(cells: DataFrame, keys: list[str], level: int) -> DataFrame:
    """The cells after all passes; what has been recovered stands in rows with ``cell`` -1, ``digest`` and its side.

    In a pass, lone digests of one table are taken out of their cells of all tables, which may leave other
    digests alone there. A digest has one cell in a table, so no pass takes a digest out twice.
    """
    for k in range(PASSES):
        table = k % TABLES
        lone = (
            (F.abs("n") == 1) & (F.col("check") == _check(F.col("key"))) & (F.col("cell") >= F.col("width") * table)
            & (F.col("cell") < F.col("width") * (table + 1))
        )
        zero = F.lit(0).cast("long")

        def as_row(cell: Column, digest: Column, n: Column, key: Column, check: Column) -> Column:
            return F.struct(cell.alias("cell"), digest.alias("digest"), n.alias("n"), key.alias("key"), check.alias("check"))

        taken = [
            as_row(_cell(F.col("key"), t, F.col("width"), level), zero, -F.col("n"), F.col("key"), F.col("check"))
            for t in range(TABLES) if t != table
        ]
        found = as_row(F.lit(-1).cast("long"), F.col("key"), F.col("n"), zero, zero)
        same = as_row(*[F.col(c) for c in ("cell", "digest", "n", "key", "check")])
        out = F.when(lone, F.array(found, *taken)).otherwise(F.array(same))
        cells = cells.select(*keys, "width", F.explode(out).alias("x")).select(*keys, "width", "x.*")
        cells = _summed(cells, keys)
    return cells


def differences(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """``keys, digest, side``: digests that only one of two lists holds, recovered from their sketches.

    ``pairs`` has the lists ``a`` and ``b`` of distinct digests and may not repeat its keys, which are not null;
    side 1 is ``a``, side -1 is ``b``. Fingerprints are subtracted first; pairs whose cells can't be peeled
    empty are tried again with larger sketches until all are. Pairs are dealt out once per attempt, and building
    and peeling then go on where they are. Equal lists give no rows, an empty frame gives none.
    """
    todo, done, level = pairs.select(*keys, F.col(a).alias("a"), F.col(b).alias("b")), [], 0
    while True:
        cells = _peeled(_differences(todo.repartition(*keys), keys, level), keys, level)
        cells = materialize(cells.select(*keys, "cell", "digest", F.col("n").alias("side")), "peeled")
        failed = cells.where("cell >= 0").select(*keys).distinct()
        if failed.isEmpty():
            done.append(cells)
            break
        failed = materialize(failed, "failed")
        done.append(cells.join(failed, keys, "left_anti"))
        todo, level = todo.join(failed, keys, "left_semi"), level + 1
    return reduce(DataFrame.union, done).select(*keys, "digest", "side")


def _linked(docs: DataFrame) -> DataFrame:
    """``id, key, before``: each distinct (id, text) once, with id, key and length of the one before it, in a ring."""
    ids = docs.groupBy("id", "key").agg(F.first("n").alias("n"))
    rows = ranged(ids, "id", "key")
    own = F.struct("id", "key", "n")
    last = rows.groupBy("part").agg(F.max(own).alias("last")).orderBy("part").collect()  # a row per partition
    ring = [(r["part"], last[k - 1]["last"]) for k, r in enumerate(last)]
    kind = rows.select(own.alias("last")).schema["last"].dataType.simpleString()
    edges = rows.sparkSession.createDataFrame(ring, f"part int, edge {kind}")
    inside = F.lag(own).over(Window.partitionBy("part").orderBy("id", "key"))
    return rows.withColumn("before", inside).join(F.broadcast(edges), "part").select(
        "id", "key", F.coalesce("before", "edge").alias("before")
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, n, head, next_digests``: every row with the next document's opening and paragraph digests.

    The opening is as long as a quarter of the row's own text, or all. Documents ascend by id (null first),
    then by a hash of the text, and the first follows the last; rows with one id and text are one document, and
    each of them gets the same. A single document is its own next. Whole texts are shuffled once.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), text_key(text_col).alias("key"))
    links = _linked(rows.select("id", "key", F.length("text").alias("n")))
    same = lambda a, b: F.col(a[0]).eqNullSafe(F.col(b[0])) & (F.col(a[1]) == F.col(b[1]))
    links = links.select(F.col("id").alias("link_id"), F.col("key").alias("link_key"), "before")
    met = rows.join(links, same(("id", "key"), ("link_id", "link_key")))
    sent = met.select(
        F.col("before.id").alias("to_id"), F.col("before.key").alias("to_key"),
        F.substring(F.col("text"), F.lit(1), F.expr("before.n div 4").cast("int")).alias("head"),
        paragraph_digests(F.col("text")).alias("next_digests"),
    )
    sent = sent.groupBy("to_id", "to_key").agg(F.first("head").alias("head"), F.first("next_digests").alias("next_digests"))
    out = rows.join(sent, same(("id", "key"), ("to_id", "to_key")))
    return out.select("id", "text", F.length("text").alias("n"), "head", "next_digests")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited form, and likeness to the edited form and to the next document.

    The last quarter of the code points of the edited text is the opening of the next document. A fingerprint
    is the sketch of a text's paragraph digests, so equal texts have equal ones; likeness is the number of
    paragraphs in both texts over that in either. Null text counts as empty; two texts without paragraphs are
    alike (1), one of them is unlike any other (0). Ids may be null or repeated, repeated rows come back with
    equal values, other columns are ignored, an empty table gives no rows.
    """
    rows = with_next(docs, id_col, text_col)
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n") - F.expr("n div 4")).cast("int"))
    rows = rows.withColumn("edited", F.concat(kept, F.col("head")))
    rows = materialize(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "id", F.col("n").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"), paragraph_digests(F.col("text")).alias("own"),
            paragraph_digests(F.col("edited")).alias("other"), F.col("next_digests").alias("next"),
        ),
        "digests",
    )
    both = F.array(*[F.struct(F.lit(k).alias("pair"), F.col("own").alias("a"), F.col(c).alias("b")) for k, c in enumerate(("other", "next"))])
    pairs = rows.select("row", F.explode(both).alias("p")).select("row", "p.pair", "p.a", "p.b")
    differing = differences(pairs, ["row", "pair"], "a", "b").groupBy(F.col("row").alias("of_row")).agg(
        *[F.sum((F.col("pair") == k).cast("long")).alias(f"d{k}") for k in (0, 1)]
    )
    met = rows.join(differing, F.col("row") == F.col("of_row"), "left")

    def likeness(list_col: str, differing: str) -> Column:
        sizes, d = F.size("own") + F.size(list_col), F.coalesce(differing, F.lit(0))
        return F.when(sizes == 0, F.lit(1.0)).otherwise((sizes - d) / (sizes + d))

    return met.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(sketch(F.col("own"))).alias("fingerprint"),
        as_text(sketch(F.col("other"))).alias("edited_fingerprint"), likeness("other", "d0").alias("near_edited"),
        likeness("next", "d1").alias("near_next"),
    )
