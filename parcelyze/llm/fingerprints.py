"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line; a long line counts as several, each cut at the first blank
after ``PIECE`` characters. A text's distinct paragraph digests go into a sketch: a
digest falls into one cell of each of three tables, and a cell holds how many
digests it got, their exclusive or, and the exclusive or of their check hashes.

The fingerprint of a text is its sketch of 24 cells, written out. Two fingerprints
subtract cell by cell, and what both texts share cancels. A cell left with a single
digest (count 1 or -1, matching check) gives it away; taking it out of its other
cells frees more, until the difference is listed (peeling). Likeness is shared / all
distinct paragraphs, from the two numbers of digests and the recovered difference.

Where a difference is too large for 24 cells, both texts get larger sketches: as many
groups of 24 cells (a power of four) as hold both texts' digests at 12 a group. They are
built and subtracted as a table, one row a cell, clustered by document, so nothing is
exchanged: a digest adds its sign and its bits to three cells, and cells are summed. The
cells of a group are then one row and peel like a fingerprint. A group that still does
not peel is tried again with four groups in its place and fresh hashes, up to
``RETRIES`` times.

Only DataFrame and SQL functions are used. NULL texts are empty; a text without
paragraphs is like another such text (1.0) and unlike any other (0.0).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import merged
from .common import materialize

PIECE = 96
SLOTS = 8                  # cells per table: 3 * 8 for a group
GROUP = 12                 # digests of both texts a group of a larger sketch is meant for
ROUNDS = 8                 # peeling rounds over the cells of a group
RETRIES = 12
TASK_DIGESTS = 250_000     # digests whose cells a task sums and peels
MOST_TASKS = 100_000       # beyond, tasks hold more
_PARAGRAPH = rf"[^\n]{{1,{PIECE}}}[^\s]*"


def digests(text: Column) -> Column:
    """Sorted distinct 64-bit digests of the paragraphs."""
    return F.array_sort(F.array_distinct(F.transform(
        F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p))))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once: the one element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit(1))


def _spread(d: Column, depth: Column) -> Column:
    """The bits that place a digest in a sketch of 4 ** depth groups."""
    return F.xxhash64(d, F.lit(7) + depth)


def _bits(x: Column, at: Column | int, mask: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, F.lit(at) if isinstance(at, int) else at).bitwiseAND(mask)


def _group(h: Column, depth: Column) -> Column:
    return _bits(h, 12, F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(2) * depth).cast("int")) - 1)


def _cells_of(h: Column) -> list:
    """The cells of a digest in its group, one a table: cell i of the 24 is bit i."""
    return [F.call_function("shiftleft", F.lit(1 << t * SLOTS).cast("long"), _bits(h, 3 * t, F.lit(SLOTS - 1).cast("long")).cast("int"))
            for t in range(3)]


def _marks(d: Column, depth: Column) -> Column:
    """The three cells of a digest in one number."""
    return _once(_spread(d, depth), lambda h: reduce(Column.bitwiseOR, _cells_of(h)))


# ------------------------------------------------------------- fingerprints
def _nothing(bit: Column) -> Column:
    return F.struct(bit.alias("bit"), F.lit(0).alias("count"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))


def _taking(c: Column, i: Column, count: Column) -> Column:
    return F.struct(c["bit"].alias("bit"), count.alias("count"), c["key"].bitwiseXOR(i["key"]).alias("key"),
                    c["check"].bitwiseXOR(i["check"]).alias("check"))


def _apart(i: Column, bit: Column) -> Column:
    """Whether a digest is not in a cell."""
    return i["marks"].bitwiseAND(bit) == 0


def sketch(d: Column) -> Column:
    """The 24 cells (bit, count, key, check) of a set of digests."""
    items = F.transform(d, lambda x: F.struct(_marks(x, F.lit(0)).alias("marks"), x.alias("key"), _check(x).alias("check")))
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(3 * SLOTS)])
    return _once(items, lambda held: F.transform(bits, lambda bit: F.aggregate(
        held, _nothing(bit), lambda c, i: F.when(_apart(i, bit), c).otherwise(_taking(c, i, c["count"] + 1)))))


def spell(cells: Column) -> Column:
    """A sketch as text: count.key.check of every cell in hexadecimal, an empty cell as '-'."""
    return F.concat_ws("-", F.transform(cells, lambda c: F.when(c["count"] == 0, F.lit("")).otherwise(F.concat(
        F.hex(c["count"].cast("long")), F.lit("."), F.hex(c["key"]), F.lit("."), F.hex(c["check"])))))


def parse(fingerprint: Column) -> Column:
    """The sketch that :func:`spell` wrote."""
    def number(parts, i):
        return F.coalesce(F.conv(F.get(parts, F.lit(i)), 16, -10).cast("long"), F.lit(0).cast("long"))

    def cell(x, i):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i)
        return _once(F.split(x, "\\."), lambda p: F.when(x == "", _nothing(bit)).otherwise(F.struct(
            bit.alias("bit"), number(p, 0).cast("int").alias("count"), number(p, 1).alias("key"), number(p, 2).alias("check"))))
    return F.transform(F.split(fingerprint, "-"), cell)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""
    return spell(sketch(digests(F.coalesce(text, F.lit("")))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _taking(x, y, x["count"] - y["count"]))


def _used(c: Column) -> Column:
    return (c["count"] != 0) | (c["key"] != 0) | (c["check"] != 0)


def peel(cells: Column, depth: Column | None = None) -> Column:
    """(left, plus, minus): how many cells of a subtracted group did not peel, and the
    digests that only the first and only the second sketch held, each sorted."""
    depth = F.lit(0) if depth is None else depth
    none = F.array().cast("array<struct<key:bigint,count:int,check:bigint>>")

    def step(s, _):
        alone = F.filter(s["left"], lambda x: (F.abs(x["count"]) == 1) & (_check(x["key"]) == x["check"]))
        # a digest may stand alone in several of its cells
        digests_found = F.array_distinct(F.transform(alone, lambda x: F.struct(
            x["key"].alias("key"), x["count"].alias("count"), x["check"].alias("check"))))

        def without(found):
            items = F.transform(found, lambda i: F.struct(
                _marks(i["key"], depth).alias("marks"), i["key"].alias("key"), i["count"].alias("count"), i["check"].alias("check")))
            return _once(items, lambda gone: F.filter(F.transform(s["left"], lambda x: F.aggregate(
                gone, x, lambda c, i: F.when(_apart(i, c["bit"]), c).otherwise(_taking(c, i, c["count"] - i["count"])))), _used))
        return _once(digests_found, lambda found: F.when(F.size(found) == 0, s).otherwise(F.struct(
            without(found).alias("left"), F.concat(s["found"], found).alias("found"))))

    def signed(s, sign):
        return F.array_sort(F.transform(F.filter(s["found"], lambda x: x["count"] == sign), lambda x: x["key"]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(F.filter(cells, _used).alias("left"), none.alias("found")),
                       step, lambda s: F.struct(F.size(s["left"]).alias("left"), signed(s, 1).alias("plus"), signed(s, -1).alias("minus")))


# ------------------------------------------------------------ larger sketches
def depth_for(digests_of_both: Column) -> Column:
    """The smallest depth, 1 at least, whose 4 ** depth groups hold so many digests."""
    need = F.greatest(F.lit(1.0), digests_of_both / F.lit(float(GROUP)))
    return F.greatest(F.lit(1), F.least(F.lit(24), F.ceil(F.log2(need) / 2 - F.lit(1e-9)).cast("int")))


def larger(pairs: DataFrame, keys: list) -> DataFrame:
    """(keys, depth, grp, left, plus, minus) from rows (keys, a, b, depth): the sketches of
    4 ** depth groups subtracted and peeled, one row a group with a difference. ``pairs``
    is clustered by the leading columns of ``keys``; no exchange follows."""
    def marks(c, sign):
        return F.transform(c, lambda d: F.struct(d.alias("d"), F.lit(sign).alias("sign")))
    one = pairs.select(*keys, "depth", F.explode(F.concat(marks(F.col("a"), 1), marks(F.col("b"), -1))).alias("m"))
    one = one.select(*keys, "depth", F.col("m.d").alias("d"), F.col("m.sign").alias("sign"),
                     _spread(F.col("m.d"), F.col("depth")).alias("h"), _check(F.col("m.d")).alias("check"))
    rows = one.select(*keys, "depth", _group(F.col("h"), F.col("depth")).alias("grp"), "sign", "d", "check",
                      F.explode(F.array(*_cells_of(F.col("h")))).alias("bit"))
    by = [*keys, "depth", "grp"]
    cell = F.struct("bit", "count", "key", "check")
    cells = rows.groupBy(*by, "bit").agg(F.sum("sign").cast("int").alias("count"), F.bit_xor("d").alias("key"),
                                         F.bit_xor("check").alias("check")).filter(_used(cell))
    # 24 cells a group at most
    groups = cells.groupBy(*by).agg(F.collect_list(cell).alias("cells"))
    return groups.withColumn("r", peel(F.col("cells"), F.col("depth"))).select(*by, "r.*")


def next_in_order(keys: DataFrame) -> DataFrame:
    """Add next_kid and next_tie to the distinct rows (id, kid, tie, ...): the next
    key in descending order of the id, NULL last; after the last comes the first.
    Keys are range-partitioned; a partition's last key meets the first of the next
    partition through a table of one row per partition."""
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    dealt = materialize(keys.distinct().repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    w = Window.partitionBy("part").orderBy(*order)
    key = F.struct("kid", "tie")
    inside = dealt.withColumn("next", F.lead(key).over(w)).withColumn("place", F.row_number().over(w))
    heads = inside.filter("place = 1").select("part", key.alias("head"))
    parts = Window.orderBy("part")                                  # one row per partition
    heads = heads.select("part", F.coalesce(
        F.lead("head").over(parts),
        F.first("head").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("over"))
    out = inside.join(heads, "part").withColumn("next", F.coalesce("next", "over"))
    return out.select(*keys.columns, F.col("next.kid").alias("next_kid"), F.col("next.tie").alias("next_tie"))


def versions(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of ``docs``: id, kid, tie, copy, n_chars, edited_sha256 and the
    digests of the text (a), of its edited text (e) and of the next document (x). The
    edit replaces the last half of the text by the first as many characters of the
    next document. Rows with one id and one text stand once in the order; ``copy``
    numbers them.

    (kid, tie) is the key of a text: its id (NULL: 0) and a hash of the text and of
    whether the id is NULL. Texts are dealt out by it once, for both joins."""
    d = docs.select(F.col(id_col).cast("long").alias("id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("kid", F.coalesce("id", F.lit(0))).withColumn("tie", F.xxhash64("text", F.col("id").isNull()))
    nxt = next_in_order(d.select("id", "kid", "tie", F.length("text").alias("n")))
    once = Window.partitionBy("kid", "tie").orderBy(F.lit(1))
    # an exchange of its own below the window, so that both readers share it
    texts = d.select("kid", "tie", "text").repartition("kid", "tie").withColumn("copy", F.row_number().over(once))
    half = F.floor(F.col("n") / 2).cast("int")
    to = nxt.select("id", "n", F.col("kid").alias("for_kid"), F.col("tie").alias("for_tie"),
                    F.col("next_kid").alias("kid"), F.col("next_tie").alias("tie"))
    given = texts.filter("copy = 1").join(to, ["kid", "tie"]).select(
        "id", "n", F.col("for_kid").alias("kid"), F.col("for_tie").alias("tie"),
        F.substring(F.col("text"), F.lit(1), half).alias("lead"), digests(F.col("text")).alias("x"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - half), F.col("lead"))
    j = texts.join(given, ["kid", "tie"]).select("id", "kid", "tie", "copy", "n", "text", edited.alias("edited"), "x")
    return j.select("id", "kid", "tie", "copy", F.col("n").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), "x")


def _taken(pairs: DataFrame, todo: DataFrame, tasks: int, most: bool) -> DataFrame:
    """(kid, tie, kind, a, b, depth): the pairs of ``todo`` with the digests that lie in the
    groups that did not peel, of every depth tried before; dealt to ``tasks`` by (kid, tie).
    ``most``: most pairs are among them, so both sides are dealt first and the join needs
    no exchange of its own; else only what the join leaves is dealt."""
    def dealt(df, now):
        return df.repartition(tasks, "kid", "tie") if now else df
    wanted = dealt(todo, most).groupBy("kid", "tie").agg(F.collect_list(F.struct("kind", "depth", "tried")).alias("wanted"))
    found = dealt(pairs, most).join(merged(wanted) if most else wanted, ["kid", "tie"]).withColumn(
        "w", F.get(F.filter("wanted", lambda w: w["kind"] == F.col("kind")), F.lit(0))).filter("w IS NOT NULL")

    def inside(c):
        return F.filter(c, lambda d: F.forall(F.col("w.tried"), lambda t: F.array_contains(
            t["bad"], _group(_spread(d, t["depth"]), t["depth"])))).alias(c)
    return dealt(found.select("kid", "tie", "kind", inside("a"), inside("b"), F.col("w.depth").alias("depth")), not most)


def differences(pairs: DataFrame) -> DataFrame:
    """(kid, tie, kind, plus, minus) from rows (kid, tie, kind, a, b): the digests that
    only a and only b hold, recovered from sketches. Fingerprints are subtracted and
    peeled first; pairs that do not peel get larger sketches, and groups of these that do
    not peel are tried again four times as large. One row per pair and peeled part
    (pairs without a difference have one with empty lists). Runs several jobs."""
    keys = ["kid", "tie", "kind"]
    first = pairs.withColumn("r", peel(subtract(sketch(F.col("a")), sketch(F.col("b")))))
    failed = F.col("r.left") > 0
    # digests are not written again: pairs that failed take theirs from ``pairs``
    first = materialize(first.select(*keys, failed.alias("failed"), F.when(~failed, F.col("r.plus")).alias("plus"),
                                     F.when(~failed, F.col("r.minus")).alias("minus"),
                                     (F.size("a") + F.size("b")).cast("long").alias("held")), "sketches")
    done = first.filter("NOT failed").select(*keys, "plus", "minus")
    todo = first.filter("failed").select(*keys, "held", depth_for(F.col("held")).alias("depth"),
                                         F.array().cast("array<struct<depth:int,bad:array<bigint>>>").alias("tried"))
    for retry in range(RETRIES):
        held = todo.agg(F.sum("held")).first()[0]
        if held is None:
            return done
        tasks = min(held // TASK_DIGESTS + 1, MOST_TASKS)
        tried = materialize(larger(_taken(pairs, todo, tasks, retry == 0), keys), "sketches")
        done = done.unionByName(tried.filter("left = 0").select(*keys, "plus", "minus"))
        bad = tried.filter("left > 0").groupBy(*keys, "depth").agg(F.collect_list("grp").alias("bad"))
        share = F.size("bad") / F.pow(F.lit(4.0), F.col("depth"))
        todo = todo.join(bad, [*keys, "depth"]).select(
            *keys, F.ceil(F.col("held") * share).alias("held"), (F.col("depth") + 1).alias("depth"),
            F.concat("tried", F.array(F.struct("depth", "bad"))).alias("tried"))
    raise RuntimeError(f"sketches did not peel after {RETRIES} retries")


def likeness(na: Column, plus: Column, minus: Column) -> Column:
    return F.when(na + minus == 0, F.lit(1.0)).otherwise((na - plus) / (na + minus))


def compare(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next for every row of ``docs``. Runs several jobs."""
    v = materialize(versions(docs, id_col, text_col), "versions")
    pairs = v.filter("copy = 1").select("kid", "tie", "a", F.explode(F.array(
        F.struct(F.lit("edited").alias("kind"), F.col("e").alias("b")),
        F.struct(F.lit("next").alias("kind"), F.col("x").alias("b")))).alias("p")).select(
        "kid", "tie", F.col("p.kind").alias("kind"), "a", F.col("p.b").alias("b"))
    d = differences(pairs)
    names = [(k, c) for k in ("edited", "next") for c in ("plus", "minus")]
    d = d.groupBy("kid", "tie").agg(*[
        F.sum(F.when(F.col("kind") == k, F.size(c))).alias(f"{k}_{c}") for k, c in names])
    na = F.size("a").cast("double")
    return v.join(d, ["kid", "tie"]).select(
        "id", "n_chars", "edited_sha256", spell(sketch(F.col("a"))).alias("fingerprint"),
        spell(sketch(F.col("e"))).alias("edited_fingerprint"),
        likeness(na, F.col("edited_plus"), F.col("edited_minus")).alias("near_edited"),
        likeness(na, F.col("next_plus"), F.col("next_minus")).alias("near_next"))
