"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source is wanted target / source size times. The whole part is taken as it is; the fractions are rounded
together, so that the words taken stay close to the target: two documents duel, mass moves at random between their fractions
until one of them is 0 or 1, and the other goes on with the rest. A duel keeps the sum and every document's expectation.

The duels form a reduction tree. A source's documents of about the same size are dealt out over groups of about ``GROUP``, each
group is folded in order of size (neighbours weigh about the same, so little is lost when mass moves), and what is left of each
group meets on the next level, in the end across the size classes of a source. A source that holds a third of all rows is many
groups. Repeated rows are one member of a group: a duel between equal fractions is an addition, which a partial aggregate does.
Chance comes from hashes of the ids: reruns agree. The copies go back to the rows as two bits a row, so no text is shuffled.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlake.llm.common import WORD
from firmlake.operators.ids import dense_ids
from firmlake.session import write_and_read

GROUP = 256
MOST_COPIES = 3
CYCLE = 3  # weights 1, 2, 3, 1, ...
BROADCAST_ROWS = 50_000  # a table of sources and size classes up to this size is sent to all tasks; a larger one is shuffled
NAME_BYTES = 256  # ... if no name is longer
BLOCK_BITS = 15  # rows of a bitmap of copies, as a power of two: what bitmap_construct_agg takes
BITMAP_BYTES = 32 << 20  # bitmaps of copies up to this size are sent to all tasks, for over 100 million rows; beyond that the rows are shuffled
UNIT = ["source", "size", "d", "t"]  # rows that agree in these (doc_id as d, the text's hash as t) are exchangeable

UNIFORM = "(shiftrightunsigned(xxhash64(a.d, x.d, x.t, {level}), 11) * pow(2D, -53))"
#: the next document loses the duel (or wins a whole copy) and leaves; otherwise the carried one does
NEXT_LEAVES = "if(a.p + x.p < 1, {u} * (a.p + x.p) < a.p, {u} * (2 - a.p - x.p) >= 1 - x.p)"
FOLD = """
aggregate(slice(places, 2, size(places)),
  named_struct('done', cast(array() as array<struct<i:int,copy:int>>), 'i', places[0].i, 'd', places[0].d, 't', places[0].t, 'p', places[0].p),
  (a, x) -> named_struct(
    'done', concat(a.done, array(named_struct('i', if({next}, x.i, a.i), 'copy', if(a.p + x.p < 1, 0, 1)))),
    'i', if({next}, a.i, x.i), 'd', if({next}, a.d, x.d), 't', if({next}, a.t, x.t),
    'p', if(a.p + x.p < 1, a.p + x.p, a.p + x.p - 1)))
"""


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources weigh 1, 2, 3, ... in code point order, null last. Targets share all words by weight; a target above
    ``MOST_COPIES`` times its source stops there, and the excess is shared again until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_ids(totals, [F.col("source").asc_nulls_last()], start=0, id_column="place")
    sources = write_and_read(ranked.withColumn("weight", F.col("place") % CYCLE + 1), "sources")
    limit = F.col("source_size") * MOST_COPIES
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    share, capped = (total or 0) / (weights or 1), -1
    while True:
        over = limit <= F.col("weight") * share
        fixed, free, now = sources.agg(F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if now == capped or not free:
            break
        share, capped = ((total or 0) - (fixed or 0)) / free, now
    return sources.select("source", "source_size", F.least(limit.cast("double"), F.col("weight") * F.lit(float(share))).alias("target"))


def _duels(items: DataFrame, level: int) -> DataFrame:
    """One level: the members of every group with their copy, and null for the one that goes on with fraction p."""
    u = UNIFORM.format(level=level)
    fold = FOLD.format(next=NEXT_LEAVES.format(u=u))
    groups = items.groupBy("source", "class", "part").agg(F.collect_list("item").alias("items"))
    placed = groups.withColumn("places", F.expr("array_sort(transform(items, (x, i) -> named_struct('s', -x.size, 'd', x.d, 't', x.t, 'i', i, 'p', x.p)))"))
    folded = placed.withColumn("fold", F.expr(fold))
    every = F.expr(
        "concat(transform(fold.done, x -> named_struct('item', items[x.i], 'copy', x.copy, 'p', 0D)),"
        " array(named_struct('item', items[fold.i], 'copy', cast(null as int), 'p', fold.p)))"
    )
    return folded.select("source", "class", F.explode(every).alias("one")).select("source", "class", "one.*")


def _row_copies(narrow: DataFrame, decided: DataFrame) -> DataFrame:
    """(uid, size, source_size, target, copies) of each row from the copies of its unit.

    Of the rows of one unit the first ``extra`` in order of uid get a copy more. They are numbered by the input partition that
    uid names: counts per unit and partition are added up first, so that no task gathers a unit that is repeated very often.
    """
    shared = ["source_size", "target"]
    single = decided.where("n = 1").select("uid", "size", *shared, (F.col("whole") + F.col("extra")).cast("int").alias("copies"))
    repeated = decided.where("n > 1")
    if repeated.isEmpty():
        return single
    placed = narrow.withColumn("block", F.shiftright("uid", 33))

    def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
        return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])

    counts = placed.groupBy(*UNIT, "block").agg(F.count("*").alias("rows"))
    ahead = F.sum("rows").over(Window.partitionBy(*UNIT).orderBy("block")) - F.col("rows")
    known = counts.join(repeated, same(counts, repeated, UNIT)).select(*[counts[c] for c in counts.columns], "whole", "extra", *shared)
    known = write_and_read(known.withColumn("ahead", ahead), "repeated")
    joined = placed.join(known, same(placed, known, [*UNIT, "block"])).select(*[placed[c] for c in placed.columns], "whole", "extra", "ahead", *shared)
    number = F.row_number().over(Window.partitionBy(*UNIT, "block").orderBy("uid")) + F.col("ahead")
    copies = F.col("whole") + F.when(number <= F.col("extra"), 1).otherwise(0)
    return single.union(joined.select("uid", "size", *shared, copies.cast("int").alias("copies")))


def _decided(docs: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as stored (uid, row, ...), and (uid, size, source_size, target, copies) of each; see ``mix``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    stored = write_and_read(
        rows.select(F.monotonically_increasing_id().alias("uid"), word_count(F.col("row.text")).alias("size"), F.xxhash64("row.text").alias("t"), "row"), "rows"
    )
    narrow = stored.select("uid", F.col("row.source").alias("source"), "size", F.col("row.doc_id").alias("d"), "t")
    units = write_and_read(narrow.groupBy(*UNIT).agg(F.count("*").alias("n"), F.min("uid").alias("uid")), "units")
    units = units.withColumn("class", F.floor(2 * F.log2(F.col("size") + 1)).cast("int"))
    by_class = write_and_read(units.groupBy("source", "class").agg(F.count("*").alias("documents"), F.sum(F.col("size") * F.col("n")).alias("size")), "sizes")
    targets = source_targets(by_class)
    known = by_class.join(targets, by_class["source"].eqNullSafe(targets["source"])).select(by_class["source"], "class", by_class["documents"], "source_size", "target")
    n_rows, longest, most = by_class.agg(F.count("*"), F.max(F.octet_length("source")), F.max("documents")).first()
    if n_rows <= BROADCAST_ROWS and (longest or 0) <= NAME_BYTES:
        known = F.broadcast(known)
    joined = units.join(known, units["source"].eqNullSafe(known["source"]) & (units["class"] == known["class"]))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies).cast("int")
    share = (copies - whole) * F.col("n")  # of all rows of the unit together
    items = joined.select(
        known["source"],
        known["class"],
        F.pmod(F.xxhash64("d", "size", "t", F.lit(0)), F.ceil(F.col("documents") / group)).alias("part"),
        F.struct(
            "d", "t", "size", (share - F.floor(share)).alias("p"), F.floor(share).alias("sure"), whole.alias("whole"), "n", "uid",
            "source_size", "target", "documents",
        ).alias("item"),
    )
    decided, level = [], 0
    while True:
        held = write_and_read(_duels(items, level), "duels")
        decided.append(held.where("copy is not null").select("source", "item", "copy"))
        going_on = held.where("copy is null").select("source", "class", F.col("item").withField("p", F.col("p")).alias("item"))
        level += 1
        if level > 1 and (most or 0) <= group ** (level - 1):  # the last level has met across the classes
            break
        if (most or 0) <= group**level:
            items = going_on.select("source", F.lit(-1).alias("class"), F.lit(0).alias("part"), "item")
            most = group**level
        else:
            parts = F.ceil(F.col("item.documents") / group ** (level + 1))
            items = going_on.withColumn("part", F.pmod(F.xxhash64("item.d", "item.t", F.lit(level)), parts))
    u = F.expr("shiftrightunsigned(xxhash64(item.d, item.t, -1), 11) * pow(2D, -53)")
    decided.append(going_on.select("source", "item", F.when(u < F.col("item.p"), 1).otherwise(0).alias("copy")))
    every = reduce(DataFrame.union, decided)
    extra = F.col("item.sure") + F.col("copy")
    every = every.select("source", "item.d", "item.t", "item.size", "item.n", "item.uid", "item.whole", "item.source_size", "item.target", extra.alias("extra"))
    return stored, _row_copies(narrow, every)


def mix(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) as struct ``row``, with size, source_size, target and copies (0 to 3).

    size is the number of words; null and blank texts have 0 words and may be taken or not at no cost. A null source is a source
    of its own, the last one. Null doc_ids are allowed. Rows with one doc_id, text and source are one unit, whose fractions are
    added up ahead of the duels; each of its rows gets the whole part of its share or one more, and which ones get more follows
    the order in which the rows were read. A table without words has target 0 everywhere; an empty table gives an empty result.
    Columns of any name stay inside ``row``.

    The rows are stored once; the duels carry ids, sizes and fractions only.
    """
    stored, copies = _decided(docs, group)
    return stored.select("uid", "row").join(copies, "uid").select("row", "size", "source_size", "target", "copies")


def _bitmaps(copies: DataFrame) -> DataFrame:
    """(block, low, high) from (uid, copies): the two bits of the copies of each 2 ** ``BLOCK_BITS`` neighbouring uids."""
    inside = F.col("uid").bitwiseAND((1 << BLOCK_BITS) - 1)
    placed = copies.where("copies > 0").select(F.shiftright("uid", BLOCK_BITS).alias("block"), inside.alias("at"), "copies")

    dealt = placed.repartition("block")  # in front of any partial bitmaps, of which there would be one for each task and block
    low, high = (F.when(F.col("copies").bitwiseAND(bit) > 0, F.col("at")).alias(name) for bit, name in ((1, "low"), (2, "high")))
    return dealt.select("block", low, high).groupBy("block").agg(
        *[F.expr(f"substring(bitmap_construct_agg({c}), 1, coalesce(max({c}) div 8 + 1, 0)) AS {c}") for c in ("low", "high")]
    )


def _bit(bitmap: str) -> str:
    """SQL of the bit of ``uid`` in its block's bitmap, 0 where that ends before it or is missing."""
    at = f"(uid & {(1 << BLOCK_BITS) - 1})"
    return f"(shiftright(coalesce(cast(conv(hex(substring({bitmap}, cast({at} div 8 as int) + 1, 1)), 16, 10) as int), 0), cast({at} % 8 as int)) & 1)"


def mixed(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    stored, copies = _decided(docs, group)
    copies = write_and_read(copies.select("uid", "copies"), "copies")
    bitmaps = write_and_read(_bitmaps(copies), "bitmaps")
    size = bitmaps.agg(F.sum(F.octet_length("low") + F.octet_length("high"))).first()[0] or 0
    if size <= BITMAP_BYTES:
        placed = stored.select("uid", "row", F.shiftright("uid", BLOCK_BITS).alias("block")).join(F.broadcast(bitmaps), "block")
        taken = placed.select("row", F.expr(f"{_bit('low')} + 2 * {_bit('high')}").alias("copies"))
    else:
        taken = stored.select("uid", "row").join(copies, "uid").select("row", "copies")
    return taken.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_")).select("row.*")
