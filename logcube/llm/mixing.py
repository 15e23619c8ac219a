"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Every source has a target number of words: its share by weight of
   ``share`` times all words, at most ``max_repeats`` times its own words; what
   that limit leaves over is shared among the others by weight (water filling).
2. The whole mix, in blocks of ``block_words``, is allotted to the sources by
   highest quotients target / (2 * blocks so far + 1); a source's blocks are
   allotted to its shards in the same way.  Quotas are integers.
3. A shard's documents stand in a seeded order and form a ring of words.  Its
   quota of blocks is dealt from the start of the ring, so a document is taken
   once a round, and in part where the last block ends within it.

Only the light (document, source, size) table is shuffled.  A source is cut
into up to ``max_shards`` shards, so that a hot source is spread over tasks.
Sources, of which there may be millions (hosts, say), are a table like any other:
their order, the filling and the seats follow from range partitions, of which
only the totals meet (``running``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import WORD, stored, text_or_empty

BLOCK_WORDS = 64
SHARD_WORDS = 100_000
MAX_SHARDS = 4096
WEIGHTS = (3, 1, 2)
#: Up to so many sources, their table is broadcast (some 50 bytes each).
BROADCAST_SOURCES = 100_000
#: Halvings of the quotient's interval: beyond the precision of a double.
HALVINGS = 80
#: Quotients that are tried in one pass over the sources, passes at most, and seats
#: per source between two quotients that are few enough to be ranked.
TRIED, PASSES, RANKED = 32, 24, 2


def apportion(weights: Column, seats: Column) -> Column:
    """Sainte-Lague seats (array<bigint>) for ``weights`` (array<double>).

    Seat i of a weight has the quotient weight / (2i - 1); the highest
    quotients win, the earlier weight on a tie.  Above a quotient q a weight
    has floor((weight / q + 1) / 2) seats, so q is found by halving, and the
    few seats left go to the highest next quotients."""

    def at(quotient: Column) -> Column:
        return F.transform(weights, lambda w: F.floor((w / quotient + 1) / 2).cast("bigint"))

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)

    top = F.array_max(weights)
    top = F.when(top > 0, top).otherwise(1.0)  # weightless rows: no seats, no division by zero
    # At 2 * top no weight has a seat; at ``low`` the largest one alone has all.
    low = top / (2 * seats + 1)
    start = F.struct(low.alias("low"), (2 * top).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        fits = total(at(middle)) <= seats
        return F.struct(F.when(fits, s["low"]).otherwise(middle).alias("low"), F.when(fits, middle).otherwise(s["high"]).alias("high"))

    quotient = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve)["high"]
    return _once(quotient, lambda q: _once(at(q), lambda counts: _with_rest(weights, seats - total(counts), counts)))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, not at every mention of it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_rest(weights: Column, left: Column, counts: Column) -> Column:
    """One more seat for each of the ``left`` highest next quotients."""
    following = F.zip_with(weights, counts, lambda w, n: -w / (2 * n + 1))
    order = F.transform(following, lambda q, i: F.struct(q.alias("q"), i.alias("i")))
    last = F.get(F.array_sort(order), left.cast("int") - 1)  # NULL if none is left
    both = F.struct(order.alias("order"), last.alias("last"))
    return _once(both, lambda b: F.zip_with(counts, b["order"], lambda n, o: n + F.when(o <= b["last"], 1).otherwise(0)))


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in ``order``, which tells all of them apart,
    and of each of ``sums`` the sum over the rows before.

    Rows are dealt into range partitions; the totals of each, one row, meet in a
    window, and within a partition the rows are added up."""
    keyed = rows.withColumn("_sums", F.struct(*[c.alias(k) for k, c in sums.items()], F.lit(1).cast("bigint").alias("rank")))
    ranged = stored(keyed.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    names = [*sums, "rank"]
    totals = ranged.groupBy("_part").agg(*[F.sum(f"_sums.{k}").alias(k) for k in names])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("_part", F.struct(*[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in names]).alias("_from"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {k: F.coalesce(F.sum(f"_sums.{k}").over(within), F.lit(0)) + F.col(f"_from.{k}") for k in names}
    return ranged.join(F.broadcast(offsets), "_part").withColumns(before).drop("_part", "_sums", "_from")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """(source, source_size) -> + ordinal, target.  Sources stand by code
    point, NULL last, and ``weights`` repeat along them.  One row per source."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = running(sizes, [F.col("source").asc_nulls_last()], {}, "sources-in-order").withColumnRenamed("rank", "ordinal")
    rows = rows.withColumns({"weight": F.get(cycle, F.col("ordinal") % len(weights)), "cap": F.col("source_size").cast("double") * max_repeats})
    # Full sources first: with the first k - 1 at their caps, the others share by weight.
    rows = rows.withColumn("full_at", F.col("cap") / F.col("weight"))
    rows = running(rows, [F.col("full_at"), F.col("ordinal")], {"full": F.col("cap"), "lighter": F.col("weight")}, "sources-filling").drop("rank")
    total = rows.agg(F.sum("source_size").cast("double").alias("size"), F.sum("weight").alias("weight")).first()
    wanted, all_weights = (total["size"] or 0.0) * share, total["weight"] or 0.0
    level = (F.lit(wanted) - F.col("full")) / (F.lit(all_weights) - F.col("lighter"))
    found = rows.withColumn("level", level).agg(F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level")))).first()[0]
    target = F.col("cap") if found is None else F.least(F.col("cap"), F.lit(found) * F.col("weight"))
    return rows.select("source", "source_size", "ordinal", target.alias("target"))


def seats_of(sources: DataFrame, blocks: int) -> DataFrame:
    """(ordinal, target) -> + seats: ``blocks`` Sainte-Lague seats for any number
    of sources.

    A few quotients at a time are tried with one sum over the sources each, until
    not many more seats than sources lie between two of them; only those are
    written out and ranked, by quotient, the earlier source on a tie."""
    totals = sources.agg(F.sum("target").alias("target"), F.count("*").alias("n"), F.max("target").alias("top")).first()
    if not blocks or not totals["target"]:
        return sources.withColumn("seats", F.lit(0).cast("bigint"))

    def at(quotient: float) -> Column:
        return F.floor((F.col("target") / F.lit(quotient) + 1) / 2).cast("bigint")

    # All seats are above ``low``, as the largest source alone has that many there; none above ``high``.
    low, high, below, above = totals["top"] / (2 * blocks + 1), 2.0 * totals["top"], None, 0
    for _ in range(PASSES):
        if below is not None and below - above <= RANKED * totals["n"] + 1000:
            break
        tried = [low * (high / low) ** (i / TRIED) for i in range(TRIED)]
        seats = list(sources.agg(*[F.sum(at(q)) for q in tried]).first())
        fits = [i for i, n in enumerate(seats) if n <= blocks]
        first = min(fits, default=TRIED)  # seats fall as quotients rise
        if first < TRIED:
            high, above = tried[first], seats[first]
        if first > 0:
            low, below = tried[first - 1], seats[first - 1]
        else:
            below = seats[0]
            break  # exactly those seats are above ``low``
    # One seat less and one more at the ends, where a quotient may be rounded to either side.
    sure = sources.withColumn("sure", F.greatest(at(high) - 1, F.lit(0).cast("bigint")))
    left = blocks - sure.agg(F.sum("sure")).first()[0]
    open_seats = sure.select("ordinal", F.explode(F.sequence(F.col("sure"), at(low) + 1)).alias("seat"), "target")
    open_seats = open_seats.select("ordinal", "seat", (F.col("target") / (2 * F.col("seat") + 1)).alias("quotient"))
    ranked = running(open_seats, [F.col("quotient").desc(), F.col("ordinal"), F.col("seat")], {}, "seats")
    won = ranked.where(F.col("rank") < left).groupBy("ordinal").agg(F.count("*").alias("won"))
    return sure.join(won, "ordinal", "left").withColumn("seats", F.col("sure") + F.coalesce("won", F.lit(0))).drop("sure", "won")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    max_repeats: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    max_shards: int = MAX_SHARDS,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    taken, text_hash (xxhash64 of the text).

    size is the number of words (NULL text: 0); taken is the number of words
    the mix takes of the document, repeats counted, at most ``max_repeats``
    times its size.  The order of documents is seeded and depends on their
    contents alone, so reruns agree; repeated rows are documents of their own.
    A table without words takes nothing; an empty table gives an empty result."""
    text = text_or_empty(text_col)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
            order.alias("place"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "sizes",
    )
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats)
    shards = F.least(F.lit(max_shards), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))).cast("int")
    sources = stored(sources.withColumn("shards", shards), "sources")
    small = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    numbered = sized.join(small.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    numbered = numbered.withColumn("shard", F.pmod(number, F.col("shards")).cast("int"))

    quotas = _quotas(numbered, sources, block_words)
    ring = Window.partitionBy("ordinal", "shard").orderBy("place", "doc_id", "size", "text_hash")
    dealt = numbered.join(quotas, ["ordinal", "shard"])
    end = F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, 0))
    dealt = dealt.withColumn("end", end)
    words = F.least(F.col("quota") * block_words, F.col("shard_size") * max_repeats)
    rounds = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(0).cast("bigint")
    part = F.least(F.col("size"), F.greatest(F.lit(0), words - rounds * F.col("shard_size") - (F.col("end") - F.col("size"))))
    taken = (rounds * F.col("size") + part).cast("bigint")
    return dealt.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "text_hash")


def _quotas(numbered: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """(ordinal, shard, shard_size, quota): blocks per shard."""
    blocks = sources.agg(F.round(F.sum("target") / block_words).cast("bigint")).first()[0] or 0
    whole = seats_of(sources.select("ordinal", "target"), blocks).select("ordinal", F.col("seats").alias("blocks"))
    shards = numbered.groupBy("ordinal", "shard").agg(F.sum("size").alias("shard_size"))
    by_source = shards.groupBy("ordinal").agg(F.sort_array(F.collect_list(F.struct("shard", "shard_size"))).alias("of"))  # at most max_shards
    by_source = by_source.join(whole, "ordinal")
    seats = apportion(F.transform("of", lambda s: s["shard_size"].cast("double")), F.col("blocks"))
    rows = by_source.withColumn("seats", seats)
    rows = rows.select("ordinal", F.posexplode("of").alias("k", "of"), "seats")
    return rows.select("ordinal", "of.shard", "of.shard_size", F.coalesce(F.get("seats", F.col("k")), F.lit(0)).alias("quota"))
