"""Document fingerprints: a homomorphic multiset hash of the parts of paragraphs.

Every part is hashed to a wide vector of random odd numbers between -255 and
255, and a text's fingerprint is the sum of its parts' vectors.  Sums do not
depend on order, and a paragraph is inserted or deleted by adding or subtracting
its own fingerprint.

A lane is a bigint of its own, which no text can wrap: 2**31 parts, more than an
array holds, come to less than 2**39.  While they are summed, three lanes share a
bigint for as many parts as fit.  Lanes of unrelated parts are
uncorrelated with mean zero, so the cosine of two fingerprints estimates how
much of their multisets the texts share, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import stored, text_or_empty

#: Lanes of a fingerprint, a signed bigint each.
WIDTH = 96
#: A lane is one bigint: its sums are exact modulo this power, at this place of it.
MODULUS = 1 << 64
SHIFTS = (0,)
#: While parts are summed, three lanes of bytes lie in one bigint, 21 bits apart;
#: the sums of so many parts fit there.
PACKED = (0, 21, 42)
RUN = ((1 << 21) - 1) // 255
BYTES = sum(0xFF << s for s in PACKED)
#: The start of a text up to the end of its last whole line or sentence.
HEAD = r"(?s)^(.*(?:\n|[\p{P}\p{S}] +(?=[^ ])))"
#: Paragraphs are cut at line ends and at spaces after a punctuation mark or symbol.
PARAGRAPH_END = r"\n+|(?<=[\p{P}\p{S}]) +"
#: A paragraph of more characters is cut into parts of 1 to ``PART_ATOMS`` atoms:
#: words with the white space behind them, and in runs of more than 16 characters
#: (scripts without spaces, junk) single characters.
LONG, PART_ATOMS = 32, 8
ATOM = r"(?<!\S)\S{1,16}(?!\S)\s{0,4}|\S\s{0,4}|\s{1,4}"
#: A part ends behind an atom where the hash of it and the two before it has
#: these bits 0: about every 4th word and every 8th single character.
WORD_MASK, CHARACTER_MASK = 3, 7


def paragraphs(text: Column, end: str = PARAGRAPH_END) -> Column:
    """The non-empty paragraphs of a text."""
    return F.filter(F.split(text, end), lambda p: p != "")


def parts(text: Column, end: str = PARAGRAPH_END) -> Column:
    """The paragraphs of a text, long ones cut where the content says so.

    An edit moves only the ends around it.  Without such an end within
    ``PART_ATOMS`` atoms a part ends there, so that monotonous texts have several
    parts as well.  Parts of a paragraph depend on nothing outside of it."""

    def ends(atoms: Column) -> Column:
        def end_behind(atom: Column, i: Column) -> Column:
            mask = F.when(F.length(atom) == 1, CHARACTER_MASK).otherwise(WORD_MASK)
            cut = F.xxhash64(F.get(atoms, i - 2), F.get(atoms, i - 1), atom).bitwiseAND(mask.cast("bigint")) == 0
            return F.when(cut | (i == F.size(atoms) - 1), i + 1)

        return F.filter(F.transform(atoms, end_behind), F.isnotnull)

    def cut(p: Column) -> Column:
        def between(end: Column, j: Column) -> Column:
            starts = F.sequence(F.coalesce(F.get(p["ends"], j - 1), F.lit(0)), end - 1, F.lit(PART_ATOMS))
            return F.transform(starts, lambda s: F.array_join(F.slice(p["atoms"], s + 1, F.least(F.lit(PART_ATOMS), end - s)), ""))

        return F.flatten(F.transform(p["ends"], between))

    atoms = F.transform(paragraphs(text, end), lambda p: F.when(F.length(p) > LONG, F.regexp_extract_all(p, F.lit(ATOM), F.lit(0))).otherwise(F.array(p)))
    return F.flatten(F.transform(F.transform(atoms, lambda a: F.struct(a.alias("atoms"), ends(a).alias("ends"))), cut))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two multisets of paragraphs."""
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of a multiset without the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: x - y)


def fingerprint(text: Column, width: int = WIDTH, end: str = PARAGRAPH_END) -> Column:
    """array<bigint> of ``width``, a multiple of three; all zero for a NULL or
    empty text."""
    if width % len(PACKED):
        raise ValueError(f"width {width} is no multiple of {len(PACKED)}")
    seeds = F.array(*[F.lit(i) for i in range(width // len(PACKED))])
    digests = F.transform(parts(F.coalesce(text, F.lit("")), end), lambda p: F.xxhash64(p))

    def run(all_digests: Column, start: Column) -> Column:
        """Lanes of RUN digests at most: twice the sum of their bytes, less 255 each."""
        some = F.slice(all_digests, start + 1, F.lit(RUN))
        zero = F.array_repeat(F.lit(0).cast("bigint"), width // len(PACKED))
        packed = F.aggregate(some, zero, lambda total, d: F.zip_with(total, seeds, lambda t, s: t + F.xxhash64(s, d).bitwiseAND(F.lit(BYTES))))
        less = F.size(some).cast("bigint") * 255
        return F.flatten(F.transform(packed, lambda x: F.array(*[F.shiftright(x, s).bitwiseAND(F.lit((1 << 21) - 1)) * 2 - less for s in PACKED])))

    def summed(all_digests: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(all_digests) - 1), F.lit(RUN))
        return F.aggregate(starts, F.array_repeat(F.lit(0).cast("bigint"), width), lambda total, start: add(total, run(all_digests, start)))

    return F.get(F.transform(F.array(digests), summed), F.lit(0))


def to_hex(fp: Column) -> Column:
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two fingerprints, negative ones as 0.  Equal
    fingerprints have 1, an empty text and another one 0."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    cosine = F.when(norms > 0, _dot(a, b) / norms).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def successors(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``columns`` of ``keys`` with those of the next row in their
    ascending order (NULLs first) as struct ``next``; the last row's next is the
    first.  Range partitions are ordered one by one, and only one row of each
    meets the others, so no task holds the whole order."""
    ranged = keys.select(*columns).distinct().repartitionByRange(*columns).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "order")
    row = F.struct(*columns)
    firsts = ranged.groupBy("part").agg(F.min(row).alias("first"))  # one row per partition
    parts = Window.orderBy("part")
    following = F.coalesce(F.lead("first").over(parts), F.first("first").over(parts))
    firsts = firsts.select("part", following.alias("following"))
    within = Window.partitionBy("part").orderBy(*columns)
    led = ranged.withColumn("led", F.lead(row).over(within))
    return led.join(F.broadcast(firsts), "part").select(*columns, F.coalesce("led", "following").alias("next"))


def _with_tails(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, next, text, tail, n_rows), one row per document and key of the next
    one; repeated rows are one of n_rows.  A key is the doc_id and a hash of the text."""
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    order = successors(texts.select("doc_id", "text_hash", F.length("text").alias("n_chars")), ["doc_id", "text_hash", "n_chars"])

    def key(of: str = "") -> Column:
        # Never NULL, as in ``texts``: so both sides of a join are dealt out by the same expression.
        return F.struct(F.col(f"{of}doc_id").alias("doc_id"), F.coalesce(F.col(f"{of}text_hash"), F.lit(0).cast("bigint")).alias("text_hash"))

    # Combined on the map side, so that a row that is repeated without end is one.
    texts = texts.groupBy(F.struct("doc_id", "text_hash").alias("key")).agg(F.first("text").alias("text"), F.count("*").alias("n_rows"))
    order = order.select(key().alias("of"), key("next.").alias("key"), F.floor(F.col("n_chars") / 4).cast("int").alias("cut"))
    # With all columns of ``texts``, so that both joins read one exchange of them.
    tail = F.when(F.col("n_rows") > 0, F.expr("left(text, cut)"))
    after = order.join(texts, "key").select(F.col("of").alias("key"), F.col("key").alias("next"), tail.alias("tail"))
    return texts.join(after, "key")


def _kept() -> Column:
    return F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))")


def fingerprints_of_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """As ``fingerprints_with_edits``, but with key and edited_sha256 instead of
    the edited text.

    The hash's own algebra spares the edited text: up to the last whole line or
    sentence before the cut both texts have the same parts, which are hashed once
    and count for both.  Parts become rows, and a text's lanes sums over its rows."""
    rows = _with_tails(docs, id_col, text_col).withColumn("kept", _kept())
    rows = rows.withColumn("start", F.length(F.regexp_extract("kept", HEAD, 1)))
    edited = F.concat("kept", "tail")

    def tagged(text: Column, in_text: bool, in_edited: bool) -> Column:
        tag = F.lit(int(in_text) + 2 * int(in_edited)).alias("tag")
        return F.transform(parts(text), lambda p: F.struct(F.xxhash64(p).alias("digest"), tag))

    # In runs whose sums fit a packed bigint.
    digests = F.concat(
        tagged(F.expr("left(text, start)"), True, True),
        tagged(F.expr("substring(text, start + 1)"), True, False),
        tagged(F.expr("concat(substring(kept, start + 1), tail)"), False, True),
    )
    n_chars, sha256 = F.length("text").cast("bigint"), F.sha2(edited.cast("binary"), 256)
    rows = rows.select("key", "next", "n_rows", n_chars.alias("n_chars"), sha256.alias("edited_sha256"), digests.alias("digests"))
    rows = rows.withColumn("n_runs", F.ceil(F.size("digests") / RUN))
    names = ["key", "next", "n_rows", "n_chars", "edited_sha256", "n_runs"]
    one_by_one = rows.select(*names, F.posexplode_outer("digests").alias("place", "part"))
    hashes = [F.xxhash64(F.lit(i), "part.digest").bitwiseAND(F.lit(BYTES)) for i in range(width // len(PACKED))]
    of = {"text": F.col("part.tag").bitwiseAND(F.lit(1)) > 0, "edited": F.col("part.tag").bitwiseAND(F.lit(2)) > 0}
    sums = [F.sum(F.when(has, h).otherwise(0)).alias(f"{name}{i}") for name, has in of.items() for i, h in enumerate(hashes)]
    counts = [F.sum(F.when(has, 1).otherwise(0)).cast("bigint").alias(f"n_{name}") for name, has in of.items()]
    summed = one_by_one.groupBy(*names, F.floor(F.col("place") / RUN).alias("run")).agg(*counts, *sums)

    def lanes(name: str) -> Column:
        found = [F.shiftright(f"{name}{i}", s).bitwiseAND(F.lit((1 << 21) - 1)) * 2 - F.col(f"n_{name}") * 255 for i in range(width // len(PACKED)) for s in PACKED]
        return F.array(*found)

    summed = summed.select(*names, lanes("text").alias("fingerprint"), lanes("edited").alias("edited_fingerprint"))
    summed = stored(summed, "lanes")
    # Texts of several runs are few, and long.
    runs = summed.where("n_runs > 1").groupBy(*names).agg(
        F.collect_list(F.struct("fingerprint", "edited_fingerprint")).alias("runs")  # one entry per RUN parts
    )

    def total(name: str) -> Column:
        return F.aggregate(F.col(f"runs.{name}"), F.array_repeat(F.lit(0).cast("bigint"), width), add).alias(name)

    whole = summed.where("n_runs <= 1").unionByName(runs.select(*names, total("fingerprint"), total("edited_fingerprint")))
    following = whole.select(F.col("key").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    whole = whole.join(following, "next").withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
    return whole.select("key", F.col("key.doc_id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_text, fingerprint,
    edited_fingerprint, next_fingerprint (array<bigint>).

    The edited text is the text with its last floor(n_chars / 4) code points
    replaced by the first as many (or all) of the next document's, in
    ascending doc_id (NULL first), then by a hash of the text; after the last
    document comes the first.  Repeated rows have one next document, the next
    different one; a lone document is its own.  NULL texts count as empty;
    other columns are not read; an empty table gives an empty result."""
    edited = _with_tails(docs, id_col, text_col).select("key", F.concat(_kept(), "tail").alias("edited_text"))
    found = fingerprints_of_edits(docs, id_col, text_col, width)
    columns = ["doc_id", "n_chars", "edited_text", "fingerprint", "next_fingerprint", "edited_fingerprint"]
    return edited.join(found, "key").select(*columns)
