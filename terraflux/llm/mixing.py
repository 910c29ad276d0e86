"""Mixing sources to target weights by a time-varying curriculum.

Targets: every source gets its share of the words by weight, capped at ``MAX_REPEATS`` times its
size, the excess reshared by weight (water filling, in closed form over sources sorted by size per weight).
Curriculum: source s is drawn at the rate target_s * (1 + ramp_s * (2t - 1)) at time t of 0..1. Its
integral is the cumulative demand of the source; a document's offset in its source, divided by the target and put
through the inverse of that integral, is the time at which it is due. The demand of all sources up to then, as a share
of the whole, is its training position, and documents are range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.llm.shared import WORD, materialise

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Ramp of the rate by weight: light sources early, heavy ones late.
RAMPS = (-0.5, 0.0, 0.5)
#: Hex digits of the order key that make a coarse and a fine bucket: offsets are summed within fine buckets, then over the fine
#: buckets of a coarse one, then over coarse ones. A source of 10^10 documents has about 150,000 in each of 65,536 fine buckets.
COARSE_DIGITS, FINE_DIGITS = 2, 4


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, weight, source_size, target, demand) of every source of ``sizes`` (source, size).

    Sources by code point, null last, weigh 1, 2, 3, repeating. The targets add up to all sizes.
    A source without words has target 0. demand, the same in each row: whole words of the targets of each weight. No rows
    give no rows. Ranks need all distinct sources, one row each, in one place.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    own = own.select("source", "source_size", ((rank - 1) % 3 + 1).cast("long").alias("weight"))
    own = own.withColumn("cap", MAX_REPEATS * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.select("*", (F.sum("source_size").over(every) - before).alias("rest"), F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("heavy"))
    own = own.withColumn("full", F.col("cap") * F.col("heavy") <= F.col("rest") * F.col("weight"))
    # sources that are not full share what the full ones leave, by weight
    level = F.first(F.when(~F.col("full"), F.struct("rest", "heavy")), ignorenulls=True).over(every)
    own = own.withColumn("level", level)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise((F.col("level.rest") * F.col("weight")).cast("double") / F.col("level.heavy"))
    own = own.select("source", "weight", "source_size", target.alias("target"))
    all_rows = Window.orderBy("weight").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    demand = [F.sum(F.when(F.col("weight") == w, F.floor("target")).otherwise(0)).over(all_rows) for w in WEIGHTS]
    return own.withColumn("demand", F.array(*demand))


def position(share: Column, ramp: Column) -> Column:
    """The time t at which the cumulative demand (1 - ramp) * t + ramp * t * t reaches ``share``."""
    slow = 1 - ramp
    bent = (-slow + F.sqrt(slow * slow + 4 * ramp * share)) / (2 * ramp)
    return F.when(ramp == 0, share).otherwise(bent)


def progress(time: Column, demand: Column, ramps: tuple[float, float, float]) -> Column:
    """Share of all sources' demand that is due up to ``time``."""
    flat = sum(demand[i] * F.lit(1.0 - r) for i, r in enumerate(ramps))
    bent = sum(demand[i] * F.lit(float(r)) for i, r in enumerate(ramps))
    return (flat * time + bent * time * time) / (flat + bent)


def mix(docs: DataFrame, ramps: tuple[float, float, float] = RAMPS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken, positions, and the columns of ``keep``.

    A source is passed over in the order of md5(doc_id); a pass takes whole documents, and the last,
    partial pass ends within one document, exactly at the whole words of the target. taken is the
    number of words over all passes, at most ``MAX_REPEATS`` times size; positions has the training
    position of each copy, 0 to 1. Reruns agree: the order depends on ids and sizes alone, and repeated rows
    share a source's words between them. Null text has size 0; null ids sort as the empty text;
    other columns are ignored; empty tables give no rows. A hot source is no single group: offsets
    are summed within buckets of the order and over two levels of bucket totals.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = materialise(docs.select(F.col("doc_id").cast("long"), "source", words(F.col("text")).alias("size"), key.alias("key"), *keep), "sizes")
    weighed = targets(sizes)
    sizes = sizes.withColumn("bucket", F.substring("key", 1, FINE_DIGITS))
    own = ["source", "bucket"]
    fine = sizes.groupBy(*own).agg(F.sum("size").alias("words")).withColumn("coarse", F.substring("bucket", 1, COARSE_DIGITS))
    coarse = fine.groupBy("source", "coarse").agg(F.sum("words").alias("words"))
    before = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = fine.withColumn("base", before(Window.partitionBy("source", "coarse").orderBy("bucket")))
    coarse = coarse.withColumn("start", before(Window.partitionBy("source").orderBy("coarse")))
    coarse = coarse.alias("a").join(weighed.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "coarse", "start", "weight", "source_size", "target", "demand")
    nested = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.coarse") == F.col("b.coarse"))
    facts = fine.alias("a").join(coarse.alias("b"), nested).select("a.source", "bucket", (F.col("base") + F.col("start")).alias("base"), "weight", "source_size", "target", "demand")
    within = Window.partitionBy(*own).orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket"))
    rows = rows.alias("a").join(facts.alias("b"), same).select("doc_id", *keep, "a.source", "size", "weight", "source_size", "target", "demand", (F.col("offset") + F.col("base")).alias("offset"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("whole", whole)
    rest = F.floor("target") - F.col("whole") * F.col("source_size") - F.col("offset")
    part = F.greatest(F.lit(0), F.least(rest, F.col("size")))
    rows = rows.withColumn("taken", (F.col("whole") * F.col("size") + part).cast("long"))
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rows = rows.withColumn("copies", copies)
    ramp = F.element_at(F.array(*[F.lit(float(r)) for r in ramps]), F.col("weight").cast("int"))
    share = lambda k: F.least(F.lit(1.0), (k * F.col("source_size") + F.col("offset")) / F.col("target"))
    places = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda k: progress(position(share(k), ramp), F.col("demand"), ramps))).otherwise(F.array().cast("array<double>"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", "taken", places.alias("positions"), *keep)


def every_copy(mixed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per copy, taken its words; a document that is not taken is one row of no words, copy and position null."""
    copies = mixed.select("doc_id", "source", "size", "source_size", "target", F.col("taken").alias("all"), F.posexplode_outer("positions").alias("copy", "position"), *keep)
    # least() would pass over the null of a document that is not taken
    words_here = F.when(F.col("copy").isNull(), F.lit(0)).otherwise(F.least(F.col("size"), F.col("all") - F.col("copy") * F.col("size"))).cast("long")
    return copies.select("doc_id", "source", "size", "source_size", "target", "copy", words_here.alias("taken"), "position", *keep)


#: A word with the white space before it.
_SPACED = r"[\x20\x09-\x0D]*" + WORD


def texts_in_order(docs: DataFrame, ramps: tuple[float, float, float] = RAMPS) -> DataFrame:
    """The mixed corpus: the rows of ``every_copy`` in training order, each with the columns of its row of ``docs``; untaken documents last.

    text is what the mix takes: the whole text of a copy, for the partial copy of a source the text up to its last taken word, for a document
    that is not taken an empty one; n_chars, where there is one, is its length. Rows are met by id, source and a hash of the text, rows that
    agree in these by their number, so ids may repeat or be null. Columns of ``docs`` with the name of one of the mix are left out.
    """
    made = ("size", "source_size", "target", "copy", "taken", "position", "_print", "_n")
    rest = [c for c in docs.columns if c not in ("doc_id", "source", *made)]
    same = ["doc_id", "source", "_print", "_n"]
    number = F.row_number().over(Window.partitionBy("doc_id", "source", "_print").orderBy("_print"))
    keyed = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("_print", F.xxhash64("text"))
    mixed = materialise(mix(keyed, ramps, ("_print",)), "mixed")
    copies = every_copy(mixed.withColumn("_n", number), ("_print", "_n")).alias("m")
    texts = keyed.withColumn("_n", number).select(*same, *rest).alias("t")
    both = copies.join(texts, [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in same])
    begun = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(_SPACED), F.lit(0)), F.lit(1), F.col("taken").cast("int")), "")
    text = F.when(F.col("copy").isNull(), F.lit("")).when(F.col("taken") < F.col("size"), begun).otherwise(F.col("text"))
    out = both.select("m.doc_id", "m.source", *rest, "size", "source_size", "target", "copy", "taken", "position").withColumn("text", text)
    if "n_chars" in rest:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("copy").isNull() | (F.col("taken") < F.col("size")), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    order = [c for c in docs.columns if c in ("doc_id", "source", *rest)]
    return out.select(*order, "size", "source_size", "target", "copy", "taken", "position").orderBy(F.col("position").asc_nulls_last(), "doc_id", "copy")


def in_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by training position; documents that are not taken are left out."""
    copies = mixed.select("doc_id", "source", "size", "taken", F.posexplode("positions").alias("copy", "position"))
    words_here = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    return copies.select("doc_id", "source", "copy", "position", words_here.alias("words")).orderBy("position", "doc_id", "copy")
