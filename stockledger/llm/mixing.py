"""Mixing sources to target weights by hash-threshold histograms.

A document's place in its source is a hash of its id and text. The tokens of a
source are summed by hash bucket; the bucket where the running sum passes the
source's budget is the only one that is counted again, in smaller buckets, down
to one hash value. What lies below that threshold is taken, what lies above is
not, and the document at the threshold is cut to what the budget leaves. No
document is sorted, a hot source is reduced to its buckets before the shuffle,
and thresholds are nested: a larger budget keeps all that a smaller one takes,
and a budget above the source's size takes whole rounds of it first.

Everything is DataFrame code; the driver holds the number of sources, the sums
of a few columns and the water level of the shares.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, number

WORD = r"[^\x20\x09-\x0D]+"
#: Hash bits in all, and those that one round of counting resolves.
BITS, STEP = 60, 10


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(key: Column, text: Column) -> Column:
    """60 bits of the md5 of id and text: the document's place in its source."""
    both = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def shares(sources: DataFrame, weights: Sequence[float], budget: float, most: float, shared: Shared) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    Sources in the order of their names' code points, null last, take the
    weights in turn. They share ``budget`` times the sum of all sizes by weight;
    no target exceeds ``most`` times its source's size, and what is over is
    shared again by weight among the others until none is above.
    """
    placed = number(sources, [F.col("source").isNull(), F.col("source")], shared, "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = shared.save(placed.withColumn("w", F.element_at(cycle, (F.col("n") % len(weights) + 1).cast("int"))), "weights")
    full = F.lit(float(most)) * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level only rises, so a source that is full stays so
        is_full = F.lit(level) * F.col("w") >= full
        held, w, n_full = weighted.agg(F.sum(F.when(is_full, F.col("source_size"))), F.sum(F.when(~is_full, F.col("w"))), F.count_if(is_full)).first()
        if not w:
            break
        new = (budget * total - most * (held or 0)) / w
        above = weighted.where(~is_full & (F.lit(new) * F.col("w") > full)).count()
        level = new
        if not above:
            break
    return weighted.withColumn("target", F.least(F.lit(level) * F.col("w"), full))


def thresholds(sized: DataFrame, budgets: DataFrame, shared: Shared) -> DataFrame:
    """``budgets(sid, rounds, rest)`` with the place where a running sum over ``sized(sid, place, size)`` passes ``rest``.

    Adds ``at`` and ``at_size`` (place and size of the documents at the
    threshold, null where ``rest`` is 0), ``left`` (what they may take) and
    ``alike`` (how many there are: more than one only for repeated rows).
    """
    rows = sized.where("size > 0")
    open_ = budgets.where("rest > 0").select("sid", F.lit(0).cast("long").alias("bucket"), F.col("rest").alias("left"))
    for bits in range(STEP, BITS + 1, STEP):
        inside = rows.withColumn("bucket", F.shiftright("place", BITS - bits + STEP)).join(open_, ["sid", "bucket"])
        if bits > STEP:  # from here on one bucket a source
            inside = shared.save(inside, "boundary")
            rows = inside.select("sid", "place", "size")
        sums = inside.groupBy("sid", "left", F.shiftright("place", BITS - bits).alias("bucket")).agg(F.sum("size").alias("tokens"), F.min("place").alias("low"), F.max("place").alias("high"))
        passing = _passing(sums, "bucket", shared)
        open_ = passing.select("sid", "bucket", "left")
        if not passing.where("low < high").take(1):
            break
    # what is left of a bucket has one place a source: it passes at one size
    final = rows.withColumn("bucket", F.shiftright("place", BITS - bits)).join(open_, ["sid", "bucket"])
    alike = final.groupBy("sid", "left", F.col("place").alias("at"), F.col("size").alias("at_size")).agg(F.sum("size").alias("tokens"), F.count("*").alias("alike"))
    found = _passing(alike, "at", shared, "at_size")
    return budgets.join(found.select("sid", "at", "at_size", "alike", "left"), "sid", "left")


def _passing(sums: DataFrame, bucket: str, shared: Shared, then: str | None = None) -> DataFrame:
    """Of ``sums(sid, left, bucket, tokens)``, at most some thousand rows a source, the row where the running sum passes ``left``."""
    order = Window.partitionBy("sid").orderBy(bucket, *([then] if then else []))
    running = sums.withColumn("upto", F.sum("tokens").over(order))
    passing = running.where("upto > left and upto - tokens <= left").withColumn("left", F.col("left") - (F.col("upto") - F.col("tokens"))).drop("upto")
    return shared.save(passing, "passing")


def mix(df: DataFrame, key: str, text: str, source: str, shared: Shared, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per row of ``df``: key, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``size`` counts the words of the text, ``target`` is the source's share in
    words (:func:`shares`), ``taken`` the words that the mix takes of the row:
    whole rounds of the source, and in the last round all of the rows below the
    source's threshold and of the one at it what the budget leaves. So the taken
    words of a source are its target rounded to a word, and a row gives at most
    ``most`` (a whole number) times its size.

    Null texts have size 0; null keys count as empty; null sources are a source
    of their own; sources without a word have target 0. Rows of one key and text
    are alike: which of them is taken makes no difference, how many is fixed.
    Other columns of ``df`` are not looked at. An empty table gives an empty one.
    """
    if most != int(most) or not 0 <= budget <= most or not weights or min(weights) <= 0:
        raise ValueError("weights above 0, most a whole number, 0 <= budget <= most")
    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").cast("string").alias("source"))
    sized = shared.save(given.select("key", "source", n_words(F.col("text")).alias("size"), place_of(F.col("key"), F.col("text")).alias("place")), "sized")
    sources = shares(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most, shared)
    words = F.least(F.round("target").cast("long"), F.lit(int(most)) * F.col("source_size"))
    whole = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    planned = sources.withColumn("words", words).withColumn("rounds", whole).withColumn("rest", F.col("words") - F.col("rounds") * F.col("source_size"))
    plan = shared.save(planned.select(F.col("n").alias("sid"), "source", "source_size", "target", "rounds", "rest"), "plan")
    named = sized.join(plan.select("sid", F.col("source").alias("__source")), sized["source"].eqNullSafe(F.col("__source"))).drop("__source")
    cut = shared.save(thresholds(named.select("sid", "place", "size"), plan, shared), "cut")
    marked = named.select("sid", "key", "size", "place").join(cut, "sid")
    below = (F.col("place") < F.col("at")) | ((F.col("place") == F.col("at")) & (F.col("size") < F.col("at_size")))
    at = (F.col("place") == F.col("at")) & (F.col("size") == F.col("at_size")) & (F.col("size") > 0)
    again = F.when(F.col("at").isNull(), 0).when(below, F.col("size")).when(at, F.least("left", "size")).otherwise(0)
    out = ("key", "source", "size", "source_size", "target")
    one = marked.where(~F.coalesce(at & (F.col("alike") > 1), F.lit(False))).select(*out, (F.col("rounds") * F.col("size") + again).alias("taken"))
    if cut.where("alike > 1").take(1):  # rows that are alike at a threshold: so many whole, one cut, the others none
        rows = number(marked.where(at & (F.col("alike") > 1)), [F.col("sid")], shared, "alike")
        first = rows.groupBy("sid").agg(F.min("n").alias("first"))
        turn = F.least("size", F.greatest(F.lit(0), F.col("left") - (F.col("n") - F.col("first")) * F.col("size")))
        one = one.union(rows.join(first, "sid").select(*out, (F.col("rounds") * F.col("size") + turn).alias("taken")))
    return one.withColumnsRenamed({"key": key, "source": source}) if source != "source" or key != "key" else one


def oracle() -> str:
    """DuckDB SQL for :func:`mix` over ``documents`` with the weights 3, 1, 2, 1.5 times the size and 2 rounds at most."""
    return r"""
        WITH d AS (SELECT row_number() OVER () AS i, doc_id, source,
                    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)) AS BIGINT) AS place FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
        r AS (SELECT *, 2.0::DOUBLE * source_size / w AS full_at, coalesce(sum(source_size) OVER lower, 0) AS held, sum(w) OVER rest AS w_rest,
                    1.5::DOUBLE * sum(source_size) OVER () AS all_words
              FROM s WINDOW lower AS (ORDER BY 2.0::DOUBLE * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                            rest AS (ORDER BY 2.0::DOUBLE * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        l AS (SELECT max((all_words - 2.0::DOUBLE * held) / w_rest) AS level FROM r),
        t AS (SELECT source, source_size, least(level * w, 2.0::DOUBLE * source_size) AS target FROM s, l),
        b AS (SELECT *, least(CAST(round(target) AS BIGINT), 2 * source_size) AS words FROM t),
        c AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS rounds FROM b),
        x AS (SELECT d.*, c.source_size, c.target, c.rounds, c.words - c.rounds * c.source_size AS rest,
                    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, size, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
        SELECT doc_id, size, source_size, target, CAST(rounds * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM x
    """
