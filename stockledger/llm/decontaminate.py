"""Benchmark decontamination by winnowing (DataFrame functions only).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Of every ``WINDOW`` consecutive words, the least of its ``GRAM``-word hashes is a
fingerprint; a shared run of ``WINDOW`` words thus always shares one. Documents
that share a fingerprint with the benchmark are candidates. Their hits are
extended to every window position, each window is compared with the items'
windows by 128 bits of hash, and the words inside any occurrence are hit. Items shorter than a
window are one window each; for each such length that occurs, the documents'
fingerprints hold all their runs of that length.

The wide pass over the documents yields one row a document before its
shuffle. Sides are broadcast only where Spark knows from stored sizes that
they are small; otherwise the joins shuffle hashes, never texts of documents
that are not candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared

WINDOW, GRAM = 10, 5
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; empty for null. Only A-Z change case."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.length(t) == F.octet_length(t)
    low = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _SEPARATORS), "")


def runs(w: Column | str, n: int) -> Column:
    """Hash of every run of ``n`` consecutive words; empty if there are fewer."""
    w = F.col(w) if isinstance(w, str) else w
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(df: DataFrame, w: str, out: str, short: list[int]) -> DataFrame:
    """Add ``out``: the winnowed fingerprints of ``w``, with all runs of the lengths in ``short``."""
    span = WINDOW - GRAM + 1
    df = df.withColumn("__g", F.when(F.size(w) >= WINDOW, runs(w, GRAM)).otherwise(F.array().cast("array<bigint>")))
    least = F.when(F.size("__g") >= span, F.transform(F.sequence(F.lit(1), F.size("__g") - (span - 1)), lambda i: F.array_min(F.slice(F.col("__g"), i, span)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("__f", least).drop("__g")
    return df.withColumn(out, F.array_distinct(F.concat("__f", *[runs(w, n) for n in short]))).drop("__f")


def _windows(df: DataFrame, keep: list[str], w: str, lengths: list[int], whole_only: bool) -> DataFrame:
    """(keep, pos, len, h1, h2): windows of the given lengths; for items, a short one only as a whole."""

    def of_length(n: int) -> Column:
        def one(i: Column) -> Column:
            run = F.slice(F.col(w), i, n)
            return F.struct((i - 1).alias("pos"), F.lit(n).alias("len"), F.xxhash64(run).alias("h1"), F.xxhash64(F.lit("again"), F.reverse(run)).alias("h2"))

        fits = F.size(w) >= n if n == WINDOW or not whole_only else F.size(w) == n
        return F.when(fits, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), one)).otherwise(F.array())

    every = F.concat(*[of_length(n) for n in lengths])
    return df.select(*keep, F.explode(every).alias("x")).select(*keep, "x.*")


def find(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, shared: Shared) -> tuple[DataFrame, DataFrame]:
    """(documents, hits).

    documents: (``key``, doc, n_words), one row per distinct (key, text);
    ``doc`` is their hash. hits: (doc, pos, len, items): window occurrences,
    ``items`` the sorted distinct ids (as text) that have the window. Null
    texts and items have no words and never hit; null item ids count as empty.
    """
    bench = shared.save(items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0), "items")
    short = sorted(r[0] for r in bench.select(F.size("w").alias("n")).where(F.col("n") < WINDOW).distinct().collect())  # nine at most
    of_items = bench.where(F.size("w") >= WINDOW).withColumn("__none", F.lit(1))
    prints = _fingerprints(of_items, "w", "f", []).select(F.explode("f").alias("f"))
    for n in short:
        prints = prints.union(bench.where(F.size("w") == n).select(F.explode(runs("w", n)).alias("f")))
    prints = shared.save(prints.distinct().withColumn("__hit", F.lit(1)), "prints")

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("doc"), words(F.col(text)).alias("w"))
    rows = _fingerprints(rows, "w", "f", short).select("key", "doc", F.size("w").cast("long").alias("n_words"), F.explode_outer("f").alias("f"))
    seen = rows.join(prints, "f", "left").groupBy("key", "doc", "n_words").agg(F.max("__hit").alias("hit"))
    seen = shared.save(seen, "documents")
    candidates = shared.save(seen.where("hit = 1").select("doc").distinct(), "candidates")

    lengths = [*short, WINDOW]
    wanted = _windows(bench, ["item"], "w", lengths, True).groupBy("len", "h1", "h2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    wanted = shared.save(wanted, "windows")
    near = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("doc"), F.col(text).alias("t")).join(candidates, "doc", "left_semi").select("doc", words(F.col("t")).alias("w"))
    hits = _windows(near, ["doc"], "w", lengths, False).join(wanted, ["len", "h1", "h2"]).select("doc", "pos", "len", "items").dropDuplicates(["doc", "pos", "len"])
    return seen.withColumnRenamed("key", key).drop("hit"), shared.save(hits, "hits")


def report(docs: DataFrame, key: str, hits: DataFrame) -> DataFrame:
    """(``key``, doc, n_words, n_hit, n_items, items_sha256, contaminated) from ``find``'s results."""
    ahead = Window.partitionBy("doc").orderBy("pos", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("len")
    spans = hits.withColumn("before", F.coalesce(F.max(end).over(ahead), F.lit(0)))
    n_hit = spans.groupBy("doc").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("pos", "before"))).alias("n_hit"))
    found = hits.select("doc", F.explode("items").alias("item")).groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = docs.join(n_hit, "doc", "left").join(found, "doc", "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(key, "doc", "n_words", n.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n > 0).alias("contaminated"))


def oracle() -> str:
    """DuckDB SQL of the report over ``documents`` and ``benchmark``, from the definitions."""
    w = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
    WITH d AS (SELECT doc_id, {w} AS ws FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {w} AS ws FROM benchmark),
    bw AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT item, ws, least(len(ws), {WINDOW}) AS k, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i FROM b WHERE len(ws) > 0)),
    dw AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)),
    hit AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, g)),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
    its AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hit GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
    """
