"""Quality rules with cross-document line frequency (DataFrame functions only).

Base measures come from each whole text. For the line rule, lines are
normalised (lower case, digits to 0, white space folded) and hashed; per host,
the distinct documents that hold a line are counted. Lines above the host's
limit are removed wherever they stand, and a document that keeps too small a
share of its words is rejected.

Line counts are partial sums before the shuffle, so a line that stands in a
third of all documents is a few rows an executor; the join back carries one
row per distinct line of a document, and Spark splits a line's partition
when it is skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\u000b\f\r"
SYMBOLS = r"[#*$%&|<>]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    #: Percent of the words that may lie in repeated windows.
    max_repeat_percent: int = 30
    #: A line is boilerplate when more distinct documents of its host hold it than both of these allow.
    line_documents: int = 20
    line_percent: int = 1
    #: Percent of its words that a document must keep.
    min_kept_percent: int = 30


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _repeat_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Add ``out``: words in ``WINDOW``-word windows that occur twice or more in the text.

    Only texts with a repeated window are looked at closely; there, windows
    sorted by hash show the repeated ones, and their word spans are joined.
    """
    n = F.size(w)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    hashes = F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(w), i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("__h", hashes)
    df = df.withColumn("__z", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same_before = lambda e, i: (i > 0) & (F.get(F.col("__z"), F.greatest(i - 1, F.lit(0)))["h"] == e["h"])
    same_after = lambda e, i: F.coalesce(F.get(F.col("__z"), i + 1)["h"] == e["h"], F.lit(False))
    df = df.withColumn("__p", F.array_sort(F.transform(F.filter("__z", lambda e, i: same_before(e, i) | same_after(e, i)), lambda e: e["i"])))
    covered = F.aggregate(
        "__p",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).cast("long").alias("n")),
    )["n"]
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop("__h", "__z", "__p")


def base_measures(df: DataFrame, text: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of the whole text; null is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    df = df.withColumn("__w", words(F.col(text))).withColumn("__lines", lines)
    df = _repeat_words(df, "__w", "n_repeat_words")
    return df.select(
        "*",
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
    ).drop("__w", "__lines")


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent)


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACE_CHARS))), r"[0-9]+", "0"), SPACE, " ")


def _host(host: str) -> Column:
    """A null host is a host of its own, apart from an empty one."""
    c = F.col(f"`{host}`").cast("string")
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c))


def _document(key: str, text: str, host: str) -> Column:
    return F.xxhash64(_host(host), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit("")))


def frequent_lines(df: DataFrame, key: str, text: str, host: str, limits: Limits, shared: Shared) -> tuple[DataFrame, DataFrame]:
    """(distinct lines of each document, lines above their host's limit).

    The first has (host, doc, line, n, words): ``doc`` is the hash of host, key
    and text, so repeated rows are one document, ``n`` the times that the line
    stands in it and ``words`` their words in all. The second has (host, line).
    """
    rows = df.select(_host(host).alias("host"), _document(key, text, host).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    rows = rows.select("host", "doc", F.posexplode(F.split("t", "\n")).alias("at", "raw"))
    rows = rows.where(F.length(F.btrim("raw", F.lit(SPACE_CHARS))) > 0).select("host", "doc", "at", F.xxhash64(normalised(F.col("raw"))).alias("line"), F.size(words(F.col("raw"))).cast("long").alias("words"))
    once = rows.groupBy("host", "doc", "line", "at").agg(F.max("words").alias("words")) if _repeated(df, key, text, host) else rows
    lines = shared.save(once.groupBy("host", "doc", "line").agg(F.count("*").alias("n"), F.sum("words").alias("words")), "lines")
    documents = lines.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("held")).where(F.col("held") > limits.line_documents)
    over = counts.join(documents, "host").where(F.col("held") * 100 > F.col("documents") * limits.line_percent)
    return lines, shared.save(over.select("host", "line"), "frequent")


def _repeated(df: DataFrame, key: str, text: str, host: str) -> bool:
    """Whether a document stands in several rows; then a line's place in it must count once."""
    return not df.select(_document(key, text, host).alias("doc")).groupBy("doc").count().where("count > 1").isEmpty()


def apply_rules(df: DataFrame, key: str, text: str, host: str, shared: Shared, limits: Limits = Limits()) -> DataFrame:
    """(``key``, the base measures, base_failed, n_boilerplate_words, kept) for every row of ``df``.

    n_boilerplate_words counts the words of lines above their host's limit,
    wherever they stand. Null text has no words and fails; a null host is a host
    of its own; repeated rows are one document and get equal results; an empty
    table gives an empty one; other columns are not read.
    """
    lines, frequent = frequent_lines(df, key, text, host, limits, shared)
    lost = lines.join(frequent, ["host", "line"]).groupBy("doc").agg(F.sum("words").alias("n_boilerplate_words"))
    own = df.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), _document(key, text, host).alias("doc"))
    measured = base_measures(own, "__text").drop("__text").join(shared.save(lost, "lost"), "doc", "left").drop("doc")
    boiler = F.coalesce("n_boilerplate_words", F.lit(0)).cast("long")
    kept = ~base_failed(limits) & ((F.col("n_words") - boiler) * 100 >= F.col("n_words") * limits.min_kept_percent)
    return measured.select(F.col("__key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed(limits).alias("base_failed"), boiler.alias("n_boilerplate_words"), kept.alias("kept"))


def oracle(limits: Limits = Limits()) -> str:
    """DuckDB SQL of the same results over ``documents``, from the definitions."""
    ws = r"[\x20\x09-\x0D]+"
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host FROM documents),
    w AS (SELECT doc_id, t, host, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
    rep AS (SELECT doc_id, i FROM win SEMI JOIN (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1) r USING (doc_id, g)),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM rep) GROUP BY doc_id),
    ln AS (SELECT host, doc_id, regexp_replace(regexp_replace(lower(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]+', '0', 'g'), '{ws}', ' ', 'g') AS line, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS k FROM (SELECT host, doc_id, unnest(ls) AS l FROM w)),
    lw AS (SELECT host, doc_id, line, sum(k) AS k FROM ln GROUP BY host, doc_id, line),
    freq AS (SELECT host, line FROM lw GROUP BY host, line HAVING count(*) > {limits.line_documents} AND count(*) * 100 > {limits.line_percent} * (SELECT count(DISTINCT x.doc_id) FROM lw x WHERE x.host = lw.host)),
    lost AS (SELECT doc_id, sum(k) AS b FROM lw SEMI JOIN freq USING (host, line) GROUP BY doc_id),
    m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost.b, 0) AS b
          FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words) AS base_failed, CAST(b AS BIGINT) AS n_boilerplate_words,
           NOT (n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words) AND (n_words - b) * 100 >= n_words * {limits.min_kept_percent} AS kept FROM m
    """
