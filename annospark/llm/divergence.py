"""Divergence of sources within a language: terms are grouped into cells of equal counts, and each cell is worked out once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annospark.llm.common import partitions_for, staged, text_slices, unstage

#: Bytes of other than letters and non-ASCII characters.
_GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
LEAST_DOCUMENTS = 10
TOP = 10
#: Rows of counts that a task holds before it sends them on.
_HELD = 1 << 19
#: Counts of a block of terms over all sources of a language, at most.
_BLOCK = 1 << 20


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in a group, and documents (rows) that have it. Terms are runs of letters
    A-Z and characters beyond ASCII, A-Z lower-cased; null counts as empty. Each task folds its rows as it reads them, and sends
    what it holds before that grows large, so a hot group or term arrives as one row per task and not as one per place."""

    def folded(tables: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        return found.rename_columns(["lang", "source", "term", "n", "docs"])

    def counted(part: pa.RecordBatch) -> pa.Table:
        words = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), _GAPS)
        term = words.values.slice(words.offsets[0].as_py(), words.offsets[-1].as_py() - words.offsets[0].as_py()).dictionary_encode()
        code = term.indices.to_numpy()
        names = term.dictionary
        row = np.repeat(np.arange(part.num_rows), np.diff(words.offsets.to_numpy()))
        full = pc.not_equal(names, "").to_numpy(zero_copy_only=False)[code] if len(names) else np.zeros(0, bool)
        key, n = np.unique(row[full] * max(1, len(names)) + code[full], return_counts=True)  # a row per document and term
        at, term_at = key // max(1, len(names)), key % max(1, len(names))
        columns = {"lang": part.column("lang").take(pa.array(at)), "source": part.column("source").take(pa.array(at)), "term": names.take(pa.array(term_at)), "n": pa.array(n.astype(np.int64)), "docs": pa.array(np.ones(len(n), np.int64))}
        return folded([pa.table(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows, least = 0, 0  # rows held, and after the last fold
        for batch in batches:
            for part in text_slices(batch, limit=4 << 20):
                held.append(counted(part))
                rows += held[-1].num_rows
                if rows > 2 * least + _HELD // 4:
                    held = [folded(held)]
                    rows = least = held[0].num_rows
                if least > _HELD:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held, rows, least = [], 0, 0
        if held:
            yield from folded(held).to_batches(max_chunksize=1 << 16)

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text"))
    counts = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counts.repartition(partitions_for(docs), "lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * terms)), exact beyond longs."""
    wide = lambda c: c.cast("decimal(20,0)")
    return (F.floor(_div(wide(count + 2) * F.lit(UNIT).cast("decimal(10,0)"), total + 2 * terms)) + 1).cast("long")


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of numbers from 0 on: ``div`` has no function of its own."""
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares, at most UNIT + 1 each, so that longs hold all of it."""
    return _div((p - q) * (p - q), p + q)


def _groups(docs: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, total, lang_total, terms) of every group that occurs: kept occurrences in it and in its language, and the
    language's kept terms."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.join(own, ["lang", "source"], "left").join(lang, "lang", "left").select("lang", "source", zero("total"), zero("lang_total"), zero("terms"))


def kept_counts(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``counts`` of the terms that at least so many documents of their language have, with ``lang_n``, the language's count."""
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs")).filter(F.col("lang_docs") >= least)
    return counts.join(terms.drop("lang_docs"), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms that are commoner in it than in its language, by divergence.

    Terms of a group with the same two counts are one cell, for which the value is worked out once. Cells of equal value are merged,
    and a group's values are taken from the largest on until their terms together are ``top``; only terms of these cells are
    expanded, in UTF-8 order within a value. Both rankings keep ``top`` rows per group and task before they shuffle.
    """
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms_here")).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.select("lang", "source", "n", "lang_n", "terms_here", p.alias("p"), q.alias("q")).filter("n > 0 and p > q")
    cells = staged(cells.select("lang", "source", "n", "lang_n", "terms_here", divergence(F.col("p"), F.col("q")).alias("value")), "cells")
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms_here").alias("terms_here"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = values.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= top)
    ahead = F.coalesce(F.sum("terms_here").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = first.withColumn("ahead", ahead).filter(F.col("ahead") < top).select("lang", "source", "value")
    chosen = cells.join(wanted, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    found = kept.join(chosen, ["lang", "source", "n", "lang_n"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _block_sums(blocks: pd.DataFrame, zeros: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block's terms for each two sources; a term is a row of shares, and equal rows are worked out once."""
    base = zeros.sort_values("at")
    at, zero = base["at"].to_numpy(), base["zero"].to_numpy()
    row, terms = pd.factorize(blocks["term"])
    shares = np.repeat(zero[None, :], len(terms), axis=0)
    shares[row, np.searchsorted(at, blocks["at"].to_numpy())] = blocks["p"].to_numpy()
    shares, times = np.unique(shares, axis=0, return_counts=True)
    out = []
    for k in range(len(at) - 1):
        p, q = shares[:, k : k + 1], shares[:, k + 1 :]
        out.append((((p - q) ** 2 // (p + q)) * times[:, None]).sum(axis=0))
    lang = base["lang"].iloc[0]
    first, second = np.triu_indices(len(at), 1)
    return pd.DataFrame({"lang": lang, "a": at[first], "b": at[second], "value": np.concatenate(out) if out else np.zeros(0, np.int64)})


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every two sources of a language, with the divergence summed over all kept terms.

    Kept terms are dealt into blocks by their hash, so that one holds about ``_BLOCK`` counts (terms times the language's sources); each
    block sums all its terms for each two sources, equal rows of counts once, and sends one row per pair. The result itself has a row for each
    two sources of a language, and nothing before it has more than that per block.
    """
    marked = staged(
        groups.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).withColumn("sources", F.count("*").over(Window.partitionBy("lang"))), "sources"
    )
    zero = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    many = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("terms") * F.col("sources") / _BLOCK))
    zeros = marked.filter("terms > 0 and sources > 1").select(F.col("lang").alias("lang"), F.col("at").alias("at"), zero.alias("zero"), F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("block"))
    rows = kept.join(marked.filter("sources > 1"), ["lang", "source"])
    rows = rows.select("lang", F.pmod(F.xxhash64("term"), many).alias("block"), "term", "at", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    sums = rows.groupBy("lang", "block").cogroup(zeros.groupBy("lang", "block")).applyInPandas(_block_sums, "lang string, a int, b int, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionAll(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    one = marked.select("lang", "source", F.col("at").alias("a"))
    other = marked.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))
    pairs = one.join(other, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")).withColumn("rank", rank)


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group; see ``source_pairs`` (part ``pair``) and ``top_terms`` (``term``).

    Null text, lang and source count as empty strings, equal rows as documents of their own; ids and other columns are never read. A
    group without terms has its pairs; a language without kept terms has pairs of value 0, one of a single source none, and an
    empty table no row. Arithmetic is exact: shares by 38-digit decimals, sums of values within longs.
    """
    counts = staged(term_counts(docs, lang_col, source_col, text_col), "counts")
    kept = staged(kept_counts(counts, least), "kept")
    unstage(counts)
    groups = staged(_groups(docs, kept, lang_col, source_col), "groups")
    parts = [f(kept, groups).withColumn("part", F.lit(part)) for part, f in (("pair", source_pairs), ("term", lambda k, g: top_terms(k, g, top)))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT row_no) >= {LEAST_DOCUMENTS}),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + {UNIT}::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v) AS p, 1 + {UNIT}::HUGEINT * (k.n + 2) // (l.total + 2 * v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN l ON g.lang = l.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
