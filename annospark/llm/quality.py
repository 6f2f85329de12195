"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation learns how far to trust each."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
ROUNDS = 30
RULES = ("length", "word_length", "symbols", "lower_case", "upper_case", "dup_lines", "repeats")
#: First guesses: the share of good documents, and how likely a rule votes bad, abstains and votes good on good and bad ones.
FIRST_PRIOR = 0.8
FIRST_GOOD, FIRST_BAD = (0.02, 0.08, 0.9), (0.4, 0.1, 0.5)
#: Added to each count of a vote, so that none becomes impossible.
SMOOTHING = 0.5


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over each whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lower, n_lines.

    Words are runs of characters other than blanks and line controls; null text has none. All of it runs inside Spark's
    expressions, row by row, without a shuffle. A text of n words costs O(n log n).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, r"[^\p{Ll}]+", "")).cast("long").alias("n_lower"),
    )
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    base = base.withColumn("hashes", hashes).withColumn("n_words", F.size("words").cast("long"))
    # the hash of each window of eight words
    h = F.col("hashes")
    windows = F.when(
        F.col("n_words") > WINDOW,
        F.transform(F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
    )
    base = base.withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    base = base.withColumn("ordered", F.when(repeats, F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    o = F.col("ordered")
    same = lambda j, k: F.get(o, j)["w"].eqNullSafe(F.get(o, k)["w"])
    places = F.filter(F.transform(o, lambda x, j: F.when(((j > 0) & same(j, j - 1)) | same(j, j + 1), x["i"])), lambda i: i.isNotNull())
    base = base.withColumn("places", F.sort_array(places))
    # words under the windows that start at these places
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, i: F.struct((i + WINDOW).alias("end"), (s["n"] + F.least(F.lit(WINDOW), i + WINDOW - s["end"])).alias("n")),
        lambda s: s["n"],
    )
    return base.select(
        "doc_id",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_lower",
        F.size("lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains. Integer arithmetic, so that no rounding decides."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "length": rule(n >= 50, n < 20),
        "word_length": rule((chars >= 3 * n) & (chars <= 10 * n), (chars < 2 * n) | (chars > 15 * n)),
        "symbols": rule(100 * F.col("n_symbols") <= chars, 20 * F.col("n_symbols") > chars),
        "lower_case": rule(100 * F.col("n_lower") >= 88 * chars, 100 * F.col("n_lower") < 84 * chars),
        "upper_case": rule(10 * F.col("n_upper") <= chars, 10 * F.col("n_upper") > 4 * chars),
        "dup_lines": rule(20 * F.col("n_dup_lines") <= F.col("n_lines"), 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "repeats": rule(20 * F.col("n_repeat_words") <= n, 20 * F.col("n_repeat_words") > 3 * n),
    }


@dataclass
class RuleModel:
    """The share of good documents; for each rule, how likely it votes -1, 0 and 1 on good and on bad documents."""

    prior: float
    good: list[list[float]]
    bad: list[list[float]]

    @property
    def accuracy(self) -> dict[str, tuple[float, float]]:
        """Of each rule, when it votes: how often it is right on good and on bad documents."""
        return {k: (g[2] / (g[0] + g[2]), b[0] / (b[0] + b[2])) for k, g, b in zip(RULES, self.good, self.bad)}

    def log_odds(self, rules: dict[str, Column]) -> Column:
        found = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, g, b in zip(RULES, self.good, self.bad):
            bad, none, good = (F.lit(math.log(x / y)) for x, y in zip(g, b))
            found = found + F.when(rules[name] == -1, bad).when(rules[name] == 0, none).otherwise(good)
        return found


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> RuleModel:
    """Expectation-maximisation over the counts of vote patterns: at most 3^rules of them, whatever the number of documents.

    Expectation: a pattern's probability of being good, from the prior and what each vote says. Maximisation: the prior
    is the mean probability, and a rule's vote rates are those among the good and the bad mass. Without any document
    the first guesses stay.
    """
    model = RuleModel(FIRST_PRIOR, [list(FIRST_GOOD) for _ in RULES], [list(FIRST_BAD) for _ in RULES])
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        weight = [[math.log(x / y) for x, y in zip(g, b)] for g, b in zip(model.good, model.bad)]
        odds = math.log(model.prior / (1 - model.prior))
        p = [1 / (1 + math.exp(-(odds + sum(w[v + 1] for v, w in zip(vote, weight))))) for vote, _ in patterns]
        mass = sum(n * q for (_, n), q in zip(patterns, p))
        for j in range(len(RULES)):
            for v in (-1, 0, 1):
                good = sum(n * q for (vote, n), q in zip(patterns, p) if vote[j] == v)
                every = sum(n for vote, n in patterns if vote[j] == v)
                model.good[j][v + 1] = (good + SMOOTHING) / (mass + 3 * SMOOTHING)
                model.bad[j][v + 1] = (every - good + SMOOTHING) / (total - mass + 3 * SMOOTHING)
        model.prior = (mass + SMOOTHING) / (total + 2 * SMOOTHING)
    return model


def judge(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``counts`` (of ``features``) with base_failed, posterior (probability of being good) and kept.

    A document is kept if it does not fail the base rules and its posterior is at least ``threshold``. An empty table stays empty.
    """
    rules = votes()
    found = counts.groupBy(*[rules[k].cast("int").alias(k) for k in RULES]).count().collect()
    model = fit(sorted((tuple(r[k] for k in RULES), r["count"]) for r in found))
    posterior = 1 / (1 + F.exp(-model.log_odds(rules)))
    return counts.withColumn("base_failed", base_failed()).withColumn("posterior", posterior).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """A verdict for each row of ``docs``; repeated rows get one each, a null id stays null, null text counts as no words
    and fails the base rules. Counts are staged in the shared folder, so texts are read once."""
    return judge(staged(features(docs, id_col, text_col), "quality"), threshold)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    """The whole of it in DuckDB SQL; the expectation-maximisation rounds are a recursive table of one row."""
    r = len(RULES)
    v = ", ".join(f"v{j}" for j in range(r))
    score = " + ".join(f"w[{3 * j + 2} + v{j}]" for j in range(r))
    first = ", ".join(f"ln({g / b})" for _ in RULES for g, b in zip(FIRST_GOOD, FIRST_BAD))
    learnt = ", ".join(
        f"ln(((coalesce(sum(n * p) FILTER (v{j} = {k}), 0) + {SMOOTHING}) / (sum(n * p) + {3 * SMOOTHING})) / "
        f"((coalesce(sum(n * (1 - p)) FILTER (v{j} = {k}), 0) + {SMOOTHING}) / (sum(n * (1 - p)) + {3 * SMOOTHING})))"
        for j in range(r)
        for k in (-1, 0, 1)
    )
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
          list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
base AS (SELECT doc_id, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         len(l) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^\\p{{Ll}}]', '', 'g')) AS n_lower FROM words),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, n_words - {WINDOW - 2})) AS i FROM base WHERE n_words >= {WINDOW})),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, sum(least({WINDOW}, coalesce(i - before, {WINDOW}))) AS n_repeat_words
        FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM dup) GROUP BY doc_id),
f AS MATERIALIZED (SELECT b.* EXCLUDE (w), coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM base b LEFT JOIN rep USING (doc_id)),
v AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  CASE WHEN n_words < 20 THEN -1 WHEN n_words >= 50 THEN 1 ELSE 0 END AS v0,
  CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN -1 WHEN word_chars >= 3 * n_words AND word_chars <= 10 * n_words THEN 1 ELSE 0 END AS v1,
  CASE WHEN 20 * n_symbols > word_chars THEN -1 WHEN 100 * n_symbols <= word_chars THEN 1 ELSE 0 END AS v2,
  CASE WHEN 100 * n_lower < 84 * word_chars THEN -1 WHEN 100 * n_lower >= 88 * word_chars THEN 1 ELSE 0 END AS v3,
  CASE WHEN 10 * n_upper > 4 * word_chars THEN -1 WHEN 10 * n_upper <= word_chars THEN 1 ELSE 0 END AS v4,
  CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN -1 WHEN 20 * n_dup_lines <= n_lines THEN 1 ELSE 0 END AS v5,
  CASE WHEN 20 * n_repeat_words > 3 * n_words THEN -1 WHEN 20 * n_repeat_words <= n_words THEN 1 ELSE 0 END AS v6 FROM f),
pat AS MATERIALIZED (SELECT {v}, count(*) AS n FROM v GROUP BY ALL),
em(step, prior, w) AS (
  SELECT 0, {FIRST_PRIOR}::DOUBLE, [{first}]::DOUBLE[]
  UNION ALL
  SELECT step + 1, prior, w
  FROM (SELECT step, (sum(n * p) + {SMOOTHING}) / (sum(n) + {2 * SMOOTHING}) AS prior, [{learnt}] AS w
        FROM (SELECT step, n, {v}, 1 / (1 + exp(-(ln(prior / (1 - prior)) + {score}))) AS p FROM em, pat WHERE step < {ROUNDS}) GROUP BY step)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-(ln(prior / (1 - prior)) + {score}))) >= 0.5 AS kept
FROM v, (SELECT prior, w FROM em ORDER BY step DESC LIMIT 1)
"""


OP1_SQL = _sql()
