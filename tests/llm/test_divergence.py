"""Divergence of sources against a plain count of all terms."""

import random
import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annospark.llm import divergence as d

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value int, at int, p int, part string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, s, "x", 1, 2, 3, 4, "y") for k, (t, lang, s) in enumerate(rows)], SCHEMA)


def plain(rows, least, top):
    """All rows of the result, term by term."""
    count, total, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        count[lang, source].update(terms)
        total[lang].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= least]

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        shares, q = {s: share(count[lang, s]) for s in sources}, share(total[lang])
        for s in sources:
            pairs = [(sum(f(shares[s][t], shares[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(shares[s][t], q[t]), t) for t in kept if count[lang, s][t] and shares[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def rows_of(df):
    found = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "Straße", "ÉTÉ", "été", "K", "日本", "x\x00y", "it's", "İ", "é", "😀", "tie1", "tie2", "tie3"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for _ in range(n):
        source = rng.choice(["hot", "hot", "s1", "s2", None, "é"])
        text = " ".join(rng.choice(words[: 20 if source == "hot" else 75]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "de", None]), source))
    return rows


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equals_a_plain_count(spark, least):
    rows = corpus(least, 150) + [(None, "en", "only nulls"), ("", "fr", "s1"), ("one two", "fr", "s2"), ("3 4 -- !", "it", "alone"), ("word " * 50_000, "de", "long"), ("z" * 300_000, "de", "long")]
    df = frame(spark, rows)
    assert rows_of(d.source_divergence(df.repartition(4), least)) == plain(rows, least, d.TOP)
    assert rows_of(d.source_divergence(df.unionAll(df), least, top=3)) == plain(rows + rows, least, 3)


def test_many_terms_of_one_cell_are_expanded_in_byte_order(spark):
    names = [a + b for a in "zYéa日" for b in string.ascii_lowercase]
    rows = [(" ".join(names), "en", "one")] * 2 + [("other words here", "en", "two")] * 3
    found = d.source_divergence(frame(spark, rows), least=1)
    assert rows_of(found) == plain(rows, 1, d.TOP)
    assert [r.item for r in found.filter("part = 'term' and source = 'one'").orderBy("rank").collect()] == sorted({n.translate(LOWER) for n in names}, key=str.encode)[:10]


def test_small_blocks_and_folds_give_the_same(spark, monkeypatch):
    rows = corpus(9, 200)
    want = plain(rows, 2, d.TOP)
    monkeypatch.setattr(d, "_BLOCK", 16)
    monkeypatch.setattr(d, "_HELD", 8)
    assert rows_of(d.source_divergence(frame(spark, rows), 2)) == want


def test_empty_tables_and_languages_without_kept_terms(spark):
    assert d.source_divergence(frame(spark, [])).count() == 0
    rows = [("a b", "en", "s1"), ("c", "en", "s2"), (None, None, None)]
    found = rows_of(d.source_divergence(frame(spark, rows)))
    assert found == {("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)} == plain(rows, 10, 10)


def test_shares_are_exact_beyond_longs(spark):
    big = 9 * 10**17
    row = spark.range(1).select(d.share(F.lit(big), F.lit(10**18), F.lit(5)).alias("p"), d.share(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(1)).alias("q")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (10**18 + 10) and row.q == 10**9 + 1
