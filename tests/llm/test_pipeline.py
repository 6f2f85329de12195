"""The pipeline against a plain version of its stages."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from annospark.llm import bpe
from annospark.llm.common import staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices(["th", "an", "er", "on", "it", "es"], k=rng.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 14))).capitalize() + ". "
    shared = "".join(sentence() for _ in range(8)) + "\n"
    texts = [None, "", "12 -- 34", "###"]
    for k in range(40):
        base = "".join(sentence() for _ in range(rng.randint(1, 25)))
        texts.append(base if k % 5 else base + "\n" + shared + sentence())
        if k % 4 == 0:
            texts.append(base.upper() if k % 8 else base)
        if k % 6 == 0:
            words = base.split(" ")
            words[len(words) // 2] = "changed"
            texts.append(" ".join(words))
    return [(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in enumerate(texts)]


def plain(rows):
    """Texts by id after the first four stages."""
    docs = {i: t for i, t, *_ in rows if t and re.search(r"[^\W\d_]", t)}
    low = lambda t: t.encode().lower()
    groups = defaultdict(list)
    for i, t in docs.items():
        groups[low(t)].append(i)
    docs = {max(v): docs[max(v)] for v in groups.values()}
    sets = {}
    for i, t in docs.items():
        w = low(t).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    comp = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            for j in docs:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    docs = {i: t for i, t in docs.items() if comp[i] == i}
    seen, out = set(), {}
    for i in sorted(docs):
        units = re.findall(r"[^.?\n]+[.?\n ]*|[.?\n ]+", docs[i])
        words = [low(u).split() for u in units]
        kept = ""
        for k, u in enumerate(units):
            near = words[k - 1] * (k > 0), words[k], words[k + 1] if k + 1 < len(words) else []
            key = None
            if len(words[k]) >= 8:
                key = b" ".join(words[k])
            elif words[k] and sum(map(len, near)) >= 8:
                key = b"\n".join(b" ".join(w) for w in near)
            if key is None or key not in seen:
                kept += u
            seen.add(key) if key is not None else None
        if kept.strip(" "):
            out[i] = kept
    return out


def test_stages_match_a_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        docs = staged(stage(spark, docs, ""), "stage")
        assert docs.columns == cp.COLUMNS
    expected = plain(rows)
    assert {r.doc_id: r.text for r in docs.collect()} == expected
    assert len(expected) < len(rows) - 4
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    pieces = defaultdict(list)
    for r in cp.STAGES[-1][1](spark, docs, "").collect():
        pieces[r.doc_id].append(r)
    for i, t in expected.items():
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        own = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)


def test_run_over_files_and_over_nothing(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "a")).count() > 20
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "b")).count() == 0


def test_stages_over_repeated_and_null_ids(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices(["th", "an", "er", "on", "it", "es"], k=4))
    texts = ["".join(" ".join(word() for _ in range(11)).capitalize() + ". " for _ in range(4)) for _ in range(6)]
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[1]), (None, texts[2]), (2, texts[2] + "More."), (3, texts[3].upper()), (3, texts[3]), (None, None), (4, ""), (5, texts[4] + texts[5]), (6, texts[5])]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], SCHEMA)
    kept = []
    for _, stage in cp.STAGES[:-1]:
        docs = staged(stage(spark, docs, ""), "stage")
        assert docs.columns == cp.COLUMNS
        kept.append(Counter((r.doc_id, r.text) for r in docs.collect()))
    language, exact, near, substring = kept
    assert language.total() == 10 and language[1, texts[0]] == 2
    assert exact == Counter([(1, texts[0]), (1, texts[1]), (None, texts[2]), (2, texts[2] + "More."), (3, texts[3]), (5, texts[4] + texts[5]), (6, texts[5])])
    assert near == Counter([(1, texts[0]), (1, texts[1]), (2, texts[2] + "More."), (3, texts[3]), (5, texts[4] + texts[5]), (6, texts[5])])
    assert substring == near - Counter([(6, texts[5])])
    assert cp.STAGES[-1][1](spark, docs, "").select("doc_id", "doc_tokens").distinct().count() == 5
