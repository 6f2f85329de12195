"""The text operators against brute force, on small tables with nulls, ties, repeated rows and clashing column names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annospark.llm import bpe, common, exact_dedup, jaccard_join, language_id, packing, quality, substring_dedup, token_counts, token_files, toxicity

LONG = "word " * 30000
ODD = [
    None, "", " ", "\n\n", "a", "A", "Hello, World! it's <|endoftext|> ok", "日本語 テキスト。 ok%", "x" * 3000, "é́ Ǆ İ ß ΑΣ.", "a\x00b\x1cc\x85d\xa0e", "«%x» _%_ 1%2 %%", "  two  spaces\t\tx ", LONG,
    "<|startoftext|>x", "don't we'll I'M", "ẖ H̱ ẖ", "😀!! ok!!😀",
]


def docs(spark, texts, extra=True):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:  # names that operators use inside
        rows = [(*r, 1, 2, "x", 3, 4) for r in rows]
        schema += ", n long, digest int, key string, ids int, unit int"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_encoded_as_the_library_does(name):
    import public_tokenizers
    from annospark.llm import word_table

    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    table = word_table.WordTable(word_table.vocabulary(path))
    rng = random.Random(3)
    alphabet = "aAbéßµª²½ .,'!%_<|>\n\t \x1ć日"
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(3000)]
    ids, counts = table.encode(texts)
    edges = np.append(0, np.cumsum(counts))
    for text, a, b in zip(texts, edges, edges[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_round_trip(spark):
    df = docs(spark, ODD)
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(df)).collect()}
    sums = {r.doc_id: r for r in bpe.round_trip_digests(bpe.encode(df)).collect()}
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(found[i].ids) == ids and found[i].text == (text or "")
        assert sums[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert sums[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    twice = bpe.encode(df.unionAll(df).repartition(1).sortWithinPartitions("doc_id")).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in twice) == sorted((i, list(r.ids)) for i, r in found.items() for _ in "ab")
    equal_blocks = bpe.encode(df.unionAll(df)).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in equal_blocks) == sorted((i, list(r.ids)) for i, r in found.items() for _ in "ab")
    assert [(r.doc_id, list(r.ids)) for r in bpe.encode(df.filter("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long"))).collect()] == [(None, [])]
    assert bpe.encode(df.limit(0)).count() == 0
    shuffled = bpe.encode(df.repartition(3, F.rand())).collect()  # another order at each reading
    assert sorted((r.doc_id, list(r.ids)) for r in shuffled) == sorted((i, list(r.ids)) for i, r in found.items())
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text == ""


RUNS = ["a" + " " * 10**6 + "b", "a" + "\n" * 10**6 + "b", "\t" * 10**6, " \n\t" * 300_000 + "c", "." * 10**5, "x" * 10**5]


def test_long_runs_are_encoded_as_the_library_does(spark):
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(RUNS)}
    df = docs(spark, RUNS)
    for r in bpe.decode(bpe.encode(df)).collect():
        assert list(r.ids) == expected[r.doc_id] and r.text == RUNS[r.doc_id]
    pieces = defaultdict(list)
    for r in packing.pack(df).collect():
        pieces[r.doc_id].append(r)
    for i, ids in expected.items():
        assert [x for r in sorted(pieces[i], key=lambda r: r.start) for x in r.ids] == [*ids, 0]


def test_a_failed_call_leaves_no_row_without_ids(monkeypatch):
    from annospark.llm import word_table

    table = word_table.WordTable(word_table.vocabulary(bpe.BYTE_BPE))
    expected = table.encode(["one two"])[0].tolist()
    with monkeypatch.context() as m:
        m.setattr(word_table.ByteVocabulary, "encode", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.encode(["three four"])
    assert table.encode(["one two"])[0].tolist() == expected and len(table.encode(["three four"])[0]) == 2


def test_decoding_of_odd_ids(spark):
    rows = spark.createDataFrame([(1, [50256, 0, 1]), (None, [220]), (2, None), (3, []), (1, [162])], "doc_id long, ids array<int>")
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    found = sorted(((r.doc_id or 0, list(r.ids), r.text) for r in bpe.decode(rows.withColumn("piece", F.lit(1))).collect()), key=str)
    assert found == sorted(((i, ids, library.decode(ids, skip_special_tokens=False)) for i, ids in [(1, [50256, 0, 1]), (0, [220]), (2, []), (3, []), (1, [162])]), key=str)
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(rows.select("doc_id", F.array(F.lit(60_000)).alias("ids"))).collect()
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(rows.select("doc_id", F.array(F.lit(1), F.lit(None).cast("int")).alias("ids"))).collect()


def test_decoding_by_slices_of_a_task(spark):
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    arrays = [np.random.default_rng(k).integers(0, 50257, n).tolist() for k, n in enumerate((1, 0, 300_000, 5, 270_000, 140_000, 140_000, 2))]
    rows = spark.createDataFrame(list(enumerate(arrays)), "doc_id long, ids array<int>").coalesce(1)
    for found in bpe.decode(rows).collect():
        assert list(found.ids) == arrays[found.doc_id] and found.text == library.decode(arrays[found.doc_id], skip_special_tokens=False)
    spark.conf.set("spark.sql.optimizer.disableHints", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # a join that mixes rows doesn't go by unseen
        with pytest.raises(Exception, match="came apart|outside the vocabulary"):
            bpe.decode(rows.repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.disableHints")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_token_files(spark, tmp_path):
    library = Tokenizer.from_file(token_files.WORD_BPE)
    df = docs(spark, ODD).repartition(5)
    token_files.write_token_files(df, str(tmp_path / "t"), partitions=3)
    rows = {r.doc_id: r for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()}
    start = 0
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (rows[i].start, list(rows[i].ids)) == (start, ids)
        start += len(ids)
    with_null = docs(spark, ["a"]).unionAll(docs(spark, ["b"]).withColumn("doc_id", F.lit(None).cast("long")))
    token_files.write_token_files(with_null, str(tmp_path / "n"))
    assert [r.doc_id for r in token_files.read_token_files(spark, str(tmp_path / "n")).orderBy("start").collect()] == [None, 0]
    wanted = spark.createDataFrame([(3,), (7,), (7,), (None,), (99,)], "doc_id long")
    some = {r.doc_id: r for r in token_files.read_documents(spark, str(tmp_path / "t"), wanted).collect()}
    assert sorted(some) == [3, 7] and all((some[i].start, some[i].ids) == (rows[i].start, rows[i].ids) for i in some)
    twice = docs(spark, ["a", "b c"]).unionAll(docs(spark, ["d"])).unionAll(with_null)
    token_files.write_token_files(twice, str(tmp_path / "r"), partitions=1)
    found = token_files.with_ids_crc32(token_files.read_token_files(spark, str(tmp_path / "r"))).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 0, 0, 0, 1] and [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    sums = Counter(zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for t in ("a", "b c", "d", "a", "b"))
    assert Counter(r.ids_crc32 for r in found) == sums
    assert token_files.read_documents(spark, str(tmp_path / "r"), spark.createDataFrame([(0,)], "doc_id long")).count() == 3
    token_files.write_token_files(df.limit(0), str(tmp_path / "e"))
    assert token_files.read_documents(spark, str(tmp_path / "e"), wanted).count() == 0
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("values", [[0], [5], [-9, -9, 4], [0, 0, 0], list(range(1000)), [-(1 << 62), 0, 1 << 62], sorted(random.Random(1).choices(range(10**9), k=777))])
def test_elias_fano(values):
    ef = token_files.EliasFano.from_bytes(token_files.EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    if len(values) > 500:
        assert 8 * len(ef.to_bytes()) < len(values) * (3 + np.log2((values[-1] + 1) / len(values))) + 8 * 200


def test_packing(spark):
    library = Tokenizer.from_file(bpe.BYTE_BPE)
    rows = packing.pack(docs(spark, ODD), window=64).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by[i], key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == ids and [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) <= 64
    assert packing.pack(docs(spark, ODD).limit(0)).count() == 0
    twice = docs(spark, ["a b", None]).unionAll(docs(spark, ["a b"])).unionAll(docs(spark, ["c"]).withColumn("doc_id", F.lit(None).cast("long")))
    found = packing.pack(twice, window=8).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.length) for r in found) == [(-1, 2), (0, 3), (0, 3), (1, 1)]


def test_how_full_sequences_get_does_not_depend_on_the_partitions(spark, monkeypatch):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, "word " * rng.randint(1, 90)) for i in range(3000)], "doc_id long, text string")
    fills = []
    for n in (1, 150):
        rows = packing.pack(df.repartition(n), window=64)
        fills.append(rows.agg(F.sum("length") / F.count_distinct("sequence_id") / 64).first()[0])
    assert min(fills) > 0.995
    monkeypatch.setattr(packing, "BLOCK_IDS", 200)
    assert packing.pack(df.limit(50), window=64).agg(F.sum("length")).first()[0] == packing.pieces(df.limit(50), window=64).agg(F.sum(F.length("ids")) / 2).first()[0]


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(2)
    lengths = np.array([rng.randint(1, 40) for _ in range(400)])
    at, offset = packing.best_fit_decreasing(lengths, 40)
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):  # the same by looking at all windows
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            room[room.index(min(fits))] -= lengths[i]
        else:
            room.append(40 - lengths[i])
    assert at.max() + 1 == len(room) and sorted(room) == sorted(40 - np.bincount(at, lengths).astype(int))


def test_exact_dedup(spark):
    texts = ["Aa", "aA", "b", None, "", "É", "é", "b"] + [f"c{k % 7}" for k in range(60)]
    df = docs(spark, texts).unionAll(docs(spark, ["zz"]).withColumn("doc_id", F.lit(None).cast("long")))
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")].append(i)
    found = {r.doc_id: r for r in exact_dedup.exact_dedup(df.repartition(6)).collect()}
    for text, ids in groups.items():
        for i in ids:
            r = found[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
    assert found[None].kept and found[None].keep_id is None
    assert sorted(r.keep_id for r in exact_dedup.exact_dedup(docs(spark, texts), prefer="smallest").filter("kept").collect()) == sorted(min(v) for v in groups.values())
    twice = docs(spark, ["q"]).unionAll(docs(spark, ["q"]))
    assert sorted(r.kept for r in exact_dedup.exact_dedup(twice).collect()) == [False, True]
    assert exact_dedup.drop_exact_copies(df).count() == len(groups) + 1
    rows = [(1, "x", "p"), (1, "X", "q"), (1, "y", "r"), (2, "y", "s"), (None, "x", "t"), (None, "z", "u"), (None, "Z", "v"), (3, None, "w"), (4, "", "a")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, digest string").coalesce(1)
    assert sorted(exact_dedup.drop_exact_copies(odd).toPandas()["digest"]) == ["a", "q", "s", "v"]
    assert sorted(exact_dedup.drop_exact_copies(odd, prefer="smallest").toPandas()["digest"]) == ["p", "r", "u", "w"]
    for partitions in (2, 3, 40):
        groups_ = exact_dedup.merge_tree(exact_dedup.digests(df.repartition(5)), partitions).filter("n > 1").count()
        assert groups_ == sum(len(v) > 1 for v in groups.values())
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def near_texts():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [None, "", "one", "one", "one two", "one two three four", "One  two\nthree four", "is on " * 50, "is on " * 51]
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([5, 6, 8, 12, 25, 60, 200]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(texts)))
    changed = True
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(comp[i], comp[j])
            if comp[i] != low or comp[j] != low:
                comp[i] = comp[j] = low
                changed = True
    return sets, comp


@pytest.mark.parametrize("light", [None, 0, 24])
def test_near_duplicates(spark, monkeypatch, light):
    if light is not None:
        monkeypatch.setattr(jaccard_join, "boundary", lambda *a, **k: light)
        monkeypatch.setattr(jaccard_join, "BLOCK", 4)
        monkeypatch.setattr(jaccard_join, "STAR", 2)
        monkeypatch.setattr(jaccard_join, "HOT", -3)  # salts for every key
        monkeypatch.setattr(jaccard_join, "_MAX_SALT", 3)
        monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
        monkeypatch.setattr(jaccard_join, "_PIECE", 64)
    texts = near_texts()
    sets, comp = brute_components(texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs(spark, texts)).collect()}
    assert found == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, comp))}
    if light is None:
        assert jaccard_join.drop_near_duplicates(docs(spark, texts)).count() == len(set(comp))
        assert jaccard_join.near_duplicates(docs(spark, texts).limit(0)).count() == 0
        null = docs(spark, ["a b c d e f"]).withColumn("doc_id", F.lit(None).cast("long"))
        assert tuple(jaccard_join.near_duplicates(null).first()) == (None, 2, None)


def test_lists_in_small_batches(spark):
    """Heads and flags by plain loops, however the rows of a list fall into batches."""
    rng = random.Random(7)
    rows = []
    for key in range(60):
        salted = key % 10 == 0
        for doc in range(rng.choice([1, 1, 2, 2, 3, 9])):
            rows.append((key, 1000 * key + doc, 10 + doc % 3, 0, rng.randint(-5, 0), rng.randint(1, 3) if salted else 0, doc % 2))
    df = spark.createDataFrame(rows, "key long, doc_id long, n int, kind byte, rank short, salt short, index byte")
    expected = Counter()
    for key in range(60):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[4], r[1]))
        for r in own[1:]:
            expected[key, r[1], own[0][1], own[0][2], len(own) > 2 or r[5] > 0, r[6]] += 1
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in (1, 2, 3, 7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        found = Counter((r.key, r.doc_id, r.head, r.head_n, r.many, r["index"]) for r in jaccard_join.shared_lists(df).collect())
        assert found == expected, size
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert jaccard_join.shared_lists(df.limit(0)).count() == 0


def test_near_duplicates_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (3, b + " more"), (9, a + " tail"), (None, c), (None, c + " d"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("key", F.lit("x"))
    found = Counter(map(tuple, jaccard_join.near_duplicates(df).collect()))
    assert found == Counter([(5, 26, 5), (5, 26, 3), (3, 27, 3), (9, 27, 5), (None, 26, None), (None, 27, None), (7, 0, 7), (7, 0, 7)])
    kept = jaccard_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted([(5, a), (3, b + " more"), (-1, c), (7, ""), (7, "")])


def template_pages(k, n_words, own, seed=11):
    """Pages of a template, each with as many words of its own at the same places; of some of them another page has most."""
    rng = random.Random(seed)
    base, texts = [f"t{i}" for i in range(n_words)], []
    for c in range(k):
        words = list(base)
        for w in range(own if isinstance(own, int) else rng.choice(own)):
            words[5 + (n_words - 8) // 14 * w] = f"own{c // 3 if rng.random() < 0.3 else -c}x{w}"
        texts.append(" ".join(words[: n_words - rng.choice([0, 0, 7, 20])] if not isinstance(own, int) else words))
    return texts


def test_pages_of_a_template_leave_no_pairs_to_compare(spark, monkeypatch):
    """Every page shares 72 % with every other: its rarest shingles are its own, so no list of the template's is compared."""
    seen = []
    stragglers = jaccard_join.straggler_pairs
    monkeypatch.setattr(jaccard_join, "straggler_pairs", lambda rows, *a: (seen.append(rows.count()), stragglers(rows, *a))[1])
    for k in (60, 240):
        texts = [" ".join(f"own{c}x{w}" if w % 33 == 10 and w < 300 else f"t{w}" for w in range(300)) for c in range(k)]
        assert all(r.component_id == r.doc_id for r in jaccard_join.near_duplicates(docs(spark, texts)).collect())
    assert seen == [0, 0]


@pytest.mark.parametrize(("n_words", "own"), [(150, (2, 3, 4, 5)), (90, (1, 2, 3)), (300, (4, 5, 6, 7, 8))])
def test_pages_of_a_template_around_the_bound(spark, monkeypatch, n_words, own):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    texts = template_pages(90, n_words, own)
    sets, comp = brute_components(texts)
    assert 1 < len(set(comp)) < len(texts)
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs(spark, texts)).collect()}
    assert found == dict(enumerate(comp))


def test_a_linked_pair_shares_a_rarest_shingle_of_the_smaller_set():
    """Whatever the order of shingles: the smaller set's index prefix meets what the larger one lists."""
    rng = random.Random(12)
    for _ in range(3000):
        n = rng.randint(1, 60)
        m = rng.randint(n, n * 100 // 80)
        low = int(jaccard_join.needed(n, m))
        if low > n:
            continue
        both = rng.randint(low, n)
        order = list(range(n + m - both))
        rng.shuffle(order)
        small = sorted(rng.sample(order, n))
        common = set(rng.sample(small, both))
        rest = [x for x in order if x not in small][: m - both]
        large = sorted(common | set(rest))
        assert len(large) == m
        assert set(small[: jaccard_join._index_prefix(n, 80)]) & set(large[: jaccard_join._prefix(m, 80)])


def edited_copies(k, n_words, edits):
    """Copies of a text, each with words of its own at places of its own, and last the text itself."""
    rng = random.Random(k)
    base = [f"w{i}" for i in range(n_words)]
    texts = []
    for c in range(k):
        words = list(base)
        for at in rng.sample(range(0, n_words - 4, 6), edits):
            words[at] = f"own{c}x{at}"
        texts.append(" ".join(words))
    return [*texts, " ".join(base)]


def test_copies_that_link_with_their_base_alone(spark, monkeypatch):
    """The base has the largest id and 3,000 shingles; its copies link to it and not to each other. Few pairs are compared."""
    counts = []
    for k in (30, 60):
        texts = edited_copies(k, 3004, 55)
        sets, comp = brute_components(texts)
        assert set(comp) == {0} and 100 * len(sets[0] & sets[1]) < 80 * len(sets[0] | sets[1])
        seen = []
        monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *a, f=verified, **b: (seen.append(pairs.count()), f(pairs, *a, **b))[1])
        found = jaccard_join.near_duplicates(docs(spark, texts)).collect()
        assert {r.component_id for r in found} == {0}
        counts.append(sum(seen))
    assert counts[1] <= 2.5 * counts[0] and counts[1] <= 4 * 60


verified = jaccard_join.verified


def test_signatures_keep_every_pair_that_links():
    rng = random.Random(3)
    for size in (20, 300, 2500, 9000):
        base = np.unique(np.array([rng.getrandbits(64) for _ in range(size)], np.uint64))
        sets = [base]
        for share in (0.02, 0.1, 0.12, 0.3):
            sets.append(np.unique(np.concatenate([base[int(size * share) :], np.array([rng.getrandbits(64) for _ in range(int(size * share))], np.uint64)])))
        sets.append(base[: int(0.8 * size)])
        n, sig = np.array([len(s) for s in sets]), [jaccard_join.signature(s) for s in sets]
        left, right = np.triu_indices(len(sets), 1)
        ok = jaccard_join._may_link(left, right, n, sig, 80)
        for i, j, found in zip(left, right, ok):
            both = len(np.intersect1d(sets[i], sets[j]))
            jaccard = both / (n[i] + n[j] - both)
            assert found or jaccard < 0.8
            assert not found or jaccard > 0.7 or size < 100


def test_boundary_follows_cost():
    assert jaccard_join.boundary({n: 100 for n in range(1, 31)}) > jaccard_join.boundary({n: 100 for n in range(1, 31)}, scan_cost=1)
    assert jaccard_join.boundary({}) == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    assert {r.comp for r in jaccard_join.components(links).filter("v <= 40").collect()} == {0}
    assert jaccard_join.components(links.limit(0)).count() == 0


def test_substring_dedup(spark):
    passage = "The quick brown fox jumps over the lazy dog near here. Short one. Then another long sentence follows with more than eight words in it."
    texts = ["Intro of one. " + passage + " End of one.", None, "", "Different start? " + passage.upper() + "\nTail.", passage, "Short one. Nothing else.", "Short one. Nothing else.", "é " * 9 + ". " + "é " * 9 + "."]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs(spark, texts)).collect()}
    assert found[0].text == texts[0] and found[1].text is None and found[2].text == ""
    assert "QUICK" not in found[3].text and "SHORT ONE" not in found[3].text and "Different start" in found[3].text and "Tail." in found[3].text
    for i in (3, 7):
        kept, last = "", 0
        for span in found[i].removed:
            kept, last = kept + texts[i][last : span.start], span.end
        assert kept + texts[i][last:] == found[i].text and found[i].removed
    assert found[5].text == found[6].text == texts[5]  # too short to compare
    assert found[0].key == "x"
    assert substring_dedup.substring_dedup(docs(spark, texts).limit(0)).count() == 0


def test_substring_dedup_of_repeated_and_null_ids(spark):
    one, two = ("Here stands sentence number %s with more than eight words in it. " % k for k in ("one", "two"))
    rows = [(5, one), (5, one + "Own words here. "), (None, one + two), (None, two), (3, two), (7, None), (7, None), (9, "word " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__units": F.lit(1), "units": F.lit(2), "first_doc": F.lit("z")}).drop("__units").coalesce(1)
    found = substring_dedup.substring_dedup(df, passages=False)
    assert found.columns == [*df.columns, "removed"]
    got = Counter((r.doc_id, r.text) for r in found.collect())
    assert got == Counter([(5, one), (5, "Own words here. "), (None, ""), (None, ""), (3, two), (7, None), (7, None), (9, "word " * 200_000)])
    assert substring_dedup.substring_dedup(df).filter("doc_id = 9").first().text == "word " * substring_dedup.RUN


def test_substring_dedup_of_lines_and_paragraphs(spark):
    lines = ["All rights reserved", "own %d", "Home | News | About", ""]
    texts = ["\n".join(line % i if "%" in line else line for line in lines) + f"Tail {i}" for i in range(3)]
    found = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs(spark, texts), min_words=1, passages=False, unit="line").collect()}
    assert found == {0: texts[0], 1: "own 1\nTail 1", 2: "own 2\nTail 2"}
    block = "first line of a block\nsecond line of that block"
    texts = [f"Head\n\n{block}\n \n\nEnd.", f"{block}\nand more\n\n{block.upper()}\n\nLast", block]
    found = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in substring_dedup.substring_dedup(docs(spark, texts), passages=False, unit="paragraph").collect()}
    a = len(block) + len("\nand more\n\n")
    assert found[0] == (texts[0], []) and found[1] == (texts[1][:a] + "Last", [(a, a + len(block) + 2)]) and found[2] == ("", [(0, len(block))])
    for name, pattern in substring_dedup.UNITS.items():
        import re

        for text in [t.encode() for t in ODD if t] + [b"\n\na\n\n\n b\n", b" \n \n", b"a\n\n"]:
            assert b"".join(re.findall(pattern, text)) == text, name


def brute_levels(texts, levels, least):
    """Texts without what stands earlier as a paragraph, line or sentence, and the spans that go."""
    import re

    found = []
    for rank, text in enumerate(texts):
        for level, name in enumerate(levels):
            at, units = 0, []
            for raw in re.findall(substring_dedup.UNITS[name].decode(), text, re.ASCII):
                words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), raw))
                units.append((at, at + len(raw), at + len(raw) - len(raw.lstrip(" \t\n\r\v\f")), words))
                at += len(raw)
            for k, (a, b, place, words) in enumerate(units):
                near = [units[j][3] if 0 <= j < len(units) else [] for j in (k - 1, k, k + 1)]
                if len(words) >= least:
                    found.append((" ".join(words), rank, place, level, a, b))
                elif words and sum(map(len, near)) >= least:
                    found.append(("\n".join(map(" ".join, near)), rank, place, level, a, b))
    earliest, marks, seen = {}, [set() for _ in texts], set()
    for key, rank, place, level, a, b in sorted(found):
        earliest.setdefault(key, (rank, place))
        if (key, rank, place) not in seen and earliest[key] != (rank, place):
            marks[rank] |= set(range(a, b))
        seen.add((key, rank, place))
    return ["".join(c for i, c in enumerate(t) if i not in m) for t, m in zip(texts, marks)], marks


def test_substring_dedup_of_several_units_together(spark):
    rng = random.Random(7)
    texts = ["", "One line of words\n\nOne line of words\nand more. and more.", "and more.", "One line of words", "Own. One  LINE of words \n \nOwn"]
    for _ in range(150):
        texts.append("".join(rng.choice(["aa ", "Bb ", "é ", "cc. ", "dd? ", "e\n", "\n", "\n \n", " ", "\t", "\v"]) for _ in range(rng.randint(1, 24))))
    for least in (2, 4):
        rows = substring_dedup.substring_dedup(docs(spark, [*texts, None]), min_words=least, passages=False, unit=substring_dedup.LEVELS).collect()
        found = {r.doc_id: r for r in rows}
        kept, marks = brute_levels(texts, substring_dedup.LEVELS, least)
        assert [found[i].text for i in range(len(texts))] == kept and sum(map(len, marks)) > 100
        assert all({i for s in found[k].removed for i in range(s.start, s.end)} == m for k, m in enumerate(marks))
        assert found[len(texts)].text is None and found[len(texts)].removed == []
        assert all(a.end < b.start for r in rows for a, b in zip(r.removed, r.removed[1:]))
    # a line of three short sentences repeats at both its ends, which the sentences with their neighbours do not
    line = "Short one. Nothing else. All rights of it reserved"
    rows = substring_dedup.substring_dedup(docs(spark, [f"Head\n{line}\nTail", f"Others before\n{line}\nbehind"]), passages=False, unit=substring_dedup.LEVELS).collect()
    assert {r.doc_id: r.text for r in rows}[1] == "Others before\nbehind"


def test_substring_dedup_of_passages(spark):
    words = [f"w{k}x" for k in range(400)]
    mid = " ".join(words[:60])
    lines = "\n".join(" ".join(words[100 + k : 102 + k]) for k in range(0, 60, 2))
    han = "".join(chr(0x4E00 + 37 * k) for k in range(120))
    texts = [
        f"Some start {mid} and an end of it.", f"Another beginning goes {mid} with some other words behind.",
        f"Menu\n{lines}\nEnd", f"Other head\n{lines}\nOther tail",
        f"甲乙{han}丙丁", f"子丑寅{han}卯辰巳", "word " * 3000,
    ]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs(spark, texts)).collect()}
    assert all(found[i].text == texts[i] for i in (0, 2, 4))
    for i, passage, own in ((1, mid.split(), ["Another beginning goes", "with some other words behind."]), (3, lines.split(), ["Other head", "Other tail"]), (5, list(han), ["子丑寅", "卯辰巳"])):
        edge = substring_dedup.POINT_WINDOW if i == 5 else substring_dedup.WINDOW + 2  # a line of two words
        assert sum(w in found[i].text for w in passage) < 2 * edge and not any(w in found[i].text for w in passage[edge:-edge])
        assert all(o in found[i].text for o in own)
        (span,) = found[i].removed
        assert texts[i][: span.start] + texts[i][span.end :] == found[i].text
    assert found[6].text == "word " * substring_dedup.RUN
    units = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs(spark, texts), passages=False).collect()}
    assert all(units[i] == texts[i] for i in (1, 3, 5))


def brute_segmentation(word, scores, longest):
    """(tokens, pieces used) of the best path, longest pieces first among equals."""
    word = token_counts.MARK + word
    best = [(0.0, 0, 0)]
    for j in range(1, len(word) + 1):
        size = len(word[j - 1].encode())
        options = [(best[i][0] + scores[word[i:j]], -best[i][1] - 1, -i, word[i:j]) for i in range(max(0, j - longest), j) if word[i:j] in scores]
        options.append((best[j - 1][0] + token_counts.BYTE_SCORE * size, -best[j - 1][1] - size, -j, None))
        value, n, _, piece = max(options, key=lambda o: o[:3])
        best.append((value, -n, (j - len(piece or "x"), piece)))
    used, at = [], len(word)
    while at:
        at, piece = best[at][2]
        used.append(piece)
    return best[-1][1], [p for p in used if p]


def test_token_counts(spark, monkeypatch):
    pieces = token_counts.vocabulary()
    longest = max(map(len, pieces))
    df = docs(spark, ODD)
    words = Counter(w.decode() for t in ODD for w in (t or "").encode().split())
    assert {r.word.decode(): r.n for r in token_counts.word_counts(df).withColumn("word", F.col("word")).collect()} == dict(words)
    scores = token_counts.rank_scores()
    for _ in range(2):  # expectation and maximisation by plain loops
        uses = Counter()
        for w, n in words.items():
            for p in brute_segmentation(w, dict(zip(pieces, scores)), longest)[1]:
                uses[p] += n
        total = np.array([uses[p] for p in pieces]) + token_counts.SMOOTHING
        scores = np.log(total / total.sum())
    found = token_counts.estimate_scores(df)
    assert np.allclose(found, scores)
    assert np.allclose(token_counts.estimate_scores(df.limit(0)), token_counts.rank_scores())
    by_piece = dict(zip(pieces, found))
    for limit in (4, token_counts.MAX_TRIE):  # words one by one, and in the trie
        segment = token_counts.Segmenter(found)
        monkeypatch.setattr(token_counts, "MAX_TRIE", limit)
        expected = [brute_segmentation(w, by_piece, longest) for w in words]
        assert segment.count(list(words)).tolist() == [n for n, _ in expected]
        uses = Counter(p for (_, used), n in zip(expected, words.values()) for p in used for _ in range(n))
        assert segment.uses(list(words), np.array(list(words.values()), float)).tolist() == [uses[p] for p in pieces]
    rows = {r.doc_id: r for r in token_counts.token_counts(df, found).collect()}
    for i, text in enumerate(ODD):
        own = Counter(w.decode() for w in (text or "").encode().split())
        assert (rows[i].n_words, rows[i].n_tokens) == (own.total(), sum(n * brute_segmentation(w, by_piece, longest)[0] for w, n in own.items()))
    assert token_counts.token_counts(df.limit(0), found).count() == 0


def test_a_word_of_a_million_characters_is_counted_in_seconds():
    import time

    rng = random.Random(1)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=10**6))
    start = time.time()
    assert 300_000 < token_counts.Segmenter(token_counts.rank_scores()).count([word, "a"])[0] < 10**6
    assert time.time() - start < 30


def test_language_id(spark):
    texts = [(k, "the house of the people and that was with this" if k % 2 else "der die das und nicht mit einer schönen straße", "en" if k % 2 else "de") for k in range(60)]
    train = spark.createDataFrame([*texts, (100, None, "en"), (101, "x", None), (102, "это русский текст для проверки", "ru")], "doc_id long, text string, lang string")
    model = language_id.train(train)
    assert model.languages == ["de", "en", "ru"]
    mixed = "the people and that was with this house. " * 3 + "und nicht mit einer schönen straße der die das " * 2
    rows = {r.doc_id: r for r in language_id.identify(docs(spark, [mixed, None, "12 34 --", "", "русский", "the people and that", LONG]), model).collect()}
    assert [s.lang for s in rows[0].spans] == ["en", "de"] and mixed[rows[0].spans[1].start :].startswith("und")
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0
    assert rows[4].lang_pred == "ru" and rows[5].lang_pred == "en" and 0 <= rows[0].score <= 1
    none = language_id.train(train.limit(0))
    assert none.languages == [] and language_id.identify(docs(spark, ["a"]), none).first().lang_pred == "und"
    assert language_id.keep_known(docs(spark, [mixed, None, "--"]), model).count() == 1 and language_id.keep_known(docs(spark, ["a", "1"]), none).count() == 1


def test_letters_are_those_of_unicode(spark):
    find = language_id.find_words
    assert find("½ ² ①② Ⅷ x½y 12_a٣b") == ["x", "y", "a", "b"]
    assert find("😀 ab½ 𐌰𐌱1 𠀀") == ["ab", "𐌰𐌱", "𠀀"]
    assert find("हिन्दी में é e\u0301a 一二 ꙮ") == ["हिन्दी", "में", "é", "e\u0301a", "一二", "ꙮ"]
    train = spark.createDataFrame([(k, "हिन्दी में लिखा वाक्य" if k % 2 else "an english sentence", "hi" if k % 2 else "en") for k in range(40)], "doc_id long, text string, lang string")
    model = language_id.train(train)
    found = {r.doc_id: r for r in language_id.identify(docs(spark, ["½ ²", "①② Ⅷ", "वाक्य लिखा", "sentence ½"]), model).collect()}
    assert [(found[i].lang_pred, found[i].score) for i in range(2)] == [("und", 0.0)] * 2
    assert (found[2].lang_pred, found[3].lang_pred) == ("hi", "en") and len(found[2].spans) == 1
    assert language_id.keep_known(docs(spark, ["½ ²", "①"]), model).count() == language_id.keep_known(docs(spark, ["½ ²", "①"]), language_id.train(train.limit(0))).count() == 0


def test_language_scores_by_plain_loops(spark):
    rows = [(0, "Die Straße ist lang", "de"), (1, "the street is long", "en"), (2, "улица ulica", "ru"), (3, "the the", "en"), (None, "is is", "en")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def bucket(gram):
        h, wrap = 0, (1 << 64) - 1
        for n, c in enumerate(gram, 1):
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + n) & wrap
        return (((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & wrap) >> 48

    grams = lambda word: [f" {word} "[i : i + n] for n in range(1, 5) for i in range(len(word) + 3 - n)]
    counts, letters = {k: Counter() for k in ("de", "en", "ru")}, {k: Counter() for k in ("de", "en", "ru")}
    for _, text, lang in rows:
        for word in text.lower().split():
            counts[lang].update(bucket(g) for g in grams(word))
            letters[lang]["cyrillic" if word[0] > "\u0400" else "latin"] += len(word)
    words = ["straße", "street", "улица", "is", "ελ"]
    expected = []
    for word in words:
        log_p = [sum(np.log((c[bucket(g)] + 0.5) / (c.total() + 0.5 * language_id.BUCKETS)) for g in grams(word)) for c in counts.values()]
        script = "cyrillic" if word[0] > "\u0400" else "greek" if word[0] > "\u0370" else "latin"
        used = [own[script] >= 0.01 * own.total() for own in letters.values()]
        expected.append([p - max(log_p) + (0 if u or not any(used) else -40) for p, u in zip(log_p, used)])
    assert np.allclose(model.score(words), expected, atol=1e-3)


def test_rare_languages_are_learned_under_a_bound(spark):
    rows = [(k, "the house of people", "en") for k in range(3000)] + [(9000 + k, "das haus der leute", "de") for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df, max_rows=100)
    twice = docs(spark, ["das haus der leute", None]).unionAll(docs(spark, ["das haus der leute"]))
    assert [(r.doc_id, r.lang_pred) for r in language_id.identify(twice, model).orderBy("doc_id").collect()] == [(0, "de"), (0, "de"), (1, "und")]
    assert language_id.identify(twice.limit(0), model).count() == 0


def test_keep_known_by_evidence(spark):
    rng = random.Random(5)
    words = {
        "en": "the house of people and that was with this they went home again when evening came over small town".split(),
        "de": "der die das und nicht mit einer schönen straße haus leute gehen wieder nach hause abend kleine stadt".split(),
    }
    rows = [(k, " ".join(rng.choices(words[lang], k=20)), lang) for k in range(200) for lang in ("en", "de")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    letters = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(n))
    keep = ["the people went home", "Haus und Straße", "evening", "the people went home. Это русский текст", "they went home " + letters(1)]
    drop = ["Это русский текст для проверки", "这是一个中文句子", "ελληνικό κείμενο", letters(6), letters(40), "home: Это русский текст для проверки языка", None, "12 --"]
    found = {r.doc_id for r in language_id.keep_known(docs(spark, keep + drop), model, 1 / 3).collect()}
    assert found == set(range(len(keep)))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    lengths = np.array([0, 3, 1, 5, 2])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    labels = language_id.viterbi(scores, lengths, 0.7)
    from itertools import product

    for a, n in zip(np.cumsum(lengths) - lengths, lengths):
        value = lambda path: sum(scores[a + i, k] for i, k in enumerate(path)) - 0.7 * sum(x != y for x, y in zip(path, path[1:]))  # noqa: B023, E731
        if n:
            assert value(labels[a : a + n]) == pytest.approx(max(value(p) for p in product(range(3), repeat=int(n))), abs=1e-5)


def test_toxicity(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 8 == 0
        rows.append((i, " ".join(rng.choices([f"w{k}" for k in range(300)], k=40) + (["nasty", "vile"] if bad else []))))
        labels.append((i, int(bad) if i % 3 else None))
    df = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, lab, common.crc_bucket("doc_id", 4) != 2)
    found = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert len(found) == 602 and all(0 <= r.score <= 1 for r in found.values())
    hits = [found[i].predicted == int(i % 8 == 0) for i in range(600)]
    assert sum(hits) > 590 and found[1000].predicted == 0 and found[1000].score == found[1001].score
    empty = toxicity.train(df, lab.limit(0), F.lit(True))
    assert toxicity.score(df, empty).filter("predicted = 1").count() == 0


def test_risk_of_positive_and_unlabelled_rows_by_plain_loops():
    import math

    rng = random.Random(4)
    for trial in range(20):
        n, prior = 40, rng.choice([0.05, 0.3, 0.9])
        z = np.array([rng.gauss(0, 3) for _ in range(n)])
        positive = np.array([rng.random() < 0.5 for _ in range(n)])
        unlabelled = np.array([rng.random() < 0.6 for _ in range(n)]) | ~positive
        positive[0] = unlabelled[1] = True
        loss = lambda m: math.log(1 + math.exp(-m))

        def terms(z):
            mean = lambda rows, sign: sum(loss(sign * z[i]) for i in rows) / len(rows)  # noqa: E731, B023
            p, u = np.flatnonzero(positive).tolist(), np.flatnonzero(unlabelled).tolist()  # noqa: B023
            return prior * mean(p, 1), mean(u, -1) - prior * mean(p, -1)  # noqa: B023

        first, second, g = toxicity.pu_risk(z, positive, unlabelled, prior)
        assert (first, second) == pytest.approx(terms(z))
        for i in range(n):
            up, down = z.copy(), z.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            change = [(a - b) / 2e-5 for a, b in zip(terms(up), terms(down))]
            assert g[i] == pytest.approx(sum(change) if second >= 0 else -change[1], abs=1e-6)


def test_toxicity_draw_is_bounded_where_ids_repeat(spark, monkeypatch):
    rows = [(1, "foul words here"), *[(2, f"clean text {k % 7}") for k in range(500)], *[(1, "foul words here")] * 500, *[(k, f"plain page {k}") for k in range(3, 60)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    seen = []
    fit = toxicity._nonnegative_pu
    monkeypatch.setattr(toxicity, "_nonnegative_pu", lambda flat, edge, positive, *rest: seen.append(len(positive)) or fit(flat, edge, positive, *rest))
    for most in (3, 10):
        model = toxicity.train(df, labels, F.lit(True), max_positive=most, max_unlabelled=20, max_used=5)
        assert toxicity.score(df, model).count() == len(rows)
    assert all(n <= 30 for n in seen)


def test_toxicity_of_odd_rows(spark):
    texts = [f"w{k % 7} w{k % 11} " + ("nasty vile " if k % 5 == 0 else "kind ") * 3 for k in range(200)]
    rows = [(k if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, "kind again"), (7, "kind again"), (8, "nasty vile " * 200_000), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"features": F.lit("x"), "flags": F.lit(1), "u": F.lit(2)})
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(0, 200, 2)] + [(4, None), (None, 1), (6, 0), (6, 0)], "doc_id long, toxic int")
    found = [toxicity.score(df, toxicity.train(df.repartition(n), labels, F.lit(True))).collect() for n in (1, 5)]
    assert [tuple(r) for r in found[0]] == [tuple(r) for r in found[1]] and len(found[0]) == len(rows)
    assert all(r.predicted == int("nasty" in (t or "")) for r, (_, t) in zip(found[0], rows))
    small = toxicity.train(df, labels, F.lit(True), max_positive=5, max_unlabelled=20)
    assert toxicity.score(df, small).count() == len(rows)
    assert toxicity.score(df.limit(0), toxicity.train(df.limit(0), labels, F.lit(True))).count() == 0
    spark.createDataFrame(rows, "doc_id long, text string")


def test_queries_of_tables_with_null_ids(spark, tmp_path):
    rows = [(k if k % 9 else None, "the house of people" if k % 2 else "das haus der leute", "en" if k % 2 else "de") for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for query, modulus, rest in ((language_id.op5_language_id, 3, 1), (toxicity.op3_toxicity, 4, 2)):
        found = query(spark, str(tmp_path)).collect()
        assert len(found) == 60
        assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in found)


def test_quality(spark):
    clean = " ".join(f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(90)) + "."
    texts = [clean, None, "", "too short", " ".join(["a b c d e f g h i"] * 6), "x %%% $$$ | | " * 30, clean.upper(), clean + "\n" + clean]
    q = {r.doc_id: r for r in quality.quality(docs(spark, texts)).collect()}
    assert (q[1].n_words, q[1].base_failed, q[1].kept) == (0, True, False) and q[3].base_failed
    assert q[0].kept and q[0].n_repeat_words == 0 and q[7].n_dup_lines == 1 and q[7].n_repeat_words == 180
    w = texts[4].split()
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    assert q[4].n_repeat_words == len(covered)
    assert quality.quality(docs(spark, texts).limit(0)).count() == 0


def test_quality_of_repeated_and_long_rows(spark):
    clean = " ".join(f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(90)) + "."
    long = " ".join(f"term{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{k // 100}" for k in range(60_000))
    rows = [(1, clean), (1, clean), (1, "too short"), (None, clean), (2, long), (3, "word " * 50_000), (4, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit(1), "n_words": F.lit("z"), "kept": F.lit(None).cast("int")})
    found = quality.quality(df).collect()
    assert len(found) == len(rows)
    by = Counter((r.doc_id, r.n_words, r.base_failed) for r in found)
    assert by[1, 90, False] == 2 and by[1, 2, True] == 1 and by[None, 90, False] == 1 and by[2, 60_000, False] == 1 and by[3, 50_000, True] == 1 and by[4, 1, True] == 1


def test_expectation_maximisation_finds_the_noisy_group():
    good, bad = (1, 1, 1, 1, 1, 1, 1), (1, 1, -1, -1, 1, 1, 1)
    model = quality.fit([(good, 900), (bad, 90), ((1, 1, 1, 1, 1, 0, 1), 10)])
    assert 0.85 < model.prior < 0.95 and model.accuracy["symbols"][1] > 0.8
    assert quality.fit([]).prior == quality.FIRST_PRIOR
