"""Operators of ``panelkit.llm`` against brute force on small tables.

The fixture has null ids, texts and sources, empty and long texts, copies,
near copies, repeated rows, and an extra column named like an output.
"""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from panelkit.llm import (chat, components, dedup, encode, jaccard, mixing, outliers, pieces, quality_model,
                          suffix_tree, text, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, size string"
WORDS = "the of and to in is for on with as by at from that this it be are was or".split()


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def fold(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def make_rows():
    rng = random.Random(3)
    rows = []
    for i in range(120):
        n = rng.choice([0, 1, 4, 5, 12, 40, 90])
        body = " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))
        rows.append([i, body, rng.choice(["en", "de"]), rng.choice(["a", "b", "c", None]), "x"])
    long_text = " ".join(f"w{k % 977}" for k in range(20_000))
    rows += [[200, None, "en", "a", None], [201, "", None, "b", "x"], [202, long_text, "en", "a", "x"],
             [203, long_text.upper(), "en", "c", "x"], [204, " \n\t ", "en", "a", "x"]]
    base = [f"t{k}" for k in range(80)]
    for k in range(12):  # near copies
        w = list(base)
        w[5 + k] = "changed"
        rows.append([300 + k, " ".join(w), "en", "a", "x"])
    rows += [[320 + k, "Same Text here and there, again" if k % 2 else "same text here and there, again", "en", "b", "x"]
             for k in range(9)]
    rows += [[7, rows[7][1], "en", "a", "x"], [None, "null id one two three four", "en", "a", "x"]]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_hash_index(rows):
    import pyarrow as pa
    texts = [r[1] for r in rows]
    data, offsets = text.text_buffer(pa.array(texts, pa.string()))
    h, first, starts, ends = text.words(data, offsets)
    got = [[data[starts[k]:ends[k]].tobytes().decode() for k in range(first[i], first[i + 1])] for i in range(len(texts))]
    assert got == [split(t) for t in texts]
    keys = np.unique(h)[::2]
    at = text.HashIndex(keys).find(h)
    assert ((at >= 0) == np.isin(h, keys)).all() and (keys[at[at >= 0]] == h[at >= 0]).all()


def test_mix_targets_and_repetitions(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size
    total = sum(r.size for r in got)
    assert total == sum(len(split(r[1])) for r in rows)
    # water-filling by repeated clamping
    weight = dict(zip(sorted(by, key=lambda s: (s is None, s or "")), [5, 2, 1, 5]))
    size = {s: sum(r.size for r in v) for s, v in by.items()}
    clamped = set()
    while True:
        left = 1.5 * total - sum(2 * size[s] for s in clamped)
        share = {s: 2 * size[s] if s in clamped else left * weight[s] / sum(w for x, w in weight.items() if x not in clamped)
                 for s in by}
        over = {s for s in by if share[s] > 2 * size[s]}
        if not over:
            break
        clamped |= over
    for s, v in by.items():
        assert v[0].target == pytest.approx(share[s])
        assert abs(sum(r.taken for r in v) - share[s]) <= max(r.size for r in v) / 2 + 1
    again = mixing.mix(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_mix_without_usable_weights(docs, spark, empty):
    none = spark.createDataFrame([("a", 0.0), ("b", None), ("zz", 1.0)], "source string, weight double")
    assert all(r.target == 0 and r.taken == 0 for r in mixing.mix(docs, none).collect())
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_exact_groups_levels_agree(docs, rows, empty):
    want = collections.defaultdict(list)
    for r in rows:
        want[fold(r[1])].append(r[0])
    plain = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in dedup.exact_groups(docs).collect()]
    assert len(plain) == len(rows)
    for t, ids in want.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        mine = [r for r in plain if r[4] == sha]
        assert len(mine) == len(ids) and sum(r[3] for r in mine) == 1
        top = max((i for i in ids if i is not None), default=None)
        assert {r[1] for r in mine} == {top} and {r[2] for r in mine} == {len(ids)}
        assert [r[0] for r in mine if r[3]] == [top]
    tiny = dedup.exact_groups(docs, limit=300).collect()  # salts and several levels
    assert sorted(map(str, map(tuple, tiny))) == sorted(map(str, plain))
    assert dedup.exact_groups(empty).count() == 0
    kept = dedup.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(want)


@pytest.mark.parametrize("copies", [1, 5, 40])
def test_buckets_fit_beside_a_hot_text(spark, monkeypatch, copies):
    """One hash over the limit stops neither the doubling nor joins the buckets, also if a text is over it alone."""
    from pyspark.sql import functions as F
    limit, size = 4000, 5000 if copies < 40 else 300
    texts = [f"{k} " + "distinct " * 30 for k in range(800)] + ["Hot" * (size // 3)] * copies
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen, real = [], dedup._collapse

    def spy(records, carry, most):
        if most > 1 << 40:
            weight = F.octet_length("content") + dedup.RECORD_BYTES
            held = records.groupBy(F.spark_partition_id().alias("at")).agg(F.sum(weight).alias("held"))
            seen.append(held.agg(F.max("held")).first()[0])
        return real(records, carry, most)

    monkeypatch.setattr(dedup, "_collapse", spy)
    got = dedup.exact_groups(docs, limit=limit).collect()
    assert len(got) == len(texts) and sum(r.kept for r in got) == 801
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id >= 800} == {(799 + copies, copies)}
    assert all(r.keep_id == r.doc_id and r.group_size == 1 for r in got if r.doc_id < 800)
    assert seen and max(x or 0 for x in seen) <= 2 * limit


def test_content_table_compares_contents():
    table = dedup.ContentTable()
    numbers = [table.add(5, str(k % 100).encode()) for k in range(300)]  # one hash for all
    assert numbers == [k % 100 for k in range(300)]


def brute_links(rows):
    sets = []
    for r in rows:
        w = split(fold(r[1]))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if fold(rows[i][1]) == fold(rows[j][1]) or (a and b and 5 * len(a & b) >= 4 * len(a | b)):
                links[i] += 1
                links[j] += 1
                x, y = root[i], root[j]
                root = [min(x, y) if z in (x, y) else z for z in root]
    return links, root


def test_near_groups_against_all_pairs(docs, rows, empty, monkeypatch):
    links, root = brute_links(rows)
    want = collections.Counter((r[0], n) for r, n in zip(rows, links))
    for block in (512, 4):  # several blocks in a bucket and in a component
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = jaccard.near_groups(docs).collect()
        assert collections.Counter((r.doc_id, r.n_links) for r in got) == want
        least = {}
        for r, g in zip(rows, root):
            if r[0] is not None:
                least[g] = min(least.get(g, 10 ** 9), r[0])
        ids = {r[0]: least[g] for r, g in zip(rows, root) if r[0] is not None}
        assert all(r.class_id == ids[r.doc_id] for r in got if r.doc_id is not None)
    assert jaccard.near_groups(empty).count() == 0
    assert jaccard.one_of_each_group(docs).columns == docs.columns


@pytest.mark.parametrize("two", [False, True])
def test_walk_connects_what_all_pairs_connect(two):
    from panelkit.llm.components import local_labels
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 16, (6, jaccard.HASHES), dtype=np.uint16)
    sig = seeds[rng.integers(0, 6, 150)]
    off = rng.random(sig.shape) < rng.uniform(0, 0.4, (150, 1))
    sig[off] = rng.integers(0, 1 << 16, int(off.sum()), dtype=np.uint16)
    side = rng.integers(0, 2, 150)
    every = jaccard.surviving(sig, *jaccard._pairs(side, 0, 150, two))
    some = jaccard._walk(sig, side, two)
    assert (local_labels(*some, 150) == local_labels(*every, 150)).all()
    assert len(some[0]) < len(every[0])
    one = np.zeros(150, np.int64)  # a pair of blocks of which one is empty
    assert not len(jaccard._walk(sig, one, True)[0]) and not len(jaccard._pairs(one, 0, 150, True)[0])


def test_bayes_table_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches()
    assert all(least[n] <= n * 0.8 for n in range(1, jaccard.HASHES + 1))
    assert least[jaccard.HASHES] > jaccard.HASHES * 0.55  # and drops dissimilar ones


def test_components_rounds_match_one_task(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(500 + k, 501 + k) for k in range(40)]
    df = spark.createDataFrame(edges, "a long, b long")
    one = sorted(map(tuple, components.components(df).collect()))
    assert one == sorted(map(tuple, components.components(df, one_task=0).collect()))


def test_suffix_tree_base_and_gain(docs, rows, empty):
    from pyspark.sql import functions as F
    from panelkit.llm.text import bucket_of
    src = docs.select("doc_id", (bucket_of(F.col("doc_id"), 10) == 0).alias("held_out"), "text")
    got = suffix_tree.score(src, *suffix_tree.learn(src)).collect()
    ids = [(r[0], split(fold(r[1])) + [None]) for r in rows]
    train = collections.Counter()
    for i, w in ids:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            train.update(w)
    n, v = sum(train.values()), len(train)
    want = collections.Counter()
    for i, w in ids:
        base = sum(np.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i, len(w), sum(train[x] > 0 for x in w), n, round(float(base), 4))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    nothing = empty.select("doc_id", F.lit(False).alias("held_out"), "text")
    assert suffix_tree.score(nothing, *suffix_tree.learn(nothing)).count() == 0


def test_suffix_tree_is_a_distribution():
    """Over the vocabulary and one unknown, every retained node's probabilities add up to 1."""
    a, b, c = np.sort(text.mix(np.arange(3, dtype=np.uint64)))
    tree = suffix_tree.Tree(1000, 3, np.array([a, b, c]), np.array([500, 300, 200]))
    tree.grow(np.array([a, b]), np.array([b, a]), np.array([450, 280]))
    contexts, spread, entries, value = tree.depths[0]
    assert len(contexts) == 2
    for node, away in zip(contexts, spread):
        total = 0.0
        for w, root in [*zip(tree.words, tree.root), (None, tree.unigram(0))]:
            hit = -1 if w is None else text.HashIndex(entries).find(suffix_tree.gram(np.array([node]), np.array([w])))[0]
            total += 10 ** value[hit] if hit >= 0 else root * 10 ** away
        assert total == pytest.approx(1.0)


def test_suffix_tree_nodes_do_not_fade_with_the_corpus(spark):
    """Two occurrences retain a context in 2.5 M tokens as in few."""
    rare = [(i, False, "alpha beta gamma delta") for i in range(2)]
    filler = [(10 + i, False, " ".join(f"w{(i * 7 + k * k) % 997}" for k in range(25_000))) for i in range(100)]
    docs = spark.createDataFrame(rare + filler + [(5, True, "beta gamma delta never")],
                                 "doc_id long, held_out boolean, text string").repartition(4)
    got = {r.doc_id: r for r in suffix_tree.score(docs, *suffix_tree.learn(docs)).collect()}
    assert got[0].train_tokens > 2_400_000
    assert got[0].score > got[0].base_score + 10 and got[5].score > got[5].base_score + 5


def test_suffix_tree_tables_match_the_driver(docs):
    from pyspark.sql import functions as F
    from panelkit.llm.text import bucket_of
    src = docs.select("doc_id", (bucket_of(F.col("doc_id"), 10) == 0).alias("held_out"), "text")
    here = suffix_tree.score(src, *suffix_tree.learn(src)).collect()
    for heavy in (0, 300):  # all weights in the join, or some
        there = suffix_tree.score(src, *suffix_tree.learn(src, p_min=1e-3, small=0, heavy=heavy)).collect()
        rows = [sorted((str(r[:5]), round(r.base_score, 6), round(r.score, 6)) for r in x) for x in (here, there)]
        assert rows[0] == rows[1]


def test_suffix_tree_leaves_no_shuffle_files_and_maps(spark, docs, rows):
    """What learning has shuffled and sent to the tasks is gone when it ends."""
    import os

    def left():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        sent = [os.path.join(at, f) for at, _, files in os.walk(spark.sparkContext._temp_dir) for f in files]
        return {f for f in (disk.apply(i).getName() for i in range(disk.size())) if f.startswith("shuffle_")} | {
            f for f in sent if os.path.getsize(f) >= 1 << suffix_tree.BITS - 3}

    src = docs.select("doc_id", docs.doc_id.isNull().alias("held_out"), "text")
    src.count()  # fills the cache below it
    before = left()
    tree, elsewhere = suffix_tree.learn(src, small=0, heavy=300)
    assert left() <= before and tree.depth == suffix_tree.DEPTH and elsewhere.count() > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert suffix_tree.score(src, tree, elsewhere).count() == len(rows)


def test_suffix_tree_scoring_keeps_sums_only(docs, rows):
    """What scoring leaves on disk is a row a text and wave, however many keys the texts hold."""
    import pyarrow.parquet as pq
    src = docs.select("doc_id", docs.doc_id.isNull().alias("held_out"), "text")
    out = suffix_tree.score(src, *suffix_tree.learn(src, small=0, heavy=0))
    files = [f.removeprefix("file://").removeprefix("file:") for f in out.inputFiles()]
    assert files and sum(pq.read_metadata(f).num_rows for f in files) <= len(rows) * suffix_tree.WAVES


def test_suffix_tree_packed_columns_come_back(rows):
    """Every row comes back once, in the range of its key; nulls of another frame's columns give nothing."""
    import pyarrow as pa
    key = text.mix(np.arange(5000, dtype=np.uint64))
    batch = suffix_tree._packed(key, 7, key=key, p=key / 3.0, word=key % np.uint64(2) == 0)
    back, p, word = (suffix_tree._values(batch, c, t) for c, t in (("key", np.uint64), ("p", np.float64), ("word", bool)))
    assert (np.sort(back) == np.sort(key)).all() and (p == back / 3.0).all() and (word == (back % np.uint64(2) == 0)).all()
    for part, at in zip(batch.column("part").to_pylist(), range(batch.num_rows)):
        own = suffix_tree._values(batch.slice(at, 1), "key")
        assert len(own) and all(int(k) * 7 >> 64 == part for k in own)
    none = pa.RecordBatch.from_arrays([pa.nulls(3, pa.binary())], ["key"])
    assert len(suffix_tree._values(none, "key")) == 0 and suffix_tree._packed(key[:0], 7, key=key[:0]).num_rows == 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "a<b>\\l #x </turn>\n"), (1, 1, "user", None), (1, 2, "assistant", "\\### Assistant: </turn> ok"),
            (1, 3, "user", "é\\b"), (1, 4, "assistant", ""), (1, 5, "user", "tail"), (2, 0, "user", "only"),
            (None, 0, None, "x"), (None, 0, None, "x"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 0, "ro\nle", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, example int")
    made = chat.expand(df)
    by = collections.defaultdict(list)
    for r in made.select("*", chat.read_turns(made.formatted).alias("turns"), chat.masked(made).alias("reply")).collect():
        by[r.conv_id].append(r)
    for conv, got in by.items():
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))
        got.sort(key=lambda r: r.example)
        assert [(t.role, t.text) for t in got[-1].turns] == [(r[2] or "", r[3] or "") for r in turns]
        replies = [r[3] or "" for r in turns if r[2] == "assistant"]
        assert [g.reply for g in got][:len(replies)] == replies
        for g in got:  # all turns before the reply are context
            assert [t.text for t in g.turns] == [r[3] or "" for r in turns][:len(g.turns)]
    assert chat.expand(df.limit(0)).count() == 0


def test_outlier_statistics_and_verdict(spark, docs, rows, empty):
    got = outliers.judge(docs).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for r in rows:
        w = split(r[1])
        keys = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        n = collections.Counter(keys)
        covered = {k for i, x in enumerate(keys) if n[x] > 1 for k in range(i, i + 5)}
        lines = [x for x in (r[1] or "").split("\n") if split(x)]
        want[(r[0], len(w), sum(map(len, w)), len(re.findall(outliers.SYMBOLS, r[1] or "")), len(lines) - len(set(lines)),
              len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                                r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert outliers.judge(empty).count() == 0


def test_outliers_reject_planted_ones(spark):
    rng = random.Random(5)
    good = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(60)), "en", "s")
            for i in range(200)]
    bad = [(1000 + i, " ".join(rng.choice(WORDS) + str(k) + "$$$***" for k in range(60)), "en", "s") for i in range(40)]
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(good + bad, "doc_id long, text string, "
                                                                          "lang string, source string")).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in bad)


@pytest.fixture(scope="module")
def vocab():
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(encode.MODEL, "rb").read())
    proto.trainer_spec.model_type = 1  # the library's unigram segmentation of the same pieces
    for p in proto.pieces:
        if p.score < -1e8:  # single precision in the library would lose all others beside it
            p.score = -33000.0
    return proto.SerializeToString()


def test_pieces_match_the_library(vocab):
    import pyarrow as pa
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=vocab)
    rng = random.Random(2)
    parts = list("abcdehilnorst   \n\t,.!ñéß日本😀#\r;") + ["th", "er", "the ", "ing", "  "]
    texts = ["", " ", "  a", "a ", "abc" * 60, "日" * 40] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(1, 90))) for _ in range(400)]
    automaton = pieces.Automaton(v := pieces.Vocabulary.load(proto=vocab))
    offsets, ids = automaton.encode(*text.text_buffer(pa.array(texts)))
    counts = automaton.counts(*text.text_buffer(pa.array(texts)))
    for k, t in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == sp.encode(t), t
        assert counts[k] == len(sp.encode(t))
    decoder = pieces.Decoder(v)
    at, raw = decoder.decode(offsets, ids)
    assert [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])] == texts


def test_encode_decode_round_trip(docs, rows, empty):
    v = pieces.Vocabulary.load(encode.MODEL)
    odd = docs.union(docs.limit(1).selectExpr("999 doc_id", "'mark ▁ é \\n\\n  two' text", "lang", "source", "size"))
    coded = encode.encode(odd, v, "test")
    assert coded.columns == [*[c for c in docs.columns if c != "text"], "ids", "n_pieces"]
    back = encode.decode(encode.encode(odd.withColumnRenamed("text", "t"), v, "test", "t", drop=False), v, "test", "back")
    for r in back.collect():
        assert r.back == (r.t or "") and r.n_pieces == len(r.ids)
    counts = encode.count_tokens(odd, v, "test")
    want = collections.Counter((r.doc_id, r.n_pieces) for r in coded.collect())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in counts.collect()) == want
    assert encode.encode(empty, v, "test").count() == 0 and encode.count_tokens(empty, v, "test").count() == 0


def labelled(spark, bad):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        wrong = rng.random() < 0.3
        w = [rng.choice(WORDS) + rng.choice("abcdef") for _ in range(rng.randint(15, 60))]
        rows.append((i, bad(rng, w) if wrong else ". ".join(" ".join(w[k:k + 6]) for k in range(0, len(w), 6)), "en", "s"))
        labels.append((i, 0 if wrong else 1, 1 if wrong else 0))
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (None, "a b", "en", "s")]
    labels += [(5, labels[5][1], None), (None, 1, 0), (1000, None, None)]
    return (spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels[:240]))


def test_quality_classifier_held_out(spark):
    docs, labels, truth = labelled(spark, lambda rng, w: " ".join(x.upper() + "!!" for x in w))
    got = quality_model.classify(docs, labels).collect()
    assert len(got) == 243 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id][0] for r in held]) > 0.95
    kept = quality_model.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert quality_model.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality_model.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    count = rng.integers(0, 9, 200).astype(float)
    curve = quality_model.isotonic(count, np.minimum(count, rng.integers(0, 9, 200)))
    assert len(curve) == 200 and (np.diff(curve) >= -1e-12).all()


def test_toxic_sentences_located(spark):
    def bad(rng, w):
        return ". ".join([" ".join(w[:6]), "you " + rng.choice(["nastyword", "nastywords", "vileone"]) + " there", " ".join(w[6:])])

    docs, labels, truth = labelled(spark, bad)
    got = toxicity.classify(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id][1] for r in held)
    for r in got:
        for s in r.offending:
            span = texts[r.doc_id].encode()[s.start:s.start + s.length].decode()
            assert "nasty" in span or "vile" in span
    assert next(r for r in got if r.doc_id == 1000).score == 0
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert all(r.score == 0 for r in toxicity.classify(docs, labels.limit(0)).collect())


def test_pipeline_keeps_all_without_a_model_and_shows_the_round_trip(spark, docs, rows):
    import corpus_pipeline
    for label in ([], [(1, None)], [(1, 0), (2, 0)]):
        labels = spark.createDataFrame(label, "doc_id long, quality int")
        kept = quality_model.good_documents(docs, labels)
        assert kept.columns == docs.columns and kept.count() == len(rows)
    coded = corpus_pipeline.tokenize(spark, docs, "").collect()
    want = collections.Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in coded) == want


def test_what_a_batch_took_is_given_back(monkeypatch):
    import pyarrow as pa
    given = []
    monkeypatch.setattr(text, "give_back", lambda: given.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c"])], ["text"])
    assert [p.num_rows for p in text.slices(batch, "text", 1)] == [1, 1, 1] and given == [1]
    assert list(text.slices(batch.slice(0, 0), "text")) == [] and given == [1]
