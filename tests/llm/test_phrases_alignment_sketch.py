"""Collocations, cross-tokenizer alignment and SetSketch near-dedup against brute force.

The fixture has null ids, texts and langs, empty and long texts, copies, near
copies, repeated rows, ties, and extra columns named like internal ones.
"""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from panelkit.llm import align, collocations, setsketch

SCHEMA = "doc_id long, text string, lang string, node long, _text string, a_ids string, label string"
WORDS = "the of and to in is for on with as by at from that this it be are was or".split()


def fold(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def make_rows():
    rng = random.Random(5)
    rows = []
    for i in range(90):
        n = rng.choice([0, 1, 3, 4, 12, 60])
        body = " ".join(rng.choice(WORDS) + rng.choice(["", "", "S", ".", ",", ";\n"]) for _ in range(n))
        rows.append((i, body, rng.choice(["en", "de", None])))
    base = [f"t{k}" for k in range(70)]
    for k in range(14):  # near copies of a base that change other words each
        w = list(base)
        w[4 * k:4 * k + 2] = [f"x{k}", f"y{k}"]
        rows.append((300 + k, " ".join(w), "en"))
    rows.append((299, " ".join(base), "en"))
    rows += [(320 + k, "Same Text here and there" if k % 2 else "same text HERE and there", "en") for k in range(5)]
    rows += [(500 + k, "red Green blue, red green; green blue\tred" + " x" * k, ["de", None, "und"][k % 3]) for k in range(15)]
    rows += [(400, None, "en"), (401, "", None), (402, " \t\n", "en"), (403, "one two", "de"), (404, "ONE two", "de"),
             (405, "two one", "de"), (406, "a▁b", "en"), (407, "<|endoftext|> and </s> <unk>", "en"), (408, "é世界🎉 x", "en"),
             (409, "w" * 900 + " " * 600 + "z", "en"), (410, " ".join(f"w{k % 977}" for k in range(9000)), "en"),
             (None, " ".join(base[:-1] + ["none"]), "en"), (None, "no id at all here", "en"),
             (7, rows[7][1], rows[7][2]), (299, "another text under the same id", "en")]
    return [(*r, 1, "x", "y", "z") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- collocations ---------------------------------------------------------------------------

def brute_phrases(rows, least, top, cover):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(r[1])):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in cand.items():
            if any(100 * b >= cover * a for q, b in cand.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        best.sort()
        out += [(lang, i + 1, s[2].decode(), -s[1], s[3], s[4], n[lang], -s[0]) for i, s in enumerate(best[:top])]
    return sorted(out)


@pytest.mark.parametrize("weak", [False, True])
def test_collocations(docs, rows, weak, monkeypatch):
    if weak:  # words, and so n-grams, of equal fingerprints everywhere
        monkeypatch.setattr(collocations.Slice, "word_hashes", lambda s: s.starts.astype(np.uint64) * np.uint64(0) + np.uint64(9))
    want = brute_phrases(rows, 4, 40, 80)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=4, top=40).collect())
    assert got == want and {r[0] for r in got} == {"en", "de", "und"} and len(got) > 45


def test_collocations_of_an_empty_table(empty):
    assert collocations.collocations(empty).collect() == []


def test_scores_stay_exact_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10 ** 18  # 2,000,000 times this passes 64 bits
    found = spark.createDataFrame([("en", 1, "p", big), ("en", 1, "q", big + 1), ("en", 2, "p q", big - 7)],
                                  "lang string, n int, phrase string, f long")
    monkeypatch.setattr(collocations, "phrases", lambda *a: found)
    r = collocations.collocations(found).first()
    assert r.score == 2_000_000 * (big - 7) // (2 * big + 1) and (r.a, r.l, r.r) == (big - 7, big, big + 1)


@pytest.mark.parametrize("task, most", [
    (lambda b: collocations._count_task(b, 2, None), 40),
    (lambda b: collocations._phrase_task(b, {2: np.full(1 << (collocations.BITS - 3), 255, np.uint8)}), 90)])
def test_a_task_of_collocations_needs_little_beside_its_batch(task, most):
    """The workers share an executor with its heap: MB that a task takes for itself (before: 54 and 124)."""
    import tracemalloc

    import pyarrow as pa
    rng = random.Random(1)
    text = [" ".join(rng.choices(WORDS, k=700)) + "." for _ in range(2000)]
    batch = pa.record_batch([pa.array(["en"] * 2000), pa.array(text)], ["lang", "text"])
    sum(x.num_rows for x in task(iter([batch.slice(0, 1)])))  # tables that are kept
    tracemalloc.start()
    assert sum(x.num_rows for x in task(iter([batch]))) > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 4 << 20 and peak < most << 20


# --- alignment ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def pair():
    return align.Pair(*align._files(align.MODEL_A, align.MODEL_B))


def brute_alignment(pair, text):
    """[(A ids, B ids)] of the groups and the linked id pairs, from the two libraries."""
    if not text:
        return [], []
    a = pair.a.library.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.library.encode(text)
    at, bt = [pair.a.bytes[k] for k in a], [pair.b.bytes[k] for k in b]
    if not b"".join(at) == b"".join(bt) == b" " + text.encode():
        return [], []
    ends_a, ends_b = list(itertools.accumulate(map(len, at))), list(itertools.accumulate(map(len, bt)))
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
             if ends_a[i] - len(at[i]) < ends_b[j] and ends_b[j] - len(bt[j]) < ends_a[i]]
    return groups, links


@pytest.mark.parametrize("heavy", [1_000_000, 60, 0])
def test_alignment(docs, rows, pair, heavy, monkeypatch):
    monkeypatch.setattr(align, "HEAVY", heavy)
    rows = [r for r in rows if r[0] != 410]
    made = [(r[0], *brute_alignment(pair, r[1])) for r in rows]
    count = collections.Counter(p for _, _, links in made for p in set(links))
    most = collections.Counter()
    for (a, _), c in count.items():
        most[a] = max(most[a], c)
    want = []
    for doc_id, groups, links in made:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        want.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                     sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if text else ""))
    out = align.summaries(docs.filter("doc_id IS NULL OR doc_id <> 410"))
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
           for r in out.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert not any(r[1] for r in got if r[0] in (400, 401, 406))  # null, empty, U+2581


def test_align_gives_ids_and_ends(docs, rows, pair):
    out = align.align(docs.filter("doc_id < 330 OR doc_id > 403"))
    assert "text" not in out.columns and out.schema["a_ids"].dataType.simpleString() == "array<int>"
    texts = {r[0]: r[1] for r in rows}
    for r in out.collect():
        if r.doc_id in (None, 7, 299, 410):
            continue
        groups, _ = brute_alignment(pair, texts[r.doc_id])
        cut = lambda ids, ends: [ids[p:q] for p, q in zip([0, *ends[:-1]], ends)]
        assert list(zip(cut(r.a_ids, r.a_ends), cut(r.b_ids, r.b_ends))) == groups and r._text == "x"


def test_common_ends_of_long_stretches():
    rng = np.random.default_rng(1)
    for shared in (0, 1, 3, 400):
        points = np.sort(rng.choice(5000, 2400, replace=False)) + 1
        a, b = points[::2], points[1::2]
        both = rng.choice(5000, shared, replace=False) + 1
        end_a, end_b = (np.unique(np.concatenate([x, both, [6000]])) for x in (a, b))
        last = align.common_ends(end_a, end_b, np.array([0]), np.array([len(end_a)]))
        assert end_a[last].tolist() == np.intersect1d(end_a, end_b).tolist()


def test_alignment_of_an_empty_table(empty):
    assert align.summaries(empty).collect() == [] and align.align(empty).collect() == []


# --- SetSketch ------------------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}


def brute_components(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [q[0] for k, q in enumerate(rows) if find(k) == find(i) and q[0] is not None]
        component = min(ids) if ids else None
        out.append((r[0], len(sets[i]), component, component == r[0]))
    return out


@pytest.mark.parametrize("block, narrow", [(512, 48), (3, 1)])
def test_near_components(docs, rows, block, narrow, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "NARROW", narrow)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = [tuple(r) for r in setsketch.near_components(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_near_components_of_an_empty_table(empty):
    assert setsketch.near_components(empty).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    for size, common in ((400, 380), (400, 300), (60, 50), (2000, 600)):
        flat = rng.integers(0, 1 << 63, 2 * size - common, dtype=np.uint64)
        a, b = np.sort(flat[:size]), np.sort(flat[size - common:])
        joint = np.unique(flat)
        k = [setsketch.registers(x, np.array([0, len(x)]))[0] for x in (a, b, joint)]
        assert (setsketch.merge(k[0], k[1]) == k[2]).all()
        more, less = np.array([(k[0] > k[1]).sum()]), np.array([(k[0] < k[1]).sum()])
        best, gain = setsketch.estimate(np.array([size]), np.array([size]), more, less)
        true = common / len(joint)
        assert abs(best[0] - true) < 0.17 and gain[0] >= -1e-9
        grid = np.linspace(0.001, 0.999, 999)
        n = np.full(999, 1.0)
        brute = setsketch._likelihood(grid, 0.5 * n, 0.5 * n, more * n, less * n)
        assert abs(grid[np.argmax(brute)] - best[0]) < 2e-3


def test_likelihood_rarely_drops_a_pair_at_the_threshold():
    rng = np.random.default_rng(3)
    more = rng.multinomial(setsketch.REGISTERS, [0.1, 0.1, 0.8], 200_000)
    sizes = np.full(len(more), 450.0)
    best, gain = setsketch.estimate(sizes, sizes, more[:, 0], more[:, 1])
    assert ((best < 0.8) & (2 * gain > setsketch.RATIO)).mean() <= 1e-5
