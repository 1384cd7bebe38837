"""Exact, near and substring dedup against brute force and on awkward rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import components, exact, induced, near, substrings


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_exact_groups_equal_brute_force(docs):
    texts = texts_of(docs)
    best, size = {}, Counter(texts.values())
    for i, t in texts.items():
        best[t] = max(i, best.get(t, i))
    for r in exact.exact_groups(docs, k=3).collect():
        t = texts[r["doc_id"]]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (best[t], size[t], best[t] == r["doc_id"], hashlib.sha256(t.encode()).hexdigest())


@pytest.mark.parametrize("k", [1, 255])
def test_exact_on_awkward_rows(awkward, nothing, k):
    got = [tuple(r) for r in exact.exact_groups(awkward, k=k).collect()]
    assert len(got) == 13
    same = [(i, kept) for i, keep, n, kept, _ in got if keep == 2]
    assert sorted(same) == [(1, False), (2, False), (2, True)]
    assert sorted((i, keep, n) for i, keep, n, _, s in got if s == hashlib.sha256(b"").hexdigest()) == [(3, 4, 2), (4, 4, 2)]
    assert exact.exact_groups(nothing).count() == 0
    kept = exact.without_copies(awkward, k=k)
    assert kept.columns == awkward.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 4, 5, 6, 7, 8, 9, 10, 11]


@given(st.lists(st.integers(0, 12), max_size=200), st.integers(1, 4))
@settings(max_examples=50, deadline=None)
def test_misra_gries_loses_no_heavy_hitter(items, k):
    summary = {}
    for i in range(0, len(items), 7):
        for x, n in Counter(items[i : i + 7]).items():
            summary[x] = summary.get(x, 0) + n
        summary = exact.shrink(summary, k)
    assert len(summary) <= k
    assert {x for x, n in Counter(items).items() if n * (k + 1) > len(items)} <= set(summary)


def links_of(texts):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = set(zip(w, w[1:], strict=False)) if len(w) > 1 else ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_groups_equal_brute_force(docs):
    wanted = links_of(texts_of(docs))
    assert {r[0]: tuple(r)[1:] for r in near.near_groups(docs).collect()} == wanted


def test_near_links_reach_over_chains_and_decoys(spark):
    random.seed(1)
    words = [f"w{i}" for i in range(400)]
    base = random.sample(words, 60)
    texts, n = {}, 0
    for step in range(25):  # each a few words from the one before, so the ends share little
        base = [random.choice(words) if random.random() < 0.04 else w for w in base]
        texts[n] = " ".join(base)
        n += 1
    half = random.sample(words, 60)
    for _ in range(30):  # alike, but no links
        texts[n] = " ".join(random.choice(words) if random.random() < 0.2 else w for w in half)
        n += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in near.near_groups(df).collect()} == links_of(texts)


def test_near_on_awkward_rows(awkward, nothing):
    got = {(r[0], r[1], r[2], r[3]) for r in near.near_groups(awkward).collect()}
    assert {(1, 5, 1, True), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (9, 1, 9, True), (10, 1, 9, False)} <= got
    assert any(i is None and c is None and kept for i, _, c, kept in got) and {c for i, _, c, _ in got if i in (6, 7)} == {6}
    assert near.near_groups(nothing).count() == 0
    kept = near.without_near_copies(awkward)
    assert kept.columns == awkward.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 11]


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(1)
    work = np.empty((near.REGISTERS, near.CHUNK), np.uint64)
    for n, shared in ((400, 0.8), (400, 0.0), (3000, 0.5)):
        one = rng.integers(0, 2**63, n, dtype=np.uint64)
        other = np.concatenate([one[: int(n * shared)], rng.integers(0, 2**63, n - int(n * shared), dtype=np.uint64)])
        a, b = (near.registers(np.unique(x), work) for x in (one, other))
        true = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
        assert abs(float(near.estimate(a, b, np.float64(n), np.float64(n))) - true) < 0.16
    assert near.compress(np.array([0, 1, 2**63, 2**64 - 1], np.uint64)).tolist()[2:] == [0, (1 << near.MANTISSA) - 1]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@given(st.text("abc", min_size=1, max_size=80), st.sampled_from([4, 9, 50]), st.sampled_from([3, 1 << 20]))
@settings(max_examples=150, deadline=None)
def test_suffixes_are_sorted_with_their_prefixes(text, depth, resident):
    s = text.encode()
    found = [(int(p), int(n)) for at, lcp in induced.suffix_order(np.frombuffer(s, np.uint8), depth, resident) for p, n in zip(at, lcp, strict=True)]
    heads = [s[p : p + depth] for p, _ in found]
    assert sorted(p for p, _ in found) == list(range(len(s))) and heads == sorted(heads)
    for (_, n), a, b in zip(found[1:], heads, heads[1:], strict=False):
        common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert n == common or (n > common and common == min(len(a), len(b)))


def repeats_of(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        b = texts[i].encode()
        gone, own = bytearray(len(b)), set()
        for k in range(len(b) - 49):
            if b[k : k + 50] in seen:
                gone[k : k + 50] = b"\1" * 50
            else:
                own.add(b[k : k + 50])
        seen |= own
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(docs):
    assert {r[0]: tuple(r)[1:] for r in substrings.remove_repeats(docs).collect()} == repeats_of(texts_of(docs))


@pytest.mark.parametrize("hot", [2, 10_000])
def test_repeats_on_periodic_and_overlapping_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    random.seed(2)
    pool = ["".join(random.choice("ab ") for _ in range(70)) for _ in range(4)] + ["x" * 120, "xy" * 60, "é" * 60]
    texts = {i: "".join(random.choice(pool)[random.randint(0, 20) :] for _ in range(random.randint(0, 5))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in substrings.remove_repeats(df).collect()} == repeats_of(texts)


def test_a_passage_in_many_documents_is_dealt_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 20)
    random.seed(4)
    noise = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = noise(160)
    edges = [noise(30) for _ in range(5)]  # some documents share more than the passage
    texts = {i: noise(60) + random.choice(edges) + passage + random.choice(edges) + noise(60) for i in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r[0]: tuple(r)[1:] for r in substrings.remove_repeats(df).collect()} == repeats_of(texts)


def test_repeats_on_awkward_rows(awkward, nothing):
    got = [tuple(r) for r in substrings.remove_repeats(awkward).collect()]
    assert len(got) == 13 and substrings.remove_repeats(nothing).count() == 0
    by = {i: (n, gone, spans) for i, n, gone, spans, _ in got}
    assert by[3] == (0, 0, 0) and by[2] == (30, 0, 0) and by[7][0] - by[7][1] == 3 and by[7][2] == 1 and by[None][1] == 0


def test_repeats_of_a_key_with_several_texts(spark):
    a, b, c = "A quick brown fox " * 5, "bbbb" * 10 + "some passage that is shared by two documents and is long enough", "some passage that is shared by two documents and is long enough" + "ccc" * 9
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (2, "short"), (None, a), (4, b[:45])]
    got = sorted(tuple(r)[:4] for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r[0] is not None)
    shared = len("some passage that is shared by two documents and is long enough")
    assert got == sorted([(1, 90, 0, 0), (2, 90, 90, 1), (2, 103, 0, 0), (2, 103, 0, 0), (3, len(c), shared, 1), (2, 5, 0, 0), (4, 45, 0, 0)])


def test_near_groups_with_small_blocks(spark, docs, monkeypatch):
    for name, value in (("HUB", 2), ("MINORS", 2), ("OTHERS", 3)):
        monkeypatch.setattr(near, name, value)
    random.seed(5)
    base = [f"w{i}" for i in range(80)]
    texts = {i: " ".join(random.choice(["x", "y", w]) if random.random() < p else w for w in base) for i, p in enumerate([0.03] * 25 + [0.15] * 25)}
    assert {r[0]: tuple(r)[1:] for r in near.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()} == links_of(texts)


def test_near_links_just_above_the_limit(spark):
    random.seed(9)
    rows, wanted = [], 0
    for i in range(400):  # pairs of similarity between 0.80 and 0.82
        words = [f"{i}v{j}" for j in range(random.randint(150, 300))]
        other = list(words)
        while True:
            other[random.randrange(len(other))] = f"{i}z{random.random()}"
            both = len(set(zip(words, words[1:], strict=False)) & set(zip(other, other[1:], strict=False)))
            union = 2 * (len(words) - 1) - both
            if 100 * both < 82 * union:
                break
        if 100 * both >= 80 * union:
            wanted += 1
            rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    got = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).where("not kept").count()
    assert wanted > 200 and got == wanted


def test_near_groups_of_a_key_with_several_texts(spark):
    one, other, third = "a b c d e f g h i j", "q r s t u v w x y z", "k l m n o p"
    df = spark.createDataFrame([(5, one), (5, other), (5, other), (1, one), (2, other), (3, third), (3, None), (None, one)], "doc_id long, text string")
    first = {tuple(r) for r in near.near_groups(df).collect()}
    assert first == {tuple(r) for r in near.near_groups(df.orderBy("text").repartition(3)).collect()}
    components_of = {c for i, _, c, _ in first if i == 5}
    assert len(components_of) == 1 and components_of < {1, 2} and {(3, 5, 3, True), (3, 0, 3, True), (None, 9, None, True)} <= first


def test_stages_keep_columns_of_every_name(spark):
    names = "doc_id text id sha sha_ rank rank_ digest dropped n_ __id __sha __n kept keep_id text_sha256 group_size component tag".split()
    rows = [(i, t, *([str(k) for k in range(17)])) for i, t in ((1, "same words here"), (2, "same words here"), (2, "same words here"), (3, None), (4, ""))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    for keep in (exact.without_copies, near.without_near_copies):
        got = keep(df)
        assert got.columns == names and {r["rank_"] for r in got.collect()} == {"4"}
    assert sorted(r["doc_id"] for r in exact.without_copies(df).collect()) == [2, 4]
    assert sorted(r["doc_id"] for r in near.without_near_copies(df).collect()) == [1, 3, 4]
