import random
import re
import tracemalloc

import numpy as np
import pytest

from opinio.llm import components, shingles
from opinio.llm import jaccard_tree as jt
from opinio.llm.components import connected_components
from opinio.llm.shingles import shingle_sets


def words(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", t) if w]


def brute_set(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def edited(rnd, w, n):
    w = list(w)
    for _ in range(n):
        w[rnd.randrange(len(w))] = rnd.choice("abcdefgh") * rnd.randint(1, 3)
    return w


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 4)))
    shared = [word() for _ in range(30)]
    texts = ["", None, " \t\n", "one", "One", "a b c d", "a  b\tC d", "a b c d e", "a b c d e f"]
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(3, 120))]
        if rnd.random() < 0.5:
            base += shared
        for _ in range(rnd.randint(1, 6)):
            texts.append(" ".join(edited(rnd, base, rnd.randint(0, 3))))
    hub = [word() for _ in range(100)]
    for _ in range(60):  # a chain: neighbours link, ends do not
        hub = edited(rnd, hub, 1)
        texts.append(" ".join(hub))
    texts += [texts[20]] * 5 + [texts[21].upper()] * 2
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[30]), (3, texts[31]), (40, texts[40]), (40, texts[40])]
    rnd.shuffle(rows)
    return rows


def test_shingle_sets():
    rnd = random.Random(1)
    texts = ["", " ", "a", "A b", "a b c d", "a b c d e", "é\x0bB\x1cc\xa0d e f g", "x " * 50_000, "q" * 3_000_000]
    texts += ["".join(rnd.choice("abAB é\n\t\x85") for _ in range(rnd.randint(0, 200))) for _ in range(500)]
    sets = list(shingle_sets(texts))
    names = {}
    for t, found in zip(texts, sets):
        want = brute_set(t)
        assert len(found) == len(want) and (np.diff(found.astype(object)) > 0).all()
        assert names.setdefault(want, found.tobytes()) == found.tobytes()
    assert len(set(names.values())) == len(names)


def test_memory_of_long_texts(monkeypatch):
    monkeypatch.setattr(shingles, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    text = " ".join(f"word{i:08d}" for i in range(230_000))  # 3 MB
    tracemalloc.start()
    [found] = shingle_sets([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 230_000 - 4
    assert peak < 50e6


def test_tree_finds_all_links():
    rnd = random.Random(9)
    for _ in range(40):
        base = [np.unique(np.array([rnd.getrandbits(64) for _ in range(rnd.randint(1, 90))], np.uint64)) for _ in range(8)]
        sets = []
        for b in base:
            for _ in range(rnd.randint(1, 9)):
                keep = b[np.array([rnd.random() < 0.93 for _ in b])]
                sets.append(np.unique(np.append(keep if len(keep) else b, b[:1])))
        rnd.shuffle(sets)
        found = set(map(frozenset, jt.SignatureTree(sets).candidates(range(len(sets)))))
        for i, a in enumerate(sets):
            for j in range(i):
                over = len(np.intersect1d(a, sets[j]))
                if 100 * over >= 80 * (len(a) + len(sets[j]) - over):
                    assert frozenset((i, j)) in found
        assert len(jt.links(sets, [0] * len(sets))) == 0


def test_tree_prunes():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 1 << 63, 200).astype(np.uint64)) for _ in range(300)]
    assert len(list(jt.SignatureTree(sets).candidates(range(300)))) < 100


@pytest.mark.parametrize("sets, seed", [(512, 1), (7, 2)])
def test_matches_brute_force(spark, monkeypatch, sets, seed):
    monkeypatch.setattr(jt, "SETS", sets)
    monkeypatch.setattr(jt, "COMBINE", 500)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, sid int").repartition(3)
    got = [tuple(r) for r in jt.jaccard_components(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_components(spark):
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 200)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(connected_components(df).collect())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_stars_need_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, name: written.append(name) or df.localCheckpoint())
    edges = [(i, i % 3) for i in range(10, 3000)] + [(i % 3, i) for i in range(10, 3000)]
    got = dict(connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect())
    assert got == {0: 0, 1: 1, 2: 2} | {i: i % 3 for i in range(10, 3000)}
    assert len(written) == 1


def test_other_texts_are_left_out_before_the_shuffle(spark):
    rows = [(f"text {i}", hash((i, "key"))) for i in range(20_000)]
    keyed = spark.createDataFrame(rows, "text string, __key long").repartition(3)
    held = spark.createDataFrame([(k,) for _, k in rows[:4000]], "key long")
    left = {tuple(r) for r in jt._maybe_among(keyed, held).collect()}
    assert set(rows[:4000]) <= left <= set(rows)
    assert len(left) < 6500
    assert jt._maybe_among(keyed, held.where("false")).count() == 0


def test_empty_table(spark):
    assert jt.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_common_passage_does_not_chain_unlike_sets(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for _ in range(30):
        own = " ".join(word() for _ in range(60))
        rows += [(len(rows), f"{own} {passage} {word()}"), (len(rows) + 1, f"{own} {passage} {word()}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    levels = jt.bucket_levels(jt.set_table(docs, "doc_id", "text"))
    blocks = connected_components(jt.link_runs(jt.prefix_rows(docs, levels, "text")))
    assert {r["count"] for r in blocks.groupBy("component").count().collect()} == {2}
    found = jt.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows))


@pytest.mark.parametrize("last", [0, 1 << 17])
def test_components_by_rounds_or_at_once(spark, monkeypatch, last):
    monkeypatch.setattr(components, "LAST", last)
    if last:  # a small graph needs no rounds
        monkeypatch.setattr(components, "_large_star", None)
        monkeypatch.setattr(components, "_are_stars", None)
    rnd = random.Random(last)
    order = rnd.sample(range(-500, 500), 600)
    pairs = [(order[i], order[i + 1]) for i in range(299)] + [(order[300], x) for x in order[301:400]]
    pairs += [(order[400 + i], order[400 + i // 2]) for i in range(1, 200)]
    rnd.shuffle(pairs)
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(7)
    want = {x: min(part) for part in (order[:300], order[300:400], order[400:]) for x in part}
    assert {r.node: r.component for r in connected_components(edges).collect()} == want


def test_a_cluster_of_near_copies_is_one_block(monkeypatch):
    """All pairs pass the tree; those that are one component by then are not looked at."""
    looked = []
    real = jt.np.intersect1d
    monkeypatch.setattr(jt.np, "intersect1d", lambda *a, **k: looked.append(1) or real(*a, **k))
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base, rng.integers(0, 2**63, 4, dtype=np.uint64)])) for _ in range(2000)]
    assert len(sets) <= jt.SETS
    tracemalloc.start()
    found = jt.links(sets, list(range(len(sets))))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(looked) == 1999
    assert most < 20 << 20
