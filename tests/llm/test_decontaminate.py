import random

import numpy as np

from opinio.llm import decontaminate as dc


def brute_align(a, b):
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = 1.0 if a[i - 1] == b[j - 1] else -0.5
            rows[i][j] = max(0.0, rows[i - 1][j - 1] + step, rows[i - 1][j] - 0.5, rows[i][j - 1] - 0.5)
            best = max(best, rows[i][j])
    return best


def test_align_matches_brute_force():
    rnd = random.Random(6)
    for _ in range(200):
        a = [rnd.randrange(5) for _ in range(rnd.randint(1, 12))]
        b = [rnd.randrange(6) for _ in range(rnd.randint(1, 30))]
        score, end = dc.align(np.array(a), np.array(b))
        assert score == brute_align(a, b)
        assert brute_align(a, b[:end]) == score


def corpus():
    rnd = random.Random(4)
    lexicon = ["".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 6))) for _ in range(300)]
    text = lambda n: [rnd.choice(lexicon) for _ in range(n)]
    items = [text(rnd.randint(15, 50)) for _ in range(30)] + [["two", "words"], ["seven"] * 2 + text(5)]
    docs = []
    for k in range(300):
        w = text(rnd.randint(0, 300))
        if k % 3 == 0:
            own = list(items[rnd.randrange(len(items))])
            for _ in range(rnd.randint(0, len(own) // 5)):
                at = rnd.randrange(len(own))
                own[at:at + 1] = rnd.choice([[], ["new"], [own[at], "more"]])
            cut = rnd.randint(0, len(w))
            w[cut:cut] = own
        docs.append(" ".join(x.upper() if rnd.random() < 0.1 else x + rnd.choice(["", "", ",", "."]) for x in w))
    docs += [" ".join(items[0])] * 200  # n-grams that are frequent in the corpus
    return docs, [" ".join(i).capitalize() + "." for i in items]


def test_matches_brute_force(spark):
    docs, items = corpus()
    drows = [(i, t, 0.5) for i, t in enumerate(docs)] + [(None, items[1], 0.5), (0, docs[0], 0.5), (9999, None, 0.5)]
    irows = [(i, t) for i, t in enumerate(items)] + [(100, None), (101, "..."), (None, items[2])]
    ddf = spark.createDataFrame(drows, "doc_id long, text string, similarity double").repartition(4)
    idf = spark.createDataFrame(irows, "item_id long, text string")
    got = {}
    for r in dc.find_contamination(ddf, idf).collect():
        got.setdefault((r.doc_id, r.item_id), []).append(r.similarity)
    words = {t: dc.words_of(t) for _, t, _ in drows} | {t: dc.words_of(t) for _, t in irows}
    for i, t, _ in drows:
        for j, u in irows:
            a, b = words[u], words[t]
            share = brute_align(a, b) / len(a) if a and b and len(set(a) & set(b)) >= 0.4 * len(set(a)) else 0.0
            found = got.get((i, j))
            if found:
                assert abs(max(found) - share) < 1e-9 and share >= (dc.LEAST if len(a) >= dc.SHORT else 1)
            else:  # edited copies within a fifth always hold a seed
                assert share < (0.7 if len(a) >= dc.SHORT else 1)
    assert any(len(found) == 2 for (i, _), found in got.items() if i == 0)
    clean = {r.doc_id for r in dc.drop_contaminated(ddf, idf).collect()}
    assert clean == {i for i, _, _ in drows} - {i for i, _ in got}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(docs, items).count() == 0
    assert dc.drop_contaminated(docs, items).count() == 1
    full = spark.createDataFrame([("q", "a b c d e f g h i j")], "item_id string, text string")
    assert dc.find_contamination(docs.limit(0), full).count() == 0
    more = spark.createDataFrame([("x", "z A, b c d e f g h i J")], "doc_id string, text string")
    assert [tuple(r)[:3] for r in dc.find_contamination(more, full).collect()] == [("x", "q", 1.0)]


def found_in(text, item, others=()):
    """Matches of one item in a text, with seeds chosen by a small corpus."""
    block = dc.Block([("q", dc.words_of(item))])
    counts = np.zeros(len(block.keys), np.int64)
    corpus = [text, *others]
    for t in corpus:
        counts[block.pairs_in(block.numbers(t))] += 1
    block.choose(counts, len(corpus))
    return block.matches(text)


def test_copies_without_three_words_in_a_row():
    words = [f"w{i}" for i in range(30)]
    replaced = [f"x{i}" if i % 3 == 2 else w for i, w in enumerate(words)]
    inserted = [y for i, w in enumerate(words) for y in ([w, f"x{i}"] if i % 2 else [w])]
    around = [f"y{i}" for i in range(50)]
    for copy in (replaced, inserted):
        share = brute_align(words, copy) / 30
        assert share >= dc.LEAST
        for others in ((), [" ".join(words)] * 50):  # also where all pairs are frequent
            got = found_in(" ".join(around + copy + around), " ".join(words), others)
            assert [(name, round(s, 9)) for name, s, _, _ in got] == [("q", round(share, 9))]
            assert 50 <= got[0][2] < got[0][3] <= 50 + len(copy)


def test_copies_in_parts():
    words = [f"w{i}" for i in range(30)]
    for gaps in ((12, 12), (30, 0), (0, 30), (15, 15), (16, 15)):
        copy = words[:10] + ["x"] * gaps[0] + words[10:20] + ["y"] * gaps[1] + words[20:]
        share = brute_align(words, copy) / 30
        text = ["z"] * 40 + copy + ["z"] * 40
        got = found_in(" ".join(text), " ".join(words))
        assert [m[1] for m in got] == ([share] if share >= dc.LEAST else [])
        assert all(brute_align(words, text[first:end]) / 30 == share for _, _, first, end in got)


def test_every_pair_from_least_on():
    rnd = random.Random(8)
    found = 0
    for k in range(400):
        lexicon = [f"w{i}" for i in range(rnd.choice([6, 20, 100]))]
        item = [rnd.choice(lexicon) for _ in range(rnd.randint(8, 40))]
        edits, copy = rnd.random() * 0.9, []
        for w in item:
            kind = rnd.random() >= edits or rnd.randrange(4)
            copy += ([rnd.choice(lexicon)], [w], [], [w, "new"], [w] + ["new"] * rnd.randint(1, 20))[
                1 if kind is True else (0, 2, 3, 4)[kind]]
        text = [rnd.choice(lexicon) for _ in range(rnd.randint(0, 60))]
        cut = rnd.randint(0, len(text))
        text[cut:cut] = copy
        share = brute_align(item, text) / len(item)
        others = [" ".join(item)] * 3 if k % 2 else [" ".join(text)] * 3
        got = found_in(" ".join(text), " ".join(item), others)
        assert [m[1] for m in got] == ([share] if share >= dc.LEAST else [])
        found += len(got)
    assert 50 < found < 350


def test_scripts_without_spaces():
    assert dc.words_of("Abc,東京 タワーx1 กข。é") == ["abc", "東", "京", "タ", "ワ", "ー", "x1", "ก", "ข", "é"]
    item = "東京で一番高い建物の名前は何ですか"
    (_, share, first, end), = found_in(f"昨日{item}と聞かれました", item)
    assert (share, first, end) == (1.0, 2, 2 + len(item))
    assert found_in("昨日東京で一番低い建物の名前は何でしょうかと聞かれました", item)
