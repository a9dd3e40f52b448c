import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from opinio.functions.text import clean_content
from opinio.operators import similarity as sim
from tests.conftest import SF_SMALL


def brute_max_cosine(docs):
    """Plain-Python per-group TF-IDF (smooth idf, L2) and max off-diagonal cosine."""
    groups = {}
    for g, i, text in docs:
        groups.setdefault(g, []).append((i, Counter(regex.findall(r"\w\w+", text or ""))))
    out = {}
    for g, rows in groups.items():
        n = len(rows)
        df = Counter(t for _, c in rows for t in c)
        vecs = []
        for _, c in rows:
            w = {t: tf * (math.log((1 + n) / (1 + df[t])) + 1) for t, tf in c.items()}
            norm = math.sqrt(sum(x * x for x in w.values()))
            vecs.append({t: x / norm for t, x in w.items()} if norm else {})
        best = 0.0
        for a in range(n):
            for b in range(a + 1, n):
                best = max(best, sum(v * vecs[b].get(t, 0.0) for t, v in vecs[a].items()))
        out[g] = min(best, 1.0)
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    return {r.reviewer_id: r.cos_sim for r in sim.reviewer_similarity(df).collect()}


def test_hand_cases(spark):
    rows = [
        ("one", "1", "alpha beta gamma"),
        ("two", "2", "same words here"), ("two", "3", "same words here"),
        ("three", "4", "red green"), ("three", "5", "red green"), ("three", "6", "blue yellow"),
        ("disjoint", "7", "aa bb"), ("disjoint", "8", "cc dd"),
        ("empty", "9", ""), ("empty", "10", "x y"),
    ]
    got = run(spark, rows)
    assert got["one"] == 0.0
    assert got["two"] == pytest.approx(1.0)
    assert got["three"] == pytest.approx(1.0)
    assert got["disjoint"] == 0.0
    assert got["empty"] == 0.0


def test_matches_brute_force_on_documents(spark):
    from pyspark.sql import functions as F
    from opinio.sources.tables import reviews
    r = reviews(spark, SF_SMALL).select("reviewer_id", "review_id",
                                         clean_content("review_content").alias("review_content"))
    rows = [tuple(x) for x in r.collect()]
    want = brute_max_cosine(rows)
    got = {x.reviewer_id: x.cos_sim for x in sim.reviewer_similarity(r).collect()}
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], abs=1e-9), g


def test_similarity_pairs_threshold(spark):
    rows = [("g", "1", "aa bb cc"), ("g", "2", "aa bb cc"), ("g", "3", "aa zz yy"), ("g", "4", "qq rr")]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.doc_vectors(df)
    pairs = {(p.review_id_a, p.review_id_b) for p in sim.similarity_pairs(vecs, 0.9).collect()}
    assert pairs == set()  # "1" and "2" are copies: members of one class, not a pair
    assert {(r.review_id, r.class_id) for r in sim.copy_classes(vecs).collect()} >= {("1", "1"), ("2", "1")}


WORDS = st.sampled_from(["aa", "bb", "cc", "dd", "ee", "ff", "gg", "x"])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]),
                          st.lists(WORDS, min_size=0, max_size=6).map(" ".join)),
                min_size=1, max_size=12))
def test_property_exact_and_bounded(spark, docs):
    rows = [(g, str(i), t) for i, (g, t) in enumerate(docs)]
    got = run(spark, rows)
    want = brute_max_cosine(rows)
    for g, v in want.items():
        assert 0.0 <= got[g] <= 1.0
        assert got[g] == pytest.approx(v, abs=1e-9)


def test_template_reviews_stay_linear(spark):
    """One reviewer's template texts, each with a word of its own, make no pairs."""
    template = " ".join(f"word{i}" for i in range(30))
    rows = [("u", f"{i:05d}", f"{template} own{i} " + "more " * (i % 7)) for i in range(2000)]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    heads = sim.class_heads(vecs, "reviewer_id", "review_id")
    reps = heads.where("place = 1")
    assert reps.count() == 7  # one for each count of the word "more"
    assert sim.bound_pairs(reps, "reviewer_id", "review_id").count() <= 7
    zero = spark.createDataFrame([("u", 0.0)], "reviewer_id string, t double")
    assert sim.candidate_pairs(sim.postings(reps, zero, "reviewer_id", "review_id"),
                               "reviewer_id", "review_id").count() <= 21
    got = sim.max_cosine(vecs).first().cos_sim
    from collections import Counter
    import math
    few = rows[:14]  # the classes repeat, so the first of each with its twin show the maximum
    terms = [Counter(t.split()) for _, _, t in few]
    n, df_ = 2000, Counter()
    for _, _, t in rows:
        df_.update(set(t.split()))
    w = [{t: c * (math.log((1 + n) / (1 + df_[t])) + 1) for t, c in d.items()} for d in terms]
    norm = [math.sqrt(sum(x * x for x in d.values())) for d in w]
    best = max(sum(x * w[j].get(t, 0) for t, x in w[i].items()) / (norm[i] * norm[j])
               for i in range(14) for j in range(i))
    assert abs(got - best) < 1e-9


def edited_templates(n, seed=3):
    """Texts of one template, each with some words replaced by rarer ones."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"word{k}" for k in range(60)]
        for _ in range(rnd.randint(4, 12)):
            words[rnd.randrange(60)] = f"other{rnd.randrange(300)}"
        rows.append(("u", f"{i:05d}", " ".join(words)))
    return rows


def test_alike_reviews_verify_few_pairs(spark, monkeypatch):
    """2,000 near-alike, never equal reviews of one reviewer: under a tenth of the pairs is verified."""
    rows = edited_templates(2000)
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    assert vecs.select("class").distinct().count() == 2000
    verified = []

    def counted(pairs, *rest):
        pairs = sim.materialise(pairs, "counted")
        verified.append(pairs.count())
        return real(pairs, *rest)

    real = sim.verify_pairs
    monkeypatch.setattr(sim, "verify_pairs", counted)
    got = sim.max_cosine(vecs).first().cos_sim
    assert sum(verified) < 0.1 * 2000 * 1999 / 2
    assert got == pytest.approx(dense_max_cosine(rows), abs=1e-9)


def dense_max_cosine(rows):
    texts = [Counter(t.split()) for _, _, t in rows]
    n, df = len(texts), Counter(w for t in texts for w in t)
    at = {w: k for k, w in enumerate(df)}
    m = np.zeros((n, len(at)))
    for i, t in enumerate(texts):
        for w, c in t.items():
            m[i, at[w]] = c * (math.log((1 + n) / (1 + df[w])) + 1)
    m /= np.linalg.norm(m, axis=1)[:, None]
    cos = m @ m.T
    np.fill_diagonal(cos, 0)
    return min(cos.max(), 1.0)


def test_residuals_are_suffix_norms(spark):
    rnd = random.Random(8)
    for n in (0, 1, 63, 64, 65, 300):
        w = [rnd.random() / 20 for _ in range(n)]
        df = spark.createDataFrame([([(1, f"t{i}", x) for i, x in enumerate(w)],)],
                                   "entries array<struct<df:int,token:string,w:double>>")
        got = df.select(sim.residuals().alias("r")).where("size(entries) > 0").first()
        for k, x in enumerate(got.r if got else []):
            rest = math.sqrt(sum(v * v for v in w[k + 1:]))
            assert (x.token, x.w) == (f"t{k}", w[k])
            assert rest <= x.rest <= rest + 2e-6


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.8, 0.95])
def test_no_pair_above_the_threshold_is_given_up(spark, threshold):
    rnd = random.Random(9)
    rows = [("gh"[i % 2], f"{i:03d}", " ".join(rnd.choice("abcdefghijklmnop") * 2 for _ in range(rnd.randint(1, 12))))
            for i in range(90)]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    full = {(r.reviewer_id, r.review_id): {e.token: e.w for e in r.entries} for r in vecs.collect()}
    bound = spark.createDataFrame([("g", threshold), ("h", threshold)], "reviewer_id string, t double")
    cand = {(r.a, r.b): r for r in sim.candidate_pairs(sim.postings(vecs, bound, "reviewer_id", "review_id"),
                                                       "reviewer_id", "review_id").collect()}
    for (g, a), va in full.items():
        for (h, b), vb in full.items():
            if g == h and a < b:
                cos = sum(w * vb.get(t, 0) for t, w in va.items())
                assert cos < threshold or (a, b) in cand
                assert (a, b) not in cand or cand[a, b].part - 1e-9 <= cos <= cand[a, b].most + 1e-9


def test_copies_are_members_not_pairs(spark):
    rows = [("u", f"{i:03d}", "alpha beta gamma") for i in range(50)] + [("u", "900", "alpha beta delta")]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    assert [(r.review_id_a, r.review_id_b) for r in sim.similarity_pairs(vecs, 0.1).collect()] == [("000", "900")]
    members = {r.review_id: r.class_id for r in sim.copy_classes(vecs).collect()}
    assert members == {**{f"{i:03d}": "000" for i in range(50)}, "900": "900"}


def test_texts_are_read_once(spark):
    from opinio.operators.features import review_features
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from opinio.sources.tables import reviews
    for out in (sim.tfidf_weights(df.selectExpr("source AS reviewer_id", "doc_id AS review_id", "text AS review_content")),
                review_features(reviews(spark, "/root/testdata/sf0.001", with_label=False))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "documents.parquet" not in out._jdf.queryExecution().executedPlan().toString()
        assert "text#" not in plan


def dense_pairs(rows, threshold):
    """Brute-force cosines at or above the threshold, by ids."""
    out = {}
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        texts = [Counter(t.split()) for _, _, t in own]
        n, df = len(texts), Counter(w for t in texts for w in t)
        vecs = []
        for t in texts:
            v = {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in t.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            vecs.append({w: x / norm for w, x in v.items()})
        for i in range(n):
            for j in range(n):
                cos = sum(x * vecs[j].get(w, 0.0) for w, x in vecs[i].items())
                if own[i][1] < own[j][1] and cos >= threshold - 1e-9:
                    out[own[i][1], own[j][1]] = min(cos, 1.0)
    return out


@pytest.mark.parametrize("block,share", [(1 << 21, 1 / 8), (300, 0.0), (300, 1.1)])
def test_blocks_meet_each_pair_once(spark, monkeypatch, block, share):
    """Groups of one and of several blocks, tokens as dense columns and as postings."""
    monkeypatch.setattr(sim, "BLOCK_ENTRIES", block)
    monkeypatch.setattr(sim, "DENSE_SHARE", share)
    monkeypatch.setattr(sim, "_CELLS", 500)
    rows = [(g, f"{i}{g}", t) for g, n in (("u", 60), ("v", 9), ("w", 1)) for i, (_, _, t) in enumerate(edited_templates(n))]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    for threshold in (0.1, 0.35):
        pairs = sim.similarity_pairs(vecs, threshold).collect()
        want = dense_pairs(rows, threshold)
        assert {(r.review_id_a, r.review_id_b): r.cosine for r in pairs} == pytest.approx(want, abs=1e-9)
        assert len(pairs) == len(want) > 1
    best = {g: max(c for (a, _), c in dense_pairs(rows, 0.0).items() if a.endswith(g)) for g in "uv"}
    assert {r.reviewer_id: r.cos_sim for r in sim.max_cosine(vecs).collect()} == pytest.approx({**best, "w": 0.0}, abs=1e-9)


def test_alike_reviews_make_no_rows_per_pair(spark, monkeypatch):
    """No row per candidate pair and no vector per pair is made, whatever the texts have in common."""
    def never(*_):
        raise AssertionError("rows by pair")

    monkeypatch.setattr(sim, "verify_pairs", never)
    monkeypatch.setattr(sim, "candidate_pairs", never)
    rows = edited_templates(400)
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    vecs = sim.materialise(sim.doc_vectors(df))
    got = {(r.review_id_a, r.review_id_b): r.cosine for r in sim.similarity_pairs(vecs, 0.5).collect()}
    assert got == pytest.approx(dense_pairs(rows, 0.5), abs=1e-9)
    assert sim.max_cosine(vecs).first().cos_sim == pytest.approx(dense_max_cosine(rows), abs=1e-9)


def test_norms_shuffle_no_weights(spark):
    """The weights' norms need no window over all token rows: they are grouped per document, without raw weights."""
    df = spark.createDataFrame([("u", "1", "aa aa bb"), ("u", "2", "aa cc"), ("u", None, "aa"), (None, "3", "aa")],
                               "reviewer_id string, review_id string, review_content string")
    out = sim.tfidf_weights(df)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = {(r.review_id, r.token): r for r in out.collect()}
    assert set(rows) == {("1", "aa"), ("1", "bb"), ("2", "aa"), ("2", "cc"), (None, "aa")}
    raw = [2 * 1.0, math.log(4 / 2) + 1]
    assert rows["1", "aa"].weight == pytest.approx(raw[0] / math.hypot(*raw)) and rows["1", "aa"].tf == 2
    assert rows["1", "aa"].df == 3 and rows[None, "aa"].weight == pytest.approx(1.0)


def test_one_id_for_two_documents_is_an_error(spark):
    df = spark.createDataFrame([("u", "1", "aa bb"), ("u", "1", "aa cc"), ("u", "2", "bb aa cc")],
                               "reviewer_id string, review_id string, review_content string")
    with pytest.raises(Exception, match="have one id"):
        sim.similarity_pairs(sim.materialise(sim.doc_vectors(df)), 0.1).collect()


def test_vectors_have_no_row_per_word(spark):
    df = spark.createDataFrame([("g", str(i), f"alpha beta w{i}") for i in range(20)],
                               "reviewer_id string, review_id string, review_content string")
    plan = sim.doc_vectors(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "FlatMapGroupsInArrow" in plan


def test_vectors_of_blocks_equal_those_of_whole_groups(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(f"g{i % 2}", str(i // 2), " ".join(rng.choices([f"t{k}" for k in range(60)] + ["é", "zz", "x"], k=rng.randint(0, 30))))
            for i in range(120)]
    rows += [("g0", "1", "t1 t2 t1 own"), ("g0", None, "t3 t4"), ("g0", None, "t3"), ("g1", "900", None), (None, "5", "t1 t2")]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")

    def found():
        out = {}
        for r in sim.doc_vectors(df).collect():
            out[r.reviewer_id, r.review_id] = (
                [(e.df, e.token, round(e.w, 9)) for e in r.entries], round(r.norm, 9), round(r.shared, 9), r.whole)
        return out

    whole = found()
    raw = {}
    for r in sim.raw_weights(df, "reviewer_id", "review_id", "review_content").collect():
        raw.setdefault((r.reviewer_id, r.review_id), []).append(r)
    assert whole.keys() == raw.keys()
    for key, terms in raw.items():
        norm = math.sqrt(sum(t.raw ** 2 for t in terms))
        shared = sorted((t.df, t.token, t.tf, round(t.raw / norm, 9)) for t in terms if t.df >= 2)
        assert whole[key][0] == [(d, t, w) for d, t, _, w in shared]
        assert whole[key][1:] == (round(norm, 9), round(sum(t.raw ** 2 for t in terms if t.df >= 2), 9),
                                  all(t.df >= 2 for t in terms))
    monkeypatch.setattr(sim, "VECTOR_WORDS", 300)
    monkeypatch.setattr(sim, "BIN_WORDS", 100)
    assert found() == whole


def test_weights_have_no_row_per_word_in_a_shuffle(spark, monkeypatch):
    """Whole groups and blocks of them give the weights that follow from the counts, also for repeated and missing ids."""
    rng = random.Random(5)
    rows = [(f"g{i % 2}", str(i // 2), " ".join(rng.choices([f"t{k}" for k in range(60)] + ["é", "zz", "x"], k=rng.randint(0, 30))))
            for i in range(120)]
    rows += [("g0", "1", "t1 t2 t1 own"), ("g0", None, "t3 t4"), ("g0", None, "t3"), ("g1", "900", None), (None, "5", "t1 t2")]
    df = spark.createDataFrame(rows, "reviewer_id string, review_id string, review_content string")
    plan = sim.tfidf_weights(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "FlatMapGroupsInArrow" in plan
    terms = sim.raw_weights(df, "reviewer_id", "review_id", "review_content").collect()
    norms = Counter()
    for r in terms:
        norms[r.reviewer_id, r.review_id] += r.raw ** 2
    want = Counter((r.reviewer_id, r.review_id, r.token, r.tf, r.df, round(r.raw / math.sqrt(norms[r.reviewer_id, r.review_id]), 9))
                   for r in terms)

    def found():
        out = sim.tfidf_weights(df)
        assert out.columns == ["reviewer_id", "review_id", "token", "tf", "df", "weight"]
        return Counter((*r[:5], round(r.weight, 9)) for r in out.collect())

    assert found() == want
    monkeypatch.setattr(sim, "VECTOR_WORDS", 300)
    monkeypatch.setattr(sim, "BIN_WORDS", 100)
    assert found() == want
