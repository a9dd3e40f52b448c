import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from opinio.llm import merkle as mk

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout):
    """Each node's proof as (place, siblings) by level, and the last node."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // fanout * fanout:k // fanout * fanout + fanout]
            proofs[i].append((k % fanout, run[:k % fanout] + run[k % fanout + 1:]))
        nodes = [H(*nodes[k:k + fanout]) for k in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return proofs, nodes[0]


def brute(rows, fanout, claims=None):
    """(id, leaf) -> (subroot, root, proof digest, folded root), as sorted tuples."""
    groups = {}
    for r, c in zip(rows, claims or rows):
        groups.setdefault(r[1], []).append((r[0], H(*map(enc, r)), H(*map(enc, c))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        below[s] = climb([x[1] for x in groups[s]], fanout)
    tops, root = climb([below[s][1] for s in order], fanout)
    out = []
    for s, top in zip(order, tops):
        for (i, leaf, claim), proof in zip(groups[s], below[s][0]):
            node = claim
            for at, others in proof + top:
                node = H(*others[:at], node, *others[at:])
            out.append((i, leaf, below[s][1], root, H(*(d for _, o in proof + top for d in o)), node))
    return sorted(out, key=repr)


def collected(df):
    rows = df.collect()
    return sorted(((r.doc_id, *(bytes(r[x]).hex() for x in ("leaf", "subroot", "root", "proof_digest", "folded_root")))
                   for r in rows), key=repr)


OUT = ("leaf", "subroot", "root", "proof_digest", "folded_root")


@pytest.mark.parametrize("fanout,depth,sizes", [
    (2, 1, [1, 2, 3, 5, 8, 13]), (3, 1, [1, 10, 28, 55]), (2, 2, [37, 4, 1, 9, 16, 17]), (16, 3, [40, 1, 17]),
])
def test_matches_brute_force(spark, fanout, depth, sizes):
    rnd = random.Random(fanout * 10 + depth)
    rows = []
    for s, n in enumerate(sizes):
        source = None if s == 0 else "é" * s if s % 2 else f"S{s}"
        rows += [(rnd.randint(-50, 50), source, rnd.choice(["en", None]), rnd.choice([None, 3]),
                  rnd.choice(["", "Text É", None, f"x{rnd.random()}"])) for _ in range(n)]
    rows += [(None, "S2", None, None, None), rows[-1], rows[-1]]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", grp string, hash string").repartition(5)
    claims = [(*r[:4], r[4] and r[4].replace("Text", "text")) for r in rows]
    got = mk.manifest(df, claims={"text": F.replace(F.col("text"), F.lit("Text"), F.lit("text"))}, fanout=fanout,
                      depth=depth, outputs=OUT)
    assert collected(got) == brute(rows, fanout, claims)


def test_proofs_fold_to_the_root(spark):
    rows = [(i, f"s{i % 3}", "en", i, "a" * i) for i in range(100)] + [(200, None, None, None, "long " * 200_000)]
    got = mk.manifest(spark.createDataFrame(rows, SCHEMA), fanout=4, depth=2).collect()
    assert len(got) == len(rows) and len({bytes(r.root) for r in got}) == 1
    for r in got:
        proof = [(x["at"], [bytes(d) for d in x["others"]]) for x in r.proof]
        assert mk.fold(bytes(r.leaf), proof) == bytes(r.root)
        assert mk.fold(b"x" * 32, proof) != bytes(r.root)


def test_query_matches_brute_force(spark):
    from opinio.llm.queries import op13_merkle

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "source", "lang", "n_chars", "text").collect()]
    bend = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    claims = [(*r[:4], r[4].translate(bend) if r[4] and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]) for r in rows]
    got = op13_merkle(spark, sf).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute(rows, 16, claims)
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert any(not r.verified for r in got)


def test_lone_rows_and_empty_tables(spark):
    one = spark.createDataFrame([(7, "a", None, 1, "t")], SCHEMA)
    r = mk.manifest(one, outputs=OUT).first()
    assert bytes(r.leaf) == bytes(r.subroot) == bytes(r.root) == bytes(r.folded_root)
    assert bytes(r.proof_digest).hex() == H("")
    assert mk.manifest(one.limit(0), outputs=OUT).count() == 0


def test_id_named_like_an_output(spark):
    df = spark.createDataFrame([(1, "a", "t"), (2, "a", "u")], "root long, g string, text string")
    got = mk.manifest(df, id_col="root", group_col="g", fields=("root", "text"), outputs=("leaf", "root"))
    assert got.columns == ["root", "leaf", "root_"]
    assert sorted(r["root"] for r in got.collect()) == [1, 2]
