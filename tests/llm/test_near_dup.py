import random
import re

import numpy as np
from pyspark.sql import functions as F

from wayflux.llm.components import components
from wayflux.llm.near_dup import NearDup, _dealt, _repeated, keep_one, near_dup_groups
from wayflux.llm.queries import op7_near_dup
from wayflux.llm.superminhash import signatures

WORD = re.compile(r"[^ \t-\r]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(len(words) - size + 1, 1)))


def brute(rows, size, least):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= least * len(x | y):
                root[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(sets):
        out.append((i, len(s), min(sets[j][0] for j in range(len(sets)) if find(j) == find(k))))
    return sorted(out)


def got(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


def test_all_documents_against_brute_force(spark, sf_dir, texts):
    frame = op7_near_dup(spark, sf_dir)
    assert got(frame) == brute(texts, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in frame.collect())


def test_chain_of_near_copies_that_miss_their_center(spark):
    draw = random.Random(3)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in draw.sample(range(120), draw.randrange(0, 9)):
            words[k] = f"n{i}x{k}"
        rows.append((i, " ".join(words)))
    for i in range(90, 130):  # each differs from the one before by a word
        base = list(base)
        base[(i * 7) % 120] = f"c{i}"
        rows.append((i, " ".join(base)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(near_dup_groups(frame, NearDup(3, 85))) == brute(rows, 3, 85)


def test_a_shingle_that_most_documents_hold(spark):
    """One passage stands in all texts, so its shingles are hot and shared out among tasks."""
    draw = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(240):
        words = list(passage)
        for k in draw.sample(range(60), draw.randrange(0, 4)):
            words[k] = f"n{draw.randrange(40)}"
        own = [f"o{i // 3}x{k}" for k in range(draw.choice((0, 3, 9, 30)))]
        rows.append((i, " ".join(words + own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert got(near_dup_groups(frame, NearDup(3, 85))) == brute(rows, 3, 85)


def test_shares_meet_every_row_once(spark):
    """The salted joins give what the plain ones give, hot shingles or not."""
    rows = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 0, id % 1500) as shingle", "cast(cast(id as string) as binary) as class")
    sums = rows.groupBy("shingle").agg(F.count("*").alias("size"))
    dealt = _dealt(rows, sums, "size", 5000)
    assert dealt.where("shingle = 0").agg(F.countDistinct("salt")).first()[0] > 200
    assert dealt.where("shingle > 0").agg(F.max("salt")).first()[0] == 0
    met = dealt.join(_repeated(sums, "size", 5000), ["shingle", "salt"])
    plain = rows.join(sums, "shingle")
    assert met.count() == 5000
    assert met.select(*plain.columns).exceptAll(plain).isEmpty()


def test_odd_rows(spark, odd, none):
    found = near_dup_groups(odd, NearDup(3, 85)).collect()
    assert len(found) == odd.count()
    by_size = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found}
    assert by_size[(1, 0)] == (1, True) and by_size[(2, 0)] == (2, True) and by_size[(3, 0)] == (3, True)
    assert by_size[(4, 1)] == (4, True)
    assert by_size[(5, 4)] == (None, False) and by_size[(None, 4)] == (None, True)
    assert by_size[(7, 29_999)] == (6, False) and by_size[(7, 6)] == (7, True)
    assert near_dup_groups(none).count() == 0
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert 6 in [r.doc_id for r in kept.collect()] and 5 not in [r.doc_id for r in kept.collect()]


def test_signatures_estimate_similarity_and_stop_early():
    draw = np.random.default_rng(1)
    sets = []
    for n in (1, 2, 10, 100, 1000, 5000):
        shared = draw.integers(0, 2**63, n, dtype=np.uint64)
        sets += [np.unique(np.concatenate([shared, draw.integers(0, 2**63, n // 4, dtype=np.uint64)]))
                 for _ in range(2)]
    signs = signatures(sets, 128)
    for k in range(0, len(sets), 2):
        true = len(np.intersect1d(sets[k], sets[k + 1])) / len(np.union1d(sets[k], sets[k + 1]))
        assert abs((signs[k] == signs[k + 1]).mean() - true) < 0.15
        assert (signs[k] < np.iinfo(np.uint64).max).all()
    assert (signatures([np.zeros(0, np.uint64)], 16) == np.iinfo(np.uint64).max).all()
    alone = signatures(sets[:1], 128)
    assert (alone[0] == signs[0]).all()
    assert sorted(alone[0] >> np.uint64(32)) == list(range(128))  # one element ranks each slot once


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)] \
        + [(200, k) for k in range(201, 240)]
    found = {r.node: r.root for r in components(
        spark.createDataFrame([*edges, *edges[:3]], "u bigint, v bigint")).collect()}
    assert {found[k] for k in range(41)} == {0} and {found[k] for k in (100, 101, 102)} == {100}
    assert {found[k] for k in range(200, 240)} == {200}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_rows_of_a_kept_id_stay_by_their_own_text(odd):
    assert [r.text for r in keep_one(odd).where("doc_id = 7").collect()] == ["other words stand here under the same id"]
