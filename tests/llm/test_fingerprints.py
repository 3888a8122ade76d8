import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from wayflux.llm.fingerprints import (
    CELLS, difference, edited_fingerprints, estimated, likeness, peeled, sketch, subtracted, with_next)
from wayflux.llm.queries import op1_fingerprints


def digest(*parts):
    h = 42
    for part in parts:
        h = xxhash.xxh64_intdigest(part.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def cut(units, between, ends):
    out, start = [], 0
    for k in range(1, len(units) + 1):
        if k == len(units) or ends(units, k):
            out.append(between.join(units[start:k]))
            start = k
    return out


def paragraphs(text):
    """Sentences of lines; those of over 400 characters in pieces, and words of over 100 in them."""
    found = set()
    for sentence in (x for line in text.split("\n") for x in re.split(r"(?<=[.!?]) ", line)):
        if len(sentence) <= 400:
            found.add(sentence)
            continue
        words = [part for word in sentence.split(" ") for part in (
            [word] if len(word) <= 100 else cut(list(word), "", lambda u, k: k >= 4 and digest(*u[k - 4:k]) % 32 == 0))]
        found |= set(cut(words, " ", lambda u, k: digest(u[k - 1]) % 8 == 0))
    return {p for p in found if p.strip(" ")}


def long_bits(value):
    return value & (1 << 64) - 1


def number_hash(*values):
    h = 42
    for v in values:
        h = (xxhash.xxh64_intdigest(v.encode(), seed=h) if isinstance(v, str)
             else xxhash.xxh64_intdigest(long_bits(v).to_bytes(8, "little"), seed=h))
    return h - (1 << 64) if h >> 63 else h


def written(text):
    """The published form of a sketch, cell by cell."""
    cells = {}
    for key in {digest(p) for p in paragraphs(text)}:
        check = number_hash(key, "check") & 0xFFFFFFFF
        for table in range(3):
            at = (long_bits(number_hash(key, CELLS)) >> 21 * table) % CELLS + table * CELLS
            n, k, c = cells.get(at, (0, 0, 0))
            cells[at] = (n + 1, k ^ long_bits(key), c ^ check)
    return ",".join(f"{i}-{n:x}-{k:x}-{c:x}" for i, (n, k, c) in sorted(cells.items()) if n or k or c)


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(texts):
    out = []
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    round(alike(paragraphs(t), paragraphs(edited)), 9),
                    round(alike(paragraphs(t), paragraphs(following)), 9)))
    return out


def test_all_documents_against_brute_force(spark, sf_dir, texts):
    rows = op1_fingerprints(spark, sf_dir).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
            for r in rows] == brute(texts)
    prints = {}
    for k, ((_, text), row) in enumerate(zip(texts, rows)):
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint == written(text)
        half = len(text) // 2
        assert row.edited_fingerprint == written(text[:len(text) - half] + texts[(k + 1) % len(texts)][1][:half])


def test_odd_rows(spark, odd, none):
    rows = edited_fingerprints(odd.where("doc_id is null or doc_id <> 7")).collect()
    assert len(rows) == odd.count() - 2
    fives = [r for r in rows if r.doc_id == 5]
    assert len(fives) == 2 and fives[0] == fives[1]
    by = {(r.doc_id, r.n_chars): r for r in rows}
    assert by[(1, 0)].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[(1, 0)].fingerprint == by[(2, 0)].fingerprint and by[(1, 0)].near_next == 1.0
    assert by[(4, 3)].near_edited == 0.0
    assert edited_fingerprints(none).count() == 0
    alone = edited_fingerprints(odd.where("doc_id = 4")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"ono").hexdigest()


def test_next_crosses_neighbourhoods(spark):
    docs = spark.range(0, 1100).selectExpr("id * 3 as doc_id", "concat('t', id) as text").repartition(7)
    found = {r.doc_id: r.next_text for r in with_next(docs, 7).collect()}
    assert found == {3 * k: f"t{(k + 1) % 1100}" for k in range(1100)}


def test_null_ids_are_spread_by_their_texts(spark):
    docs = spark.range(0, 500).selectExpr("cast(null as bigint) as doc_id", "concat('t', id) as text")
    more = docs.unionByName(docs).unionByName(spark.createDataFrame([(1, "last")], "doc_id bigint, text string"))
    found = with_next(more, 10).collect()
    assert len(found) == 501 and Counter(r.times for r in found) == {2: 500, 1: 1}
    step, seen, at = {r.text: r.next_text for r in found}, [], "last"
    for _ in found:
        at = step[at]
        seen.append(at)
    assert len(set(seen)) == 501 and seen[-1] == "last"


def test_estimate_follows_the_difference_and_one_pass_equals_subtracting(spark):
    draw = random.Random(3)
    for shared, mine, theirs in ((50, 3, 4), (10, 60, 60), (500, 200, 5), (0, 900, 900)):
        keys = [draw.randrange(-2**63, 2**63) for _ in range(shared + mine + theirs)]
        frame = spark.createDataFrame([(keys[:shared + mine], keys[:shared] + keys[shared + mine:])] , "a array<bigint>, b array<bigint>")
        frame = frame.withColumns({"x": sketch(F.col("a")), "y": sketch(F.col("b"))}).withColumn("d", subtracted("x", "y"))
        row = frame.select(estimated(F.col("d"), F.size("a"), F.size("b"), CELLS).alias("e"),
                           (F.col("d") == difference("a", "b", CELLS)).alias("same")).first()
        assert row.same and 0.4 * (mine + theirs) <= row.e <= 2 * (mine + theirs), (mine, theirs, row.e)


def test_peeling_recovers_both_sides_and_fails_honestly(spark):
    draw = random.Random(2)
    keys = [draw.randrange(-2**63, 2**63) for _ in range(600)]
    rows = [(keys[:20], keys[3:24]), ([], []), (keys[:5], []), (keys[:2], keys[:2]), (keys[:300], keys[300:])]
    frame = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    frame = frame.select("a", sketch(F.col("a")).alias("x"), sketch(F.col("b")).alias("y"), F.size("a").alias("n"))
    found = frame.select(peeled(subtracted("x", "y")).alias("p"), "n").select(
        "p.mine", "p.theirs", likeness(F.col("n"), F.col("p")).alias("near")).collect()
    assert set(found[0].mine) == set(keys[:3]) and set(found[0].theirs) == set(keys[20:24])
    assert [r.near for r in found] == [17 / 24, 1.0, 0.0, 1.0, None]


def test_main_path_is_native(spark, sf_dir):
    plan = op1_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edited_texts_of_one_line_share_paragraphs(spark):
    draw = random.Random(5)
    words = [f"w{draw.randrange(10**6)}" for _ in range(1200)]
    rows = [(1, " ".join(w + "." * (k % 8 == 7) for k, w in enumerate(words[:120]))),  # sentences of one line
            (2, " ".join(words[120:600])),  # one long sentence
            (3, "".join(words[600:]))]  # one long word
    assert len(rows[0][1]) < 1000 and max(len(p) for p in rows[0][1].split(". ")) < 100
    found = {r.doc_id: r for r in edited_fingerprints(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i in (1, 2, 3):
        assert 0.2 < found[i].near_edited < 0.5 and found[i].near_next == 0.0, i
