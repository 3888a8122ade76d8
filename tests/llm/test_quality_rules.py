import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from wayflux.llm.common import table
from wayflux.llm.queries import op12_quality_rules, training_rows
from wayflux.llm.quality_rules import (
    Condition, Covering, DecisionList, learn_rules, quality_report, text_statistics)

SPACE = "[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def check(got, texts):
    for r in got:
        counts = brute(texts[r.doc_id])
        assert tuple(r)[1:6] == counts, r.doc_id
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed and r.rule is None)


def test_counts_of_all_documents_against_brute_force(spark, sf_dir, texts):
    got = op12_quality_rules(spark, sf_dir).collect()
    assert len(got) == len(texts)
    check(got, dict(texts))


def test_hard_texts(spark):
    run = " ".join(f"w{k}" for k in range(9))
    texts = {1: None, 2: "", 3: " \n\t\x0b\x0c\r ", 4: run, 5: f"{run} {run}", 6: "a " * 8, 7: "a " * 9, 8: "a b " * 40,
             9: f"{run} x {run} y {run} z", 10: "same\nsame \nsame\n\n\n \nsame", 11: "\U0001f600  é #*$%&|<> <\x00>",
             12: " ".join(f"w{k % 7919}" for k in range(40_000)), 13: "z" * 200_000, 14: ("p q r s t u v w " * 2 + "break ") * 3}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    check(quality_report(frame, labels).collect(), texts)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op12_quality_rules(spark, sf_dir).collect()}
    seen = [(got[r.doc_id].kept, r.quality) for r in table(spark, sf_dir, "labels").collect()
            if held_out(r.doc_id) and not got[r.doc_id].base_failed]
    assert len(seen) > 50
    assert sum(kept == bool(quality) for kept, quality in seen) >= 0.97 * len(seen)
    assert all(kept for kept, quality in seen if quality)


def test_labels_of_the_held_out_fifth_are_not_learnt(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    flipped = labels.withColumn("quality", F.when(training_rows(), F.col("quality")).otherwise(1 - F.col("quality")))
    stats = text_statistics(docs)
    assert learn_rules(stats, labels, usable=training_rows()) == learn_rules(stats, flipped, usable=training_rows())


def made(spark, rows):
    """Statistics with given symbols, capitals and line lengths; all else alike."""
    fixed = {c: "0.0D" for c in ("word_length", "shouting", "digits", "bars", "dup_lines", "repeats", "open_lines")}
    return spark.createDataFrame(rows, "doc_id bigint, symbols double, capitals double, line_words double").select(
        "*", F.lit(100).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_repeat_words"),
        F.lit(1.0).alias("distinct_words"), *[F.expr(v).alias(c) for c, v in fixed.items()])


def test_conjunctions_are_learnt_in_order_and_pruned(spark):
    rows, labels = [], []
    for k in range(1200):
        symbols, capitals, line = k % 10 / 10, k // 10 % 10 / 10, float(k // 100)
        bad = (symbols >= 0.5 and capitals >= 0.6) or line < 1
        rows.append((k, symbols, capitals, line + k / 1e5))
        labels.append((k, 0 if bad else 1))
    stats = made(spark, rows)
    learnt = learn_rules(stats, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert 2 <= len(learnt.rules) <= 3
    names = [{c.name for c in rule} for rule in learnt.rules]
    assert {"symbols", "capitals"} in names and {"line_words"} in names
    said = {r.doc_id: r.k for r in stats.select("doc_id", learnt.first().alias("k")).collect()}
    assert sum((said[k] is None) == bool(good) for k, good in labels) >= 0.98 * len(labels)


def test_noise_gives_no_rules(spark):
    rows = [(k, k * 7 % 11 / 10, k * 5 % 13 / 10, k * 3 % 17 / 10) for k in range(600)]
    labels = spark.createDataFrame([(k, int(zlib.crc32(b"%d" % k) % 10 > 0)) for k in range(600)], "doc_id bigint, quality int")
    assert learn_rules(made(spark, rows), labels) == DecisionList()


def test_one_class_no_labels_and_repeated_ids(spark):
    stats = made(spark, [(1, 0.1, 0.0, 1.0), (1, 0.9, 0.0, 1.0), (2, 0.5, 0.0, 1.0), (None, 0.9, 0.0, 1.0)])
    for marks in ([], [(1, 1), (2, 1)], [(1, 0), (2, 0)], [(1, None), (None, 0), (2, 7)], [(1, 0), (1, 1), (2, 1)]):
        labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
        assert learn_rules(stats, labels, Covering(support=5)) == DecisionList()
    assert stats.select(DecisionList().first().alias("k"), DecisionList().text().alias("t")).distinct().count() == 1


def test_conditional_chain(spark):
    listed = DecisionList(((Condition("symbols", True, 0.5), Condition("capitals", False, 0.2)), (Condition("line_words", False, 2.0),)))
    stats = made(spark, [(1, 0.5, 0.1, 9.0), (2, 0.5, 0.2, 9.0), (3, 0.6, 0.0, 1.0), (4, 0.0, 0.9, 1.5)])
    got = {r.doc_id: (r.k, r.t) for r in stats.select("doc_id", listed.first().alias("k"), listed.text().alias("t")).collect()}
    assert got == {1: (0, "symbols >= 0.5 and capitals < 0.2"), 2: (None, None), 3: (0, "symbols >= 0.5 and capitals < 0.2"),
                   4: (1, "line_words < 2")}


def test_the_sample_is_bounded_by_a_hash(spark):
    from wayflux.llm.quality_rules import labelled_rows

    rows = [(k, k / 4000, 0.0, float(k)) for k in range(4000)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(4000)] * 3, "doc_id bigint, quality int")
    taken = labelled_rows(made(spark, rows), labels, Covering(labelled=500), None)
    assert 400 < taken.count() < 600
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan


def test_odd_rows_and_native_plan(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, 0)], "doc_id bigint, quality int")
    assert quality_report(odd, labels).count() == odd.count() and quality_report(none, labels).count() == 0
    plan = quality_report(odd, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
