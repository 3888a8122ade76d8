import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import brute as contaminated
from test_near_dup import brute as groups
from wayflux.llm.common import stored, table
from wayflux.llm.mixing import document_rates
from wayflux.llm.queries import op3_toxicity
from test_token_files import brute as token_rows


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    steps, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, sf_dir), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.schema == docs.schema
        steps.append(now)
    rows = [sorted((r.doc_id, r.text) for r in s.collect()) for s in (docs, *steps[:4])]
    toxic = {r.doc_id for r in op3_toxicity(spark, sf_dir).where("predicted = 1").collect()}
    assert rows[1] == [r for r in rows[0] if r[0] not in toxic]
    root = {i: r for i, _, r in groups(rows[1], 5, 80)}
    assert rows[2] == [r for r in rows[1] if root[r[0]] == r[0]]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hit = {r[0] for r in contaminated(rows[2], items) if r[-1]}
    assert rows[3] == [r for r in rows[2] if r[0] not in hit]
    drawn = {r.doc_id for r in document_rates(steps[2]).where("drawn").collect()}
    assert rows[4] == [r for r in rows[3] if r[0] in drawn]
    assert sorted(tuple(r) for r in steps[4].collect()) == token_rows(rows[4])
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in steps[4].collect())


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "tokens"]
    assert all(re.fullmatch(r"\w+", n) for n, _ in corpus_pipeline.STAGES)


def test_odd_rows_pass_all_stages(spark, sf_dir, odd, none):
    now = odd.withColumn("n_chars", F.length("text")).unionByName(
        table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "source", "lang", "7 as id", "'x' as class",
                                                     "1 as tokens", "'t' as word", "2 as rank", "cast(n_chars as int) n_chars"))
    empty, columns = none.withColumn("n_chars", F.length("text")), now.columns
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, sf_dir), f"odd-{name}")
        empty = stored(stage(spark, empty, sf_dir), f"none-{name}")
        assert empty.count() == 0, name
        if name != "tokens":
            assert now.columns == empty.columns == columns, name
            kept = Counter((r.doc_id, r.text and r.text[:3]) for r in now.where("source = 'src0' and class = 'x'").collect())
            assert kept[1, None] and kept[None, None] and kept[2, ""], name
    assert now.where("doc_id is null").count() >= 1 and now.where("n_tokens = 1").count() >= 3
