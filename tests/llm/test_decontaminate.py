import hashlib
import re

from wayflux.llm.common import table
from wayflux.llm.decontaminate import contamination, drop_contaminated, occurrences
from wayflux.llm.queries import op10_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, span=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - span + 1, 1)):
            if w:
                windows.setdefault(tuple(w[k:k + span]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len(found - {None}),
                    hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in frame.collect()), key=str)


def test_all_documents_against_brute_force(spark, sf_dir, texts):
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    frame = op10_decontaminate(spark, sf_dir)
    assert got(frame) == brute(texts, items)
    docs = table(spark, sf_dir, "documents")
    shuffled = contamination(docs, table(spark, sf_dir, "benchmark"), broadcast_bytes=0)
    assert got(shuffled) == got(frame)
    clean = {r.doc_id for r in frame.collect() if not r.contaminated}
    assert {r.doc_id for r in drop_contaminated(docs, table(spark, sf_dir, "benchmark")).collect()} == clean


def test_odd_rows_and_items(spark, odd, none):
    items = [(1, "two three"), (2, None), (3, "..."), (None, "w100 w101 w102"), (4, "W5 w6-w7"), (4, "w5 w6 w7"),
             (5, " ".join(f"w{k}" for k in range(20, 45)))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(contamination(odd, benchmark)) == brute(docs, items)
    assert contamination(none, benchmark).count() == 0
    assert occurrences(odd, benchmark.limit(0)).count() == 0
    assert drop_contaminated(odd, benchmark).columns == odd.columns
    assert drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()


def test_main_path_is_native(spark, sf_dir):
    plan = op10_decontaminate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
