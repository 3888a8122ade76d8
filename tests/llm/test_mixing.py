import numpy as np

from wayflux.llm.common import table
from wayflux.llm.mixing import DIMENSIONS, Mix, document_rates, mixed_sample, raked
from wayflux.llm.queries import op6_mixing


def brute(cells, mix):
    """Raking, then scaling with full cells, in numpy."""
    tokens = cells["tokens"].to_numpy(float)
    total, weight, targets = tokens.sum(), tokens / tokens.sum(), {}
    for name in DIMENSIONS:
        share = cells.groupby(name)["tokens"].sum() / total
        raw = share ** mix.flatten[name]
        for value, given in mix.shares.get(name, {}).items():
            if value in raw.index:
                raw[value] = given
        targets[name] = cells[name].map(raw / raw.sum()).to_numpy()
    before = np.inf
    for _ in range(mix.rounds):
        error = 0
        for name in DIMENSIONS:
            sums = cells.assign(w=weight).groupby(name)["w"].transform("sum").to_numpy()
            step = targets[name] / sums
            weight, error = weight * step, max(error, np.abs(step - 1).max())
        if error <= mix.tolerance or error > 0.999 * before:
            break
        before = error
    ratio, scale = weight * total / tokens, mix.keep
    for _ in range(64):
        full = ratio * scale >= 1
        rest = (tokens * ratio)[~full].sum()
        better = (mix.keep * total - tokens[full].sum()) / rest if rest else scale
        if better <= scale * (1 + 1e-9):
            break
        scale = better
    return np.minimum(1, ratio * scale)


def test_rates_of_all_cells_against_brute_force(spark, sf_dir):
    for mix in (Mix(), Mix(keep=0.3, shares={"lang": {"de": 0.5, "en": 0.2}})):
        cells = raked(table(spark, sf_dir, "documents"), mix).toPandas()
        assert np.allclose(cells["rate"], brute(cells, mix), rtol=1e-6)
        assert abs((cells["rate"] * cells["tokens"]).sum() / cells["tokens"].sum() - mix.keep) < 1e-3


def test_marginals_reach_their_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    cells = raked(docs, Mix(shares={"lang": {"en": 1.0, "de": 1.0, "fr": 1.0, "es": 1.0}})).toPandas()
    share = cells.groupby("lang")["weight"].sum()
    assert np.allclose(share, 0.25, atol=0.01)


def test_sample_follows_the_rates(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    rows = op6_mixing(spark, sf_dir).toPandas()
    assert len(rows) == docs.count() and abs(rows["drawn"].mean() - rows["rate"].mean()) < 0.05
    assert sorted(r.doc_id for r in mixed_sample(docs).collect()) == sorted(rows[rows["drawn"]]["doc_id"])
    assert rows[rows["rate"] >= 1]["drawn"].all()


def test_odd_rows(spark, odd, none):
    rates = document_rates(odd).collect()
    assert len(rates) == odd.count() and {r.lang for r in rates} == {""}
    assert all(r.drawn for r in rates if r.topic == "empty")
    assert mixed_sample(odd, Mix(keep=1.0)).count() == odd.count()
    assert mixed_sample(odd).columns == odd.columns
    assert mixed_sample(none).count() == 0
    assert mixed_sample(odd.drop("source", "lang")).count() <= odd.count()
    assert mixed_sample(odd.where("text is null")).count() == 2


def test_missed_targets_are_told(spark):
    rows = [(k, "a b c d", "s1" if k % 2 else "s2", "en" if k % 2 else "de") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    against = Mix(shares={"source": {"s1": 1.0, "s2": 3.0}, "lang": {"en": 3.0, "de": 1.0}})
    missed = {r.missed for r in document_rates(docs, against).collect()}
    assert len(missed) == 1 and missed.pop() > 0.5
    assert {r.missed <= 1e-3 for r in document_rates(docs, Mix(shares={"lang": {"en": 3.0, "de": 1.0}},
            flatten={"source": 1.0, "lang": 1.0, "topic": 1.0})).collect()} == {False}
    assert all(r.missed <= 1e-3 for r in document_rates(docs).collect())
