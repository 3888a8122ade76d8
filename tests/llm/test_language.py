import math
import re
from collections import Counter, defaultdict

from wayflux.llm.common import table
from wayflux.llm.language import LanguageModel, page_languages, visible
from wayflux.llm.queries import op2_language


def grams_of(text):
    found = Counter()
    for word in re.sub(r"[^\w]+|[\d_]+", " ", text.lower()).split():
        found.update(f" {word} "[k:k + 3] for k in range(len(word)))
    return found


def brute(pages, docs, m=LanguageModel()):
    """(lang, posterior, text_lang) of each page: all evidence counted and multiplied in plain Python."""
    counts = defaultdict(Counter)
    for _, text, lang in {(i, t, x) for i, t, x in docs if None not in (i, t, x)}:
        counts[lang].update(grams_of(text))
    langs, kinds = sorted(counts), len(set().union(*counts.values()))
    bottom = {x: sum(counts[x].values()) + m.smoothing * kinds for x in langs}
    known = {g for x in langs for g, n in counts[x].items() if n >= m.least}

    def log_p(x, g):
        n = counts[x][g]
        return math.log(((n if n >= m.least else 0) + m.smoothing) / bottom[x])

    rows = []
    for _, url, html in pages:
        seen = {g: n for g, n in grams_of(visible(html)).items() if g in known}
        raw = [sum(n * log_p(x, g) for g, n in seen.items()) for x in langs]
        score = [max((s - max(raw)) * m.strength, -m.text_bound) for s in raw]
        host, path = "", ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda c: c.group().lower(), host)
        declared = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", html or "")
        address = re.match(r"/([A-Za-z]{2})(?:/|$)", path) or re.search(r"\.([a-z]{2,})$", host)
        rows.append((host, ".".join(host.split(":")[0].split(".")[-2:]), declared[1].lower() if declared else "",
                     address[1].lower() if address else "", score, langs[score.index(max(score))]))
    every = Counter(r[5] for r in rows)
    overall = {x: (every[x] + 1) / (len(rows) + len(langs)) for x in langs}
    table_of = {}
    for name, k in (("declared", 2), ("address", 3)):
        by = defaultdict(Counter)
        for r in rows:
            if r[k]:
                by[r[k]][r[5]] += 1
        sums = Counter(r[5] for r in rows if r[k])
        table_of[name] = {v: {x: math.log((c[x] + m.smoothing) / (sums[x] + m.smoothing * (len(by) + 1))) for x in langs}
                          for v, c in by.items()}
    domain, host = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        host[r[0]][r[5]] += 1
        domain[r[1]][r[5]] += 1
    out = []
    for r in rows:
        d, h = domain[r[1]], host[r[0]]
        parent = {x: (d[x] + m.prior * overall[x]) / (sum(d.values()) + m.prior) for x in langs}
        total = [s + table_of["declared"].get(r[2], {}).get(x, 0) + table_of["address"].get(r[3], {}).get(x, 0)
                 + math.log((h[x] + m.prior * parent[x]) / (sum(h.values()) + m.prior)) for s, x in zip(r[4], langs)]
        top = max(total)
        out.append((langs[total.index(top)], 1 / sum(math.exp(t - top) for t in total), r[5]))
    return out


def test_fusion_of_all_pages_against_brute_force(spark, sf_dir):
    pages = [tuple(r) for r in table(spark, sf_dir, "pages").select("page_id", "url", "html").collect()]
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "lang").collect()]
    got = {r.page_id: r for r in op2_language(spark, sf_dir).collect()}
    for (page_id, _, _), (lang, posterior, text_lang) in zip(pages, brute(pages, docs)):
        r = got[page_id]
        assert (r.lang, r.text_lang) == (lang, text_lang) and abs(r.posterior - posterior) < 1e-6, page_id


def test_very_long_page(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    html = "<html lang=en>" + "<p>the and of to in is that</p>" * 50_000
    pages = spark.createDataFrame([(1, "http://a.example.org/", html)], "page_id bigint, url string, html string")
    assert page_languages(pages, docs).first().lang == "en"


def test_all_pages_have_their_language(spark, sf_dir):
    rows = op2_language(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "pages").count()
    assert sum(r.lang == r.address for r in rows) >= 0.98 * len(rows)
    assert all(0 < r.posterior <= 1 for r in rows)


def test_evidence_decides_where_the_text_is_silent(spark):
    docs = spark.createDataFrame(
        [(k, "the cat and the dog were there with them " * 3, "en") for k in range(20)]
        + [(100 + k, "der hund und die katze waren nicht dort " * 3, "de") for k in range(20)] + [(1, "x", None), (2, None, "fr")],
        "doc_id bigint, text string, lang string")
    html = '<html lang="{}"><body>{}</body></html>'
    rows = [(k, f"http://a.en-site.com/{k}", html.format("en", "the dog and the cat were there")) for k in range(40)]
    rows += [(100 + k, f"http://b.deutsch.de/{k}", html.format("de", "die katze und der hund waren dort")) for k in range(40)]
    # Wrong markup against a clear text; nothing but the markup; nothing but the address; nothing but the host; nothing.
    rows += [(1000, "http://a.en-site.com/x", html.format("de", "the dog and the cat were there with them")),
             (1001, None, html.format("de", "")), (1002, "http://c.org.de/", "12345"), (1003, "http://new.deutsch.de:80/", None),
             (1004, None, None), (1004, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'zz' as lang", "1 as total")
    found = {r.page_id: r for r in page_languages(pages, docs).collect()}
    assert all(found[k].lang == "en" and found[100 + k].lang == "de" for k in range(40))
    assert [found[1000 + k].lang for k in range(4)] == ["en", "de", "de", "de"]
    assert found[1004].lang in ("de", "en") and found[1004].posterior < 0.9
    assert page_languages(pages, docs).count() == len(rows)
    assert page_languages(pages.limit(0), docs).count() == 0
    assert {r.lang for r in page_languages(pages, docs.limit(0)).collect()} == {None}


def test_visible_text():
    assert visible("<p>a<script>b</script><!-- c -->d&nbsp;e</p>").split() == ["a", "d", "e"]
    assert visible(None) == ""
