"""Toxicity, languages and URLs: exact search against brute force, held-out accuracy, plain rules."""

import random
import re
import zlib

import numpy as np
import pytest

from seawake.llm import toxicity
from seawake.llm.languages import declared_language, languages_of, page_text, trigrams
from seawake.llm.toxicity import BlockMaxIndex
from seawake.llm.urls import HOST_WEIGHT, REJECT, RULES, TOTAL_WEIGHT, judge, templates

# --- toxicity -----------------------------------------------------------------

BAD = ["vile", "nasty", "grobian", "schuftig", "schufterei"]


def random_documents(n, seed):
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(common, k=rng.randrange(20, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(3, 7)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_block_bounds_lose_no_neighbour():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(500):
        at = np.sort(rng.choice(40, rng.integers(0, 8), replace=False))
        weights = rng.random(len(at)) + 0.1
        vectors.append((at, weights / (np.sqrt((weights**2).sum()) or 1)))
    index = BlockMaxIndex(vectors, 40, block=16)
    dense = np.zeros((500, 40))
    for i, (at, weights) in enumerate(vectors):
        dense[i, at] = weights
    for at, weights in vectors[:150]:
        query = np.zeros(40)
        query[at] = weights
        cosines = dense @ query
        want = sorted((i for i in range(500) if cosines[i] > 1e-12), key=lambda i: (-round(cosines[i], 12), i))[:15]
        found, values = index.nearest(at, weights, 15)
        assert found.tolist() == want
        assert np.allclose(values, cosines[want])


def test_held_out_accuracy(spark):
    docs, labels = random_documents(900, 1)
    odd = [(2000, None), (2001, ""), (2002, "Vile, nasty, vile grobian!"), (2003, "schuftigste schufterei " * 3), (3, docs[3][1])]
    df = spark.createDataFrame([(*d, "x", 9) for d in docs + odd], "doc_id long, text string, label string, score int")
    known = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5] + [(None, 1), (5000, 1), (2001, None), (2000, 7)]
    model = toxicity.train(df, spark.createDataFrame(known, "doc_id long, toxic int"))
    rows = toxicity.scores(df, model).collect()
    assert len(rows) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    got = {r["doc_id"]: r["predicted"] for r in rows}
    held_out = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i] == y for i, y in held_out]) > 0.97
    assert (got[2000], got[2001], got[2002], got[2003]) == (0, 0, 1, 1)
    evidence = {r["doc_id"]: r["neighbours"] for r in rows}
    assert set(evidence[2002]) <= {i for i, _ in labels}
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in rows if not r["predicted"])


def test_few_labels_and_rare_words_count(spark):
    docs = [(i, f"calm words about thing{i} and place{i}") for i in range(12)]
    docs += [(20 + i, f"calm words about grobian{i} vileness") for i in range(3)]
    labels = [(i, int(i >= 20)) for i, _ in docs]
    df = spark.createDataFrame([*docs, (50, "grobian1 vileness"), (51, "calm words about thing3"), (52, "place7")], "doc_id long, text string")
    rows = toxicity.scores(df, toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    got = {r["doc_id"]: (r["predicted"], r["neighbours"]) for r in rows}
    assert (got[50][0], got[51][0]) == (1, 0)
    assert got[50][1][0] == 21
    assert got[52][1][0] == 7  # a term of one labelled text finds it


def test_held_out_rows_are_those_of_the_rule(spark):
    df = spark.createDataFrame([(i,) for i in range(300)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", toxicity.held_out(df["doc_id"]).alias("f")).collect():
        assert r["f"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_one_class_or_none(spark, labels):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rate = sum(y for _, y in labels) / max(1, len(labels))
    assert {r["score"] for r in toxicity.scores(df, model).collect()} == {rate}
    assert toxicity.scores(df.limit(0), model).count() == 0


# --- languages ---------------------------------------------------------------------

WORDS = {"en": ["the", "and", "with", "house", "thing"], "de": ["und", "der", "nicht", "haus", "über"], "fr": ["les", "avec", "maison", "été", "dans"]}


def prose(rng, lang, n):
    return " ".join(rng.choices(WORDS[lang], k=n))


def language_tables(spark):
    rng = random.Random(0)
    docs = [(i, prose(rng, lang, 200), lang) for i, lang in enumerate(sorted(WORDS) * 5)] + [(99, None, "en"), (98, "x", None)]
    pages, truth = [], {}
    for i in range(120):
        lang = "de" if i % 3 else rng.choice(["en", "fr"])
        other = rng.choice(sorted(WORDS))
        body = f"<html lang='{lang}'><nav>{prose(rng, other, 20)}</nav><script>{prose(rng, other, 50)}</script><p>{prose(rng, lang, 60)}</p></html>"
        pages.append((i, f"https://www.host.{'de' if lang == 'de' else 'com'}/{i}", body))
        truth[i] = lang
    pages += [(200, "https://www.host.de/x", None), (201, None, "<html lang=de></html>"), (202, "bad", f"<p>{prose(rng, 'fr', 80)}</p>"), (202, "bad", "")]
    pages += [(203, "http://a.b/", "<html lang='en'><p>" + prose(rng, "fr", 3000) + "</p>")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, host string, p int"),
        truth,
    )


def test_languages(spark):
    docs, pages, truth = language_tables(spark)
    rows = languages_of(pages, docs).collect()
    assert len(rows) == pages.count()
    got = {r["page_id"]: r for r in rows if r["page_id"] != 202}
    assert {i: got[i]["lang"] for i in truth} == truth
    assert got[200]["lang"] == "de"  # only the host speaks
    assert got[201]["lang"] == "de"  # only the declaration speaks
    assert got[203]["lang"] == "fr"  # much text outweighs a wrong declaration
    assert all(1 / 3 <= r["probability"] <= 1 + 1e-9 for r in rows)
    assert languages_of(pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in languages_of(pages, docs.limit(0)).collect()} == {None}


def test_text_of_pages():
    page = "<html lang=\"de-AT\"><style>x</style><!-- no --><nav>menu</nav><div class=\"ad\">buy</div><p>Über &amp; <b>gut</b></p><footer>f</footer>"
    assert page_text(page).split() == ["Über", "&", "gut"]
    assert (declared_language(page), declared_language("<p lang='fr'>"), declared_language("")) == ("de", "", "")
    assert len(trigrams("")) == 0
    assert len(trigrams("ab")) == 2


# --- URLs ----------------------------------------------------------------------------


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "http://NET/x", "https://sub.Example.NET/en/a?q#f", "https://example.net/en", "x://example.com/de/", "x://example.com/DE/",
    "http://my-net/", "http://a.org/fr/1#top", "http://a.org?/fr/", "http://É.org/fr/\nx", "http://a//b", "http://a/b://c/d", "http://org/fr/", "net://net",
]


def test_rules(spark):
    urls = URLS + URLS[:6]
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    rows = {r["page_id"]: r for r in judge(df).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain_rule(u)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == verdict or verdict is None and rows[i]["verdict"] in ("allow", "block")
    assert judge(df.limit(0)).count() == 0


def test_templates_grow_merge_and_judge(spark):
    rules = (("h.x", "/bad/1", "block"), ("h.x", "/good/1", "allow"), ("h.x", "/worse/1", "block"))
    urls = [f"http://h.x/{kind}/{i}" for kind in ("bad", "worse", "good", "plain") for i in range(100, 160)]
    urls += [f"http://h.x/rare{i}/{i}" for i in range(5)] + ["http://h.x/" + "a/" * 40]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {urls[r["page_id"]]: r for r in judge(df, rules, support=20).collect()}
    assert rows["http://h.x/bad/130"]["template"] == "/bad/{number}"
    # siblings with the same labels and the same shapes below are one
    assert rows["http://h.x/worse/130"]["template"] == "/bad/{number}"
    assert rows["http://h.x/good/130"]["template"] != rows["http://h.x/bad/130"]["template"]
    assert rows["http://h.x/rare3/3"]["template"] == "/{other}/{number}"
    # two thirds of the host's labels block, which decides for a template without labels of its own
    assert {rows[f"http://h.x/{k}/130"]["verdict"] for k in ("bad", "worse", "plain")} == {"block"}
    assert rows["http://h.x/good/130"]["verdict"] == "allow"


def test_purity_is_smoothed_towards_the_host(spark):
    urls = spark.createDataFrame([("h", f"/a/{i}", 1, 0, 0) for i in range(30)], "host string, path string, n long, n_block long, n_label long")
    assert {r["template"] for r in templates(urls, 20).collect()} == {"/a/{number}"}
    rows = judge(spark.createDataFrame([(i, f"http://s.org/fr/{i}") for i in range(30)], "page_id long, url string")).collect()
    # 30 labels allow, five from the host, whose 30 allow with ten from the rate of zero
    assert {round(r["purity"], 9) for r in rows} == {0.0}


def test_repeated_rows_and_even_growth_change_no_verdict(spark):
    rules = (("h.x", "/news/1", "block"), ("h.x", "/shop/1", "allow"))
    paths = [f"/{kind}/{first}{i:02d}" for kind in ("news", "shop") for first in (1, 2) for i in range(8)]
    paths += [f"/wiki/{word}/{i}" for word in ("ab", "cd", "ef", "gh", "ij", "kl") for i in range(3)]

    def verdicts(times, pages):
        urls = [(i, f"http://h.x{p}" + f"/{n}" * (pages > 1)) for i, p in enumerate(paths) for n in range(pages)] * times
        rows = judge(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()
        assert len(rows) == len(urls)
        return {(r["page_id"], r["verdict"]) for r in rows}

    once = verdicts(1, 1)
    assert (8, "block") in once  # no rule fits, its template is blocked
    assert verdicts(30, 1) == once
    assert verdicts(1, 30) == once


def test_two_samples_take_sizes_into_account(spark):
    from seawake.llm.urls import _two_samples

    cases = [({"a": 6, "b": 4}, {"a": 4, "b": 6}, False), ({"a": 600, "b": 400}, {"a": 400, "b": 600}, True), ({"a": 5}, {"a": 900}, False)]
    cases += [({"a": 30}, {"b": 30}, True), ({"a": 1}, {"b": 1}, False), ({"a": 50, "b": 1}, {"a": 70}, False)]
    df = spark.createDataFrame(cases, "one map<string, long>, other map<string, long>, want boolean")
    assert df.filter(_two_samples(df["one"], df["other"]) != df["want"]).isEmpty()


def test_every_template_is_judged_by_its_smoothed_purity(spark):
    """The verdicts against a plain count of templates, with labels of some hosts only."""
    rng = random.Random(5)
    rules = (("a.x", "/bad/", "block"), ("b.x", "/ok/", "allow"), ("c.x", "/t/1", "block"))
    urls = [f"http://{h}/{d}/{rng.randrange(100, 300)}" for h in ("a.x", "b.x", "c.x", "d.x") for d in ("bad", "ok", "t") for _ in range(40)]
    rows = judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    distinct = {(r["host"], r["path"]): r for r in rows}
    counts, hosts, total = {}, {}, [0, 0]
    for (host, _), r in distinct.items():
        if r["rule"] is not None:
            fit = next(v for h, p, v in rules if h + p == r["rule"])
            for of in (counts.setdefault((host, r["template"]), [0, 0]), hosts.setdefault(host, [0, 0]), total):
                of[0] += fit == "block"
                of[1] += 1
    for (host, _), r in distinct.items():
        (n, m), (hn, hm) = counts.get((host, r["template"]), (0, 0)), hosts.get(host, (0, 0))
        host_purity = (hn + TOTAL_WEIGHT * total[0] / total[1]) / (hm + TOTAL_WEIGHT)
        purity = (n + HOST_WEIGHT * host_purity) / (m + HOST_WEIGHT)
        assert abs(r["purity"] - purity) < 1e-9
        if r["rule"] is None:
            assert r["verdict"] == ("block" if purity >= REJECT else "allow")
    assert {r["verdict"] for r in rows if r["host"] == "d.x"} == {"block" if total[0] * 2 >= total[1] else "allow"}
