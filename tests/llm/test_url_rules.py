import random

import pytest

from corpusloom.llm import url_rules as U


def test_parts_and_explicit_rules(spark):
    urls = {
        1: ("http://WWW.Example.ORG/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
        2: (None, "", "", None, "allow"),
        3: ("no scheme", "", "", None, "allow"),
        4: ("http://a.org", "a.org", "", None, "allow"),
        5: ("http://a.example.org/en/12#/es/", "a.example.org", "/en/12", "example.org/en/1", "block"),
        6: ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        7: ("x://com/fr/?://", "com", "/fr/", "com/fr/", "allow"),
        8: ("x://a.COM/de/", "a.com", "/de/", "com/de/", "block"),
        9: ("x://a.com?/de/", "a.com", "", None, "allow"),
        10: ("a://b://c.com/de/", "b:", "//c.com/de/", None, "allow"),
        11: ("", "", "", None, "allow"),
        12: ("x://ÀB.com/DE/\nz", "Àb.com", "/DE/\nz", None, "allow"),
    }
    df = spark.createDataFrame([(k, v[0], "clash", "clash") for k, v in urls.items()] + [(None, None, "", ""), (8, urls[8][0], "", "")], "page_id long, url string, host string, rule string")
    out = U.judge(df, spark.createDataFrame([], U.MINED), "allow").collect()
    assert len(out) == len(urls) + 2
    for r in out:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:]


def labelled(spark):
    pages, labels = [], []
    for i in range(400):
        spam = i % 4 == 0
        pages.append((i, f"http://{'cheap' if spam or i % 8 == 1 else 'good'}.shop.net/{'pills' if spam else 'news'}/{i}.html"))
        labels.append((i, 0 if spam else 1, 0))
    return spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_mined_rules_against_counts(spark):
    pages, labels = labelled(spark)
    mined, usual = U.mine(pages, labels, confidence=0.9)
    assert usual == "allow"
    host, path = U.url_parts(pages["url"])
    rows = pages.select("page_id", U.url_tokens(pages["url"], host, path).alias("t")).collect()
    rules = [U.Mined(tuple(r.tokens), r.verdict, r.confidence, r.pages) for r in mined.collect()]
    assert rules
    for rule in rules:
        on = [r.page_id for r in rows if set(rule.tokens) <= set(r.t)]
        right = [i for i in on if (i % 4 == 0) == (rule.verdict == "block")]
        assert rule.pages == len(right) >= U.LEAST_PAGES and abs(rule.confidence - len(right) / len(on)) < 1e-9 and rule.confidence >= 0.9
    assert any(r.tokens == ("path:pills",) and r.verdict == "block" for r in rules)
    assert not any(set(r.tokens) > {"path:pills"} and r.verdict == "block" for r in rules)
    out = {r.page_id: r.verdict for r in U.judge(pages, mined, usual).collect()}
    assert out == {i: "block" if i % 4 == 0 else "allow" for i in range(400)}


def random_rules(n, seed):
    rng = random.Random(seed)
    drawn = {(tuple(sorted(rng.sample("abcdefgh", rng.randint(1, 5)))), rng.choice(("allow", "block"))) for _ in range(n)}
    return [U.Mined(t, v, rng.choice((0.6, 0.7, 0.8, 0.9)), rng.randint(1, 3)) for t, v in sorted(drawn)]


def test_needed_rules_against_all_pairs(spark):
    rules = random_rules(200, 1)
    out = U.needed(spark.createDataFrame(rules, U.MINED)).collect()
    want = {r for r in rules if not any(set(p.tokens) < set(r.tokens) and p.verdict == r.verdict and p.confidence >= r.confidence for p in rules)}
    assert len(out) == len(want) < len(rules)
    assert {U.Mined(tuple(r.tokens), r.verdict, r.confidence, r.pages) for r in out} == want


def test_tokens_shared_by_a_group_give_single_rules(spark):
    urls = [(i, "http://a.b.c.net/d/e/f/g/h" if i % 2 else "ftp://x.org/y") for i in range(80)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    mined, _ = U.mine(pages, labels)
    rows = mined.collect()
    assert all(len(r.tokens) == 1 and r.confidence == 1 for r in rows)
    assert sum(r.verdict == "block" for r in rows) == 10


@pytest.mark.parametrize("held", [0, 1000])
def test_index_finds_what_a_scan_finds(spark, held):
    rng = random.Random(2)
    rules = [r._replace(tokens=tuple(f"host:{t}" for t in r.tokens)) for r in random_rules(60, 3)]
    hosts = [".".join(rng.sample("abcdefghij", rng.randint(1, 7))) for _ in range(200)] + ["", "a", "a"]
    pages = spark.createDataFrame([(i, f"x://{h}", "clash") for i, h in enumerate(hosts)] + [(None, None, "")], "page_id long, url string, verdict string")
    out = U.judge(pages, spark.createDataFrame(rules, U.MINED), "allow", explicit=(), held_rules=held).collect()
    assert len(out) == len(hosts) + 1
    for r in out:
        fits = [x for x in rules if r.page_id is not None and set(x.tokens) <= {f"host:{t}" for t in hosts[r.page_id].split(".")}]
        best = min(fits, key=U.Mined.rank, default=None)
        assert (r.mined_rule, r.mined_confidence, r.verdict) == ((" ".join(best.tokens), best.confidence, best.verdict) if best else (None, None, "allow"))


def test_empty_tables(spark):
    pages, labels = labelled(spark)
    mined, usual = U.mine(pages, labels.limit(0))
    assert (mined.count(), usual) == (0, "allow")
    assert U.filter_pages(pages.limit(0), labels).count() == 0
    nulls = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, quality int, toxic int")
    assert U.filter_pages(pages, nulls).filter("verdict = 'allow'").count() == 400
