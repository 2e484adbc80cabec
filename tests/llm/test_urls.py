"""URL filter: parsing and policy against plain Python, mined rules against brute force."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from watchfold.llm import urls

URLS = [
    "http://www.Example.NET/en/1?a=1#x",
    "https://example.net",
    "https://example.net/en/",
    "https://net/x",
    "https://a.b.example.com/de/9.html",
    "https://example.com/de",
    "https://notexample.com/de/1",
    "http://x.org/fr/?q=/de/",
    "ftp://x.org?fr/",
    "//x.net/a",
    "x.net/a",
    "a://b://c.net/d",
    "http://:80/",
    "://",
    "http://host#frag/path",
    "http://exa\nmple.net/e\nn?x",
    "",
    None,
    "http://" + "a." * 5000 + "net/" + "p/" * 5000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return host.translate({c: c + 32 for c in range(65, 91)}), tail[:end]


def plain_rule(host, path):
    fits = []
    for _, rule in urls.POLICY:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


@pytest.fixture()
def pages(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(1, URLS[1]), (None, URLS[0])]
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "0 as verdict")


def test_hosts_paths_and_rules(pages):
    rows = urls.judge(pages).collect()
    assert len(rows) == len(URLS) + 2
    verdicts = {rule: verdict for verdict, rule in urls.POLICY}
    by_id = {r["page_id"]: r for r in rows if r["page_id"] is not None}
    for i, url in enumerate(URLS):
        host, path = plain(url)
        assert (by_id[i]["host"], by_id[i]["path"]) == (host, path), url
        rule = plain_rule(host, path)
        assert by_id[i]["rule"] == rule
        if rule:
            assert by_id[i]["verdict"] == verdicts[rule]
        if not host:
            assert by_id[i]["verdict"] == "allow"


def test_mined_rules_agree_with_brute_force(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url").distinct()
    given = given.filter("url is not null")
    given = given.withColumn("verdict", urls.policy_verdict(urls.policy_rule(urls.host(F.col("url")), urls.path(F.col("url")))))
    found = {(tuple(r["tokens"]), r["verdict"]): r for r in urls.mine(given, 0.1, 0.7, least_urls=1).collect()}
    rows = [(set(r["t"]), r["verdict"]) for r in given.filter("verdict is not null").withColumn("t", urls.tokens(F.col("url"))).collect()]
    total = len(rows)
    counts = {x: sum(x in s for s, _ in rows) for t, _ in rows for x in t}
    often = {x for x, n in counts.items() if 0.1 * total <= n < total}
    rules = {}
    for size in (1, 2, 3):
        for some in combinations(sorted(often), size):
            having = [v for t, v in rows if t.issuperset(some)]
            for verdict in ("block", "allow"):
                n, base = having.count(verdict), sum(v == verdict for _, v in rows) / total
                if n >= 0.1 * total and n >= 0.7 * len(having) and n / len(having) >= urls.LEAST_LIFT * base:
                    rules[some, verdict] = n / len(having)
    shortest = {
        k: c
        for k, c in rules.items()
        if not any(
            o[1] == k[1] and set(o[0]) < set(k[0]) and len(o[0]) == len(k[0]) - 1 and oc >= c - 1e-12
            for o, oc in rules.items()
        )
    }
    assert {k for k in found if len(k[0]) <= 3} == set(shortest)
    for k, c in shortest.items():
        assert found[k]["confidence"] == pytest.approx(c)


def test_open_urls_get_the_best_rule(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    labelled = pages.filter("url is not null").select("url").distinct()
    labelled = labelled.withColumn("verdict", urls.policy_verdict(urls.policy_rule(urls.host(F.col("url")), urls.path(F.col("url")))))
    rules = [(set(r["tokens"]), r) for r in urls.mine(labelled).collect()]
    judged = urls.judge(pages).join(pages.select("page_id", "url"), "page_id").filter("rule is null and url is not null")
    for r in judged.withColumn("t", urls.tokens(F.col("url"))).collect():
        fits = [x for t, x in rules if t <= set(r["t"])]
        if not fits:
            assert (r["verdict"], r["mined_rule"]) == ("allow", None)
        else:
            best = max(fits, key=lambda x: (x["confidence"], x["support"], len(x["tokens"]), " ".join(x["tokens"])))
            assert (r["verdict"], r["mined_rule"]) == (best["verdict"], " ".join(best["tokens"]))


def test_no_rows(spark, pages):
    assert urls.judge(pages.limit(0)).collect() == []
    assert all(r["verdict"] == "allow" for r in urls.judge(pages, policy=()).collect())


def test_long_policies_are_refused(pages):
    with pytest.raises(ValueError, match="policy"):
        urls.judge(pages, policy=[("block", f"h{i}/") for i in range(1001)])


@pytest.mark.parametrize("allowed", [0, 1])
def test_sure_rules_stay_whatever_the_verdicts_share(spark, allowed):
    rows = [(f"https://hot.net/a/{i}" if i % 2 else f"http://hot.net/b/{i}", "block") for i in range(60)]
    rows += [("ftp://cold.org/c", "allow")] * allowed
    rules = {(tuple(r["tokens"]), r["verdict"]) for r in urls.mine(spark.createDataFrame(rows, "url string, verdict string")).collect()}
    assert {(("path:a",), "block"), (("path:b",), "block")} <= rules


def test_shared_segments_and_keys_are_mined_as_one(spark):
    """Thirty segments and keys that always come together would make 2**30 sets of them."""
    deep = "/".join(f"s{chr(97 + i)}" for i in range(15)) + "/?" + "&".join(f"k{chr(97 + i)}=1" for i in range(15))
    rows = [(f"https://deep.net/{deep}&{chr(97 + i % 26)}{chr(97 + i // 26)}=2", "block") for i in range(100)]
    rows += [(f"https://flat.org/x{chr(97 + i % 26)}{chr(97 + i // 26)}", "allow") for i in range(100)]
    rows += [(f"https://flat.org/sa/x{chr(97 + i % 26)}", "allow") for i in range(10)]
    rules = urls.mine(spark.createDataFrame(rows, "url string, verdict string")).collect()
    found = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in rules}
    alone = {f"path:s{chr(97 + i)}" for i in range(1, 15)} | {f"query:k{chr(97 + i)}" for i in range(15)}
    alone |= {"host0:net", "host1:deep"}
    assert {k[0][0] for k in found if len(k[0]) == 1 and k[1] == "block" and found[k] == 1} == alone
    assert {k[0][0] for k in found if len(k[0]) == 1 and k[1] == "allow"} == {"host0:org", "host1:flat"}
    assert found[("path:sa",), "block"] == pytest.approx(100 / 110)
    assert len(found) == len(alone) + 3
