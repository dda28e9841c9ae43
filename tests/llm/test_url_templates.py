import re

from llm_cases import WORDS
from pyspark.sql import functions as F

from tillroll.llm import url_templates as U

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def brute(url):
    """(host, path, rule) by the definition."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = re.search(r"[/?#]", rest)
    host = rest[:cut.start()] if cut else rest
    tail = rest[len(host):]
    cut = re.search(r"[?#]", tail)
    path = tail[:cut.start()] if cut else tail
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best):
                best = rule
    return host, path, best


URLS = ["http://Ex.NET/a", "https://example.net/en/5", "http://www.example.net/en/", "http://example.net/en", "ftp://a.b.org/fr/1?x",
        "http://myexample.com/de/1", "http://m.example.com/de/1#f", "http://h", "http://h?x/y", "http://H#/", "//no", None, "",
        "a://b://c/d", "http:///path", "http://net/", "http://net", "http://éÀ.org/fr/ü", "http://x.org/fr/\n1", "http://a.net:80/q"]


def pages(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)) + [(None, "http://q.io/z")], "page_id long, url string")
    for c in ("host", "path", "segments", "bad", "template", "id", "name"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_hosts_paths_and_rules_by_brute_force(spark):
    out = U.filter_urls(pages(spark, URLS * 2)).collect()
    assert len(out) == 2 * len(URLS) + 1
    for r in out:
        url = "http://q.io/z" if r.page_id is None else URLS[r.page_id % len(URLS)]
        host, path, rule = brute(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (RULES[rule] if rule else "allow"), url
    assert U.filter_urls(pages(spark, URLS).where("false")).count() == 0


def test_templates_are_generalised_merged_and_rejected(spark):
    """/shop pages are bad, /news and /blog alike good, users are one variable; another host is judged apart."""
    urls, labels = [], []
    for k in range(60):
        for part, bad in (("shop", 1), ("news", 0), ("blog", 0)):
            labels.append((len(urls), bad))
            urls.append(f"http://a.io/{part}/{k}.html")
        urls.append(f"http://a.io/u/{WORDS[k % len(WORDS)]}{'xyz'[k % 3] * (k // 3 + 1)}")
        urls.append(f"http://b.io/shop/{k}.html")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    lab = spark.createDataFrame(labels + [(0, None), (None, 1), (0, 1)], "id long, bad int")
    out = {urls[r.page_id]: r for r in U.filter_urls(df, lab).collect()}
    assert out["http://a.io/shop/3.html"].verdict == "block"
    assert out["http://a.io/shop/3.html"].template == "/shop/{number}.html"
    assert out["http://a.io/news/3.html"].verdict == out["http://b.io/shop/3.html"].verdict == "allow"
    users = {r.template for u, r in out.items() if "/u/" in u}
    assert len(users) == 1 and users.pop().endswith("/*")
    # brute-force counts of the template of each host
    n = sum("a.io/shop/" in u for u in urls)
    share = sum(b for _, b in labels) / len(labels)
    assert abs(out["http://a.io/shop/3.html"].bad_share - (n + 10 * share) / (n + 10)) < 1e-12


def test_one_host_with_very_deep_paths(spark):
    urls = ["http://h.io/" + "/".join(["d"] * k) for k in range(1, 30)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = U.filter_urls(df).collect()
    assert len(out) == len(urls) and max(r.template.count("/") for r in out) == U.DEPTH + 1


def test_a_rare_bad_branch_among_many_siblings_is_blocked(spark):
    """100 sections of 1 % each; ten of them are all bad."""
    urls, labels = [], []
    for section in range(100):
        name = "".join("abcdefghij"[int(c)] for c in f"{section:02}")
        for page in range(30):
            labels.append((len(urls), int(section % 10 == 3)))
            urls.append((f"http://big.io/{name}/{page}.html", section % 10 == 3))
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    out = U.filter_urls(df, spark.createDataFrame(labels, "id long, bad int")).collect()
    assert {(urls[r.page_id][1], r.verdict) for r in out} == {(True, "block"), (False, "allow")}


def test_branches_below_the_eighth_segment_are_told_apart(spark):
    """Under nine like segments the tenth says whether a page is bad; what lies below is the tail of it."""
    urls, labels = [], []
    for k in range(40):
        for part, bad in (("good", 0), ("bad", 1)):
            labels.append((len(urls), bad))
            urls.append("http://deep.io/" + "/".join("abcdefghi") + f"/{part}/{'xyz'[k % 3]}/{k}")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = U.filter_urls(df, spark.createDataFrame(labels, "id long, bad int")).collect()
    assert {(r.page_id % 2, r.verdict, r.template) for r in out} == {
        (0, "allow", "/a/b/c/d/e/f/g/h/i/good/**"), (1, "block", "/a/b/c/d/e/f/g/h/i/bad/**")}
    df = df.union(spark.createDataFrame([(900, "http://deep.io"), (901, "http://deep.io/a")], df.schema))
    out = U.filter_urls(df, spark.createDataFrame(labels, "id long, bad int"))
    assert out.where("template is null").count() == 0 and out.where("page_id >= 900").count() == 2


def test_the_number_of_siblings_changes_no_verdict(spark):
    """A branch with four bad labels of four, beside 23, 24, 25 and 60 good siblings: the same verdict."""
    verdicts = set()
    for n in (23, 24, 25, 60):
        urls, labels = [f"http://n.io/odd/{k}.html" for k in range(4)], [(k, 1) for k in range(4)]
        for sibling in range(n):
            name = "".join("abcdefghij"[int(c)] for c in f"{sibling:02}")
            for k in range(300):
                if k < 4:
                    labels.append((len(urls), 0))
                urls.append(f"http://n.io/{name}/{k}.html")
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        judged = U.judged(df, spark.createDataFrame(labels, "id long, bad int"))
        tree = U.template_tree(judged.select("host", "segments", "bad"), prior=2.0)
        verdicts.add(tuple((r.template, r.rejected) for r in tree.where("segments[0] = 'odd'").collect()))
    assert verdicts == {(("/odd/{number}.html", True),)}
