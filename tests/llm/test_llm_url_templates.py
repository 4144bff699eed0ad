"""Rules, templates and purity."""

from clipcurate.llm import url_templates as ut


def judged(spark, urls, **more):
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in ut.judge(pages, **more).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://A.Example.com/en/1?q#f", "http://www.example.com/en/2", "http://x.www.example.com/en/", "http://example.com/fr/1",
        "http://b.net/es/1", "http://b.net/en/1", "http://com/x", "http://notcom/x", None, "no-scheme/en/", "", "http://h.org",
        "http://h.net?x=/es/", "http://b.net/es/1",
    ]
    rows = judged(spark, urls)
    assert [(rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) for i in range(len(urls))] == [
        ("a.example.com", "/en/1", "example.com/en/", "block"),
        ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
        ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("example.com", "/fr/1", "com/", "allow"),
        ("b.net", "/es/1", "net/es/", "block"),
        ("b.net", "/en/1", None, "allow"),
        ("com", "/x", "com/", "allow"),
        ("notcom", "/x", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("h.org", "", None, "allow"),
        ("h.net", "", None, "allow"),
        ("b.net", "/es/1", "net/es/", "block"),
    ]
    assert ut.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_wildcards_carry_the_labels_to_what_no_rule_fits(spark):
    # Many names below /u/: one wildcard. Rules block most of them, so the others are rejected with them.
    names = [f"{a}{b}" for a in "abcd" for b in "efgh"]
    urls = [f"http://s.org/u/{n}" for n in names] + ["http://s.org/u/zz", "http://s.org/about/us", "http://t.org/u/zz"]
    rules = tuple(("block", "s.org", f"/u/{n}") for n in names)
    rows = judged(spark, urls, rules=rules)
    last = len(names)
    assert [rows[last + i].verdict for i in range(3)] == ["block", "allow", "allow"]
    assert rows[0].template == rows[last].template
    assert rows[0].template.endswith("/*")


def test_similar_branches_merge_and_others_do_not(spark):
    # /red and /blue are followed by the same names, /odd by others.
    urls = []
    for n in range(40):
        urls += [f"http://s.org/{c}/{'page' if n % 2 else 'item'}/{n}" for c in ("red", "blue", "green")]
        urls.append(f"http://s.org/odd/thing/{n}")
    rows = judged(spark, urls, rules=())
    templates = {u.split("/")[3]: rows[i].template for i, u in enumerate(urls)}
    assert templates["red"].split("/")[1] == templates["blue"].split("/")[1] == "~?" or templates["red"] != templates["odd"]
    assert templates["odd"].split("/")[1] == "odd"
