from ledgerhound.llm import url_filter as op


def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


def refresh(url):
    return f'<meta http-equiv="refresh" content="0; url={url}">'


PAGES = [
    (1, "http://a.com/x", link("http://b.net/y")), (2, "HTTP://B.net/y#f", None), (3, "http://c.com/de/1", refresh("http://b.net/y")),
    (4, "http://d.org/q", link("http://b.net/y")), (5, None, link("http://b.net/y")), (6, "nohost", ""), (7, "http://e.net/p", link("/z")),
    (8, "http://e.net/z", refresh("//c.com/de/9?x=1&amp;y")), (9, "http://f.net/", ""), (9, "http://f.net/", ""), (10, "http://www.example.org/en/12", ""),
    (11, "http://notorg/", ""), (12, "http://f.org/es/", ""), (13, "http://x.example.org/es", ""), (14, "http://com/de/", ""), (None, "http://g.net/fr/" + "a" * 9000, ""),
    (15, "", None), (16, "x://EXAMPLE.ORG/es/#q", ""), (17, "http://h.net?x=/de/", ""),
]
WANT = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "block", 11: "allow", 12: "allow",
        13: "allow", 14: "block", None: "allow", 15: "allow", 16: "block", 17: "allow"}
RULE = {3: "com/de/", 4: "org/", 10: "example.org/en/1", 12: "org/", 13: "org/", 14: "com/de/", 16: "example.org/es/"}


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], "page_id long, url string, html string, host string, rule int")


def test_rules_aliases_and_precedence(spark):
    got = op.judge(pages(spark), op.rule_table(spark, op.RULES)).collect()
    assert len(got) == len(PAGES)
    assert {r.page_id: r.verdict for r in got} == WANT
    assert {r.page_id: r.rule for r in got if r.rule} == RULE
    assert {r.page_id: (r.host, r.path) for r in got if r.page_id in (5, 6, 15, 16, 17)} == {5: ("", ""), 6: ("", ""), 15: ("", ""), 16: ("example.org", "/es/"), 17: ("h.net", "")}


def test_chains_of_aliases_and_given_edges(spark):
    chain = [(k, f"http://h{k}.net/", link(f"http://h{k + 1}.net/")) for k in range(20)]
    edges = spark.createDataFrame([("http://h20.net/", "http://z.com/de/", "http://z.com/de/")], "a string, b string, target_url string")
    got = op.judge(pages(spark, chain), op.rule_table(spark, op.RULES), edges).collect()
    assert {r.verdict for r in got} == {"block"} and all(r.by_alias for r in got)
    assert {r.verdict for r in op.judge(pages(spark, chain), op.rule_table(spark, op.RULES)).collect()} == {"allow"}


def test_no_rules_and_empty_table(spark):
    assert {r.verdict for r in op.judge(pages(spark), op.rule_table(spark, [])).collect()} == {"allow"}
    assert op.judge(pages(spark).limit(0), op.rule_table(spark, op.RULES)).collect() == []


def test_every_named_target_is_an_alias(spark):
    rows = [(1, "http://a.net/", link("http://b.net/") + link("http://z.com/de/")), (2, "http://c.net/", refresh("http://d.net/") + refresh("http://y.com/de/")),
            (3, "http://e.net/", link("http://f.net/") + refresh("http://g.net/"))]
    got = op.judge(pages(spark, rows), op.rule_table(spark, op.RULES)).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "allow"}
