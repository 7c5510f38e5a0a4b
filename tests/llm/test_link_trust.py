"""Link trust beside its SQL, a plain propagation and odd rows."""

import pytest
from pyspark.sql import functions as F

from check_sql import compare
from tradeloom.llm.link_trust import Rule, host_links, host_scores, judge_urls
from tradeloom.llm.queries import QUERIES, RULES, SQL

PAGES = "page_id long, url string, html string"


def linked(*targets):
    return "<p>x</p>" + "".join(f'<a class="l" href="{t}">t</a>' for t in targets)


WEB = [
    (1, "https://good.org/fr/a", linked("https://mid.com/x", "//two.com", "/own", "https://good.org/z")),
    (2, "http://MID.com/b?x=1", linked("https://far.com/")),
    (3, "http://far.com", None),
    (4, "https://spam.net/a", linked("http://victim.com/")),
    (5, "https://feeder.com/q", linked("HTTP://Spam.NET:80/a", "https://spam.net/a", "https://spam.net/b")),
    (6, "https://booster.com/", linked("https://feeder.com/x")),
    (7, "https://victim.com/p", "<a href='https://mid.com'>m</a><A HREF=https://two.com/a>t</A>"),
    (8, "https://lonely.com/p", "no links // here href=https://spam.net"),
    (9, None, linked("https://spam.net/")),
    (10, "no host", linked("https://spam.net/")),
    (11, "https://sub.example.net/en/x", ""),
    (12, "https://example.net", ""),
    (13, "ftp://a.example.com/de/#f", ""),
    (14, "https://x.com/a://b.net/", ""),
    (15, "https://notexample.com/de/", ""),
]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op2_link_trust"
    text, _, ok = compare(spark, f"/root/testdata/{sf}", name, QUERIES[name], SQL[name])
    assert ok, text


def test_linked_pages_equal_sql(spark, tmp_path):
    spark.createDataFrame(WEB, PAGES).coalesce(1).write.parquet(str(tmp_path / "made"))
    (part,) = (tmp_path / "made").glob("*.parquet")
    (tmp_path / "pages.parquet").symlink_to(part)
    import check_sql

    tables, check_sql.TABLES = check_sql.TABLES, ["pages"]
    try:
        text, _, ok = compare(spark, str(tmp_path), "op2", QUERIES["op2_link_trust"], SQL["op2_link_trust"])
    finally:
        check_sql.TABLES = tables
    assert ok, text


def test_verdicts(spark):
    got = {r.id: r for r in judge_urls(spark.createDataFrame(WEB, PAGES), RULES).collect()}
    verdicts = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdicts == {
        1: ("org/fr/", "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("net/", "block"),
        5: (None, "block"), 6: (None, "block"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"),
        10: (None, "allow"), 11: ("example.net/en/", "allow"), 12: (None, "allow"), 13: ("example.com/de/", "block"),
        14: (None, "allow"), 15: (None, "allow"),
    }
    assert (got[2].host, got[2].path, got[14].path) == ("mid.com", "/b", "/a://b.net/")
    assert (got[9].host, got[9].path, got[10].host) == ("", "", "")


def plain_scores(seeds, links, rounds, damping=0.85):
    out = {}
    for kind in ("trust", "distrust"):
        ways = [(s, d) if kind == "trust" else (d, s) for s, d in links]
        start = {h: 1 / sum(k == kind for k, _ in seeds) for k, h in seeds if k == kind}
        mass = dict(start)
        for _ in range(rounds):
            new = {h: m * (1 - damping) for h, m in start.items()}
            for s, d in ways:
                if s in mass:
                    new[d] = new.get(d, 0) + damping * mass[s] / sum(w[0] == s for w in ways)
            mass = new
        for h, m in mass.items():
            out.setdefault(h, {})[kind] = m
    return out


def test_scores_equal_plain_propagation(spark):
    links = [(f"h{i}", f"h{(i * i + k) % 17}") for i in range(17) for k in range(1 + i % 4) if i != (i * i + k) % 17]
    links = sorted(set(links))
    seeds = [("trust", "h1"), ("trust", "h4"), ("distrust", "h9"), ("distrust", "elsewhere")]
    got = host_scores(spark.createDataFrame(seeds, "kind string, host string"), spark.createDataFrame(links, "src string, dst string"), 5)
    want = plain_scores(seeds, links, 5)
    rows = got.collect()
    assert {r.host for r in rows} == set(want)
    for r in rows:
        assert r.trust == pytest.approx(want[r.host].get("trust", 0)) and r.distrust == pytest.approx(want[r.host].get("distrust", 0))


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", ""), (1, "", ""), (2, "https://a.net/" + "x" * 100_000, linked("//b.com") * 5000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("h"), "rule": F.lit(1), "src": F.lit("s")})
    got = judge_urls(pages, [*RULES, Rule("net/", "block")]).collect()
    assert sorted((str(r.id), r.verdict) for r in got) == [("1", "allow"), ("1", "allow"), ("2", "block"), ("None", "allow")]
    assert [tuple(r) for r in host_links(pages).collect()] == [("a.net", "b.com")]
    assert judge_urls(pages.where("false"), RULES).count() == 0


def test_mass_reaches_the_end_of_a_chain(spark):
    def site(kind, i):
        return f"{kind}{i}.com"

    pages = [(1, "https://seed.org/fr/a", linked(f"https://{site('t', 1)}/")), (2, "https://seed.net/a", None)]
    pages += [(100 + i, f"https://{site('t', i)}/", linked(f"https://{site('t', i + 1)}/")) for i in range(1, 31)]
    pages += [(200 + i, f"https://{site('d', i)}/", linked(f"https://{site('d', i - 1) if i > 1 else 'seed.net'}/")) for i in range(1, 31)]
    got = {r.id: r for r in judge_urls(spark.createDataFrame(pages, PAGES), RULES).collect()}
    for i in range(1, 31):
        far = 0.15 * 0.85**i  # the run to convergence
        assert [got[100 + i].trust, got[200 + i].distrust] == pytest.approx([far, far])
        assert (got[100 + i].verdict, got[200 + i].verdict) == ("allow", "block")


def test_scores_at_convergence(spark):
    links = sorted({(f"h{i}", f"h{(i * i + k) % 17}") for i in range(17) for k in range(1 + i % 4) if i != (i * i + k) % 17})
    seeds = [("trust", "h1"), ("trust", "h4"), ("distrust", "h9")]
    seeded, linking = spark.createDataFrame(seeds, "kind string, host string"), spark.createDataFrame(links, "src string, dst string")
    got = host_scores(seeded, linking, damping=0.5)
    want = plain_scores(seeds, links, 400, 0.5)
    rows = got.collect()
    assert {r.host for r in rows} == set(want)
    for r in rows:
        assert [r.trust, r.distrust] == pytest.approx([want[r.host].get(k, 0) for k in ("trust", "distrust")], rel=2e-5)
