from __future__ import annotations

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import line_dedup, url_filters
from shelfguard.llm.queries import QUERIES

LONG = "A line that is long enough to count as a repeated one"


def _lines(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def _expected(rows):
    return sorted((i if i is not None else -1, n, d, brute.sha(t)) for i, n, d, t in brute.lines(rows))


def test_lines_equal_brute_force_with_edges(docs_of):
    rng = random.Random(1)
    pool = [f"{LONG} number {k} {'x' * k}" for k in range(6)] + ["short", "", "  ", "ÄÖ " * 20, "äö " * 20]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool) + rng.choice(["", " \r"]) for _ in range(rng.randint(0, 90)))) for i in range(25)]
    rows += [(100, None), (101, ""), (102, LONG.upper()), (3, rows[3][1]), (103, "\n".join([LONG] * 400)), (None, "\n".join(pool)), (104, "\n")]
    assert _lines(line_dedup.op2_line_dedup(docs_of(rows))) == _expected(rows)


def test_a_key_in_four_documents_stays_and_in_five_goes(docs_of):
    four = [(i, LONG) for i in range(4)]
    assert all(r.n_dropped == 0 for r in line_dedup.op2_line_dedup(docs_of(four)).collect())
    got = {r.doc_id: r.n_dropped for r in line_dedup.op2_line_dedup(docs_of([*four, (9, f" {LONG.upper()}\n{LONG}")])).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 9: 0}


def test_lines_of_an_empty_table_and_clashing_columns(docs_of):
    assert line_dedup.op2_line_dedup(docs_of([])).count() == 0
    df = docs_of([(1, "a\nb")]).withColumn("n_lines", F.lit("mine")).withColumn("k", F.lit(1)).withColumn("drops", F.lit(2))
    row = line_dedup.line_dedup(df).first()
    assert (row.n_lines, row.kept_text, row.k, row.drops) == (2, "a\nb", 1, 2)


def test_line_plan_has_no_python(spark, small):
    plan = QUERIES["op2_line_dedup"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_firsts_are_marked_in_one_exchange(docs_of, spark):
    lines = line_dedup.stage(line_dedup.line_digests(docs_of([(i, f"{LONG}\n{LONG} {i}\n{LONG}") for i in range(30)])), "t")
    marked = line_dedup.first_occurrences(lines)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Window" in plan, plan
    assert marked.where("first").count() == 60 and marked.where("not first").count() == 30


URLS = [
    (1, "http://Example.NET/en/x"), (2, "http://example.net/de/x"), (3, "https://a.b.example.com/de/?q"), (4, "http://x.org/fr/a#b"),
    (5, "http://net/"), (6, "http://net"), (7, None), (8, "no scheme"), (9, "http://"), (10, "http://notexample.com/de/"),
    (11, "a://b://c.net/x"), (12, "http://c.net?x/en/"), (13, "http://.net/x"), (14, "http://net./x"), (15, "http://x.net/EN/"),
    (1, "http://Example.NET/en/x"), (16, "http://" + "s." * 300 + "example.net/en/" + "p" * 3000), (None, "http://y.net/"), (17, ""), (18, "http://a.net/\n/x"),
]


def _judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = brute.lower(rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


@pytest.mark.parametrize("rules", [url_filters.RULES, (("example.net", "/e", "block"), ("net", "", "allow"), ("example.net", "/e", "allow"), ("c.net", "/x", "block")), ()])
def test_urls_equal_brute_force(spark, rules):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("html", F.lit("x")).withColumn("prefix", F.lit(7))
    got = url_filters.url_filter(pages, url_filters.rules_table(spark, rules) if rules else spark.createDataFrame([], "host string, path string, verdict string"))
    found = sorted((str(r.page_id), str(r.url), r.host, r.path, str(r.rule), r.verdict) for r in got.collect())
    wanted = []
    for i, u in URLS:
        host, path, rule, verdict = _judge(u, rules)
        wanted.append((str(i), str(u), host, path, str(rule), verdict))
    assert found == sorted(wanted)


def test_urls_of_an_empty_table(spark):
    assert url_filters.op3_url_filters(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_urls_meet_rules_on_the_prefix_alone(spark, small, monkeypatch):
    seen, join = [], url_filters.candidates
    monkeypatch.setattr(url_filters, "candidates", lambda *a: seen.append(join(*a)) or seen[-1])
    QUERIES["op3_url_filters"](spark, small)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"(?:BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert [[re.sub(r"#.*", "", k) for k in pair] for pair in keys] == [["prefix", "prefix"]], plan
    assert "ExistingRDD" not in plan and "Python" not in plan


def test_equal_prefixes_of_other_rules_are_not_confirmed(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "PREFIX_HEX", 1)  # one rule in sixteen shares a prefix
    rules = tuple((f"h{i}.net", "/", "block") for i in range(40))
    pages = spark.createDataFrame([(i, f"http://h{i}.net/x") for i in range(60)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filters.url_filter(pages, url_filters.rules_table(spark, rules)).collect()}
    assert got == {i: "block" if i < 40 else "allow" for i in range(60)}
