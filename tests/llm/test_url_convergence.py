"""Trust and distrust spread until they settle, however long the chain of links."""

import pytest
from test_search_and_scores import PAGE, reverse, slow_spread

from fieldheat.llm.url_filters import filter_urls


def judged(spark, graph):
    rules = spark.sql("SELECT * FROM VALUES ('good.org','/','allow'),('bad.org','/','block') AS r(host, path, verdict)")
    pages = [(n, f"http://{h}/p", "".join(f"<a href='http://{o}/p'>t</a>" for o in out)) for n, (h, out) in enumerate(graph.items())]
    return {r.host: r for r in filter_urls(spark.createDataFrame(pages, PAGE), rules).collect()}


def test_distrust_goes_up_a_long_chain(spark):
    chain = [f"h{n}.net" for n in range(13, 0, -1)] + ["bad.org"]
    graph = {a: [b] for a, b in zip(chain, chain[1:])} | {"bad.org": [], "alone.net": []}
    found = judged(spark, graph)
    assert {h: r.verdict for h, r in found.items()} == {h: "allow" if h == "alone.net" else "block" for h in graph}
    expected = slow_spread(reverse(graph), "bad.org", 30)
    assert all(found[h].distrust == pytest.approx(expected[h]) for h in chain)


def test_scores_of_a_cycle_settle(spark):
    graph = {"good.org": ["a.net"], "a.net": ["b.net", "bad.org"], "b.net": ["good.org"], "bad.org": ["b.net"]}
    found = judged(spark, graph)
    trust, distrust = slow_spread(graph, "good.org", 300), slow_spread(reverse(graph), "bad.org", 300)
    for host, r in found.items():
        assert (r.trust, r.distrust) == (pytest.approx(trust[host], rel=1e-5), pytest.approx(distrust[host], rel=1e-5))
