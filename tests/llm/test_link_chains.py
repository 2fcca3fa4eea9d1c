"""Trust and distrust on graphs deeper than a few rounds."""

from collections import defaultdict

from martlight.llm import urlfilter
from martlight.llm.oracle import ORACLES
from martlight.llm.queries import QUERIES, URL_RULES
from tests.compare import connect, differences
from tests.llm.tables import PAGES
from tests.llm.test_pages import link

CHAIN = 30


def settled(own, ways):
    """Masses that one more round leaves as they are."""
    kept = {h: m * 15 // 100 for h, m in own.items()}
    ranks = dict(kept)
    while True:
        following = defaultdict(int, kept)
        for h, m in ranks.items():
            for t in ways[h]:
                following[t] += m * 85 // 100 // len(ways[h])
        if following == ranks:
            return ranks
        ranks = following


def chain_pages():
    graph = {f"c{i}.org": [f"c{i + 1}.org"] for i in range(CHAIN)}
    graph[f"c{CHAIN}.org"] = ["bad.net"]
    graph |= {"bad.net": [], "good.com": ["r0.org"], "alone.org": []}
    graph |= {f"r{i}.org": [f"r{(i + 1) % 12}.org"] for i in range(12)}
    paths = {"good.com": "/", "bad.net": "/es/"}
    rows = [(i, f"http://{h}{paths.get(h, '/p')}", "".join(map(link, t))) for i, (h, t) in enumerate(graph.items())]
    return graph, rows


def test_settled_masses_match_sql(spark, tmp_path):
    """The recursion in SQL settles after the same number of rounds, to the same unit."""
    spark.createDataFrame(chain_pages()[1], PAGES).coalesce(1).write.parquet(f"{tmp_path}/p")
    next((tmp_path / "p").glob("part-*.parquet")).rename(tmp_path / "pages.parquet")
    name = "op8_url_filters"
    assert differences(spark, connect(str(tmp_path)), QUERIES[name], ORACLES[name], str(tmp_path)) == []


def test_chains_longer_than_eight_links(spark):
    """Every host of a chain that ends at a blocked one is suspect; a ring settles to its fixed point."""
    graph, rows = chain_pages()
    found = {r.host: r for r in urlfilter.judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()}
    back = defaultdict(list)
    for s, targets in graph.items():
        for t in targets:
            back[t].append(s)
    trust = settled({"good.com": 10**15}, defaultdict(list, graph))
    distrust = settled({"bad.net": 10**15}, back)
    for h, r in found.items():
        assert abs(r.trust - trust.get(h, 0)) <= 10**7 and abs(r.distrust - distrust.get(h, 0)) <= 10**7
    assert {h for h, r in found.items() if r.verdict == "block"} == {"bad.net", *(f"c{i}.org" for i in range(CHAIN + 1))}
