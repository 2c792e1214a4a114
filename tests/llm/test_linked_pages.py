"""The registered URL query on pages that link: rules by expression and by table, scores by power iteration, ties, long pages."""
import random
import re

import pytest

from llm_rows import prose
from marquee.llm import queries, urlgraph


def plain(pages, rules, rounds=400, damping=0.85):
    """page_id -> (rule, verdict) by longest match, then by trust and distrust over the links of hosts."""
    def split(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        return host.lower(), re.match(r"[^?#]*", rest[len(host):]).group()

    def fitting(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)

    own = {p: (*split(u), fitting(*split(u))) for p, u, _ in pages}
    links = {(own[p][0], m.lower()) for p, _, html in pages if own[p][0]
             for m in re.findall(r"""href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^"'\s>/?#]+)""", html or "", re.I)}
    links = {(a, b) for a, b in links if a != b}
    hosts = {h for h, _, _ in own.values()} | {h for e in links for h in e}
    seed = {v: {h: sum(o[0] == h and o[2] is not None and o[2].verdict == v for o in own.values()) for h in hosts}
            for v in ("allow", "block")}
    score = {}
    for v, edges in (("allow", links), ("block", {(b, a) for a, b in links})):
        total, out = sum(seed[v].values()) or 1, {h: sum(a == h for a, _ in edges) for h in hosts}
        base = {h: (1 - damping) * seed[v][h] / total for h in hosts}
        now = dict(base)
        for _ in range(rounds):
            new = dict(base)
            for a, b in edges:
                new[b] += damping * now[a] / out[a]
            now = new
        score[v] = now
    return {p: (r and r.text, r.verdict if r else "block" if score["block"][h] > score["allow"][h] * (1 + 1e-7) else "allow")
            for p, (h, _, r) in own.items()}


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(9)
    good, bad = [f"g{i}.com" for i in range(3)], [f"b{i}.net" for i in range(3)]
    free = [f"h{i}.org" for i in range(25)]
    rows = [(k, f"https://{h}/", "") for k, h in enumerate(good)] + [(10 + k, f"http://{h}/es/x", "") for k, h in enumerate(bad)]
    for k, h in enumerate(free):
        to = rng.sample(free + good + bad, rng.randrange(4))
        rows.append((100 + k, f"http://{h.upper()}/a?b", " ".join(f'<a HREF = "//{t}/x">' for t in to)))
    rows += [(200 + k, f"http://{h}/", f'<a href="https://{t}">') for k, (h, t) in enumerate(
        [("g0.com", "h3.org"), ("g1.com", "h4.org"), ("g2.com", "h5.org")])]
    rows += [(300, "http://tie.org/", '<a href="http://b0.net/"><a href="http://g0.com/">'), (301, None, '<a href="//h1.org">'),
             (302, "http://long.org/", prose(3, 40_000) + '<a href="http://b1.net/">'), (303, "no scheme", None)]
    return rows


@pytest.mark.parametrize("most", [urlgraph.MAX_RULES, 0])
def test_registered_query_on_linked_pages(spark, pages, tmp_path, monkeypatch, most):
    monkeypatch.setattr(urlgraph, "MAX_RULES", most)  # 0: the rules as a table
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op2_link_graph_filter(spark, str(tmp_path)).collect()}
    want = plain(pages, queries.URL_RULES)
    assert got == want
    judged = [v for p, (rule, v) in want.items() if rule is None]
    assert judged.count("block") >= 3 and judged.count("allow") >= 3  # the links decide, both ways
