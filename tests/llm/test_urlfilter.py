"""URL verdicts over generated links, against union-find."""

from __future__ import annotations

import random
import re

import pytest

from vigil.llm import urlfilter

RULES = (("com", "/", "allow"), ("bad.com", "/x/", "block"), ("good.bad.com", "/x/", "allow"), ("net", "/b/", "block"))


def node(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("", "") if not m else (m.group(1).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m.group(2))


def rule_of(host, path):
    fits = [(len(h) + len(p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain(pages):
    """rows of (id, url, targets) -> {id: (host, path, rule, verdict)}"""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for _, url, targets in pages:
        for t in targets:
            a, b = node(url), node(t)
            if a[0] and b[0]:
                parent[find(a)] = find(b)
    voices = {}
    for n in list(parent):
        if rule_of(*n)[1]:
            voices.setdefault(find(n), set()).add(rule_of(*n)[1])
    out = []
    for i, url, _ in pages:
        n = node(url)
        rule, verdict = rule_of(*n)
        said = voices.get(find(n), set()) if n[0] else set()
        out.append((i, *n, rule, verdict or ("allow" if "allow" in said else "block" if "block" in said else "allow")))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_verdicts_equal_union_find(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.org", "b.org", "WWW.b.org", "bad.com", "good.bad.com", "n.net", "c.io"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice('xbyz')}/{rng.randint(0, 12)}" for _ in range(160)]
    chain = [f"https://chain.org/y/{k}" for k in range(40)]
    pages = [(i, u, [rng.choice(urls)] if rng.random() < 0.35 else []) for i, u in enumerate(urls)]
    pages += [(1000 + k, chain[k], [chain[k + 1]]) for k in range(39)] + [(1100, chain[39], ["http://n.net/b/1"])]        # one long chain, blocked at its end
    pages += [(1200 + k, f"http://star.org/y/{k}", ["http://hub.io/y/"]) for k in range(200)] + [(1500, "http://hub.io/y/", ["http://good.bad.com/x/9"])]
    pages += [(2000, None, []), (2001, "no scheme", ["http://n.net/b/1"]), (2002, "http://a.org/y/0?q#f", ["relative/path", ""]), (2002, "http://a.org/y/0", [])]

    def html(targets):
        forms = ['<link rel="canonical" href="{}">', "<LINK href='{}' rel=canonical>", '<meta http-equiv="refresh" content="0; url={}">']
        return "<html><head>" + "".join(rng.choice(forms).format(t) for t in targets) + "</head><body>x</body></html>"
    df = spark.createDataFrame([(i, u, html(t) if t or i % 2 else None, "x", 1) for i, u, t in pages],
                               "page_id long, url string, html string, verdict string, host int")
    got = sorted((tuple(r[:5]) for r in urlfilter.judge_urls(df, RULES).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert got == plain(pages)
    verdict = {r[0]: r[4] for r in got}
    assert {verdict[1000 + k] for k in range(39)} == {"block"} and {verdict[1200 + k] for k in range(200)} == {"allow"}
