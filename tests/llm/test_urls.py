import random
import re
from collections import defaultdict

import pytest

from pricerisk.llm.queries import URL_RULES
from pricerisk.llm.urls import alike, filter_urls, merged
from tests.llm.helpers import clashing


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "<html>") for i, u in rows], "page_id long, url string, html string")


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules=URL_RULES):
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def shape(path):
    path = re.sub(r"[*#{|}]", lambda m: f"%{ord(m.group()):02X}", path)
    out = []
    for k, s in enumerate(path.split("/")):
        if k and re.fullmatch(r"[0-9a-fA-F-]{8,}", s) and re.search(r"\d", s) and re.search(r"[a-fA-F-]", s):
            out.append("#x")
        else:
            out.append(re.sub(r"\d+", "#", s))
    out = out[1:]
    return out if len(out) <= 16 else [*out[:15], "/".join(out[15:])]


def form(rest):
    if not rest:
        return 0
    t = rest[0]
    return 1 if t == "" else 2 if t == "#" else 3 if t == "#x" else 4 if "#" in t else 5


def brute(rows, rules=URL_RULES):
    """page_id -> (host, path, rule, verdict, template): the tree grown by recursion, host by host."""
    label, tails = {}, defaultdict(list)
    for url in {u for _, u in rows}:
        host, path = split_url(url)
        label[url] = rule_of(host, path, rules)[1]
        tails[host].append((shape(path), url))
    template = {}

    def grow(node, members):
        """members: (segments left, url)"""
        groups = defaultdict(list)
        for rest, url in members:
            if rest:
                groups[rest[0]].append((rest[1:], url))
            else:
                template[url] = node
        total = sum(map(len, groups.values()))
        big = sorted((t for t in groups if len(groups[t]) >= 5), key=lambda t: (-len(groups[t]), t))[:20]
        big = [t for t in big if len(groups[t]) >= 0.05 * total]
        branches = []
        for t in big:
            c = [0] * 6
            for rest, _ in groups[t]:
                c[form(rest)] += 1
            n = [sum(label[u] == v for _, u in groups[t]) for v in ("block", "allow")]
            branches.append((t, [len(groups[t]), *n, len(groups[t]) - sum(n), *c]))
        for g in merged(branches):
            name = g[0] if len(g) == 1 else "{" + "|".join(sorted(g)) + "}"
            grow(f"{node}/{name}", [m for t in g for m in groups[t]])
        rest = [m for t in groups if t not in big for m in groups[t]]
        if rest:
            grow(node + "/*", rest)

    for host, members in tails.items():
        grow(host, members)
    bad, good = defaultdict(int), defaultdict(int)
    for url, t in template.items():
        bad[t] += label[url] == "block"
        good[t] += label[url] == "allow"
    out = []
    for i, url in rows:
        host, path = split_url(url)
        rule, verdict = rule_of(host, path, rules)
        t = template.get(url)
        own = "block" if (bad[t] + 2) / (bad[t] + good[t] + 4) >= 0.9 else "allow"
        out.append((i, host, path, rule, verdict or own, t))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in df.collect()], key=str)


def made(seed, n):
    rnd = random.Random(seed)
    hosts = ["A.example.com", "www.example.com", "sub.www.example.com", "shop.net", "x.org", "example.com", "notexample.com"]
    rows = []
    for k in range(n):
        host = rnd.choices(hosts, [3, 1, 1, 6, 8, 2, 2])[0]
        first = rnd.choice(["en", "de", "es", "fr", "EN", "tag", "wiki"])
        rest = rnd.choice([f"{rnd.randint(1, 999)}", f"p{rnd.randint(1, 9)}/x", f"s{rnd.choice('abcdefghij')}{rnd.choice('klmnop')}",
                           f"{rnd.getrandbits(48):012x}", "", "a*b/{c|d}/#", f"{rnd.randint(1, 9)}.html"])
        rows.append((k, f"http{rnd.choice(['', 's'])}://{host}/{first}/{rest}{rnd.choice(['', '', '?a=/b', '#top', '/'])}"))
    return rows


def test_against_brute_force(spark):
    rows = made(1, 900)
    rows += [(2000 + k, rows[k % 20][1]) for k in range(300)]  # repeats are no evidence
    got = rows_of(filter_urls(clashing(pages(spark, rows)), URL_RULES))
    assert got == brute(rows)
    assert any("{" in r[5] for r in got) and any(r[5].endswith("*") for r in got) and any("#x" in r[5] for r in got)


def test_rules(spark):
    rows = enumerate(
        ["http://com/", "http://a.COM/x", "http://com", "http://xcom/", "http://example.com/en/1", "http://q.example.com/en/", "http://example.com/en",
         "http://www.example.com/en/a", "http://b.www.example.com/en/", "http://awww.example.com/en/", "ftp://p.net/es/", "http://net/fr/?x", "http://p.net/ES/"]
    )
    want = ["com/", "com/", None, None, "example.com/en/", "example.com/en/", "com/", "www.example.com/en/", "www.example.com/en/", "example.com/en/", "net/es/", "net/fr/", None]
    got = {r.page_id: r for r in filter_urls(pages(spark, list(rows)), URL_RULES).collect()}
    assert [got[k].rule for k in range(len(want))] == want
    assert [got[k].verdict for k in (4, 7, 10, 12)] == ["block", "allow", "block", "allow"]


def test_evidence_decides_templates_without_rules(spark):
    """Slugs of a template share its labels: pages beside blocked ones go, those of other branches stay."""
    rules = [("block", "h.org", "/spam/b"), ("allow", "h.org", "/news/a")]
    rows = [(k, f"http://h.org/spam/{'bc'[k % 4 == 0]}{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(200)]
    rows += [(300 + k, f"http://h.org/news/{'ad'[k % 2]}{k}") for k in range(100)]
    rows += [(500 + k, f"http://h.org/blog/{k}") for k in range(100)]
    got = rows_of(filter_urls(pages(spark, rows), rules))
    assert got == brute(rows, rules)
    own = {r[0]: r[4] for r in got if r[3] is None}
    assert all(own[k] == "allow" for k in own if k >= 300)
    beside = [v for k, v in own.items() if k < 200]
    assert beside == ["block"] * 50


def test_shares_that_differ_are_not_merged():
    assert alike([100, 50, 50], [400, 210, 190]) and not alike([100, 50, 50], [400, 10, 390])
    assert merged([("a", [100, 100, 0]), ("b", [90, 0, 90]), ("c", [80, 78, 2])]) == [["a", "c"], ["b"]]


def test_long_paths_and_odd_rows(spark):
    long = "http://x.net/" + "a/" * 5000 + "1"
    rows = [(1, None), (2, ""), (3, "no scheme"), (None, "http://x.net"), (5, "http://"), (6, "http:///p"), (7, long), (7, long), (8, "a://X.Net?q#f"),
            (9, "http://x.net/es/\n1"), (10, "http://é.net/ünï/12é")]
    rows += [(20 + k, f"http://x.net/{'b/' * (k % 30)}{k}") for k in range(120)]
    got = rows_of(filter_urls(pages(spark, rows), URL_RULES))
    want = brute(rows)
    assert got == want
    assert filter_urls(pages(spark, []), URL_RULES).collect() == []
    with pytest.raises(ValueError):
        filter_urls(pages(spark, rows), [("maybe", "com", "/")])
