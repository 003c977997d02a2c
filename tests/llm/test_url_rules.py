"""Listed and mined URL rules against plain Python."""

import random
import re
from itertools import combinations

from fitloom.llm import url_rules as U
from fitloom.llm.queries import QUERIES, URL_RULES

FOLDER = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def toks(url):
    host, path = parts(url)
    query = re.match(r"(?s)[^#]*?\?([^#]*)", url or "")
    fields = [x.split("=")[0] for x in query[1].split("&")] if query else []
    out = ["h:" + x for x in host.split(".") if x] + ["p:" + re.sub("[0-9]+", "0", x) for x in path.split("/") if x]
    return set(out + ["q:" + x for x in fields if x])


def test_listed_rules_and_gaps(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?a=http://b", "https://a.example.com/en/", "http://example.com/en", "http://xexample.com/en/",
            "http://m.x.net/es/1#top", "http://net/fr/", "http://a.org?x=/net/fr/", "http://É.net/fr/\nx", "a://b://c/d", "http://x.org/" + "s/" * 5000]
    rows = [(i, u, "h", 1.0) for i, u in enumerate(urls)] + [(0, None, "h", 1.0), (None, "http://a.com/", "h", 1.0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, confidence double")
    labels = spark.createDataFrame([(1, True), (None, True), (99, False), (4, None)], "a long, b boolean")
    got = U.judge(frame, labels, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = next(u for i, u, *_ in rows if i == r.page_id)
        rule, verdict = listed(*parts(url))
        assert (r.host, r.path) == parts(url) and (r.rule, r.verdict) == (rule, verdict or "allow"), url
    assert U.judge(frame.limit(0), labels.limit(0), URL_RULES).count() == 0


def test_mined_rules_against_all_subsets(spark):
    pages = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.org/{'buy' if i % 2 else 'read'}/{i}?id={i}") for i in range(120)]
    pages += [(200 + i, f"http://mix.org/{'pills' if i % 2 else 'news'}/x") for i in range(60)]
    bad = {i: (i < 200 and i % 3 == 0 and (i % 2 == 1 or i % 12 == 0)) or (i >= 200 and i % 2 == 1) for i, _ in pages}
    labels = spark.createDataFrame([(i, b) for i, b in bad.items() if i % 5], "page_id long, bad boolean")
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(pages, "page_id long, url string"), labels, [], min_support=0.01, min_count=4).collect()}
    known = [(toks(u), bad[i]) for i, u in pages if i % 5]
    low = max(0.01, 4 / len(known)) * len(known)
    sure = {}
    for k in (1, 2, 3):
        for s in {c for t, _ in known for c in combinations(sorted(t), k)}:
            n, b = sum(set(s) <= t for t, _ in known), sum(set(s) <= t and y for t, y in known)
            if n >= low and b >= low and b / n >= 0.8:
                sure[s] = b / n
    kept = {s: c for s, c in sure.items() if not any(set(p) < set(s) and q >= c for p, q in sure.items())}
    assert kept
    for i, u in pages:
        fires = [c for s, c in kept.items() if set(s) <= toks(u)]
        assert got[i].verdict == ("block" if fires else "allow")
        if fires:
            assert abs(got[i].confidence - max(fires)) < 1e-12


def test_rules_of_long_urls_are_counted_on_whole_token_sets(spark):
    rng = random.Random(4)
    known = []
    for i in range(160):
        rare = [f"r{i}.{k}" for k in range(20)]
        some = rng.sample([f"w{k}" for k in range(18)], rng.choice([3, 9, 15]))
        known.append((rare + some, {"w1", "w2"} <= set(some) or "w3" in some and rng.random() < 0.85))
    known += [([f"copy{k}" for k in range(60)] + ["w4"], i % 8 > 0) for i in range(40)]
    frame = spark.createDataFrame(known, "tokens array<string>, bad boolean")
    least = max(0.05 * len(known), 8)
    sure = {}
    common = {t for ts, y in known for t in ts if sum(t in u for u, _ in known) >= least}
    sets = [(set(t) & common, y) for t, y in known]
    for k in (1, 2, 3):
        for s in {c for t, _ in sets for c in combinations(sorted(t), k) if sum("copy" in x for x in c) < 2}:
            n, b = sum(set(s) <= t for t, _ in sets), sum(set(s) <= t and y for t, y in sets)
            if b >= least and b / n >= 0.8:
                sure[s] = (b, b / n)
    want = {s: v for s, v in sure.items() if not any(set(p) < set(s) and q[1] >= v[1] for p, q in sure.items())}
    assert len(want) > 60 and any(len(s) > 1 for s in want)
    for limit in (12, 3):
        got = {tuple(r.antecedent): (r.support, r.confidence) for r in U.mine(frame, 0.05, 8, max_tokens=limit).collect()}
        assert got == want
    short = frame.where("tokens[20] not like 'copy%'")  # both ways, without the long copies
    ways = [{tuple(r.antecedent): (r.support, r.confidence) for r in U.mine(short, 0.05, 8, max_tokens=m).collect()} for m in (3, 100)]
    assert ways[0] == ways[1] and ways[0]


def test_query(spark):
    got = {r.page_id: r for r in QUERIES["op1_url_rules"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for p in pages:
        rule, verdict = listed(*parts(p.url))
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (*parts(p.url), rule) and (verdict is None or r.verdict == verdict)
