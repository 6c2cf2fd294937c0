"""Line dedup, URL filters and mixing."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest

from macrotide.llm import line_dedup, mixing, url_filters
from tests.llm.conftest import tuples


def brute_lines(rows, ratio=0.1, least=5):
    total, pages = Counter(), Counter()
    for _, site, text in rows:
        total[site] += 1
        pages.update((site, x) for x in {x for x in (text or "").split("\n") if x.strip(" ")})
    bad = {k for k, n in pages.items() if n >= least and n > ratio * total[k[0]]}
    return [
        (i, site, None if text is None else "\n".join(x for x in text.split("\n") if (site, x) not in bad)) for i, site, text in rows
    ]


def test_boilerplate_of_a_site_goes_and_of_no_other(frame, odd_rows):
    rows = list(odd_rows)
    for k in range(100, 200):
        site = "big" if k % 3 == 0 else None if k % 3 == 1 else f"s{k % 7}"
        lines = [f"own line {k}", "", "shared by all" if k % 2 else "rare", "menu\u00e9 |"] if k % 11 else ["shared by all", "shared by all"]
        rows.append((k, site, "\n".join(lines)))
    rows += rows[-6:]
    docs = frame(rows)
    found = line_dedup.drop_boilerplate_lines(docs)
    assert set(found.columns) == {*docs.columns, "n_lines", "n_dropped"}
    assert Counter(tuples(found, "doc_id", "source", "text")) == Counter(brute_lines(rows))
    counts = found.selectExpr("sum(n_lines)", "sum(n_dropped)").first()
    assert counts[0] == sum(len(t.split("\n")) for _, _, t in rows if t is not None)
    assert counts[1] > 0
    assert line_dedup.drop_boilerplate_lines(frame([])).count() == 0


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("tie.org", "/a", "allow"), ("tie.org", "/a", "block"), ("x.org", "", "block"), (None, "/", "block"), ("y.org", None, "block"),
]


def brute_verdict(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fits = [
        (len(h + p), v, h + p) for h, p, v in RULES
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_verdicts_match_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "https://Example.COM/en/1", "http://www.example.com/en/x?y=/es/", "http://blog.example.com/en/",
        "http://a.net/es/1#t", "ftp://a.net/fr", "http://net/es/", "http://anet/es/", "http://com", "http://com/", "x://tie.org/abc",
        "http://deep.er.tie.org/a", "http://x.org", "http://z.x.org?q=1", "http://y.org/", "a://b://c.com/d", "http://é.com/ü/ñ", "http://a..com/\n/x",
        "HTTP://WWW.EXAMPLE.COM/EN/", "http://user@example.com/en/", "http://h.com/" + "p/" * 4000,
    ] * 3
    pages = spark.createDataFrame([(k if k % 9 else None, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = url_filters.url_verdicts(pages.selectExpr("*", "'q' AS host", "1 AS rule", "2 AS digest"), rules)
    assert Counter(tuples(found)) == Counter((k if k % 9 else None, *brute_verdict(u)) for k, u in enumerate(urls))
    assert url_filters.url_verdicts(pages.limit(0), rules).count() == 0
    none = url_filters.url_verdicts(pages, rules.limit(0))
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "allow")}


def brute_mix(rows, entropy_ratio, max_passes, seed="mix"):
    docs = [(i, s if s is not None else "\x00", len((t or "").split())) for i, s, t in rows]
    docs = [d for d in docs if d[2]]
    tokens = Counter()
    for _, s, n in docs:
        tokens[s] += n
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    worst = lambda a: max(w / share[s] for s, w in weights(a).items())
    goal = entropy_ratio * math.log(len(share)) - 1e-12
    a = 1.0
    if entropy(1.0) < goal:
        low, high = 0.0, 1.0
        for _ in range(30):
            middle = (low + high) / 2
            low, high = (middle, high) if entropy(middle) >= goal else (low, middle)
        a = low
    if worst(a) > max_passes + 1e-12:
        low, high = 0.0, 1.0
        for _ in range(30):
            middle = (low + high) / 2
            low, high = (low, middle) if worst(middle) <= max_passes + 1e-12 else (middle, high)
        a = high
    out = []
    md5 = lambda *x: hashlib.md5("/".join(map(str, x)).encode()).hexdigest()
    for s, w in weights(a).items():
        whole, rest = divmod(math.floor(round(w, 9) * total), tokens[s])
        mine = [d for d in docs if d[1] == s]
        key = lambda d, p: md5(seed, p, s, "" if d[0] is None else d[0])  # noqa: B023, E731
        out += [(d[0], s, d[2], p) for p in range(whole) for d in mine]
        used = 0
        for d in sorted(mine, key=lambda d: (key(d, whole), d[0] is not None, d[0] or 0, d[2])):  # noqa: B023
            if used < rest:
                out.append((d[0], s, d[2], whole))
            used += d[2]
    return out


@pytest.mark.parametrize(("entropy_ratio", "max_passes"), [(0.95, 4.0), (1.0, 1.5), (0.6, 9.0), (1.0, 50.0)])
def test_mixture_matches_brute_force(frame, odd_rows, entropy_ratio, max_passes):
    rows = [(k, "hot" if k % 3 else f"s{k % 5}", "w " * (k % 17 + 1)) for k in range(1000, 1400)] + odd_rows
    found = mixing.mix_sources(frame(rows), entropy_ratio=entropy_ratio, max_passes=max_passes, block_digits=1)
    assert Counter(tuples(found, "doc_id", "source", "n_tokens", "pass")) == Counter(brute_mix(rows, entropy_ratio, max_passes))


def test_a_source_of_almost_no_weight_gives_one_document(frame):
    rows = [(k, "big", "w " * 200) for k in range(100)] + [(500, "small", "one two"), (501, "small", "three four")]
    settings = {"entropy_ratio": 0.0, "volume": 0.01}  # the small source's budget is below one word
    found = mixing.mix_sources(frame(rows), every_source=True, **settings).collect()
    plain = mixing.mix_sources(frame(rows), **settings).collect()
    assert [r.source for r in found].count("small") == 1 and "small" not in {r.source for r in plain}
    assert Counter(r for r in found if r.source == "big") == Counter(plain)


def test_nothing_to_mix(frame):
    assert mixing.mix_sources(frame([])).count() == 0
    assert mixing.mix_sources(frame([(1, "a", None), (2, None, " ")])).count() == 0


def test_one_source_is_taken_once(frame):
    found = mixing.mix_sources(frame([(k, "a", "x y") for k in range(50)]))
    assert Counter(r.doc_id for r in found.collect()) == Counter(range(50))
