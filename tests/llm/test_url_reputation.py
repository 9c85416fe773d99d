import math
import random

import duckdb
import pytest

from starloom.llm import queries as Q
from starloom.llm import url_reputation as U


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{sf}/{t}.parquet'")
    cols = "page_id host path rule verdict".split()
    got = Q.op7_url_reputation(spark, f"/root/testdata/{sf}").select(*cols).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(f"SELECT {','.join(cols)} FROM ({U.SQL})").fetchall()))


def brute(pages, outcomes):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        tail = rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]

    count = {}
    for url, bad in outcomes:
        host = parts(url)[0]
        if host and bad is not None:
            names = host.split(".")
            for key in (("h", host), ("d", ".".join(names[-2:])), ("s", names[-1])):
                n, y = count.get(key, (0, 0))
                count[key] = (n + 1, y + bad)

    def strength(level):
        g = [v for (k, _), v in count.items() if k == level]
        n, y = sum(a for a, _ in g), sum(b for _, b in g)
        if len(g) < 2 or y in (0, n):
            return U.DEFAULT_STRENGTH
        p = y / n
        s = sum(a * (b / a - p) ** 2 for a, b in g)
        room = n - sum(a * a for a, _ in g) / n - (len(g) - 1)
        rho = (s / (p * (1 - p)) - (len(g) - 1)) / room if room > 0 else 0
        rho = min(max(rho, 1e-3), 0.999)
        return (1 - rho) / rho

    n = sum(a for (k, _), (a, _) in count.items() if k == "s")
    mean = sum(b for (k, _), (_, b) in count.items() if k == "s") / n if n else 0.0
    k = {level: strength(level) for level in "sdh"}
    out = {}
    for pid, url in pages:
        host, path = parts(url)
        m, w = mean, k["s"]
        names = host.split(".")
        for level, name in (("s", names[-1]), ("d", ".".join(names[-2:])), ("h", host)):
            if (level, name) not in count:
                break
            a, b = count[level, name]
            m, w = (b + k[level] * m) / (a + k[level]), a + k[level]
        fits = [(r, v) for r, v in U.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, "block" if m - U.Z * math.sqrt(m * (1 - m) / (w + 1)) > U.MAX_BAD else "allow")
        out[pid] = (host, path, rule, verdict)
    return out


def test_reputation_equals_brute_force(spark):
    rng = random.Random(3)
    hosts = [f"{a}.{d}" for d in ("good.com", "bad.com", "mixed.info") for a in ("a", "b", "c", "www")]
    rate = {"good.com": 0.02, "bad.com": 0.97, "mixed.info": 0.4}
    outcomes = [(f"https://{(h := rng.choice(hosts))}/x", int(rng.random() < rate[h.split('.', 1)[1]])) for _ in range(900)]
    outcomes += [(None, 1), ("nothing", 1), ("http://a.good.com", None)]
    urls = [f"https://{h}/p" for h in hosts] + ["http://new.bad.com/", "http://new.good.com", "http://one.info/q", "ftp://zzz", None, "", "no scheme", "HTTP://WWW.Bad.COM?x#y", "http://x.example.net/en/1", "http://example.net/EN/", "http://net", "http://a.net/?q=/en/", "http://é.org/fr/", "http://xorg/fr/", "http://example.com/de/#a", "http://a://b/c", "http://h/\nline?x"]
    pages = [(i, u) for i, u in enumerate(urls)]
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages], "page_id long, url string, Host string, verdict string")
    got = U.judge(df, spark.createDataFrame(outcomes, "url string, bad int")).collect()
    want = brute(pages, outcomes)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == want
    assert {want[i][3] for i in range(len(hosts))} == {"allow", "block"}
    none = U.judge(df, spark.createDataFrame([], "url string, bad int")).collect()
    assert {r.verdict for r in none if r.rule is None} == {"allow"}
    assert U.judge(df.limit(0), spark.createDataFrame(outcomes, "url string, bad int")).count() == 0


def test_registered_domain(spark):
    df = spark.createDataFrame([("a.b.example.co.uk",), ("example.com",), ("localhost",), ("x.y.org:8080",), ("",)], "h string")
    got = [tuple(r) for r in df.select(U.domain_of(df.h), U.suffix_of(df.h)).collect()]
    assert got == [("example.co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("y.org", "org"), ("", "")]
