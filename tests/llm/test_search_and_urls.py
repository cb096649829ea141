import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pivot_search, url_filter


def brute(rows, k):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    pad = max(len(v) for _, v in ok)
    ok = [(i, np.r_[v, np.zeros(pad - len(v), int)]) for i, v in ok]
    out = set()
    for n, (q, v) in enumerate(ok):
        if q % 5 == 0:
            best = sorted((-int(v @ w), i) for m, (i, w) in enumerate(ok) if m != n)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def test_top_k_is_exact(spark, monkeypatch):
    for name, value in {"STRETCH": 80, "ROW_BLOCK": 40, "QUERY_BLOCK": 16, "PAGE": 2}.items():
        monkeypatch.setattr(pivot_search, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(300)]
    rows[7], rows[10], rows[15] = (7, None), (10, [1.0, None, 2.0]), (15, [float("nan")] * 8)
    rows[20], rows[25], rows[31] = (20, [float("inf")] * 8), (25, rows[30][1]), (31, [0.5])
    rows.append((None, [1.0] * 8))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {tuple(r) for r in pivot_search.top_k(df, F.pmod("vec_id", F.lit(5)) == 0).collect()}
    assert got == brute(spark.createDataFrame(rows, df.schema).collect(), 5)
    assert pivot_search.top_k(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("spread, share", [(1, 0.1), (50, 1)])
def test_elimination_skips_rows(spread, share):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 50
    x = np.floor(centres[rng.integers(0, 20, 4000)] + spread * rng.normal(size=(4000, 16)))
    pivots, ids = pivot_search.choose_pivots(x[:500]), np.arange(4000)
    order = pivot_search.near_order(x, ids, pivots)
    least = pivot_search.first_kth(x[:20], ids[:20], x[:500], ids[:500], 5)
    of, got, score, taken = pivot_search.search(x[:20], ids[:20], least, x[order], order, order, pivot_search.pivot_table(x[order], order, pivots), pivots, 5)
    assert taken < 20 * 4000 * share and len(got) == 100
    for i in range(20):
        want = sorted((-(x[i] @ x[j]), j) for j in range(4000) if j != i)[:5]
        assert sorted(zip(-score[of == i], got[of == i])) == want


def test_many_equal_vectors_and_clashing_names(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), -1.0], i, "q") for i in range(90)] + [(4, [1.0, 2.0], 0, "q")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, uid bigint, score string")
    got = {tuple(r) for r in pivot_search.top_k(df, F.pmod("vec_id", F.lit(5)) == 0).collect()}
    assert got == brute([r[:2] for r in rows], 5)


URLS = [None, "", "nothing", "http://WWW.Example.COM/en/1?q#x", "https://a.net/es/2", "https://net/fr/", "ftp://sub.org?x=/", "http://example.com", "x://y://z/en/", "http://cheappills.org/win", "http://spam.net/xx/?u=http://a.com/", "http://com/#"]


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(h, p) for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, "".join(max(fits, key=lambda r: len(r[0] + r[1]))) if fits else None


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(None, URLS[3], 2)], "page_id bigint, url string, host int")
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(URLS) + 1
    verdicts = {h + p: v for h, p, v in url_filter.RULES}
    for r in rows:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"]) == plain(URLS[r["page_id"]])
        assert r["verdict"] == verdicts[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_segments_and_learnt_verdicts(spark):
    good = [f"http://a{i}.gardenbooks.com/news/{i}" for i in range(40)]
    bad = [f"http://b{i}.casinowin.example.com/en/{i}" for i in range(40)]
    words = [f"http://casino.org/{w}" for w in ("win", "garden", "books", "win", "casino") for _ in range(30)]
    asked = ["http://casinowin.org/en/x", "http://booksgarden.org/news/y"]
    pages = spark.createDataFrame(list(enumerate(good + bad + words + asked)), "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert (got[len(got) - 2], got[len(got) - 1]) == ("block", "allow")
    model = url_filter.Model({"free": -2.0, "bets": -3.0, "freeb": -9.0}, -8.0)
    assert model.segment("freebets") == ["free", "bets"] and model.segment("") == []


def test_rare_names_are_learnt_and_looked_up(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = ["garden", "books", "casino", "win", "free", "news", "bets", "tulip"]
    pick = lambda: "".join(rng.choice(words, rng.integers(1, 3)))
    urls = [f"http://{pick()}.{end}/{pick()}/{pick()}" for end in ("com", "example.com/en", "org", "net/es") for _ in range(40)]
    pages = spark.createDataFrame(list(enumerate([*urls, None, "http://tulipbets.org/en/freecasino"])), "page_id bigint, url string")
    found = []
    for most in (200_000, 3):
        monkeypatch.setattr(url_filter, "VOCABULARY", most)
        found.append({r["page_id"]: r for r in url_filter.judge(pages).collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) == len(urls) + 2
    for i, r in found[0].items():
        assert (r["block_odds"] is None) == (r["rule"] is not None) == (found[1][i]["block_odds"] is None)
        assert abs((r["block_odds"] or 0) - (found[1][i]["block_odds"] or 0)) < 1e-9 and r["verdict"] == found[1][i]["verdict"]
