"""The manifest, the vector codes and the URL filter on small tables with every odd case, against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lindero.llm")

from lindero.llm import host_reputation, merkle, vector_codes  # noqa: E402

CLASHES = {"tree": 1, "hash": 2, "place": 3, "leaves": 4, "path": 5, "root": 6, "number": 7, "spread": 8, "host": "h", "rule": "r", "code": "c", "error": 9, "v": 10, "salt": 11, "bad": 12, "n": 13, "_r": 14}


# --- manifest -------------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_of(hashes):
    """Levels of a tree, the leaves first."""
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climb(levels, at, start):
    """(what the fold of ``start`` gives, the siblings on the way)."""
    h, seen = start, []
    for level in levels[:-1]:
        first = at - at % 16
        run = level[first : first + 16]
        left, right = run[: at - first], run[at - first + 1 :]
        h, at = sha(*left, h, *right), at // 16
        seen += left + right
    return h, seen


def plain_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees, sorted_rows = {}, {}
    for s in names:
        sorted_rows[s] = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = tree_of([leaf_of(r) for r in sorted_rows[s]])
    top = tree_of([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(sorted_rows[s]):
            start = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                start = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            sub, low = climb(trees[s], i, start)
            root, high = climb(top, k, sub)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], sha(*low, *high), root, root == top[-1][0]))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_rows():
    rng = random.Random(3)
    rows = [(i, "hot", rng.choice(["es", None]), i, f"Texto {i} ÑÁ") for i in range(300)]
    rows += [(i, None, "es", None, rng.choice([None, "", "A b", "a b"])) for i in range(1000, 1017)]
    rows += [(2000, "solo", "es", 1, "X" * 100_000), (2001, "", "es", 1, "-"), (2002, "ñ", None, None, None), (2003, "z", "es", 0, "3:abc"), (None, "z", "es", 0, "ABC"), (None, "z", "es", 0, "ABC")]
    rows += [(3000, "copies", "es", 1, "Igual")] * 40 + [(3000, "copies", "es", 1, "otro"), (-5, "copies", "es", 1, "N")]
    rows += [(4000 + i, f"source {i}", "es", 1, "Texto") for i in range(30)]
    return rows


def got_manifest(df):
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)


def test_manifest_against_plain_trees(spark):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(7).select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])
    got, want = got_manifest(df), plain_manifest(rows)
    assert got == want
    assert any(not r[-1] for r in got) and sum(r[-1] for r in got) > len(got) // 2
    tampered = {r[0] for r in got if not r[-1]}
    assert all(i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in tampered)


def test_manifest_of_few_rows(spark):
    for rows in ([(7, None, None, None, None)], [(1, "a", "b", 2, "C"), (2, "a", "b", 2, "C")], [(1, "a", "b", 2, "C"), (1, "b", "b", 2, "C")]):
        assert got_manifest(spark.createDataFrame(rows, DOCS)) == plain_manifest(rows)
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_stretches_of_any_ends_meet():
    """Stacks over stretches, and runs of what they leave open, give the nodes of the whole tree."""
    rng = random.Random(1)
    for _ in range(60):
        n = rng.choice([1, 2, 4, 5, 15, 16, 17, 63, 64, 65, 200])
        leaves = [sha(str(i)) for i in range(n)]
        cuts = sorted({0, n, *rng.choices(range(n + 1), k=rng.randint(0, 6))})
        nodes = {}
        for a, b in zip(cuts, cuts[1:]):
            for _tree, _n, level, place, h, is_open in merkle.climbed(iter([("t", n, i, leaves[i]) for i in range(a, b)]), 4):
                assert (level, place) not in nodes
                nodes[level, place] = (h, is_open)
        level, want = 0, leaves
        while len(want) > 1:
            opened = sorted(p for (k, p), (_, o) in nodes.items() if k == level and o)
            for parent in {p // 4 for p in opened}:
                run = [nodes[level, p][0] for p in opened if p // 4 == parent]
                assert len(run) == len(want[parent * 4 : parent * 4 + 4])  # all siblings are open, or none
                assert (level + 1, parent) not in nodes
                nodes[level + 1, parent] = (sha(*run), True)
            level, want = level + 1, [sha(*want[i : i + 4]) for i in range(0, len(want), 4)]
            assert [nodes[level, i][0] for i in range(len(want))] == want


# --- vector codes ---------------------------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next((len(r[1]) for r in ordered if r[1] and len(r[1]) % parts == 0), None)
    most = math.isqrt((1 << 62) // width) // 2 if width else 0
    whole = [[math.floor(256 * x) for x in r[1]] if len(r[1]) == width and all(abs(math.floor(256 * x)) <= most for x in r[1]) else None for r in ordered]
    step = (width or 0) // parts
    cut = [w and [w[p * step : (p + 1) * step] for p in range(parts)] for w in whole]
    books = [[c[p] for c in [c for c in cut if c][:entries]] for p in range(parts)]

    def near(p, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for c in filter(None, cut):
            for p in range(parts):
                groups[p, near(p, c[p])[1]].append(c[p])
        for (p, k), own in groups.items():
            books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    said = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], Counter()
    for r, c in zip(ordered, cut):
        found = c and [near(p, c[p]) for p in range(parts)]
        out.append((r[0], found and "".join(f"{k:02x}" for _, k in found), found and sum(d for d, _ in found), r[2], said))
        if found:
            sums[r[2]] += out[-1][2]
    seen = {r[3] for r in out if r[1]}
    return sorted(((i, c, e, sums[label] if label in seen else None, s) for i, c, e, label, s in out), key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("count", [5, 130])
def test_codes_against_plain_rounds(spark, count):
    rng = random.Random(count)
    grid = lambda: [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0, rng.uniform(-2, 2)]) for _ in range(8)]
    rows = [(i, [float(np.float32(x)) for x in grid()], rng.choice([None, 1, 2])) for i in range(count)]
    rows += [(rows[0][0], rows[0][1], 1), (3, rows[1][1], 2), (None, rows[2][1], None)]
    rows += [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [1.0] * 7 + [float("nan")], 1), (903, [float("-inf")] * 8, 1), (904, [1.0] * 4, 1), (905, [], None), (906, [float(np.float32(1e30))] * 8, 3), (-1, [0.5] * 3, 4)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5).select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])
    got = sorted((tuple(r) for r in vector_codes.coded(df, parts=4, entries=16).collect()), key=str)
    assert got == plain_codes(rows, 4, 16, 2)


def test_codes_of_tables_without_vectors(spark):
    assert vector_codes.coded(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.coded(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    got = vector_codes.coded(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], VECTORS)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in got] == [(None, None, None)]


def test_cells_lose_no_nearest_entry():
    rng = np.random.default_rng(5)
    for spread in (2, 40, 10_000):
        entries, parts = rng.integers(-spread, spread, (64, 4)), rng.integers(-spread, spread, (500, 4))
        va = vector_codes.quantised(entries)
        distance = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        at, least = vector_codes.nearest(parts, va)
        assert (at == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
    assert vector_codes.candidates(parts, va).mean() < 0.5  # the bounds spare most refinements


# --- URL filter -----------------------------------------------------------------------------------------------------


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in host_reputation.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.example.net/en/x?q#f", "http://a.example.net/en", "HTTP://A.EXAMPLE.NET/en/", "http://example.net", "http://notexample.net/en/1", "http://net/x", "http://x.net?/en/", "https://www.example.com/de/1", "https://example.com/DE/1",
    "https://example.com:80/de/1", "https://u@example.com/de/1", "https://b.org/fr/", "https://b.org/fr", "https://ÄB.org/es/", "x.net/en/", "", None, "://", "a://b://c.net/", "http://h\n.net/a\nb?c", "http://10.0.0.1/x", "http://[::1]/x", "http://shop.co.uk/x", "http://co.uk/x",
]


def test_rules_and_parts_of_urls(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r["page_id"]: r for r in host_reputation.judged(df, none).collect()}
    for i, u in enumerate(URLS):
        host, path = plain_split(u)
        rule, verdict = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow"), u


def test_domains_of_hosts(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "u@a.com:80": ("a.com", "com"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    assert {r[0]: (r[1], r[2]) for r in df.select("host", host_reputation.domain_of(F.col("host")), host_reputation.suffix_of(F.col("host"))).collect()} == hosts


def plain_rates(counts):
    """host: (n, bad) to host: (rate, variance), level by level."""
    suffix = {h: h.rsplit(".", 1)[-1] for h in counts}
    domain = {h: ".".join(h.split(".")[-2:]) for h in counts}

    def level(children, mean):
        excess = sum((b - n * mean[k][0]) ** 2 - n * mean[k][0] * (1 - mean[k][0]) for k, (n, b) in children.items())
        room = sum(n * (n - 1) * mean[k][0] * (1 - mean[k][0]) for k, (n, b) in children.items())
        rho = min(host_reputation.MOST_RHO, max(host_reputation.LEAST_RHO, excess / room if room else host_reputation.LEAST_RHO))
        k0 = 1 / rho - 1
        out = {}
        for k, (n, b) in children.items():
            r = (k0 * mean[k][0] + b) / (k0 + n)
            out[k] = (r, r * (1 - r) / (k0 + n + 1) + (k0 / (k0 + n)) ** 2 * mean[k][1])
        return out

    def summed(of):
        out = defaultdict(lambda: (0, 0))
        for h, (n, b) in counts.items():
            out[of[h]] = (out[of[h]][0] + n, out[of[h]][1] + b)
        return dict(out)

    s, d = summed(suffix), summed(domain)
    every = sum(n for n, _ in s.values())
    total = sum(b for _, b in s.values()) / every
    s2 = level(s, dict.fromkeys(s, (total, total * (1 - total) / (every + 1))))
    d2 = level(d, {k: s2[k.rsplit(".", 1)[-1]] for k in d})
    return level(counts, {h: d2[domain[h]] for h in counts})


def test_reputations_against_plain_ones(spark):
    """Bad hosts are blocked, good ones and their unlabelled neighbours are not; a hot host's pages count once each."""
    rng = random.Random(2)
    rate = {"www.good.com": 0.02, "blog.good.com": 0.05, "new.good.com": 0.0, "spam.farm.com": 0.97, "win.farm.com": 0.95, "new.farm.com": 0.0, "a.mixed.org": 0.4, "b.quiet.org": 0.1, "one.alone.org": 1.0}
    size = {"www.good.com": 400, "new.good.com": 1, "new.farm.com": 1, "one.alone.org": 1}
    pages, told = [], []
    for host, p in rate.items():
        for _ in range(size.get(host, 60)):
            i = len(pages)
            pages.append((i, f"https://{host}/es/{i}"))
            if not host.startswith("new") and (host == "one.alone.org" or rng.random() < 0.7):
                told.append((i, rng.random() < p))
    told += [(0, None), (None, True), (99_999, True), (pages[-1][0], True), (pages[-1][0], False)]
    df, labels = spark.createDataFrame(pages, "page_id long, url string").repartition(5), spark.createDataFrame(told, "page_id long, bad boolean")
    got = {r["host"]: r for r in host_reputation.judged(df, labels).dropDuplicates(["host"]).collect()}
    bad = {}
    for i, b in told:
        if i is not None and b is not None:
            bad[i] = bad.get(i, False) or b
    counts = {h: [0, 0] for h in rate}
    for i, u in pages:
        if i in bad:
            counts[u.split("/")[2]][0] += 1
            counts[u.split("/")[2]][1] += bad[i]
    want = plain_rates({h: tuple(c) for h, c in counts.items()})
    for h, (r, v) in want.items():
        assert math.isclose(got[h]["bad_rate"], r, rel_tol=1e-9)
        assert math.isclose(got[h]["bad_at_least"], r - 2.0 * math.sqrt(v), rel_tol=1e-9, abs_tol=1e-12)
    # The new host of a domain whose hosts are all bad goes with them; a single page of a lone host is not enough.
    assert {h for h in got if got[h]["verdict"] == "block"} == {"spam.farm.com", "win.farm.com", "new.farm.com"}
    assert got["one.alone.org"]["bad_rate"] > 0.5 and got["new.good.com"]["bad_rate"] < 0.1


def test_judged_tables_without_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    assert host_reputation.judged(none, labels).count() == 0
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    assert sorted((r["page_id"] or 0, r["host"], r["verdict"]) for r in host_reputation.judged(pages, labels).collect()) == [(0, "", "block"), (1, "a.com", "block"), (1, "a.com", "block")]
