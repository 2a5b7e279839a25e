import gzip
import math
import re
from collections import Counter, defaultdict

import pytest
from pyarrow import fs as pafs

from cohortlift.llm import urls, warc
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, payload string, shard int, host string, rule string, n long"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "http://A.net/x", "same"), (2, None, "same"), (2, None, "same"), (None, "http://b", "same"), (None, "nothing", None), (3, "", ""), (4, "http://c.org/fr/\n1", "é" * 1000),
            (-10**15, "http://d", "far"), (5, "https://x.example.com", "only"), (6, "x://", "z" * 300_000), (None, "a", "lonely"), (None, "b", "lonely")]
    return spark.createDataFrame([(*r, "p", 1, "h", "r", 3) for r in rows], SCHEMA)


def plain_records(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    out = []
    for r in rows:
        data, answer = (r.html or "").encode(), first.get(r.html or "")
        revisit = answer is not None and r.page_id != answer
        out.append((str(r.page_id), len(data), warc.digest(data), "revisit" if revisit else "response", str(answer if revisit else None)))
    return sorted(out)


def got(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def test_round_trip(spark, odd_pages):
    for pages in (read(spark, SMALL, "pages"), odd_pages):
        assert got(warc.round_trip(pages)) == plain_records(pages.select("page_id", "html").collect())
    assert warc.round_trip(odd_pages.where("false")).count() == 0
    assert all(r.record_type == "response" for r in warc.round_trip(odd_pages, least=5).collect() if r.payload_bytes < 5)


def test_files_are_the_same_on_a_rerun_and_stay_small(spark, tmp_path):
    pages = read(spark, SMALL, "pages")
    made = [warc.write(p, f"file://{tmp_path}/{n}", shard_bytes=60_000, roll_bytes=15_000) for n, p in enumerate((pages, pages.repartition(5)))]
    assert made[0] == made[1] and len(made[0]) > 5
    assert all(f["bytes"] <= 15_000 or f["records"] == 1 for f in made[0])
    assert {x.base_name for x in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(f"{tmp_path}/0"))} == {"manifest.json", *(f["name"] for f in made[0])}
    ids = [r.page_id for r in warc.read_back(spark, f"file://{tmp_path}/0").collect()]
    assert sorted(ids) == sorted(r.page_id for r in pages.select("page_id").collect())


def test_shards_are_even_with_outlying_and_null_ids(spark, tmp_path):
    ids = [*range(300), 10**15, -(10**17), *[None] * 300]
    pages = spark.createDataFrame([(i, "http://a", f"{n} " + "x" * 1000) for n, i in enumerate(ids)], "page_id long, url string, html string")
    manifest = warc.write(pages, f"file://{tmp_path}/w", shard_bytes=40_000)
    held = Counter()
    for f in manifest:
        held[f["name"].split("-")[0]] += f["records"]
    assert sum(held.values()) == len(ids) and len(held) >= 24 and max(held.values()) <= 40_000 // 1600 + 1
    found = []
    for f in manifest:
        with pafs.LocalFileSystem().open_input_stream(f"{tmp_path}/w/{f['name']}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
            found += [int(h.get("x-page-id", -(10**18))) for h, _ in warc.records(stream)]
    assert found == sorted(found)


def plain_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for kind, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    return host, path, best


@pytest.mark.parametrize("source", ["small", "odd"])
def test_rules_equal_brute_force(spark, odd_pages, source):
    pages = read(spark, SMALL, "pages") if source == "small" else odd_pages
    expected = sorted((str(r.page_id), r.url or "", *(str(x) for x in plain_url(r.url)[:2]), str((plain_url(r.url)[2] or [None])[0])) for r in pages.collect())
    out = urls.judged(pages)
    rows = out.collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in rows) == sorted((a, h, p, r) for a, _, h, p, r in expected)
    said = {f"{h}{p}": k for k, h, p in urls.RULES}
    assert all(r.verdict in ("allow", "block") and (r.rule is None or r.verdict == said[r.rule]) for r in rows)
    assert urls.judged(pages.where("false")).count() == 0


def test_templates(spark):
    rows = [(f"http://casino.example.com/{lang}/{i}/page{i}.html") for lang in ("en", "xx") for i in range(30)]
    rows += [f"http://good.example.com/shop/item{i}x{i % 7}y/view" for i in range(200)] + ["http://good.example.com/zz/1"]
    rows += [f"http://names.example.com/u/{a}{b}{c}/home" for a in "abcde" for b in "fghij" for c in "kl"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")
    out = urls.judged(pages).collect()
    verdicts = {r.host.split(".")[0]: r.verdict for r in out}
    assert verdicts == {"casino": "block", "good": "allow", "names": "allow"}
    # fifty user names, one page each, are one variable segment; two branches that are alike are merged
    assert {r.template for r in out if r.host.startswith("names")} == {"/u/*/home"}
    assert {r.template.split("/")[1] for r in out if r.host.startswith("casino")} == {"*"}


def plain_templates(shapes):
    """shape -> template of one host's distinct shapes, node by node."""
    out = {}

    def grow(name, members):
        values = Counter(rest[0] for _, rest in members if rest)
        m = sum(values.values())
        entropy = -sum(w / m * math.log(w / m) for w in values.values())
        below = defaultdict(list)
        for shape, rest in members:
            if rest:
                below["*" if math.exp(entropy) > urls.EFFECTIVE - 1e-6 else rest[0]].append((shape, rest[1:]))
            else:
                out[shape] = name
        for value, group in below.items():
            grow(f"{name}/{value}", group)

    grow("", [(s, s.split("/")[1:]) for s in shapes])
    return out


def plain_judgements(rows):
    """(page_id, template, purity, verdict) of all rows, by dictionaries."""
    pages = []
    for r in rows:
        host, path, best = plain_url(r.url)
        shape = re.sub("[0-9]+", "#", re.sub(r"(?<=/)([0-9]+|[0-9a-f]{8,})(?=[/.]|$)", "*", path))
        named = re.search(urls.UNWANTED, host) is not None
        pages.append((r.page_id, host, shape, best, int(best is not None or named), int(best[1] == "block" if best else named)))
    leaf, counts, families = {}, defaultdict(lambda: [0, 0]), defaultdict(set)
    for host in {p[1] for p in pages}:
        leaf[host] = plain_templates({p[2] for p in pages if p[1] == host})
    for _, host, shape, _, n, bad in pages:
        counts[host, leaf[host][shape]][0] += n
        counts[host, leaf[host][shape]][1] += bad
    for host, template in counts:
        parts = template.split("/")
        fixed = next((i for i, s in enumerate(parts) if s and "*" not in s), None)
        families[host, "/".join("*" if i == fixed else s for i, s in enumerate(parts))].add((host, template))
    final = {}
    for (_, merged), members in families.items():
        n, bad = (sum(counts[x][i] for x in members) for i in (0, 1))
        apart = False
        for x in members:
            k, b = counts[x]
            if k and n - k and 0 < bad < n:
                deviation = math.sqrt(bad / n * (1 - bad / n) * (1 / k + 1 / (n - k)))
                apart |= abs(b / k - (bad - b) / (n - k)) >= urls.APART * deviation
        together = not apart and sum(counts[x][0] > 0 for x in members) >= 2
        for x in members:
            k, b = (n, bad) if together else counts[x]
            final[x] = (merged if together else x[1], (b + 1) / (k + 2))
    out = []
    for page_id, host, shape, best, _, _ in pages:
        template, purity = final[host, leaf[host][shape]]
        out.append((str(page_id), template, round(purity, 9), best[1] if best else "block" if purity >= urls.PURE else "allow"))
    return sorted(out)


@pytest.fixture(scope="module")
def deep_pages(spark):
    made = [f"http://deep.example.org/a/b/c/d/{x}{y}/e/{i}" for x in "klmnop" for y in "qrstu" for i in range(2)]
    made += [f"http://deep.example.org/{'/'.join('xy' * 400)}{t}" for t in ("", "/", "/end", "/end/far")]
    made += [f"http://pills.example.org/fr/{a}" for a in "gh"] + [f"http://pills.example.org/{a}/{b}{c}" for a in ("fr", "in", "out") for b in "klmno" for c in "pqrs"]
    made += ["http://deep.example.org", "http://deep.example.org/", "http://deep.example.org//", "http://deep.example.org/a/b", None, "none"]
    return spark.createDataFrame(list(enumerate(made)), "page_id long, url string")


@pytest.mark.parametrize("source", ["small", "odd", "deep"])
def test_templates_purity_and_verdicts_equal_brute_force(spark, odd_pages, deep_pages, source):
    pages = {"small": read(spark, SMALL, "pages"), "odd": odd_pages, "deep": deep_pages}[source]
    expected = plain_judgements(pages.collect())
    got = sorted((str(r.page_id), r.template, round(r.purity, 9), r.verdict) for r in urls.judged(pages).collect())
    assert got == expected
    if source == "deep":
        assert sum(t == "/a/b/c/d/*/e/*" for _, t, _, _ in got) == 60


def test_templates_stay_when_rows_repeat_and_hosts_grow(spark):
    def named(names, times):
        rows = [(i, f"http://names.example.com/u/{n}/home") for i, n in enumerate(names)] * times
        return {r.template for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}

    names = [f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklm" for c in "nopqr"]
    assert named(names[:50], 1) == named(names[:50], 5) == named(names, 3) == {"/u/*/home"}
