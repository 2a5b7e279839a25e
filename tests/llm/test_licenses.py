import re

from cohortlift.llm import licenses
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"


def plain_bigrams(text):
    w = re.findall(licenses.NORMAL, re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return set(zip(w, w[1:], strict=False)) or {(x,) for x in w}


def plain(text):
    text = text or ""
    units = [("line", i, x) for i, x in enumerate(text.split("\n"))]
    if re.search(r"\n[\x20\x09\x0D]*\n", text):
        units += [("paragraph", i, x) for i, x in enumerate(re.split(r"\n[\x20\x09\x0D]*\n\s*", text))]
    if "\n" in text:
        units.append(("text", 0, text))
    out = []
    for kind, i, unit in units:
        a = plain_bigrams(unit)
        found = []
        for name, texts in licenses.TEMPLATES.items():
            for t in texts:
                b = plain_bigrams(t)
                value = round(2 * len(a & b) / (len(a) + len(b)), 6)
                if value >= licenses.DICE:
                    found.append((-value, name))
        if found:
            value, name = min(found)
            out.append((kind, i, name, -value))
    best = max(out, key=lambda x: x[3], default=(None, None, None, None))
    return best[2], best[3], len(out), ",".join(f"{k}:{i}:{n}:{v:.6f}" for k, i, n, v in out)


def check(df):
    expected = sorted(str((str(r.doc_id), *plain(r.text))) for r in df.select("doc_id", "text").collect())
    assert sorted(str((str(r.doc_id), r.license, r.dice, r.n_matches, r.matches)) for r in licenses.scanned(df).collect()) == expected


def test_matches_equal_brute_force(spark, odd, nothing):
    check(read(spark, SMALL, "documents"))
    check(odd)
    assert licenses.scanned(nothing).count() == 0
    mit, gpl = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["GPL-3.0"][1]
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", mit)
    texts = [mit, wrapped, f"Copyright 2020\n\n{wrapped}\n\n{gpl}", "released UNDER the mit license", "x\nLicensed under CC BY-NC 4.0.\ny", "", None, "\n\n\n", "License"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df)
    names = {r.doc_id: r.license for r in licenses.scanned(df).collect()}
    assert names[0] == names[1] == names[3] == "MIT" and names[2] in ("MIT", "GPL-3.0") and names[4] == "CC-BY-NC-4.0" and names[8] is None
