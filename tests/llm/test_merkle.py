import hashlib
import zlib

from cohortlift.llm import merkle
from plain import ascii_lower


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 16 * 16
        out.append((i - first, level[first:i] + level[i + 1 : first + 16]))
        i //= 16
    return out


def brute(rows):
    """(doc_id, source, lang, n_chars, text) rows -> the contract's rows, tree by tree."""
    trees = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        other = leaf([*r[:4], ascii_lower(r[4])]) if hit and r[4] is not None else leaf(r)
        trees.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), leaf(r), other, r[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree([x[1] for x in sorted(trees[s])]) for s in order}
    top = tree([built[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for j, s in enumerate(order):
        for i, (_, l, other, doc_id) in enumerate(sorted(trees[s])):
            way = path(built[s], i) + path(top, j)
            node = other
            for place, others in way:
                node = h([*others[:place], node, *others[place:]])
            out.append((doc_id, l, built[s][-1][0], root, h(o for _, others in way for o in others), node, node == root))
    return out


def check(df, **config):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    got = [tuple(r) for r in merkle.manifest(df, **config).collect()]
    expected = brute([tuple(r) for r in df.select(*fields).collect()])
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    return got


def rows_of(big, sources):
    rows = [(i, "big", "en", 3, f"Text {i}") for i in range(big)]
    rows += [(10_000 + i, f"s{i}", None, None, "X") for i in range(sources)]
    rows += [(20_000 + i, "sixteen", "de", 1, "é A") for i in range(16)] + [(30_000 + i, "seventeen", "de", 1, None) for i in range(17)]
    return rows + [(40_000, None, "en", 0, ""), (40_001, None, "en", 0, "Z"), (40_002, "", "en", 0, "Z"), (40_003, "\U0001f600", "en", 0, "Z"), (40_004, "～", "en", 0, "Z")]


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def test_equals_brute_force_over_several_tiers(spark):
    """Superblocks of one level: a source of three tiers, sources of two tiers, sources of one, of 16 and of 17."""
    got = check(spark.createDataFrame(rows_of(300, 60), COLUMNS).repartition(7), depth=1)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_equals_brute_force_beyond_a_superblock(spark):
    check(spark.createDataFrame(rows_of(4_200, 3), COLUMNS).repartition(3))


def test_odd_cases(spark, odd, nothing):
    check(odd)
    check(odd.where("doc_id = 8"))
    assert merkle.manifest(nothing).count() == 0
    assert merkle.manifest(nothing).columns == merkle.manifest(odd).columns


def test_repeated_rows_and_ids_of_text(spark):
    rows = [("same", "hot", "en", 4, "Same")] * 600 + [(None, "hot", None, None, None)] * 40 + [("b", "a", "en", 1, "B")]
    df = spark.createDataFrame(rows, "doc_id string, source string, lang string, n_chars int, text string")
    got = [tuple(r) for r in merkle.manifest(df).collect()]
    assert len(got) == 641 and len({r[3] for r in got}) == 1
    again = [tuple(r) for r in merkle.manifest(df.repartition(5)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_a_changed_cell_changes_the_root(spark, odd):
    root = {r.root for r in merkle.manifest(odd).collect()}
    other = {r.root for r in merkle.manifest(odd.replace("en", "fr", "lang")).collect()}
    assert len(root) == len(other) == 1 and root != other
