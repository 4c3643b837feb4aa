"""The manifest against trees built whole in memory."""

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from broadsheet.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
H = lambda s: sha256(s.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H("".join(low[i:i + 16])) for i in range(0, len(low), 16)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        a = i - i % 16
        yield "".join(level[a:i]), "".join(level[i + 1:a + 16])
        i //= 16


def plain(rows):
    by, out = defaultdict(list), []
    for r in rows:
        leaf = H("".join(encoded(v) for v in (r[0], r[3], r[2], r[4], r[1])))
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None
        changed = leaf
        if r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0:
            changed = H("".join(encoded(v) for v in (r[0], r[3], r[2], r[4], small)))
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf, changed, r[0]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by[s])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, x in enumerate(sorted(by[s])):
            steps = [*path(trees[s], i), *path(top, k)]
            node = x[3]
            for a, b in steps:
                node = H(a + node + b)
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return out


def rows():
    out = [(i, f"Text Nr {i} Ü", "en", f"s{i % 3}", i) for i in range(700)]
    out += [(10_000 + i, f"hot {i}", None, "hot", None) for i in range(1300)]
    out += [(5, "Dup", "en", "hot", 3), (5, "Dup", "en", "hot", 3), (5, "dup", "en", "hot", 3), (None, None, None, None, None), (None, "x", "de", "hot", 1)]
    out += [(20_000 + i, "A", "en", f"single{i:02}", 1) for i in range(40)] + [(9, "", "", "", 0), (77, "LONG " * 50_000, "en", "é", 9)]
    return out


@pytest.mark.parametrize("step", [1, 2, 3])
def test_manifest(spark, step):
    data = rows()
    docs = spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA + ", tree string, digest string").repartition(5)
    got = [tuple(r) for r in manifest.audit(docs, step=step).collect()]
    assert Counter(got) == Counter(plain(data))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_one_source_and_none(spark):
    one = [(i, f"T{i}", "en", "a", 1) for i in range(17)]
    assert Counter(map(tuple, manifest.audit(spark.createDataFrame(one, SCHEMA)).collect())) == Counter(plain(one))
    lone = [(3, "T", "en", "a", 1)]
    assert [tuple(r) for r in manifest.audit(spark.createDataFrame(lone, SCHEMA)).collect()] == plain(lone)
    empty = manifest.audit(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_only_every_step_th_level_is_stored(spark):
    docs = spark.createDataFrame([(i, "t", "en", "a", 1) for i in range(16**3 + 1)], SCHEMA)
    _, sources, top, _ = manifest.manifest(docs, step=2)
    # 4,097 leaves make levels of 257, 17, 2 and 1 nodes; stored are those of 4,097 and 17.
    assert [level.count() for level in sources.levels] == [4097, 17]
    assert [level.count() for level in top.levels] == [1]
