"""Near-duplicate stories."""

import random

from pyspark.sql import functions as F

from broadsheet.operators import curation as U


def test_near_stories(spark):
    base = "the quick brown fox jumps over the lazy dog near the quiet river bank every single morning"
    rows = [(1, base, ""), (2, base + " again", ""), (3, "", base.upper() + "!"), (4, "something else entirely happened today", ""), (5, "", ""), (6, None, None), (7, None, None)]
    rows += [(100 + i, f"market report number {i} stocks fell sharply while bonds gained ground amid fears", "") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id BIGINT, title STRING, summary STRING")
    got = {r["row_id"]: r["story_id"] for r in U.near_stories(df).collect()}
    assert got[1] == got[2] == got[3] == 1 and [got[i] for i in (4, 5, 6, 7)] == [4, 5, 6, 7]
    assert len(got) == len(rows) and all(got[100 + i] == 100 for i in range(300))
    assert U.near_stories(df.filter(F.lit(False))).collect() == []


def plain(rows, percent):
    """Components of all pairs."""
    import re
    sets = {i: set(re.findall(r"[^\W_]+", f"{t or ''}\n{s or ''}".lower())) for i, t, s in rows}
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            c = len(sets[a] & sets[b])
            if c and c * 100 >= len(sets[a] | sets[b]) * percent:
                p, q = find(a), find(b)
                low[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_no_link_is_lost(spark):
    """Every pair at the threshold counts, with chains, a hot word and groups that share words but are no stories."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(60):
        base = r.sample(words, r.randint(4, 25))
        for _ in range(6):
            kept = [w for w in base if r.random() < r.choice([1.0, 0.9, 0.75, 0.6])]
            rows.append((len(rows) * 7 + 1, " ".join([*kept, *r.sample(words, r.randint(0, 4))]), "hot"))
    rows += [(90_000 + i, rows[i % 40][1], rows[i % 40][2]) for i in range(80)]
    df = spark.createDataFrame(rows, "row_id BIGINT, title STRING, summary STRING").repartition(4)
    for percent in (50, 60, 75):
        got = {x["row_id"]: x["story_id"] for x in U.near_stories(df, percent=percent).collect()}
        assert got == plain(rows, percent)


def test_pairs_that_cannot_agree_are_not_compared(spark, monkeypatch):
    """Sets of words that are all frequent share some with most others: few of these pairs may travel with their words."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(r.sample(words, 12)), "") for i in range(300)]
    rows += [(300 + i, rows[i][1] + " more", "") for i in range(20)]
    seen, linked = [], U._linked
    monkeypatch.setattr(U, "_linked", lambda pairs, *a: seen.append(pairs.count()) or linked(pairs, *a))
    df = spark.createDataFrame(rows, "row_id BIGINT, title STRING, summary STRING")
    got = {x["row_id"]: x["story_id"] for x in U.near_stories(df).collect()}
    assert got == plain(rows, 60)
    assert sum(seen) <= 3 * len(rows)
