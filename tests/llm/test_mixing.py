import re

from riskframe.llm import mixing as op

from .cases import docs, rows_of


def check(rows, got):
    """Sizes, targets by hand, and that each source's words come near its target."""
    sizes = {}
    for i, t, _, s in rows:
        sizes.setdefault(s, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    total = {s: sum(v) for s, v in sizes.items()}
    target, free, budget = {}, set(names), float(sum(total.values()))
    while free:
        share = {s: budget * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * total[s]
            budget -= target[s]
        free -= over
    for r in got:
        assert r["source_size"] == total[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    for s in names:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - target[s]) <= 2 * max(sizes[s]) + 1, (s, taken, target[s])
    assert sum(r["taken"] for r in got) <= sum(total.values())


def test_targets_and_shares(spark):
    rows = [(i, "w " * (1 + i % 7), None, "abcdefg"[min(6, i // 40)]) for i in range(400)]
    rows += [(1000 + i, "x y z", None, None) for i in range(3)]
    got = op.mix(docs(spark, rows)).collect()
    check(rows, got)
    again = op.mix(docs(spark, rows[::-1]).repartition(5))
    assert rows_of(again, "doc_id", "taken") == sorted((r["doc_id"], r["taken"]) for r in got)


def test_odd_rows(spark):
    from .cases import ROWS

    got = op.mix(docs(spark)).collect()
    assert len(got) == len(ROWS)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)


def test_empty(spark):
    assert op.mix(docs(spark, [])).count() == 0
    assert op.apply_mix(docs(spark, [])).count() == 0


def test_apply_repeats_rows(spark):
    rows = [(i, "a b c", None, "s" if i < 2 else "t") for i in range(20)]
    df = docs(spark, rows)
    times = {r["doc_id"]: r["taken"] // 3 for r in op.mix(df).collect()}
    mixed = op.apply_mix(df)
    assert mixed.columns == df.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in times.items() if n}


def words_by_source(rows):
    out = {}
    for r in rows:
        out[r["source"]] = out.get(r["source"], 0) + len((r["text"] or "").split())
    return out


def test_apply_takes_rows_that_share_an_id_each_for_itself(spark):
    """Null and repeated ids: each source gets the words that the plan gives it."""
    rows = [(None, f"u{i} " + "w " * (i % 5), None, "a") for i in range(60)] + [(None, " ", None, "a")]  # target below its size
    rows += [(7, f"v{i} x y", None, "b") for i in range(40)] + [(i, "p q r", None, "c") for i in range(40)]
    rows += [(None, "all the same", None, "d") for _ in range(50)]  # a fourth source, weight 1: cut among equal rows
    df = docs(spark, rows)
    plan = {}
    for r in op.mix(df).collect():
        plan[r["source"]] = plan.get(r["source"], 0) + r["taken"]
    mixed = op.apply_mix(df)
    assert mixed.columns == df.columns
    got = mixed.collect()
    assert words_by_source(got) == plan and 0 < plan["a"] < sum(1 + i % 5 for i in range(60)) and plan["d"] % 3 == 0 and 0 < plan["d"] < 150
    assert sum(r["text"] == " " for r in got) == 1
