"""Change batches against a walk record by record, and streams of deliveries."""

import random

import pytest
from pyspark.sql import functions as F

from landloom.operators import history as H, lookups
from landloom.streaming import changes as S

DAY = "2030-01-01T00:00:00Z"
VERSIONS = "gml_id string, beginnt string, endet string, anlass array<string>"
CHANGES = "seq long, typename string, featureid string, context string, safetoignore string, replacedby string, anlass array<string>, endet string"


def compact(t):
    return t.replace("-", "").replace(":", "")


def walk(changes, versions, keep):
    """Every record on the table that the ones before it have left."""
    rows, out = [list(v) for v in versions], {}
    for seq, _, fid, context, safe, by, reasons, given in sorted(changes):
        context = (context or "delete").lower()
        out[seq] = "error"
        if fid is None or len(fid) not in (16, 32):
            continue
        key = fid[:16]
        open_ = sorted(r[1] for r in rows if r[0] == key and r[2] is None)
        begin = f"{fid[16:20]}-{fid[20:22]}-{fid[22:24]}T{fid[25:27]}:{fid[27:29]}:{fid[29:31]}Z" if len(fid) == 32 else min(open_, default=None)
        if begin is None or context not in ("delete", "update", "replace"):
            continue
        if context == "replace" and (safe or "").lower() not in ("true", "false"):
            continue
        if not keep:
            if context == "replace" and fid == by:
                out[seq] = "ignored"
                continue
            gone = [r for r in rows if r[0] == key and r[1] == begin]
            rows = [r for r in rows if r not in gone]
            out[seq] = "applied" if len(gone) == 1 else "ignored"
            continue
        end = {"delete": DAY, "update": given, "replace": given}[context]
        if context == "update" and end is None:
            continue
        if context == "replace":
            if by is not None and len(by) == 32 and by != fid:
                end = f"{by[16:20]}-{by[20:22]}-{by[22:24]}T{by[25:27]}:{by[27:29]}:{by[29:31]}Z"
            succ = [r[1] for r in rows if by is not None and r[0] == by[:16]]
            if end is None:
                end = min((b for b in succ if b > begin), default=None)
            elif succ.count(end) != 1:
                continue
            if end is None:
                out[seq] = "error" if safe.lower() == "false" and by is not None and fid != by else "ignored"
                continue
        hit = [r for r in rows if r[0] == key and r[1] == begin]
        also = context == "update"
        if not hit:
            if (not open_ and context != "replace") or (len(open_) == 1 and context == "replace"):
                out[seq] = "ignored"
                continue
            if len(open_) != 2:
                out[seq] = "unresolved"
                continue
            begin, also = open_[0], True
            hit = [r for r in rows if r[0] == key and r[1] == begin]
        if len(hit) != 1:
            continue
        hit[0][2] = end
        if also and reasons:
            hit[0][3] = [*(hit[0][3] or []), *reasons]
        out[seq] = "applied"
    return sorted((r[0], r[1], r[2], ",".join(r[3] or [])) for r in rows), out


def batch(seed):
    draw = random.Random(seed)
    begins = [f"20{y:02}-0{m}-01T00:00:00Z" for y in range(10, 16) for m in (1, 2)]
    ids = [f"DESN{k:012}" for k in range(12)]
    versions = [(i, b, draw.choice([None, None, b.replace("20", "21", 1)]), ["A"]) for i in ids for b in sorted(draw.sample(begins, draw.randint(0, 6)))]
    versions += [v for v in versions if draw.random() < .05]  # a version that is stored twice
    changes = []
    for seq in range(90):
        i = draw.choice(ids)
        fid = draw.choice([i, i, i + compact(draw.choice(begins)), i + compact(draw.choice([b for k, b, *_ in versions if k == i] or begins))])
        other = draw.choice([i, i, draw.choice(ids)])
        by = draw.choice([None, fid, other, other + compact(draw.choice(begins)), other + compact(draw.choice([b for k, b, *_ in versions if k == other] or begins))])
        changes.append((seq, "t", draw.choice([fid] * 20 + ["bad", None]), draw.choice(["delete", "Update", "replace", "replace", None] + (["other"] if seq % 17 == 0 else [])),
                        draw.choice(["true", "false", "False", None] if seq % 5 == 0 else ["true", "false"]), by, draw.choice([None, [f"R{seq}"]]),
                        draw.choice([None, "2029-01-01T00:00:00Z", draw.choice(begins)])))
    return versions, changes


@pytest.mark.parametrize("keep", [True, False])
def test_records_in_their_order(spark, keep):
    for seed in (1, 2):
        versions, changes = batch(seed)
        v, c = spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(changes, CHANGES)
        planned = H.plan_changes(c, v, DAY, keep)
        rows, status = walk(changes, versions, keep)
        assert {r.seq: r.status for r in planned.select("seq", "status").collect()} == status
        got = H.apply_closes(v, H.planned_closes(planned, keep)).select("gml_id", "beginnt", "endet", F.array_join("anlass", ",")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_next_after(spark):
    draw = random.Random(3)
    times = [f"20{draw.randint(10, 13)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}T00:00:00Z" for _ in range(60)]
    points = [(k, t) for t in times for k in ("a", "b") if draw.random() < .5] + [("c", None), ("a", times[0]), ("a", times[0])]
    asks = [(n, draw.choice("abcd"), draw.choice(times)) for n in range(80)]
    got = lookups.next_after(spark.createDataFrame(asks, "n int, id string, after string"), spark.createDataFrame(points, "id string, t string"), "id", "t", "next")
    want = {n: min((t for k, t in points if k == i and t and t > a), default=None) for n, i, a in asks}
    assert {r.n: r.next for r in got.collect()} == want


def test_deliveries_in_two_phases(spark, tmp_path):
    """A replaced version and its successor come in one delivery; a delivery that runs again changes nothing."""
    root, first, second, third = str(tmp_path / "r"), *(f"202{k}-01-01T00:00:00Z" for k in (0, 1, 2))
    a, b = "DESN000000000001", "DESN000000000002"
    S.start_snapshot(spark.createDataFrame([(a, first, None, ["A"]), (b, first, None, ["A"])], VERSIONS), root)
    send = lambda new, changes: S.delivery(spark.createDataFrame(new, VERSIONS), spark.createDataFrame(changes, CHANGES))
    table = lambda **k: sorted(map(str, S.snapshot(spark, root, **k).collect()))
    one = send([(a, second, None, ["N"]), (a, second, None, ["N"]), (b, first, None, ["known"])],
               [(1, "t", a + compact(first), "replace", "false", a + compact(second), None, None),
                (2, "t", "DESN000000000009", "delete", None, None, None, None)])
    S.apply_batch(one, 0, root, DAY, compact_every=2)
    done = table()
    assert {(r.gml_id, r.beginnt, r.endet) for r in S.snapshot(spark, root).collect()} == {(a, first, second), (a, second, None), (b, first, None)}
    assert len(done) == 3
    assert [(r.seq, r.status, r.problem) for r in S.outcomes(spark, root, "error").collect()] == [(2, "error", "no open version")]
    S.apply_batch(one, 0, root, DAY, compact_every=2)
    assert table() == done
    two = send([(a, third, None, ["N"])], [(3, "t", a, "replace", "true", a, None, None), (4, "t", b, "update", None, None, ["U"], third)])
    for _ in range(2):  # the second base is written by the first run and does not count for the second
        S.apply_batch(two, 1, root, DAY, compact_every=2)
    assert {(r.gml_id, r.beginnt, r.endet, ",".join(r.anlass)) for r in S.snapshot(spark, root).collect()} == {
        (a, first, second, "A"), (a, second, third, "N"), (a, third, None, "N"), (b, first, third, "A,U")}
    assert S._numbers(spark, root, "base") == [-1, 1] and table(before=1) == done
    S.apply_batch(send([], [(5, "t", a, "delete", None, None, None, None)]), 2, root, DAY, compact_every=1)
    S.expire(spark, root)
    assert S._numbers(spark, root, "base") == [1, 2] and S.finished(spark, root) == [2]
    assert sum(r.endet == DAY for r in S.snapshot(spark, root).collect()) == 1


def test_removed_versions_may_come_again(spark, tmp_path):
    root, a, first = str(tmp_path / "r"), "DESN000000000001", "2020-01-01T00:00:00Z"
    S.start_snapshot(spark.createDataFrame([(a, first, None, ["A"])], VERSIONS), root)
    none, gone = spark.createDataFrame([], VERSIONS), spark.createDataFrame([(1, "t", a, "delete", None, None, None, None)], CHANGES)
    S.apply_batch(S.delivery(none, gone), 0, root, DAY, keep_history=False)
    assert S.snapshot(spark, root).count() == 0
    S.apply_batch(S.delivery(spark.createDataFrame([(a, first, None, ["B"])], VERSIONS), gone.limit(0)), 1, root, DAY, keep_history=False)
    assert [r.anlass for r in S.snapshot(spark, root).collect()] == [["B"]]
    S.apply_batch(S.delivery(none, gone), 2, root, DAY, keep_history=False)
    assert S.snapshot(spark, root).count() == 0
