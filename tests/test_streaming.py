"""Ad click stream: feedback loop fold, re-delivery, restart, late data."""

import datetime as dt
import os
import tempfile
import time

import pytest

from visitlens.sinks.deltas import DeltaStore
from visitlens.streaming import ad_stream as STR

T0 = 1704067207179      # 2024-01-01 00:00:07.179 UTC
MIN = 60_000


def _lines(spark, spec):
    """spec: (minute offset, province, city, user, ad)."""
    return spark.createDataFrame([(f"{T0 + m * MIN}_{p}_{c}_{u}_{a}",) for m, p, c, u, a in spec],
                                 "value string")


def _store(spark, tables=STR.AD_TABLES):
    return DeltaStore(spark, tempfile.mkdtemp(prefix="vl-state-"), tables)


def _table(store, name):
    return sorted(tuple(r) for r in STR.read_table(store, name).collect())


def test_blacklist_feedback_matches_fold(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=3)
    batches = [
        [(0, "P", "C", 1, 1)] * 3,                                  # user 1 reaches 3
        [(1, "P", "C", 1, 1)] * 2 + [(1, "P", "C", 2, 1)] * 2,      # user 1 filtered now
        [(2, "P", "C", 2, 1), (2, "Q", "D", 3, 5), "bad line"],    # user 2 reaches 3
    ]
    for i, spec in enumerate(batches):
        rows = [s for s in spec if not isinstance(s, str)]
        df = _lines(spark, rows)
        if len(rows) != len(spec):
            df = df.union(spark.createDataFrame([("bad line",)], "value string"))
        job.process(df, i)
    # plain fold over the batches
    blacklist, users, stat = set(), {}, {}
    for spec in batches:
        rows = [s for s in spec if not isinstance(s, str) and s[3] not in blacklist]
        for m, p, c, u, a in rows:
            users[u, a] = users.get((u, a), 0) + 1
            stat[p, c, a] = stat.get((p, c, a), 0) + 1
        blacklist |= {u for (u, a), n in users.items() if n >= 3}
    assert [r[0] for r in _table(store, "ad_blacklist")] == sorted(blacklist) == [1, 2]
    assert {(r[1], r[2]): r[3] for r in _table(store, "ad_user_click_count")} == users
    assert {(r[1], r[2], r[3]): r[4] for r in _table(store, "ad_stat")} == stat
    top = _table(store, "ad_province_top3")
    assert [(r[1], r[2], r[3]) for r in top] == [("P", 1, 6), ("Q", 5, 1)]
    assert sorted((r.batch_id, r.rejected) for r in STR.read_table(store, "ad_rejects").collect()) == \
        [(0, 0), (1, 0), (2, 1)]


def test_redelivered_batch_ignores_its_own_blacklist(spark):
    """A batch that ran before its commit was lost writes the same rows again."""
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=3)
    df = _lines(spark, [(0, "P", "C", 1, 1)] * 4 + [(0, "P", "C", 2, 1)])
    job.process(df, 0)
    first = _table(store, "ad_stat"), _table(store, "ad_blacklist")
    job.process(df, 0)
    assert (_table(store, "ad_stat"), _table(store, "ad_blacklist")) == first


def test_compaction_keeps_the_totals(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=5, compact_every=2)
    for i in range(6):
        job.process(_lines(spark, [(i, "P", "C", 1, 1), (i, "P", "C", 2, 1)]), i)
    assert [r[-1] for r in _table(store, "ad_user_click_count")] == [5, 5]
    assert [r[0] for r in _table(store, "ad_blacklist")] == [1, 2]
    # two folds so far; the second dropped what the first replaced
    assert sorted(f[1:3] for f in store._folders("ad_stat")) == \
        [("all", 1), ("all", 3), ("part", 2), ("part", 3), ("part", 4)]
    assert [r[-2:] for r in _table(store, "ad_province_top3")] == [(1, 10)]


def test_new_checkpoint_on_old_results_is_refused(spark):
    src = tempfile.mkdtemp(prefix="vl-src-")
    root = tempfile.mkdtemp(prefix="vl-run-")
    _write_file(src, "a.txt", [f"{T0}_P_C_1_1"])

    def run(checkpoint):
        q, store = STR.start_ad_stream(spark, spark.readStream.text(src), f"{root}/state",
                                       f"{root}/{checkpoint}", trigger="availableNow")
        q.awaitTermination()
        return store
    run("one")
    with pytest.raises(Exception, match="new checkpoint needs a new result folder"):
        run("two")


def test_stateful_totals_and_late_rows(spark):
    src = tempfile.mkdtemp(prefix="vl-src-")
    root = tempfile.mkdtemp(prefix="vl-run-")
    _write_file(src, "a.txt", [f"{T0}_P_C_1_1"] * 2 + ["9223372036854775807_P_C_1_1"])
    _write_file(src, "b.txt", [f"{T0}_P_C_2_1"] * 3 + [f"{T0}_P_C_2_2"])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    q, store = STR.start_stat_stream(spark, stream, f"{root}/state", f"{root}/ckpt",
                                     trigger="availableNow")
    q.awaitTermination()
    assert [r[-2:] for r in _table(store, "ad_stat_state")] == [(1, 5), (2, 1)]
    assert STR.late_rows(q) == 0


def test_redelivered_batch_is_not_counted_twice(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=100)
    df = _lines(spark, [(0, "P", "C", 1, 1)] * 2)
    job.process(df, 0)
    job.process(df, 0)
    assert _table(store, "ad_stat")[0][-1] == 2
    assert store.last_batch() == 0


_CLOCK = [time.time() - 10_000]


def _write_file(folder, name, spark_lines):
    """Write one source file; files get increasing modification times, which
    is the order the file source hands them to micro-batches."""
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(spark_lines) + "\n")
    _CLOCK[0] += 10
    os.utime(path, (_CLOCK[0], _CLOCK[0]))
    return path


def test_stream_restart_resumes_from_checkpoint(spark):
    src = tempfile.mkdtemp(prefix="vl-src-")
    root = tempfile.mkdtemp(prefix="vl-run-")
    lines = lambda n, u: [f"{T0}_P_C_{u}_1"] * n
    _write_file(src, "a.txt", lines(2, 1))
    _write_file(src, "b.txt", lines(3, 2))

    def run():
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
        q, store = STR.start_ad_stream(spark, stream, f"{root}/state", f"{root}/ckpt",
                                       threshold=100, trigger="availableNow")
        q.awaitTermination()
        return store

    store = run()
    assert _table(store, "ad_stat")[0][-1] == 5
    _write_file(src, "c.txt", lines(4, 3))
    store = run()                      # same checkpoint: only c.txt is new
    assert _table(store, "ad_stat")[0][-1] == 9
    assert len(_table(store, "ad_user_click_count")) == 3


def test_trend_stream_drops_rows_beyond_watermark(spark):
    src = tempfile.mkdtemp(prefix="vl-src-")
    root = tempfile.mkdtemp(prefix="vl-run-")
    _write_file(src, "a.txt", [f"{T0 + 180 * MIN}_P_C_1_1", f"{T0 + 181 * MIN}_P_C_1_1"])
    # Spark drops late rows against the watermark of the batch before, so
    # the late row comes two batches after the watermark moved to 02:01.
    _write_file(src, "b.txt", [f"{T0 + 175 * MIN}_P_C_1_3"])
    # one row 2 h older than the newest seen (late), one row on time
    _write_file(src, "c.txt", [f"{T0 + 60 * MIN}_P_C_1_1", f"{T0 + 170 * MIN}_P_C_1_2"])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    q, store = STR.start_trend_stream(spark, stream, f"{root}/state", f"{root}/ckpt",
                                      watermark="60 minutes", trigger="availableNow")
    q.awaitTermination()
    got = [(r.hour, r.minute, r.ad_id, r.click_count) for r in
           STR.read_table(store, "ad_click_trend").orderBy("hour", "minute").collect()]
    assert got == [("02", "50", 2, 1), ("02", "55", 3, 1), ("03", "00", 1, 1),
                   ("03", "01", 1, 1)]
    assert STR.late_rows(q) == 1
    recent = STR.last_hour(STR.read_table(store, "ad_click_trend"), T0 + 172 * MIN)
    assert recent.count() == 1


def test_sliding_stream_matches_batch_sliding(spark):
    from visitlens.operators import ads as AD
    from visitlens.sources.adlog import decode_ad_log
    src = tempfile.mkdtemp(prefix="vl-src-")
    spec = [f"{T0 + m * MIN}_P_C_1_{m % 2}" for m in range(0, 95, 4)]
    _write_file(src, "a.txt", spec)
    for window, slide in ((3600, 600), (60, 10)):
        root = tempfile.mkdtemp(prefix="vl-run-")
        q, store = STR.start_sliding_stream(spark, spark.readStream.text(src), f"{root}/state",
                                            f"{root}/ckpt", slide, trigger="availableNow")
        q.awaitTermination()
        steps = AD.window_steps(STR.read_table(store, "ad_click_bucket"), window, slide)
        got = AD.list_windows(steps, window, slide)
        batch = AD.sliding_trend(decode_ad_log(_lines_df(spark, spec))[0], window, slide)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def _lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_random_batches_match_fold(spark):
    import random
    rnd = random.Random(7)
    for trial in range(2):
        clicks = [(rnd.randint(0, 2 * 24 * 60), rnd.choice("PQ"), rnd.choice("CD"),
                   rnd.randint(1, 4), rnd.randint(1, 3)) for _ in range(120)]
        cuts = sorted(rnd.sample(range(1, len(clicks)), 3))
        batches = [clicks[a:b] for a, b in zip([0] + cuts, cuts + [len(clicks)])]
        store = _store(spark)
        job = STR.AdStreamJob(store, threshold=6)
        for i, b in enumerate(batches):
            job.process(_lines(spark, b), i)
        black, users, stat = set(), {}, {}
        for b in batches:
            kept = [c for c in b if c[3] not in black]
            for m, p, c, u, a in kept:
                day = (T0 + m * MIN) // 86_400_000
                users[day, u, a] = users.get((day, u, a), 0) + 1
                stat[day, p, c, a] = stat.get((day, p, c, a), 0) + 1
            black |= {u for (d, u, a), n in users.items() if n >= 6}
        epoch = __import__("datetime").date(1970, 1, 1)
        got_users = {((r.date - epoch).days, r.user_id, r.ad_id): r.click_count
                     for r in STR.read_table(store, "ad_user_click_count").collect()}
        got_stat = {((r.date - epoch).days, r.province, r.city, r.ad_id): r.click_count
                    for r in STR.read_table(store, "ad_stat").collect()}
        assert {r.user_id for r in STR.read_table(store, "ad_blacklist").collect()} == black
        assert got_users == users and got_stat == stat


DAY = 24 * 60


def test_a_batch_reads_its_own_days_files_only(spark):
    """30 stored days; a batch of one day opens that day's folders, by a partition filter."""
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=100)
    job.process(_lines(spark, [(d * DAY, "P", "C", u, 1) for d in range(30) for u in (1, 2)]), 0)
    job.process(_lines(spark, [(7 * DAY, "P", "C", 1, 1)]), 1)
    day = dt.date(2024, 1, 8)
    for table in ("ad_user_click_count", "ad_stat"):
        found = store.rows(table, before=2, dates=[day])
        files = found.inputFiles()
        assert files and all("/date=2024-01-08/" in f for f in files)
        assert len(files) < len(store.rows(table).inputFiles()) / 10
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "date#" in plan.split("PartitionFilters: [")[1]
    # the lookup of R4 and the ranking of R6 scan no other day
    for frame in (job._newly_blacklisted(2, [day]), job._touched_top(2, [day])):
        assert all("/date=2024-01-08/" in f for f in frame.inputFiles())
    assert {r.click_count for r in store.total("ad_stat", STR.STAT_KEYS, dates=[day]).collect()} == {3}


def test_compaction_rewrites_touched_days_only(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=100, compact_every=3)
    spread = [(d * DAY, "P", "C", 1, d % 3) for d in range(20)]
    for i in range(3):
        job.process(_lines(spark, spread), i)
    for i in range(3, 6):              # the first of these folds all 20 days
        job.process(_lines(spark, [(4 * DAY, "P", "C", 2, 1)]), i)
    assert sum(f[1] == "all" for f in store._folders("ad_stat")) == 20
    job.process(_lines(spark, [(4 * DAY, "P", "C", 3, 1), (5 * DAY, "P", "C", 3, 1)]), 6)
    folds = [(f[0], f[2]) for f in store._folders("ad_stat") if f[1] == "all"]
    assert [f for f in folds if f[1] == 5] == [("2024-01-05", 5)]      # one day of 20 rewritten
    assert len([f for f in folds if f[1] == 2]) == 20
    parts = [(f[0], f[2]) for f in store._folders("ad_stat") if f[1] == "part"]
    assert sorted(parts) == [("2024-01-05", n) for n in (3, 4, 5, 6)] + [("2024-01-06", 6)]
    totals = {r.date.day: r.click_count for r in store.total(
        "ad_stat", ["date"]).collect()}
    assert totals == {d + 1: 3 for d in range(20)} | {5: 3 + 3 + 1, 6: 4}


def test_unfinished_batch_is_not_read(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=2)
    job.process(_lines(spark, [(0, "P", "C", 1, 1)]), 0)
    from visitlens.operators import ads as AD
    from visitlens.sources.adlog import decode_ad_log
    clicks = decode_ad_log(_lines(spark, [(0, "P", "C", 1, 1)] * 5))[0]
    store.write("ad_stat", 1, AD.ad_stat(clicks), [dt.date(2024, 1, 1)])   # and then it died
    assert [r[-1] for r in _table(store, "ad_stat")] == [1]
    job.process(_lines(spark, [(0, "P", "C", 1, 1)]), 1)
    assert [r[-1] for r in _table(store, "ad_stat")] == [2]
    assert [r[0] for r in _table(store, "ad_blacklist")] == [1]


def test_a_groups_ranking_is_replaced(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=1000, top_n=2, compact_every=3)
    top = lambda: [tuple(r)[1:] for r in _table(store, "ad_province_top3")]
    job.process(_lines(spark, [(0, "P", "C", 1, a) for a in (1, 1, 1, 2, 2, 3)]
                       + [(0, "Q", "C", 1, 9)]), 0)
    assert top() == [("P", 1, 3), ("P", 2, 2), ("Q", 9, 1)]
    # ad 3 overtakes both; Q is not touched and keeps its first version
    job.process(_lines(spark, [(0, "P", "D", 2, 3)] * 4), 1)
    assert top() == [("P", 1, 3), ("P", 3, 5), ("Q", 9, 1)]
    assert {r.batch for r in store.rows("ad_province_top3").where("province = 'Q'").collect()} == {0}
    for i in range(2, 5):
        job.process(_lines(spark, [(0, "P", "D", 2, 2)] * 2), i)
    assert top() == [("P", 2, 8), ("P", 3, 5), ("Q", 9, 1)]


def test_bloom_filter_has_no_false_negatives(spark):
    from visitlens.operators.bloom import BloomFilter
    users = spark.range(0, 3000, 3).withColumnRenamed("id", "user_id")
    for bits in (64, 1 << 14):
        bloom = BloomFilter(bits)
        assert not bloom
        bloom.add(users.where("user_id < 1500"), "user_id")
        bloom.add(users.where("user_id >= 1500"), "user_id")
        found = {r.user_id for r in spark.range(3000).withColumnRenamed("id", "user_id").where(
            bloom.may_contain("user_id")).collect()}
        assert found >= set(range(0, 3000, 3))
    assert len(found) < 1400           # and few false positives where there is room


def test_blacklisted_clicks_meet_the_filter_at_the_scan(spark):
    store = _store(spark)
    job = STR.AdStreamJob(store, threshold=3)
    job.process(_lines(spark, [(0, "P", "C", 1, 1)] * 3 + [(0, "P", "C", 2, 1)]), 0)
    from visitlens.sources.adlog import decode_ad_log
    clicks = decode_ad_log(_lines(spark, [(0, "P", "C", u, 1) for u in (1, 2, 2, 3)]))[0]
    left = job.not_blacklisted(clicks, 1)
    assert sorted(r.user_id for r in left.collect()) == [2, 2, 3]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "getbit" in plan and "LeftAnti" in plan
    # only new users are stored, so the stored blacklist needs no aggregate before the join
    job.process(_lines(spark, [(0, "P", "C", 1, 1)] * 9 + [(0, "P", "C", 2, 1)] * 2), 1)
    assert [(r.user_id, r.batch) for r in
            store.rows("ad_blacklist").orderBy("user_id").collect()] == [(1, 0), (2, 1)]
    again = STR.AdStreamJob(store, threshold=3)       # a restart rebuilds the filter
    assert sorted(r.user_id for r in again.not_blacklisted(clicks, 2).collect()) == [3]


def test_crossing_is_emitted_once(spark):
    src, root = tempfile.mkdtemp(prefix="vl-src-"), tempfile.mkdtemp(prefix="vl-run-")
    line = lambda u, m=0: f"{T0 + m * MIN}_P_C_{u}_1"
    _write_file(src, "a.txt", [line(1)] * 2 + [line(2)] * 7 + ["bad"])
    _write_file(src, "b.txt", [line(1)] * 2 + [line(2)] * 7)
    _write_file(src, "c.txt", [line(1)] * 3 + [line(3)])
    _write_file(src, "d.txt", [line(4, 5 * DAY)])             # moves the watermark four days on
    _write_file(src, "e.txt", [line(4, 5 * DAY)])
    _write_file(src, "f.txt", [line(3)] * 5 + [line(4, 5 * DAY)] * 4)   # user 3's day is over

    def run():
        q, store = STR.start_crossing_stream(
            spark, spark.readStream.option("maxFilesPerTrigger", 1).text(src), f"{root}/state",
            f"{root}/ckpt", 5, "1 day", "availableNow")
        q.awaitTermination()
        return q, store
    q, store = run()
    got = sorted((r.user_id, r.click_count, r.batch) for r in store.rows("ad_crossing").collect())
    assert got == [(1, 7, 2), (2, 7, 0), (4, 6, 5)]
    rows = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert rows <= 1                                          # the first day's counters are gone


def test_crossing_counts_in_the_engine(spark):
    """No Python step runs once a key, and stored keys stay single over batches and folds."""
    src = tempfile.mkdtemp(prefix="vl-src-")
    lines = spark.readStream.text(src)
    assert "Python" not in STR.crossing_stream(lines, 5)._jdf.queryExecution().logical().toString()
    assert "Pandas" not in STR.crossing_stream(lines, 5)._jdf.queryExecution().logical().toString()
    store = DeltaStore(spark, tempfile.mkdtemp(prefix="vl-cross-"), STR.CROSSING_TABLES)
    job = STR.CrossingJob(store, "ad_crossing", STR.USER_KEYS, compact_every=2)
    day = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    schema = STR.CROSSING_TABLES["ad_crossing"]
    batches = [[(day[0], 1, 1, 5)], [(day[0], 1, 1, 7), (day[1], 1, 1, 6)], [],
               [(day[0], 1, 1, 9), (day[0], 1, 2, 5)], [(day[0], 1, 2, 8), (day[1], 1, 1, 8)]]
    for n, rows in enumerate(batches):
        for _ in range(2 if n in (1, 4) else 1):       # a re-delivered batch
            job.process(spark.createDataFrame(rows, schema), n)
    got = sorted(tuple(r) for r in STR.read_table(store, "ad_crossing").collect())
    assert got == [(day[0], 1, 1, 5), (day[0], 1, 2, 5), (day[1], 1, 1, 6)]


def test_crossing_counts_late_clicks_of_an_open_day(spark):
    """A day's clicks count until it has been over for the lateness, however they arrive."""
    src, root = tempfile.mkdtemp(prefix="vl-src-"), tempfile.mkdtemp(prefix="vl-run-")
    _write_file(src, "a.txt", [f"{T0}_P_C_1_1"] * 2)
    _write_file(src, "b.txt", [f"{T0 + (DAY + 600) * MIN}_P_C_2_1"])    # watermark: 10:00 of day 1
    _write_file(src, "c.txt", [f"{T0 + MIN}_P_C_1_1"] * 3)
    q, store = STR.start_crossing_stream(
        spark, spark.readStream.option("maxFilesPerTrigger", 1).text(src), f"{root}/state",
        f"{root}/ckpt", 5, "1 day", "availableNow")
    q.awaitTermination()
    got = [(r.user_id, r.click_count) for r in store.rows("ad_crossing").collect()]
    assert got == [(1, 5)]


def test_late_clicks_are_counted_per_day(spark):
    """Random batches against a plain fold, with a re-delivered batch and a batch without rows."""
    import random
    rnd = random.Random(11)
    store = DeltaStore(spark, tempfile.mkdtemp(prefix="vl-late-"), STR.LATE_TABLES)
    job = STR.LateJob(store, delay_ms=6 * 60 * MIN, compact_every=2)
    newest, want, trend = None, {}, {}
    for n in range(5):
        batch = [(max(0, n * DAY + rnd.randint(-DAY, DAY // 2)), "P", "C", 1, rnd.randint(1, 2))
                 for _ in range(40)] if n != 2 else []
        df = _lines(spark, batch) if batch else spark.createDataFrame([("bad",)], "value string")
        for _ in range(2 if n == 1 else 1):
            job.process(df, n)
        for m, *_, a in batch:
            ms = T0 + m * MIN
            day = dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).date()
            late = newest is not None and ms < newest - job.delay_ms
            on, off = want.get(day, (0, 0))
            want[day] = (on + (not late), off + late)
            if not late:
                key = day, (T0 + m * MIN) // MIN, a
                trend[key] = trend.get(key, 0) + 1
        newest = max([newest or 0] + [T0 + m * MIN for m, *_ in batch]) or newest
    got = {r.date: (r.on_time, r.late) for r in STR.read_table(store, "ad_lateness").collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0
    rows = STR.read_table(store, "ad_click_trend").collect()
    assert sorted((r.date, r.click_count) for r in rows) == \
        sorted((k[0], n) for k, n in trend.items())
