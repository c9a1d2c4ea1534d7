"""What changes between runs: grown, removed and misfiled quarters, versions, trends, republished tables."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tierone import schemas as S
from tierone.config import RunContext
from tierone.operators.asof import as_of_join
from tierone.operators.bitmaps import distinct_numbers, number_sets
from tierone.operators.fingerprint import FINGERPRINT, fingerprint, merge
from tierone.operators.history import scd2_versions
from tierone.operators.merge import changed_states, merged_versions, untouched_versions
from tierone.operators.quality import rule_counts
from tierone.operators.routing import closure
from tierone.oracle import oracle_sql
from tierone.plans import bronze, partials, pipeline, reports, silver, warehouse
from tierone.queries import QUERIES
from tierone.session import scratch_path
from tierone.sources import catalog, ledger
from tierone.sources.frames import FrameSource
from tierone.sources.parquet import read_dataset
from tierone.sources.publish import publish, published
from tools.compare import duck

RUNS = [RunContext(dt.datetime(2024, m, 28, 1, 2, 3)) for m in range(1, 13)]
INST = "cert bigint, name string, city string, stname string, stalp string, asset bigint, repdte string, " \
       "active bigint, instcat bigint, charterclass string"
FIN = "cert bigint, repdte string, asset bigint, dep bigint, lnlsnet bigint, intinc bigint, eintexp bigint, " \
      "netinc bigint, rbct1 double, nperfv bigint, year int, quarter int"


def inst(spark, *rows):
    """(cert, charter class, repdte)"""
    return spark.createDataFrame([(c, f"b{c}", "x", "X", "N1", 5, d, 1, 1, k) for c, k, d in rows], INST)


def fin(spark, *rows):
    """(cert, repdte, year, quarter)"""
    return spark.createDataFrame([(c, d, 100, 50, 1, 1, 1, 1, 10.0, 1, y, q) for c, d, y, q in rows], FIN)


# ------------------------------------------------------------------ fingerprints and the ledger

def test_fingerprints_merge_and_ignore_order(spark):
    rows = [(i % 4, None if i % 7 == 0 else i, f"v{i % 5}" if i % 3 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    whole = {r.k: tuple(r) for r in fingerprint(df, ["a", "b"], ["k"]).collect()}
    parts = [spark.createDataFrame(sorted(rows, key=repr)[s::3], df.schema) for s in range(3)]
    taken = [fingerprint(p, ["a", "b"], ["k"]) for p in parts]
    merged = merge(taken[0].unionByName(taken[1]).unionByName(taken[2]), ["k"])
    assert {r.k: tuple(r) for r in merged.collect()} == whole
    none = fingerprint(df.limit(0), ["a", "b"]).first()
    assert tuple(none[c] for c in FINGERPRINT) == (0, 0, 0)


def test_every_change_changes_the_fingerprint(spark):
    def of(*rows):
        return tuple(fingerprint(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).first())

    base = of(("x", "y"), ("p", None))
    others = [of(("x", "y")), of(("x", "y"), ("p", None), ("p", None)), of(("x", "z"), ("p", None)),
              of(("x", "y"), (None, "p")), of(("x", "y"), ("p", None), ("q", "q"), ("q", "q"))]
    assert len({base, *others}) == 6


def test_units_pending_by_fingerprint(spark):
    path = scratch_path(spark, "ledger")
    schema = "year int, quarter int, n_rows bigint, hash_sum bigint, hash_xor bigint"
    old = spark.createDataFrame([(2024, 1, 5, 7, 1), (2024, 2, 5, 7, 1), (2023, 4, 1, 1, 1)], schema)
    ledger.record(ledger.work_units(spark, old), path, "t1")
    new = ledger.work_units(spark, spark.createDataFrame([(2024, 1, 5, 7, 1), (2024, 2, 5, 8, 1), (2024, 3, 1, 1, 1)], schema))
    book = ledger.read_ledger(spark, path)
    got = {r.run_key: r.landing for r in ledger.pending_units(new, book).collect()}
    assert got == {"financials_2024_Q2": 2, "financials_2024_Q3": 1}
    forced = {r.run_key for r in ledger.pending_units(new, book, ["financials_2024_Q1"]).collect()}
    assert forced == {*got, "financials_2024_Q1"}
    gone = ledger.removed_units(new, book).collect()
    assert [(r.run_key, r.year, r.quarter, r.n_rows, r.landing) for r in gone] == [("financials_2023_Q4", 2023, 4, 0, 2)]


class Failing(FrameSource):
    """Dies when it is asked for a quarter it is told to fail on."""

    def financials(self, run, periods):
        if (2024, 3) in periods:
            raise RuntimeError("lost")
        return super().financials(run, periods)


def test_a_load_that_dies_keeps_the_groups_it_committed(spark):
    rows = [(c, f"2024{m}30", 2024, q) for q, m in ((1, "03"), (2, "06"), (3, "09"), (4, "12")) for c in (1, 2)]
    paths = bronze.BronzePaths(scratch_path(spark, "groups"))
    frames = inst(spark, (1, "N", "20241231")), fin(spark, *rows)
    with pytest.raises(RuntimeError, match="lost"):
        bronze.ingest(spark, Failing(*frames, "bank"), paths, RUNS[0], commit_rows=2)
    landed = bronze.ingest(spark, FrameSource(*frames, "bank"), paths, RUNS[1], commit_rows=2)
    assert sorted(u.run_key for u in landed) == ["financials_2024_Q3", "financials_2024_Q4"]
    units = [u for u in landed]
    assert [[u.quarter for u in g] for g in bronze.commit_groups(units, 4)] == [[3, 4]]
    assert [[u.quarter for u in g] for g in bronze.commit_groups(units, 2)] == [[3], [4]]


def test_grown_changed_and_removed_quarters_reach_gold(spark):
    base, db = scratch_path(spark, "grown"), "tierone_test_grown"
    master = inst(spark, (1, "N", "20241231"), (2, "N", "20241231"))
    first = [(1, "20231231", 2023, 4), (1, "20240331", 2024, 1), (2, "20240630", 2024, 2)]

    def certs():
        return sorted((r.cert, r.year, r.quarter) for r in spark.table(f"{db}.bank_health_metrics").collect())

    def go(rows, run):
        source = FrameSource(master, fin(spark, *rows), "bank", complete=True)
        return pipeline.run_pipeline(spark, source, run, base, db).pending_units

    assert go(first, RUNS[0]) == 4 and go(first, RUNS[1]) == 0
    # A row more, under the same run id as before: the second landing of the unit.
    assert go([*first, (2, "20240331", 2024, 1)], RUNS[1]) == 1
    assert certs() == [(1, 2023, 4), (1, 2024, 1), (2, 2024, 1), (2, 2024, 2)]
    # A quarter, with it a whole year, is gone at the source.
    assert go([*first[1:], (2, "20240331", 2024, 1)], RUNS[2]) == 1
    assert certs() == [(1, 2024, 1), (2, 2024, 1), (2, 2024, 2)]
    assert spark.sql(f"SHOW PARTITIONS {db}.bank_health_metrics").count() == 1
    trend = partials.quarter_trend(partials.read_partials(spark, warehouse.partials_path(spark, db)),
                                   partials.read_bank_sets(spark, warehouse.partials_path(spark, db)))
    assert [(r.year, r.quarter, r.bank_count) for r in trend.collect()] == [(2024, 1, 2), (2024, 2, 1)]
    # A source that is not complete removes nothing.
    part = FrameSource(master, fin(spark, *first[1:2]), "bank")
    assert pipeline.run_pipeline(spark, part, RUNS[3], base, db).pending_units == 1
    assert certs() == [(1, 2024, 1), (2, 2024, 2)]


# ------------------------------------------------------------------ misfiled rows

def test_closure():
    routes = {((2024, 2), (2024, 3)), ((2024, 4), (2024, 3)), ((2023, 1), (2022, 4))}
    assert closure([(2024, 1)], routes) == ({(2024, 1)}, {(2024, 1)})
    assert closure([(2024, 2)], routes) == ({(2024, 2), (2024, 3)}, {(2024, 2), (2024, 3), (2024, 4)})
    assert closure([(2024, 3)], routes) == ({(2024, 3)}, {(2024, 2), (2024, 3), (2024, 4)})


def test_misfiled_rows_move_and_never_stop_a_run(spark):
    base, db = scratch_path(spark, "misfiled"), "tierone_test_misfiled"
    master = inst(spark, (1, "N", "20241231"))
    good = [(1, "20240630", 2024, 2), (2, "20240930", 2024, 3)]
    odd = [(3, "20240930", 2024, 2), (4, None, 2024, 2), (5, "20241399", 2024, 2), (6, "20250331", 2024, 3)]

    def go(rows, run, force=()):
        pipeline.run_pipeline(spark, FrameSource(master, fin(spark, *rows), "bank"), run, base, db, force=force)
        rows = spark.table(f"{db}.bank_health_metrics").collect()
        return sorted((r.cert, r.year, r.quarter) for r in rows)

    want = [(1, 2024, 2), (2, 2024, 3), (3, 2024, 3), (6, 2025, 1)]
    assert go(good + odd, RUNS[0]) == want
    bad = read_dataset(spark, silver.SilverPaths(base).quarantine_financials, S.QUARANTINE_FINANCIALS)
    assert sorted((r.cert, r.rejection_reason) for r in bad.collect()) == [
        (4, "repdte_without_period"), (5, "repdte_without_period")]
    # The third quarter landed again keeps the row filed under the second.
    assert go(good + odd, RUNS[1], ["financials_2024_Q3"]) == want
    # The second landed again without its misfiled row: the third loses it.
    assert go(good + odd[3:], RUNS[2]) == [(1, 2024, 2), (2, 2024, 3), (6, 2025, 1)]
    counts = reports.dq_run_trend(silver.read_unit_counts(spark, silver.SilverPaths(base).unit_counts))
    assert [(r.total_records, r.clean_records) for r in counts.filter("dataset = 'financials'").collect()] == [
        (6, 4), (6, 4), (3, 3)]


# ------------------------------------------------------------------ versions

VERSIONS = "cert bigint, name string, city string, stalp string, instcat bigint, charterclass string, active bigint, " \
           "effective_date string, expiry_date string, is_current boolean, row_created_at timestamp_ntz"
SNAPSHOT = "cert bigint, name string, city string, stalp string, instcat bigint, charterclass string, active bigint, repdte string"


def merged_in_steps(spark, snapshots):
    dim = spark.createDataFrame([], VERSIONS)
    for i, rows in enumerate(snapshots):
        changes = changed_states(dim, spark.createDataFrame(rows, SNAPSHOT))
        dim = (merged_versions(dim, changes, RUNS[i]).unionByName(untouched_versions(dim, changes))).checkpoint()
    return dim


def told(df):
    return sorted((r.cert, r.effective_date, r.expiry_date, r.is_current, r.charterclass or "", r.active or -1)
                  for r in df.collect())


def test_merging_snapshots_equals_the_full_history(spark):
    rng = random.Random(7)
    days = ["20230331", "20230630", "20230930", "20231231"]
    snaps = [[(c, f"b{c}", None, "N1", 1, rng.choice(["N", "SM", None]), rng.choice([0, 1, None]), d)
              for c in range(40) if rng.random() < 0.8] for d in days]
    snaps[2] += snaps[2][:5]                                            # repeated rows
    every = spark.createDataFrame([r for s in snaps for r in s], SNAPSHOT)
    dim = merged_in_steps(spark, snaps)
    assert told(dim) == told(scd2_versions(every, RUNS[0]))
    # Versions keep the time they were first built.
    built = {RUNS[i].run_ts: d for i, d in enumerate(days)}
    assert all(built[r.row_created_at] == r.effective_date for r in dim.collect())
    # The same snapshot again tells nothing new.
    assert changed_states(dim, spark.createDataFrame(snaps[-1], SNAPSHOT)).isEmpty()


def test_corrections_and_late_snapshots(spark):
    def row(k, d):
        return (1, "b", "c", "N1", 1, k, 1, d)

    dim = merged_in_steps(spark, [[row("N", "20230331")], [row("SM", "20231231")], [row("NM", "20231231")],
                                  [row("SB", "20230630")], [row("N", "20230515")], [row("N", "20220331")]])
    assert [t[1:3] + (t[4],) for t in told(dim)] == [
        ("20220331", "20230630", "N"), ("20230630", "20231231", "SB"), ("20231231", "99991231", "NM")]


def test_dimension_keeps_versions_and_unchanged_runs_write_nothing(spark):
    base, db = scratch_path(spark, "versions"), "tierone_test_versions"
    facts = fin(spark, (1, "20240331", 2024, 1))

    def go(run, *rows):
        pipeline.run_pipeline(spark, FrameSource(inst(spark, *rows), facts, "bank"), run, base, db)
        found = spark.table(f"{db}.dim_institution").collect()
        return sorted((r.cert, r.charterclass, r.effective_date, r.expiry_date) for r in found)

    assert go(RUNS[0], (1, "N", "20240331"), (2, "N", "20240331")) == [
        (1, "N", "20240331", "99991231"), (2, "N", "20240331", "99991231")]
    want = [(1, "N", "20240331", "99991231"), (2, "N", "20240331", "20240630"), (2, "SM", "20240630", "99991231")]
    assert go(RUNS[1], (1, "N", "20240630"), (2, "SM", "20240630")) == want
    generation = published(spark, db, "dim_institution")[0]
    assert go(RUNS[2], (1, "N", "20240930"), (2, "SM", "20240930")) == want
    assert published(spark, db, "dim_institution")[0] == generation
    # A process with an empty catalog finds them too.
    catalog.drop_tables(spark, db, catalog.list_tables(spark, db))
    pipeline.register_tables(spark, base, db)
    assert spark.table(f"{db}.dim_institution").count() == 3


def test_as_of_join_equals_brute_force(spark):
    rng = random.Random(11)
    versions, facts = [], []
    for c in range(12):
        days = sorted(rng.sample(range(100, 200), 3))
        versions += [(c, str(a), str(b), f"v{c}-{a}") for a, b in zip(days, [*days[1:], 999])]
        facts += [(c, str(rng.randint(90, 210)), i) for i in range(20)]
    facts += [(0, "150", 1000 + i) for i in range(500)]                 # a hot key and date
    facts += [(None, "150", -1), (3, None, -2), (77, "150", -3)]
    f = spark.createDataFrame(facts, "cert bigint, repdte string, n int")
    v = spark.createDataFrame(versions, "cert bigint, effective_date string, expiry_date string, label string")
    for rows in (10**6, 0):
        out = as_of_join(f, v, "cert", "repdte", ["label"], max_broadcast_rows=rows)
        want = sorted((n, next((lab for k, a, b, lab in versions if k == c and d is not None and a <= d < b), "")) for c, d, n in facts)
        assert sorted((r.n, r.label or "") for r in out.collect()) == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


# ------------------------------------------------------------------ counts

def test_corrections_are_taken_back_in_the_trend(spark):
    def row(run, key, mask, n):
        return ("financials", run.run_date, run.run_ts, mask, n, run.run_id, key)

    rows = [row(RUNS[0], "a", 0, 10), row(RUNS[0], "a", 2, 5), row(RUNS[1], "b", 0, 7),
            row(RUNS[2], "a", 0, 15), row(RUNS[2], "b", 1, 7), row(RUNS[3], "b", 0, 0)]
    out = reports.dq_run_trend(spark.createDataFrame(rows, S.DQ_UNIT_COUNTS)).collect()
    assert [(r.processed_records, r.total_records, r.clean_records) for r in out] == [
        (15, 15, 10), (7, 22, 17), (22, 22, 15), (0, 15, 15)]
    assert [r.prev_dq_pass_pct for r in out] == [None, *[r.dq_pass_pct for r in out[:-1]]]


def test_rule_counts_of_all_masks(spark):
    names = ["a", "b", "c"]
    masks = [(m, m + 1) for m in range(8)]
    want = defaultdict(int)
    for m, n in masks:
        hit = [names[i] for i in range(3) if m >> i & 1]
        for i, x in enumerate(hit):
            want[x, None] += n
            for y in hit[i + 1:]:
                want[x, y] += n
    got = rule_counts(spark.createDataFrame(masks, "rule_mask bigint, n_rows bigint"), names).collect()
    assert {(r.rule, r.with_rule): r.failures for r in got} == dict(want)


def test_number_sets_count_any_span(spark):
    rng = random.Random(3)
    rows = [(y, q, rng.choice([None, rng.randint(-70_000, 70_000), rng.randint(0, 50)])) for y in (1, 2) for q in (1, 2) for _ in range(300)]
    sets = number_sets(spark.createDataFrame(rows, "year int, quarter int, cert bigint"), "cert", ["year", "quarter"]).checkpoint()
    for keys, at in ((["year", "quarter"], 2), (["year"], 1), ([], 0)):
        want = defaultdict(set)
        for r in rows:
            if r[2] is not None:
                want[r[:at]].add(r[2])
        got = distinct_numbers(sets, keys, "n").collect()
        assert {tuple(r[k] for k in keys): r.n for r in got} == {k: len(v) for k, v in want.items()}


def test_reports_of_partials_read_no_facts(spark, sf):
    df = QUERIES["partials_quarter_trend"](spark, sf)
    assert df.inputFiles() and all("/health_partials/" in f or "/bank_sets/" in f for f in df.inputFiles())


# ------------------------------------------------------------------ republishing

def test_a_failing_write_leaves_the_earlier_rows(spark):
    db = "tierone_test_publish"
    catalog.ensure_database(spark, db, scratch_path(spark, "publish-db"))
    catalog.register_partitioned(spark, db, "t", spark.createDataFrame([], "v int, year int").schema,
                                 warehouse.table_path(spark, db, "t"), "year")

    def rows():
        return sorted((r.v, r.year) for r in spark.table(f"{db}.t").collect())

    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, 2024)], "v int, year int")
    publish(spark, db, "t", df, "year")
    assert rows() == [(1, 2023), (2, 2024), (3, 2024)]
    reader = spark.table(f"{db}.t")
    before = reader.inputFiles()
    broken = df.withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("bad row")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="bad row"):
        publish(spark, db, "t", broken, "year")
    assert rows() == [(1, 2023), (2, 2024), (3, 2024)] and published(spark, db, "t")[0] == 1
    with pytest.raises(ValueError, match="2023"):
        publish(spark, db, "t", df, "year", ["2024"])
    assert rows() == [(1, 2023), (2, 2024), (3, 2024)]
    publish(spark, db, "t", df.filter("year = 2024").withColumn("v", F.col("v") + 10), "year", ["2024"])
    assert rows() == [(1, 2023), (12, 2024), (13, 2024)]
    assert spark.read.parquet(*before).count() == 3                     # an earlier plan's files are there
    publish(spark, db, "t", df.limit(0), "year", ["2023"])
    assert rows() == [(12, 2024), (13, 2024)]
    catalog.drop_tables(spark, db, ["t"])
    assert set(published(spark, db, "t")[1]) == {"2024"}


@pytest.mark.parametrize("name", ["capital_distribution", "quarter_trend", "regional_summary", "dim_current_sample"])
def test_rows_come_in_the_order_of_the_statement(spark, sf, name):
    cursor = duck(sf).execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert [tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf).collect()] == cursor.fetchall()
