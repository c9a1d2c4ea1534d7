"""Property tests: Spark operators against brute force on random small inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierone.config import RunContext
from tierone.functions import capital_class
from tierone.operators.history import scd2_versions
from tierone.operators.quality import REASON, financials_rules, institution_rules, tag

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_int = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
names = st.sampled_from([None, "", " ", "   ", "\t", "a", " b "])


def inst_reason(cert, asset, name, active):
    out = []
    if cert is None:
        out.append("cert_is_null")
    if asset is not None and asset <= 0:
        out.append("asset_non_positive")
    if name is None or name.strip(" ") == "":
        out.append("name_empty")
    if active is not None and active not in (0, 1):
        out.append("active_invalid_value")
    return "; ".join(out)


def fin_reason(cert, asset, dep, rbct1, repdte):
    out = []
    if cert is None:
        out.append("cert_is_null")
    if asset is not None and asset <= 0:
        out.append("asset_non_positive")
    if dep is not None and dep <= 0:
        out.append("dep_non_positive")
    if rbct1 is not None and (math.isnan(rbct1) or rbct1 < 0 or rbct1 > 100):
        out.append("rbct1_out_of_range")
    if repdte is not None and len(repdte) != 8:
        out.append("repdte_invalid_format")
    return "; ".join(out)


@SETTINGS
@given(st.lists(st.tuples(maybe_int, maybe_int, names, maybe_int), min_size=1, max_size=30))
def test_institution_tagging_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "cert bigint, asset bigint, name string, active bigint")
    got = sorted(((tuple(r[:4]), r[REASON]) for r in tag(df, institution_rules()).collect()),
                 key=str)
    assert got == sorted(((tuple(r), inst_reason(*r)) for r in rows), key=str)


rbct1s = st.one_of(st.none(), st.sampled_from([-0.01, 0.0, 5.99, 6.0, 10.0, 100.0, 100.01,
                                               math.nan]))
repdtes = st.one_of(st.none(), st.sampled_from(["20240331", "2024Q1", "202403311", "ABCDEFGH"]))


@SETTINGS
@given(st.lists(st.tuples(maybe_int, maybe_int, maybe_int, rbct1s, repdtes),
                min_size=1, max_size=30))
def test_financials_tagging_and_class_match_brute_force(spark, rows):
    df = spark.createDataFrame(
        rows, "cert bigint, asset bigint, dep bigint, rbct1 double, repdte string")
    tagged = tag(df, financials_rules()).withColumn("cls", capital_class(F.col("rbct1")))
    got = sorted(str((r.cert, r.asset, r.dep, r.rbct1, r.repdte, r[REASON], r.cls))
                 for r in tagged.collect())

    def cls(x):
        if x is None:
            return "Critically Undercapitalised"
        if x >= 10:
            return "Well Capitalised"
        if x >= 8:
            return "Adequately Capitalised"
        if x >= 6:
            return "Undercapitalised"
        # NaN compares above every number in Spark.
        return "Well Capitalised" if math.isnan(x) else "Critically Undercapitalised"

    want = sorted(str((*r, fin_reason(*r), cls(r[3]))) for r in rows)
    assert got == want


def scd2_brute(rows):
    """Per key: sort distinct snapshots, keep those that differ from the previous one."""
    by_key = {}
    for cert, attr, other, date in set(rows):
        by_key.setdefault(cert, []).append((date, attr, other))
    out = []
    for cert, snaps in by_key.items():
        snaps.sort(key=lambda s: (s[0], "" if s[1] is None else "~" + s[1],
                                  -1 if s[2] is None else s[2]))
        versions, prev = [], object()
        for date, attr, other in snaps:
            if (attr, other) != prev:
                versions.append((date, attr, other))
            prev = (attr, other)
        for i, (date, attr, other) in enumerate(versions):
            nxt = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((cert, attr, other, date, nxt or "99991231", nxt is None))
    return sorted(out, key=str)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from([None, "A", "B"]),
                          st.sampled_from([None, 0, 1]),
                          st.sampled_from(["20230331", "20230630", "20230930", "20231231"])),
                min_size=1, max_size=25))
def test_scd2_matches_brute_force(spark, rows):
    # One row per (key, date): a snapshot holds one state per institution.
    seen, snap = set(), []
    for cert, attr, other, date in rows:
        if (cert, date) not in seen:
            seen.add((cert, date))
            snap.append((cert, attr, other, date))
    df = spark.createDataFrame(snap, "cert bigint, name string, active bigint, repdte string")
    got = scd2_versions(df, RunContext(), attributes=["name", "active"]).collect()
    got = sorted(((r.cert, r.name, r.active, r.effective_date, r.expiry_date, r.is_current)
                  for r in got), key=str)
    assert got == scd2_brute(snap)
