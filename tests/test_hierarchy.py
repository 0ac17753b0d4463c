"""Reads over month and year partials equal reads over days, and open little."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import content
from tidemark.plans.reads import top_repos, top_repos_coarse
from tidemark.schemas import DAY_PARTIAL
from tidemark.sinks.hierarchy import CoarseRollup, cover
from tidemark.sinks.state import RollupState
from tidemark.streaming.rollups import write_batch

D = dt.date
DATES = st.dates(D(2022, 1, 1), D(2024, 12, 31))
MONTHS = [f"{y}{m:02d}" for y in (2022, 2023, 2024) for m in range(1, 13)]


@given(start=DATES, end=DATES, months=st.sets(st.sampled_from(MONTHS)), years=st.sets(st.sampled_from(["2022", "2023", "2024"])))
@settings(max_examples=200, deadline=None)
def test_a_cover_has_every_day_once(start, end, months, years):
    parts = cover(start, end, months, years)
    assert set(parts.years) <= years and set(parts.months) <= months
    one = dt.timedelta(days=1)
    found = [first + one * k for first, last in parts.days for k in range((last - first).days + 1)]
    for k in range((D(2024, 12, 31) - D(2022, 1, 1)).days + 1):
        date = D(2022, 1, 1) + one * k
        if f"{date:%Y}" in parts.years or f"{date:%Y%m}" in parts.months:
            found.append(date)
    assert sorted(found) == [start + one * k for k in range((end - start).days + 1)]
    if months == set(MONTHS):
        assert sum((last - first).days + 1 for first, last in parts.days) <= 60


def write(spark, state, batch_id, first, days, kind="T"):
    rows = spark.range(days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"), F.lit(kind).alias("event_type"),
        F.concat(F.lit("r"), F.col("id") % 5).alias("repo_name"), (F.col("id") % 7 + 1).alias("cnt"),
    )
    write_batch(rows, "date", state.path, "rt", "a", batch_id)


@pytest.fixture
def coarse(spark, tmp_path):
    state = RollupState(spark, str(tmp_path / "counts"), DAY_PARTIAL, ("event_type", "date", "repo_name"))
    write(spark, state, 0, D(2021, 12, 15), 1200)
    state.compact()
    return CoarseRollup(spark, state)


RANGES = [("2022-01-17", "2025-01-20"), ("2022-01-01", "2024-12-31"), ("2023-03-01", "2023-03-31"), ("2023-03-05", "2023-03-09"), ("2020-01-01", "2030-01-01")]


def same(coarse, columns=("repo_name",)):
    for start, end in RANGES:
        got = top_repos_coarse(coarse, start, end, group_by=list(columns), limit=100).collect()
        assert got == top_repos(coarse.state.read(), start, end, group_by=list(columns), limit=100).collect()
        total = top_repos_coarse(coarse, start, end, event_types=["T"]).first()
        assert total == top_repos(coarse.state.read(), start, end, event_types=["T"]).first()


def test_reads_equal_those_of_days_whatever_came_after_a_refresh(spark, coarse):
    same(coarse)  # nothing refreshed yet
    assert len(coarse.refresh()) == 40 and coarse.refresh() == []
    same(coarse, ("event_type", "repo_name"))
    write(spark, coarse.state, 1, D(2023, 3, 20), 20, "U")  # live rows in two months
    same(coarse)
    coarse.state.compact()  # merged now, not refreshed
    same(coarse)
    assert coarse.refresh() == ["202303", "202304"]
    same(coarse)


def test_three_years_open_months_and_at_most_two_months_of_days(coarse):
    coarse.refresh()
    files = coarse.rows("2022-01-17", "2025-01-20").inputFiles()
    of_days = {f.split("month=")[1].split("/")[0] for f in files if "_merged/" in f}
    months = {f.split("month=")[1].split("/")[0] for f in files if "_coarse/month" in f}
    years = {f.split("year=")[1].split("/")[0] for f in files if "_coarse/year" in f}
    assert (of_days, years) == ({"202201", "202501"}, {"2023", "2024"})
    assert months == {f"2022{m:02d}" for m in range(2, 13)}
    assert len(files) == 2 + 2 + 11


def test_a_live_batch_sends_only_its_months_to_the_days(spark, coarse):
    coarse.refresh()
    write(spark, coarse.state, 1, D(2023, 3, 20), 5)
    files = coarse.rows("2022-01-01", "2024-12-31").inputFiles()
    assert {f.split("month=")[1].split("/")[0] for f in files if "_merged/" in f} == {"202303"}
    assert not any("year=2023" in f for f in files) and any("year=2022" in f for f in files)


def test_partials_cannot_be_grouped_by_date(coarse):
    with pytest.raises(ValueError, match="date"):
        top_repos_coarse(coarse, "2023-01-01", "2023-02-01", group_by=["date"])


def test_a_refresh_rewrites_changed_months_only(spark, coarse):
    coarse.refresh()
    before = coarse.record()
    write(spark, coarse.state, 1, D(2023, 3, 20), 5)
    coarse.state.compact()
    coarse.refresh()
    after = coarse.record()
    assert {m for m in after.months if after.months[m] != before.months.get(m)} == {"202303"}
    assert {y for y in after.years if after.years[y] != before.years.get(y)} == {"2023"}
    assert content(top_repos_coarse(coarse, "2023-01-01", "2023-12-31"), "count")[0][0] > 0
