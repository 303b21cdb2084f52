"""Facts and marts refreshed by day."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from test_jobs import write_sources

from lakepipe.layout import Layout
from lakepipe.plans import facts, marts, refresh
from lakepipe.plans.jobs import Jobs
from lakepipe.sources.readers import read_table
from lakepipe.sources.writers import overwrite, subfolders


def people(n, changed=()):
    lines = ["key;age;y"] + [f"{i};{20 + i + 100 * (i in changed)};{'yes' if i % 4 == 0 else 'no'}" for i in range(n)]
    return "\n".join(lines) + "\n"


def ingest_people(jobs, folder, text, day):
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text(text)
    jobs.ingest_customers(str(folder), as_of=day)
    jobs.silver_customers("key")


def ingest_day(jobs, tmp_path, name, day, n, seed, batch=None):
    write_sources(tmp_path / name, day, n, seed)
    jobs.ingest_transactions(str(tmp_path / name), "2024-01-01", batch or name)
    jobs.silver_transactions()
    jobs.date_dimension()


@pytest.fixture(scope="module")
def first_lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("refresh")
    jobs = Jobs(spark, Layout(str(base / "lake")))
    ingest_people(jobs, base / "people", people(20), "2024-01-01")
    for day in (10, 11, 45):
        ingest_day(jobs, base, f"day{day}", day, 40, day)
    jobs.customer_dimension("2023-01-01")
    return base / "lake"


@pytest.fixture
def lake(spark, first_lake, tmp_path):
    shutil.copytree(first_lake, tmp_path / "lake")
    return Jobs(spark, Layout(str(tmp_path / "lake")))


def same_as_full(jobs, rows):
    spark, gold = jobs.spark, jobs.layout.gold
    calendar, customers = read_table(spark, gold("dim_date")), read_table(spark, gold("dim_customer"))
    fact = facts.build_fact(read_table(spark, jobs.layout.silver("transactions")), customers)
    assert rows(refresh.facts_by_day(spark, jobs.layout)) == rows(fact)
    daily = marts.daily_summary(fact, calendar)
    for name, full in {
        "daily_transaction_summary": daily,
        "monthly_revenue_summary": marts.monthly_summary(fact, calendar),
        "customer_activity_summary": marts.customer_activity(fact, customers),
        "fraud_rate_by_day": marts.fraud_rate_by_day(daily),
    }.items():
        found = read_table(spark, gold(name))
        assert found.columns == full.columns
        assert dict(found.dtypes) == dict(full.dtypes)
        assert rows(found) == rows(full)


def files(jobs, table):
    base = Path(jobs.layout.gold(table))
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in base.rglob("*.parquet")}


def test_first_refresh_is_a_full_build(lake, rows):
    assert [d.isoformat() for d in lake.refresh()] == ["2023-01-10", "2023-01-11", "2023-02-14"]
    same_as_full(lake, rows)
    assert lake.refresh() == []
    same_as_full(lake, rows)


def test_other_days_and_months_stay_as_they_are(lake, tmp_path, rows):
    lake.refresh()
    days, months = files(lake, "fact_by_day"), files(lake, "customer_month_totals")
    ingest_day(lake, tmp_path, "more", 11, 30, 99)
    assert lake.refresh() == [dt.date(2023, 1, 11)]
    same_as_full(lake, rows)
    for before, after, touched in (
        (days, files(lake, "fact_by_day"), "date_sk=20230111"),
        (months, files(lake, "customer_month_totals"), "month=202301"),
    ):
        assert {f: t for f, t in before.items() if touched not in f} == {
            f: t for f, t in after.items() if touched not in f
        }
        assert not {f for f in before if touched in f} & {f for f in after if touched in f}


def test_only_folders_of_touched_days_are_opened(lake, spark, plan_text):
    touched = refresh.touched_transactions(spark, lake.layout, [dt.date(2023, 1, 11)])
    scan = plan_text(touched).replace(" ", "")
    assert "PartitionFilters:[isnotnull(transaction_date" in scan and "PushedFilters:[]" in scan
    assert [r[0] for r in touched.select("transaction_date").distinct().collect()] == [dt.date(2023, 1, 11)]


def test_withdrawn_days_and_months_go(lake, tmp_path, spark, rows):
    lake.refresh()
    ingest_day(lake, tmp_path, "instead", 12, 25, 7, batch="day45")
    assert lake.refresh() == [dt.date(2023, 1, 12), dt.date(2023, 2, 14)]
    same_as_full(lake, rows)
    assert subfolders(spark, lake.layout.gold("customer_month_totals")) == ["month=202301"]
    assert "date_sk=20230214" not in subfolders(spark, lake.layout.gold("fact_by_day"))


def test_a_refresh_that_breaks_off_is_done_again(lake, tmp_path, rows, monkeypatch):
    lake.refresh()
    ingest_day(lake, tmp_path, "more", 45, 30, 98)
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "_refresh_totals", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.refresh()
    assert lake.refresh() == [dt.date(2023, 2, 14)]
    same_as_full(lake, rows)


def test_new_versions_touch_the_days_from_their_start(lake, tmp_path, rows):
    lake.refresh()
    ingest_people(lake, tmp_path / "changed", people(20, changed=range(20)), "2024-01-02")
    lake.update_customer_dimension("2023-02-01")
    assert lake.refresh() == [dt.date(2023, 2, 14)]
    same_as_full(lake, rows)
    lake.update_customer_dimension("2023-02-01")
    assert lake.refresh() == []


def test_new_customers_and_late_versions_touch_every_day(lake, spark, tmp_path, rows):
    lake.refresh()
    ingest_people(lake, tmp_path / "added", people(21), "2024-01-02")
    lake.update_customer_dimension("2023-02-01")
    assert len(lake.refresh()) == 3
    same_as_full(lake, rows)
    ingest_people(lake, tmp_path / "late", people(21, changed=(3,)), "2024-01-03")
    lake.update_customer_dimension("2023-01-05")
    assert len(lake.refresh()) == 3
    same_as_full(lake, rows)


def test_no_customers_no_facts(lake, spark, rows):
    lake.refresh()
    customers = read_table(spark, lake.layout.gold("dim_customer"))
    overwrite(customers.filter("FALSE"), lake.layout.gold("dim_customer"))
    refresh.note_silver_days(spark, lake.layout, "all")
    assert len(lake.refresh()) == 3
    same_as_full(lake, rows)
    assert subfolders(spark, lake.layout.gold("fact_by_day")) == []


def test_more_customers_leave_loaded_transactions_where_they_are(lake, spark, tmp_path):
    def dealt():
        silver = read_table(spark, lake.layout.silver("transactions"))
        return {r["transaction_id"]: r["customer_id"] for r in silver.collect()}

    before = dealt()
    ingest_people(lake, tmp_path / "added", people(40), "2024-01-02")
    # The same delivery again, and one that gives its transactions back to another batch.
    write_sources(tmp_path / "day10", 10, 40, 10)
    for name, batch in (("day10", "day10"), ("day10", "copy")):
        lake.ingest_transactions(str(tmp_path / name), "2024-01-01", batch)
        lake.silver_transactions()
    assert dealt() == before
    ingest_day(lake, tmp_path, "other", 10, 5, 77, batch="day10")
    after = dealt()
    changed = [k for k in before if k in after and before[k] != after[k]]
    assert len(before) <= len(after) and {after[k] >= 20 for k in changed} <= {True}
    ingest_day(lake, tmp_path, "new", 12, 60, 78)
    assert max(dealt().values()) >= 20
