"""Commits, partitioned micro-batch tables, the stored silver table, late rows and arrival times."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from delayworks.operators.key_filter import key_filter, maybe_known, united
from delayworks.plans import gold_daily_route
from delayworks.plans.silver import clean_flights
from delayworks.sinks import commits
from delayworks.sinks.batches import current_run, manifest
from delayworks.sinks.commits import commit, latest
from delayworks.streaming import (
    EVENT_TIME_COLUMN,
    compact_changes,
    compact_late,
    compact_silver,
    compact_totals,
    gold_stream,
    read_arrivals,
    read_changes,
    read_days,
    read_late,
    read_silver,
    read_snapshot,
    read_totals,
    silver_stream,
)

ROUTES = [
    {"DayofMonth": d, "FlightDate": date(2024, 1, d), "CRSDepTime": 60 * i, "OriginCityName": city, "ArrDelayMinutes": 9.0 * i}
    for d in (1, 2, 3)
    for i, city in enumerate(["Lima", "007", None, "Oslo/Gardermoen", "a=b"])
]


@pytest.fixture
def landing(flights, tmp_path):
    def add(*overrides):
        flights(*overrides).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        return f"{tmp_path}/landing"

    return add


@pytest.fixture
def config(tmp_path):
    """A job that takes one file at a time."""

    def build(name, mode="append", **output):
        return (
            {"datasetInputPath": f"{tmp_path}/landing", "autoloaderOptions": {"cloudFiles.maxFilesPerTrigger": "1"}},
            {"datasetOuputPath": f"{tmp_path}/{name}", "checkpointPath": f"{tmp_path}/{name}_checkpoint", "outputMode": mode, **output},
        )

    return build


def undo_last_commit(checkpoint):
    """Let a stream take its last micro-batch for unfinished."""
    numbers = sorted((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    numbers[-1].unlink()
    (checkpoint / "commits" / f".{numbers[-1].name}.crc").unlink(missing_ok=True)


# --- commits ---


def test_commits_follow_each_other_and_old_ones_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "KEPT", 3)
    assert latest(spark, f"{tmp_path}/t") is None
    for n in range(8):
        commit(spark, f"{tmp_path}/t", lambda before: {"n": (before or {"n": 0})["n"] + 1})
    assert latest(spark, f"{tmp_path}/t") == {"n": 8}
    assert len([p for p in (tmp_path / "t" / "_commits").iterdir() if p.suffix == ".json"]) == 3


def test_of_two_writers_none_loses_a_commit(spark, tmp_path):
    def add(name):
        return commit(spark, f"{tmp_path}/t", lambda before: {"names": [*(before or {"names": []})["names"], name]})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(12)))
    assert sorted(latest(spark, f"{tmp_path}/t")["names"]) == list(range(12))


def test_a_half_written_commit_does_not_count(spark, tmp_path):
    commit(spark, f"{tmp_path}/t", lambda _: {"n": 1})
    (tmp_path / "t" / "_commits" / "_draft").write_text('{"n":')
    assert latest(spark, f"{tmp_path}/t") == {"n": 1}


# --- partitioned micro-batch tables ---

READERS = {"append": read_totals, "update": read_changes, "complete": read_snapshot}


@pytest.mark.parametrize("mode", READERS)
def test_partitioned_tables_equal_the_batch_plan(spark, landing, flights, config, mode):
    source, sink = config("gold", mode, partitionBy=["OriginCityName"])
    for at in range(0, len(ROUTES), 4):
        landing(*ROUTES[at : at + 4])
    expected = gold_daily_route(flights(*ROUTES))
    path, fold = sink["datasetOuputPath"], {"append": compact_totals, "update": compact_changes}.get(mode)
    gold_stream(spark, source, sink)
    for step in ("micro-batches", "base", "base and micro-batches"):
        if step != "micro-batches":
            if fold:
                fold(spark, path, remove=step == "base")
            landing({"CRSDepTime": 999, "DayofMonth": 2, "FlightDate": date(2024, 1, 2)})
            gold_stream(spark, source, sink)
            more = [{"CRSDepTime": 999, "DayofMonth": 2, "FlightDate": date(2024, 1, 2)}] * (1 + (step != "base"))
            expected = gold_daily_route(flights(*ROUTES, *more))
        got = READERS[mode](spark, path)
        assert sorted(got.select(expected.columns).collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_folders_of_several_layouts_are_read_together(spark, landing, flights, config):
    plain, by_city = config("gold"), config("gold", partitionBy=["OriginCityName"])
    for job, part in ((plain, ROUTES[:7]), (by_city, ROUTES[7:])):
        landing(*part)
        gold_stream(spark, *job)
    expected = gold_daily_route(flights(*ROUTES))
    got = read_totals(spark, plain[1]["datasetOuputPath"])
    assert sorted(got.select(expected.columns).collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_a_reader_lists_runs_and_one_manifest(spark, landing, config, monkeypatch):
    for n in range(6):
        landing({"CRSDepTime": n})
    job = config("gold")
    gold_stream(spark, *job)
    seen = []
    listed = commits.listed
    monkeypatch.setattr(commits, "listed", lambda s, p: seen.append(p) or listed(s, p))
    monkeypatch.setattr("delayworks.sinks.batches.listed", commits.listed)
    read_totals(spark, job[1]["datasetOuputPath"])
    assert len(seen) <= 4 and not any("folder=" in p for p in seen)


@pytest.mark.parametrize("folded", [False, True])
def test_a_micro_batch_that_is_run_again_counts_once(spark, landing, config, tmp_path, folded):
    job = config("gold", partitionBy=["OriginCityName"])
    landing(*ROUTES[:8])
    landing(*ROUTES[8:])
    gold_stream(spark, *job)
    path = job[1]["datasetOuputPath"]
    before = sorted(read_totals(spark, path).collect(), key=repr)
    if folded:
        compact_totals(spark, path, remove=True)
    undo_last_commit(tmp_path / "gold_checkpoint")
    gold_stream(spark, *job)
    assert sorted(read_totals(spark, path).collect(), key=repr) == before
    compact_totals(spark, path, remove=True)
    assert sorted(read_totals(spark, path).collect(), key=repr) == before
    (run,) = (tmp_path / "gold").glob("run=*")
    assert len(list(run.glob("folder=*"))) == 1


def test_the_manifest_names_layout_and_schema(spark, landing, config):
    job = config("gold", partitionBy=["OriginCityName"])
    landing(*ROUTES)
    gold_stream(spark, *job)
    document = latest(spark, current_run(spark, job[1]["datasetOuputPath"]))
    assert [f["partition_by"] for f in document["folders"]] == [["OriginCityName"]]
    assert "sum_TaxiOut" in json.dumps(document["schema"])


# --- the stored silver table ---


@pytest.mark.parametrize("partition_by", [[], ["FlightDate"], ["OriginCityName"]])
def test_stored_silver_holds_every_key_once(spark, landing, config, tmp_path, partition_by):
    source, sink = config("silver", partitionBy=partition_by)
    path, rows = sink["datasetOuputPath"], [*ROUTES, {"FlightDate": None}, {"CRSDepTime": None}]
    seen = set()
    for part in (rows[:9], rows[9:], rows, [*rows[5:], {"CRSDepTime": 77}, {"CRSDepTime": 77, "Distance": 1.0}]):
        landing(*part)
        silver_stream(spark, source, sink, stored=True)
        seen |= {(r.get("FlightDate", date(2024, 1, 2)), r.get("OriginCityName", "Lima"), r.get("CRSDepTime", 600)) for r in part}
        got = read_silver(spark, path).select("FlightDate", "OriginCityName", "CRSDepTime").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(seen, key=repr)
        if part is rows:
            compact_silver(spark, path, remove=True)


def test_the_first_arrival_stays_in_the_stored_table(spark, landing, config):
    job = config("silver")
    landing({"Distance": 1.0})
    silver_stream(spark, *job, stored=True)
    landing({"Distance": 2.0}, {"CRSDepTime": 602})
    silver_stream(spark, *job, stored=True)
    got = read_silver(spark, job[1]["datasetOuputPath"]).select("CRSDepTime", "Distance").collect()
    assert sorted(map(tuple, got)) == [(600, 1.0), (602, 500.0)]


def test_stored_silver_grows_by_new_keys_only(spark, landing, config, tmp_path):
    job = config("silver")
    for _ in range(3):
        landing(*ROUTES)
    silver_stream(spark, *job, stored=True)
    (run,) = (tmp_path / "silver").glob("run=*")
    assert len(manifest(spark, f"{run}").folders) == len(list(run.glob("folder=*"))) == 1
    assert not list((tmp_path / "silver_checkpoint").glob("state/*"))


@pytest.mark.parametrize("times", [1, 2])
def test_a_replayed_micro_batch_finds_the_same_rows(spark, landing, config, tmp_path, times):
    job = config("silver")
    landing(*ROUTES[:10])
    landing(*ROUTES[4:])
    silver_stream(spark, *job, stored=True)
    for _ in range(times):
        undo_last_commit(tmp_path / "silver_checkpoint")
        silver_stream(spark, *job, stored=True)
    assert read_silver(spark, job[1]["datasetOuputPath"]).count() == len(ROUTES)
    compact_silver(spark, job[1]["datasetOuputPath"], remove=True)
    (run,) = (tmp_path / "silver").glob("run=*")
    assert sorted(p.name.partition("folder=")[0] for p in run.glob("*folder=*")) == ["", "filter-"]


def test_stored_silver_cleans_if_asked(spark, landing, flights, config):
    job = config("silver")
    landing({"DepDelay": -3.0, "ArrDelayMinutes": None})
    silver_stream(spark, *job, stored=True, clean=True)
    expected = clean_flights(flights({"DepDelay": -3.0, "ArrDelayMinutes": None}))
    got = read_silver(spark, job[1]["datasetOuputPath"])
    assert got.columns == expected.columns and got.collect() == expected.collect()


def test_only_folders_of_the_same_dates_are_asked(spark, landing, config, monkeypatch):
    from delayworks.streaming import silver

    asked = []
    unknown = silver._unknown
    monkeypatch.setattr(silver, "_unknown", lambda rows, run, met, *rest: asked.append(len(met)) or unknown(rows, run, met, *rest))
    job = config("silver")
    for day in (1, 5, 5, 9):
        landing({"FlightDate": date(2024, 1, day), "CRSDepTime": day}, {"FlightDate": date(2024, 1, day), "CRSDepTime": day + 100})
        silver_stream(spark, *job, stored=True)
    assert asked == [1]


def test_a_filter_never_misses_a_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("part"))
    key = F.struct("id", "part")
    halves = [key_filter(rows.where(f"id % 20 = {n}"), key, 1 << 16) for n in (0, 1)]
    marked = maybe_known(rows, key, united(halves[0].union(halves[1])), "known", 1 << 16)
    got = {r["id"] for r in marked.where("known").collect()}
    assert {i for i in range(3000) if i % 20 < 2} <= got and len(got) < 450
    assert marked.columns == ["id", "part", "known"] and marked.count() == 3000
    none = maybe_known(rows, key, united(halves[0].limit(0)), "known", 1 << 16)
    assert none.where("known").count() == 0


# --- late rows ---


def test_late_rows_are_split_the_same_when_run_again(spark, landing, config, tmp_path):
    job = config("gold")
    path = job[1]["datasetOuputPath"]
    landing({"FlightDate": date(2024, 1, 9), "DayofMonth": 9})
    landing({"FlightDate": date(2024, 1, 1), "DayofMonth": 1}, {"FlightDate": date(2024, 1, 20), "DayofMonth": 20})
    gold_stream(spark, *job, by_event_time=True)
    for _ in range(2):
        late = [r["FlightDate"].day for r in read_late(spark, path).collect()]
        timely = {r["DayofMonth"]: r["flights_count"] for r in read_totals(spark, path).collect()}
        assert late == [1] and timely == {9: 1, 20: 1}
        undo_last_commit(tmp_path / "gold_checkpoint")
        gold_stream(spark, *job, by_event_time=True)
    landing({"FlightDate": date(2024, 1, 2)})
    gold_stream(spark, *job, by_event_time=True)
    compact_late(spark, path, remove=True)
    compact_totals(spark, path, remove=True)
    assert sorted(r["FlightDate"].day for r in read_late(spark, path).collect()) == [1, 2]
    assert {r["DayofMonth"]: r["flights_count"] for r in read_days(spark, path, with_late=True).collect()} == {1: 1, 2: 1, 9: 1}


def test_late_rows_are_stored_before_the_timely_ones_count(spark, landing, config, monkeypatch):
    from delayworks.streaming import gold

    job = config("gold")
    landing({"FlightDate": date(2024, 1, 9)})
    gold_stream(spark, *job, by_event_time=True)
    landing({"FlightDate": date(2024, 1, 1)}, {"FlightDate": date(2024, 1, 10)})

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as cut:
        cut.setattr(gold, "store", lost)
        with pytest.raises(Exception, match="lost"):
            gold_stream(spark, *job, by_event_time=True)
    assert read_late(spark, job[1]["datasetOuputPath"]).count() == 1
    gold_stream(spark, *job, by_event_time=True)
    assert read_late(spark, job[1]["datasetOuputPath"]).count() == 1
    assert sum(r["flights_count"] for r in read_totals(spark, job[1]["datasetOuputPath"]).collect()) == 2


def test_nothing_stored_has_no_days_and_no_late_rows(spark, tmp_path):
    assert read_days(spark, f"{tmp_path}/none").collect() == read_late(spark, f"{tmp_path}/none").collect() == []


# --- arrival time ---


def test_arrival_time_leaves_no_state_and_no_late_rows(spark, landing, flights, config):
    job = config("gold", partitionBy=["OriginCityName"])
    path = job[1]["datasetOuputPath"]
    for part in (ROUTES[10:], ROUTES[5:10], ROUTES[:5]):  # the latest days come first
        landing(*part)
    query = gold_stream(spark, *job, by_arrival=True)
    assert [o["numRowsTotal"] for o in query.lastProgress["stateOperators"]] == [0]
    expected = gold_daily_route(flights(*ROUTES))
    got = read_arrivals(spark, path, EVENT_TIME_COLUMN)
    assert sorted(got.select(expected.columns).collect(), key=repr) == sorted(expected.collect(), key=repr)
    landing(*ROUTES)
    gold_stream(spark, *job, by_arrival=True)
    assert sum(r["flights_count"] for r in read_arrivals(spark, path, EVENT_TIME_COLUMN).collect()) == 2 * len(ROUTES)


def test_with_a_delay_the_last_arrivals_wait_for_the_next_run(spark, landing, config):
    job = config("gold")
    landing(*ROUTES)
    query = gold_stream(spark, *job, by_arrival=True, delay="10 minutes")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == len(ROUTES)


def test_stored_silver_computes_a_micro_batch_once_and_sorts_nothing_to_dedup(spark, flights, tmp_path, monkeypatch, capsys):
    from delayworks.streaming import silver

    plans, write_folder = [], silver.write_folder

    def explained(rows, *how):
        rows.explain("formatted")
        plans.append(capsys.readouterr().out.split("\n\n")[0])
        return write_folder(rows, *how)

    monkeypatch.setattr(silver, "write_folder", explained)
    source = {"datasetInputPath": f"{tmp_path}/in", "autoloaderOptions": {"cloudFiles.format": "parquet"}}
    sink = {"format": "parquet", "datasetOuputPath": f"{tmp_path}/t", "checkpointPath": f"{tmp_path}/c", "outputMode": "append"}
    for distance in (1.0, 2.0):
        rows = flights({"Distance": distance}, {"Distance": distance, "OriginCityName": None}, {"CRSDepTime": int(distance)})
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        silver_stream(spark, source, sink, stored=True)
    assert read_silver(spark, f"{tmp_path}/t").count() == 4
    first, second = plans
    assert "SortAggregate" not in first
    assert second.count("LeftAnti") == 1 and "LeftSemi" not in second and "Union" not in second
