"""The upsert with keyed state against the one without, restarts, late messages, silent keys."""

import random

from test_stream import drop, stream, table

from paneloom.streaming import bulletins as B, state as S, upsert as U


def written(spark, target):
    return spark.read.parquet(target).count()


def test_same_table_as_without_state(spark, fresh):
    folder, plain, kept = fresh("in"), (fresh("live"), fresh("ck")), (fresh("live"), fresh("ck"))
    dice = random.Random(7)
    for turn in range(2):
        messages = [
            {"ISO_Code": dice.choice(["ITA", "ITA", "ITA", "FRA"]), "Date": f"2021-02-0{dice.randint(1, 3)}", "Confirmed": n, "seq": dice.randint(0, 99)}
            for n in range(60)
        ]
        drop(folder, f"{turn}.txt", *messages, "broken {", {"seq": 3})
        got = table(S.state_upsert_once(stream(spark, folder), *kept))
        assert got == table(U.upsert_once(stream(spark, folder), *plain))
        assert ("Unknown", "N/A") in got


def test_restart_writes_changes_only(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    key = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    drop(folder, "a.txt", key | {"Confirmed": 1, "seq": 5}, key | {"Confirmed": 4, "seq": 1})
    live = S.state_upsert_once(stream(spark, folder), target, check)
    first = live.first()["received_at"]
    assert table(live)["ITA", "2021-02-01"][0] == 1.0 and written(spark, target) == 1
    drop(folder, "b.txt", key | {"Confirmed": 2, "seq": 4})  # late: behind nothing
    assert table(S.state_upsert_once(stream(spark, folder), target, check))["ITA", "2021-02-01"][0] == 1.0
    assert written(spark, target) == 1
    drop(folder, "c.txt", key | {"Confirmed": 3, "seq": 6})
    live = S.state_upsert_once(stream(spark, folder), target, check)
    assert table(live)["ITA", "2021-02-01"][0] == 3.0 and live.first()["received_at"] == first
    assert written(spark, target) == 2


def test_positions_of_files(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    key = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    read = lambda: S.state_upsert_once(B.parse_bulletins(B.read_bulletins(spark, {}, path=folder)), target, check)
    drop(folder, "a.txt", key | {"Confirmed": 100}, key | {"Confirmed": 7})
    assert table(read())["ITA", "2021-02-01"][0] == 7.0
    drop(folder, "b.txt", key | {"Confirmed": 3})
    assert table(read())["ITA", "2021-02-01"][0] == 3.0


def test_dropped_state_keeps_the_table(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    key = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    for turn, (cases, seq) in enumerate([(1, 5), (2, 4), (3, 6)]):
        drop(folder, f"{turn}.txt", key | {"Confirmed": cases, "seq": seq})
        live = S.state_upsert_once(stream(spark, folder), target, check, idle_ms=1)
    assert table(live)["ITA", "2021-02-01"][0] == 3.0


def test_keys_make_no_python_calls_without_timers(spark, fresh):
    """The state is an aggregate of the engine; a message that is sent again later changes nothing."""
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    key = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    drop(folder, "a.txt", key | {"Confirmed": 1, "seq": 5})
    plan = S.changes(stream(spark, folder))._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan
    S.state_upsert_once(stream(spark, folder), target, check)
    drop(folder, "b.txt", key | {"Confirmed": 9, "seq": 5})
    live = S.state_upsert_once(stream(spark, folder), target, check)
    assert table(live)["ITA", "2021-02-01"][0] == 1.0 and written(spark, target) == 1
