"""Bulletins and the keyed upsert: repeats, disorder, broken messages, restarts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from paneloom.sources.writers import keyed_messages, publish
from paneloom.streaming import bulletins as B, upsert as U


def drop(folder, name, *messages):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")


def stream(spark, folder):
    """Messages whose own ``seq`` is their offset."""
    raw = spark.readStream.schema("value string").text(folder)
    return B.parse_bulletins(raw.withColumn("offset", F.coalesce(F.get_json_object("value", "$.seq").cast("long"), F.lit(0))))


def run(spark, folder, target, check, **kwargs):
    return U.upsert_once(stream(spark, folder), target, check, **kwargs)


def table(df):
    return {(r["ISO_Code"], r["Date"]): (r["New_Confirmed"], r["payload"]) for r in df.collect()}


def test_parsing(spark, rows):
    messages = [
        '{"iso_code": "ITA", "date": "2021-02-01", "Confirmed": 5}',
        '{"ISO_Code": "ITA", "iso_code": "XXX", "Date": "2021-02-01", "New_Confirmed": null, "Confirmed": 7}',
        '{"deaths": 1}',
        "not json",
        "[1, 2]",
    ]
    parsed = B.parse_bulletins(spark.createDataFrame([(m,) for m in messages], "value string"))
    good = B.good(parsed)
    assert rows(good.select("ISO_Code", "Date", "New_Confirmed")) == [("ITA", "2021-02-01", 5.0), ("ITA", "2021-02-01", 7.0), ("Unknown", "N/A", 0.0)]
    assert "iso_code" not in good.first()["payload"]
    assert rows(B.dead_letters(parsed)) == [("[1, 2]",), ("not json",)]


def test_upsert_keeps_last_payload_and_first_arrival(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    drop(folder, "a.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 1, "seq": 1}, {"ISO_Code": "ITA", "Date": "2021-02-02", "Confirmed": 2, "seq": 2})
    run(spark, folder, target, check)
    first = U.read_live(spark, target).filter("Date = '2021-02-01'").first()["received_at"]
    drop(folder, "b.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 10, "seq": 3}, {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 9, "seq": 2}, "broken {", {"ISO_Code": "FRA", "Date": "2021-01-31", "Confirmed": 4, "seq": 4})
    live = run(spark, folder, target, check)
    got = table(live)
    assert {k: v[0] for k, v in got.items()} == {("ITA", "2021-02-01"): 10.0, ("ITA", "2021-02-02"): 2.0, ("FRA", "2021-01-31"): 4.0}
    assert live.filter("Date = '2021-02-01'").first()["received_at"] == first
    # Nothing new: the restart from the checkpoint changes nothing.
    assert table(run(spark, folder, target, check)) == got
    # Replaying everything under a new checkpoint gives the same table.
    assert table(run(spark, folder, fresh("live"), fresh("ck"))) == got


def test_a_new_checkpoint_overwrites_nothing(spark, fresh):
    first, second, target, check = fresh("in"), fresh("in"), fresh("live"), fresh("ck")
    drop(first, "a.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 1, "seq": 1})
    run(spark, first, target, check)
    drop(first, "b.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 2, "seq": 2})
    run(spark, first, target, check)
    drop(second, "c.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 3, "seq": 3})
    assert table(run(spark, second, target, fresh("ck")))["ITA", "2021-02-01"][0] == 3.0
    assert len([d for d in os.listdir(target) if d.startswith("run=")]) == 2
    # An older message that a later run brings changes nothing.
    third = fresh("in")
    drop(third, "d.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 9, "seq": 2})
    assert table(run(spark, third, target, fresh("ck")))["ITA", "2021-02-01"][0] == 3.0


def test_a_repeated_batch_replaces_itself(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    drop(folder, "a.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 1, "seq": 1})
    run(spark, folder, target, check)
    os.remove(os.path.join(check, "commits", "0"))  # as if the driver died before it could commit the batch
    crc = os.path.join(check, "commits", ".0.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert len(table(run(spark, folder, target, check))) == 1
    assert [os.listdir(os.path.join(target, d)) for d in os.listdir(target) if d.startswith("run=")] == [["batch=0"]]


def test_the_last_line_of_a_file_wins(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    message = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    drop(folder, "a.txt", message | {"Confirmed": 100}, message | {"Confirmed": 7})
    live = lambda: U.upsert_once(B.parse_bulletins(B.read_bulletins(spark, {}, path=folder)), target, check)
    assert table(live())["ITA", "2021-02-01"][0] == 7.0
    drop(folder, "b.txt", message | {"Confirmed": 3})
    assert table(live())["ITA", "2021-02-01"][0] == 3.0


def test_fields_are_judged_by_their_own_position(spark, fresh):
    folder, target, check, packed = fresh("in"), fresh("live"), fresh("ck"), fresh("packed")
    message = {"ISO_Code": "ITA", "Date": "2021-02-01"}
    drop(folder, "a.txt", message | {"beds": 1, "seq": 1}, message | {"Deaths": 9, "seq": 9})
    run(spark, folder, target, check, merge="fields")
    U.compact(spark, target, packed, merge="fields")
    drop(folder, "b.txt", message | {"beds": 5, "Deaths": 5, "seq": 5})
    payload = table(run(spark, folder, packed, check, merge="fields"))["ITA", "2021-02-01"][1]
    assert payload["beds"] == "5" and payload["Deaths"] == "9"


def test_topic_messages_carry_their_entity_as_key(spark):
    rows = spark.createDataFrame([("ITA", 1)], "ISO_Code string, n int")
    assert [tuple(r) for r in keyed_messages(rows).collect()] == [("ITA", '{"ISO_Code":"ITA","n":1}')]


def test_fields_merge(spark, fresh):
    folder, target, check = fresh("in"), fresh("live"), fresh("ck")
    drop(folder, "a.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 1, "Deaths": 3, "beds": 8, "seq": 1})
    run(spark, folder, target, check, merge="fields")
    drop(folder, "b.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 2, "beds": None, "seq": 2})
    cases, payload = table(run(spark, folder, target, check, merge="fields"))["ITA", "2021-02-01"]
    assert cases == 2.0 and payload["Deaths"] == "3" and payload["beds"] is None and "beds" in payload


@pytest.mark.parametrize("merge", ["record", "fields"])
def test_compaction_keeps_the_table(spark, fresh, merge):
    folder, target, check, packed = fresh("in"), fresh("live"), fresh("ck"), fresh("packed")
    for i in range(3):
        drop(folder, f"{i}.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": i, f"f{i}": i, "seq": i})
        run(spark, folder, target, check, merge=merge)
    before = table(U.read_live(spark, target, merge=merge))
    U.compact(spark, target, packed, merge=merge)
    assert table(U.read_live(spark, packed, merge=merge)) == before
    drop(folder, "9.txt", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 99, "seq": 9})
    assert table(run(spark, folder, packed, check, merge=merge))["ITA", "2021-02-01"][0] == 99.0


def test_replay_day_by_day(spark, fresh):
    rows = [("ITA", dt.date(2021, 1, 31), 1.0), ("ITA", dt.date(2021, 2, 1), 2.0), ("FRA", dt.date(2021, 2, 1), 3.0), ("ITA", dt.date(2021, 2, 2), 4.0)]
    history = spark.createDataFrame(rows, "iso_code string, date date, confirmed double").withColumn("_id", F.lit("x"))
    tagged = B.replay_batches(history, "2021-02-01")
    assert sorted((str(r["day"]), json.loads(r["value"])["New_Confirmed"]) for r in tagged.collect()) == [("2021-02-01", 2.0), ("2021-02-01", 3.0), ("2021-02-02", 4.0)]
    folder = fresh("days")
    publish(B.normalize_record(history).filter("Date >= '2021-02-01'"), path=folder)
    assert sorted(d for d in os.listdir(folder) if d.startswith("day=")) == ["day=2021-02-01", "day=2021-02-02"]
    source = B.read_bulletins(spark, {"maxFilesPerTrigger": "1"}, path=folder)
    live = U.upsert_once(B.parse_bulletins(source), fresh("live"), fresh("ck"))
    assert {k: v[0] for k, v in table(live).items()} == {("ITA", "2021-02-01"): 2.0, ("FRA", "2021-02-01"): 3.0, ("ITA", "2021-02-02"): 4.0}


def test_rejects_are_kept(spark, fresh):
    folder, target, bad = fresh("in"), fresh("live"), fresh("bad")
    drop(folder, "a.txt", "oops", {"ISO_Code": "ITA", "Date": "2021-02-01", "Confirmed": 1, "seq": 1})
    U.upsert_stream(stream(spark, folder), target, fresh("ck"), rejects=bad).awaitTermination(120)
    assert [r["raw"] for r in spark.read.parquet(bad).collect()] == ["oops"]


def test_scratch_of_a_run_can_be_dropped(spark, fresh):
    from paneloom.session import cut_lineage, drop_scratch

    kept, gone = fresh("kept"), fresh("gone")
    for path in (kept, gone):
        spark.range(3).write.parquet(path)
    assert drop_scratch(spark, gone) and not os.path.exists(gone) and spark.read.parquet(kept).count() == 3
    assert cut_lineage(spark.range(5)).count() == 5
    with pytest.raises(ValueError):
        drop_scratch(spark, "/somewhere/else")
