"""One stream for all raw tables: every file once, repeated batches, rejects, files that are no table's."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import csv_scan
from ledgerline.sources.adapter import RawTables
from ledgerline.streaming import pipes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def folders():
    base = tempfile.mkdtemp(prefix="ll-pipes-")
    return [f"{base}/{x}" for x in ("landing", "raw", "checkpoint")]


def put(landing, table, name, lines):
    os.makedirs(f"{landing}/{table}", exist_ok=True)
    with open(f"{landing}/{table}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def rows(spark, raw, table):
    df = pipes.loaded_table(spark, raw, table)
    return sorted(map(str, df.drop("_source_file", "_file_modified_at", "load_batch").collect()))


def test_all_tables_once(spark):
    landing, raw_root, checkpoint = folders()
    raw = RawTables(spark, SF)
    for t in raw.names():
        csv_scan.write_csv(raw[t], t, landing)
    pipes.load_available(spark, landing, raw_root, checkpoint, max_files=7)  # several batches
    counts = {t: pipes.loaded_table(spark, raw_root, t).count() for t in raw.names()}
    assert counts == {t: raw[t].count() for t in raw.names()}
    assert rows(spark, raw_root, "accounts") == sorted(map(str, csv_scan.scan_table(spark, landing, "accounts").collect()))
    pipes.load_available(spark, landing, raw_root, checkpoint)  # nothing new
    assert {t: pipes.loaded_table(spark, raw_root, t).count() for t in raw.names()} == counts
    put(landing, "city", "more.csv", ["city,state_id,city_id", "Lagoa,1,777"])
    put(landing, "notes", "a.csv", ["x", "1"])  # no raw table
    pipes.load_available(spark, landing, raw_root, checkpoint)
    assert pipes.loaded_table(spark, raw_root, "city").count() == counts["city"] + 1 and not os.path.exists(f"{raw_root}/notes")


def test_a_failed_batch_is_repeated_without_double_rows(spark, monkeypatch):
    """The first try writes one table and fails at the next; the second replaces what it left."""
    landing, raw_root, checkpoint = folders()
    put(landing, "country", "a.csv", ["country,country_id", "Brazil,1", "Chile,2"])
    put(landing, "state", "a.csv", ["state,country_id,state_id", "Acre,1,1"])
    real, calls = pipes.load_files, []

    def fails_at_the_second(spark, table, paths, permissive=False):
        calls.append(table)
        if len(calls) == 2:
            raise OSError("executor lost")
        return real(spark, table, paths, permissive)

    monkeypatch.setattr(pipes, "load_files", fails_at_the_second)
    with pytest.raises(Exception, match="executor lost"):
        pipes.load_available(spark, landing, raw_root, checkpoint)
    assert len(os.listdir(raw_root)) == 1  # one table was written
    put(landing, "country", "b.csv", ["country,country_id", "Peru,3"])
    pipes.load_available(spark, landing, raw_root, checkpoint)
    assert sorted(r.country for r in pipes.loaded_table(spark, raw_root, "country").collect()) == ["Brazil", "Chile", "Peru"]
    assert pipes.loaded_table(spark, raw_root, "state").count() == 1
    # a batch given again by hand changes nothing
    files = spark.createDataFrame([("state", f"{landing}/state/a.csv")], "table_name string, path string")
    before = rows(spark, raw_root, "state")
    pipes.load_batch(files, 0, raw_root, ["state"])
    assert rows(spark, raw_root, "state") == before


def test_rejected_lines_have_a_table(spark):
    landing, raw_root, checkpoint = folders()
    put(landing, "country", "a.csv", ["country,country_id", "Brazil,1", "too,many,fields", "Chile,2"])
    put(landing, "state", "a.csv", ["state,country_id,state_id", "Acre,1,1", "few"])
    pipes.load_available(spark, landing, raw_root, checkpoint, permissive=True)
    assert pipes.loaded_table(spark, raw_root, "country").count() == 2 and pipes.loaded_table(spark, raw_root, "state").count() == 1
    bad = pipes.loaded_table(spark, raw_root, pipes.REJECTED)
    assert sorted((r.table_name, r.line) for r in bad.collect()) == [("country", "too,many,fields"), ("state", "few")]
    assert bad.where(F.col("_source_file").isNull()).count() == 0
    strict_raw, strict_checkpoint = f"{raw_root}2", f"{checkpoint}2"
    with pytest.raises(Exception):
        pipes.load_available(spark, landing, strict_raw, strict_checkpoint)
