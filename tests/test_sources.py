import os
import tempfile

import pytest

from ledgerline.sources import csv_scan
from ledgerline.streaming.ingest import ingest_available


def _write(root, table, name, text):
    d = os.path.join(root, table)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


PIX_HEADER = "id,account_id,pix_amount,pix_requested_at,pix_completed_at,status,in_or_out\n"


def test_typed_scan_marker_and_header_only(spark):
    root = tempfile.mkdtemp(prefix="ll-csv-")
    _write(root, "pix_movements", "a.csv", PIX_HEADER + "1,10,12.345,2020-01-02 03:04:05,None,completed,pix_in\n2,11,7,1577836800,2020-01-01,failed, PIX_OUT \n")
    _write(root, "pix_movements", "empty.csv", PIX_HEADER)
    _write(root, "pix_movements", "notes.txt", "ignored")
    rows = {r.id: r for r in csv_scan.scan_table(spark, root, "pix_movements").collect()}
    assert len(rows) == 2
    assert str(rows[1].pix_amount) == "12.35" and rows[1].pix_completed_at is None
    assert rows[2].pix_requested_at.year == 2020 and rows[2].in_or_out == " PIX_OUT "


def test_strict_vs_permissive_decimal(spark):
    root = tempfile.mkdtemp(prefix="ll-csv-")
    _write(root, "transfer_ins", "a.csv",
           "id,account_id,amount,transaction_requested_at,transaction_completed_at,status\n1,10,abc,1,None,completed\n")
    with pytest.raises(Exception):
        csv_scan.scan_table(spark, root, "transfer_ins").collect()
    assert csv_scan.scan_table(spark, root, "transfer_ins", permissive=True).first().amount is None


def test_streaming_ingest_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-")
    inbox, sink, ckpt = (os.path.join(base, p) for p in ("inbox", "sink", "ckpt"))
    os.makedirs(inbox)
    with open(os.path.join(inbox, "f1.csv"), "w") as f:
        f.write(PIX_HEADER + "1,10,1.00,2020-01-01,2020-01-01,completed,pix_in\n2,10,2.00,2020-01-01,None,failed,pix_out\n")
    assert ingest_available(spark, "pix_movements", inbox, sink, ckpt).count() == 2
    assert ingest_available(spark, "pix_movements", inbox, sink, ckpt).count() == 2   # rerun adds nothing
    with open(os.path.join(inbox, "f2.csv"), "w") as f:
        f.write(PIX_HEADER + "3,11,3.00,2020-01-02,2020-01-02,completed,pix_in\n")
    out = ingest_available(spark, "pix_movements", inbox, sink, ckpt)
    assert sorted(r.id for r in out.collect()) == [1, 2, 3]
    assert out.where("_file_modified_at IS NULL").count() == 0


def test_pipes_for_several_tables(spark):
    from ledgerline.streaming.ingest import start_pipes

    base = tempfile.mkdtemp(prefix="ll-pipes-")
    landing, raw, ckpt = (os.path.join(base, p) for p in ("landing", "raw", "ckpt"))
    _write(landing, "pix_movements", "a.csv", PIX_HEADER + "1,10,1.00,2020-01-01,2020-01-01,completed,pix_in\n")
    _write(landing, "accounts", "a.csv", "account_id,account_name,created_at,status\n10,Ana,2019-05-01 00:00:00,active\n")
    for q in start_pipes(spark, landing, raw, ckpt, tables=["pix_movements", "accounts"]).values():
        q.awaitTermination()
    assert spark.read.parquet(os.path.join(raw, "accounts")).first().account_name == "Ana"
    assert spark.read.parquet(os.path.join(raw, "pix_movements")).count() == 1


TRANSFER_HEADER = "id,account_id,amount,transaction_requested_at,transaction_completed_at,status\n"
RAGGED = TRANSFER_HEADER + "1,10,1.00,1577836800,None,pending\n2,10,2.00\n3,10,3.00,1577836800,1577836801,completed,extra,more\n4,10,x,2020-01-01,None,pending\n"


def test_malformed_lines_have_one_policy(spark):
    """Short and long lines: strict scans and streams fail; permissive ones keep the good rows and set the bad aside."""
    from ledgerline.streaming.ingest import rejected

    base = tempfile.mkdtemp(prefix="ll-ragged-")
    _write(base, "transfer_ins", "a.csv", RAGGED)
    with pytest.raises(Exception):
        csv_scan.scan_table(spark, base, "transfer_ins").collect()
    with pytest.raises(Exception):
        ingest_available(spark, "transfer_ins", f"{base}/transfer_ins", f"{base}/sink1", f"{base}/ckpt1")
    batch = csv_scan.scan_table(spark, base, "transfer_ins", permissive=True)
    stream = ingest_available(spark, "transfer_ins", f"{base}/transfer_ins", f"{base}/sink2", f"{base}/ckpt2", permissive=True)
    pick = lambda df: sorted((r.id, r.amount) for r in df.select("id", "amount").collect())
    assert pick(batch) == pick(stream) and [i for i, _ in pick(batch)] == [1, 4]
    lines = [sorted(r._rejected_line for r in df.collect()) for df in (csv_scan.rejected_lines(spark, base, "transfer_ins"), rejected(spark, f"{base}/sink2"))]
    assert lines[0] == lines[1] == ["2,10,2.00", "3,10,3.00,1577836800,1577836801,completed,extra,more"]


def test_pipe_types_transfer_times(spark):
    base = tempfile.mkdtemp(prefix="ll-pipe-")
    _write(base, "transfer_outs", "a.csv", TRANSFER_HEADER + "1,10,1.00,1577836800,None,pending\n")
    _write(base, "transfer_outs", "b.csv", TRANSFER_HEADER + "2,10,1.00,2020-01-01 00:00:00,1577836800,completed\n")
    out = ingest_available(spark, "transfer_outs", f"{base}/transfer_outs", f"{base}/sink", f"{base}/ckpt", max_files_per_trigger=1)
    assert out.schema["transaction_requested_at"].dataType.simpleString() == "timestamp_ntz"
    rows = {r.id: r for r in out.collect()}
    assert rows[1].transaction_completed_at is None and rows[1].transaction_requested_at == rows[2].transaction_completed_at
    assert len([f for f in os.listdir(f"{base}/ckpt/commits") if not f.startswith(".")]) == 2  # one file per trigger
