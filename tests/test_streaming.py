import os

import pytest

from snapfeed.plans.feeds import RX_FEED_COLUMNS, SUMMARY_COLUMNS
from snapfeed.streaming.ingest import RxFeedIngest, SummaryIngest, cell_columns, csv_file_batch, csv_file_stream, run_available


def feed_file(path, rows):
    header = ",".join(f'"{c}"' for c in RX_FEED_COLUMNS)
    lines = [header]
    for pid, rxn, disp, serial, ndc in rows:
        cells = [""] * len(RX_FEED_COLUMNS)
        cells[0], cells[1], cells[2], cells[3], cells[4] = pid, rxn, "2024-01-01", disp, serial
        cells[16], cells[17], cells[20], cells[25], cells[32] = "click", "$1.00", "2.00", "late", ndc
        lines.append(",".join(cells))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def handler_for(spark, tmp_dir, name, cls=RxFeedIngest, **more):
    args = dict(ndc_value=5, placeholder="PH", base_amount=100.0, statuses=["click"], partition_by_month=False) | more
    return cls(spark, os.path.join(tmp_dir, "history"), name, os.path.join(tmp_dir, "staging"), "RX_FEED", **args)


def staged(spark, name):
    cols = ["De_identified_Patient_ID", "Rx_Number", "Serial_coalesce", "dup_count", "_source_file", "_snapshot_date"]
    return sorted((tuple(map(str, r)) for r in spark.table(name).select(*cols).collect()))


OLD = ("RX_FEED_2024-01-01.csv", [("1", "10", "2024-01-02", "NI-1", "5"), ("1", "10", "2024-01-03", "", "5"), ("2", "11", "", "NM-2", "6")])
NEW = ("RX_FEED_2024-01-02.csv", [("1", "10", "2024-01-02", "NI-1", "5"), ("3", "12", "2024-01-04", "NM-3", "6"), ("3", "12", "2024-01-04", "NM-3", "6"),
                                  ("3", "12", "2024-01-04", "NM-3", "6")])
SAME_DAY = ("RX_FEED_2024-01-02b.csv", [("3", "12", "2024-01-04", "NM-3", "7"), ("4", "13", "2024-01-04", "NM-4", "6")])


def landed(tmp_dir, *files):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land, exist_ok=True)
    for name, rows in files:
        feed_file(os.path.join(land, name), rows)
    return land


def one_batch(spark, tmp_dir, name, **more):
    land = landed(os.path.join(tmp_dir, "whole"), OLD, NEW, SAME_DAY)
    handler = handler_for(spark, os.path.join(tmp_dir, "whole"), name, **more)
    handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 0)
    return staged(spark, name)


@pytest.mark.parametrize("by_month", [False, True])
def test_ingest_twice_is_noop(spark, tmp_dir, by_month):
    land = landed(tmp_dir, OLD, NEW, ("unrelated.csv", [("9", "9", "2024-01-02", "NI-9", "5")]))
    table = f"rx_staging_{int(by_month)}"
    handler = handler_for(spark, tmp_dir, table, partition_by_month=by_month)
    ckpt = os.path.join(tmp_dir, "ckpt")
    run_available(csv_file_stream(spark, land, RX_FEED_COLUMNS), ckpt, handler)
    assert handler.history().count() == 7
    refills = [r[0] for r in handler.history().select("modified_serial_id").collect() if r[0] and "refill" in r[0]]
    assert refills == ["NI-1refill1"]
    want = staged(spark, table)
    # The newer file wins the shared key; three equal lines are one row (dup_count 1).
    assert [(r[0], r[3], r[4]) for r in want] == [("1", "1", NEW[0]), ("1", "1", OLD[0]), ("2", "1", OLD[0]), ("3", "1", NEW[0])]
    run_available(csv_file_stream(spark, land, RX_FEED_COLUMNS), ckpt, handler)
    handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 0)  # a replayed batch (foreachBatch is at-least-once)
    assert handler.history().count() == 7 and staged(spark, table) == want


@pytest.mark.parametrize("order", [(OLD, NEW, SAME_DAY), (SAME_DAY, NEW, OLD)])
def test_result_is_independent_of_batches_and_arrival(spark, tmp_dir, order):
    """Older file later, same-date files in different batches: always the one-batch result."""
    name = "rx_order_" + "".join(f[0][-7:-4].strip("-") for f in order).replace("-", "_")
    want = one_batch(spark, tmp_dir, name + "_whole")
    assert [(r[0], r[3]) for r in want] == [("1", "1"), ("1", "1"), ("2", "1"), ("3", "2"), ("4", "1")]
    handler = handler_for(spark, tmp_dir, name)
    for i, file in enumerate(order):
        land = landed(tmp_dir, file)
        handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), i)
    assert staged(spark, name) == want


@pytest.mark.parametrize("step", ["_upsert", "post_merge"])
def test_replay_after_a_crash(spark, tmp_dir, step):
    """A batch that fails at any step is done again in full."""
    name = f"rx_crash_{step.strip('_')}"
    want = one_batch(spark, tmp_dir, name + "_whole")
    land = landed(tmp_dir, OLD, NEW, SAME_DAY)
    calls = []

    def fail(*args):
        calls.append(args)
        raise RuntimeError("lost")

    handler = handler_for(spark, tmp_dir, name)
    setattr(handler, step, fail)
    ckpt = os.path.join(tmp_dir, "ckpt")
    with pytest.raises(Exception, match="lost"):
        run_available(csv_file_stream(spark, land, RX_FEED_COLUMNS), ckpt, handler)
    assert calls and not os.path.exists(handler.ledger_path)
    again = handler_for(spark, tmp_dir, name)
    run_available(csv_file_stream(spark, land, RX_FEED_COLUMNS), ckpt, again)
    assert staged(spark, name) == want and again.history().count() == 9


def test_half_written_append(spark, tmp_dir):
    """Rows of a file that a crashed append left in the history are replaced."""
    want = one_batch(spark, tmp_dir, "rx_half_whole")
    handler = handler_for(spark, tmp_dir, "rx_half")
    land = landed(tmp_dir, OLD, NEW, SAME_DAY)
    whole = spark.read.parquet(os.path.join(tmp_dir, "whole", "history"))
    whole.where(f"_source_file = '{NEW[0]}'").limit(2).write.partitionBy("_snapshot_date", "_source_file").parquet(handler.history_path)
    handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 0)
    assert handler.history().count() == 9 and staged(spark, "rx_half") == want


def test_unreadable_ledger_is_an_error(spark, tmp_dir):
    handler = handler_for(spark, tmp_dir, "rx_ledger")
    os.makedirs(handler.ledger_path)
    with open(os.path.join(handler.ledger_path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        handler(csv_file_batch(spark, landed(tmp_dir, OLD), RX_FEED_COLUMNS), 0)


def test_long_and_empty_rows(spark, tmp_dir):
    n = len(RX_FEED_COLUMNS)
    land = landed(tmp_dir, OLD)
    with open(os.path.join(land, OLD[0]), "a") as f:
        f.write("," * (n - 1) + "\n")
    handler = handler_for(spark, tmp_dir, "rx_rows")
    handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 0)
    assert handler.history().count() == 3  # the all-empty line is no fill
    for extra in (1, 2):
        feed_file(os.path.join(land, "RX_FEED_2024-02-01.csv"), [("7", "1", "1/5/2024", "NM-7", "5")])
        with open(os.path.join(land, "RX_FEED_2024-02-01.csv"), "a") as f:
            f.write("8" + "," * (n - 1) + ",x" * extra + "\n")
        with pytest.raises(Exception, match="longer than header"):
            handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 1)
    feed_file(os.path.join(land, "RX_FEED_2024-02-01.csv"), [("7", "1", "1/5/2024", "NM-7", "5")])  # a US date
    handler(csv_file_batch(spark, land, RX_FEED_COLUMNS), 1)
    assert [str(r[0]) for r in handler.history().where("De_identified_Patient_ID = '7'").select("Dispense_Date").collect()] == ["2024-01-05"]


def test_summary_ingest(spark, tmp_dir):
    """Columns are matched by each file's own header, whatever their order."""
    land = os.path.join(tmp_dir, "summaries")
    os.makedirs(land)
    headers = ["RX NUM" if c == "RX_NUM" else "DATE ENTERED" if c == "DATE_ENTERED" else
               "CLAIM PAYMENT" if c == "MED_CLAIM_PAYMENT" else c for c in SUMMARY_COLUMNS]

    def write(name, rows, heads):
        lines = [",".join(heads)]
        for patid, rx_num, entered in rows:
            cells = {"PATID": patid, "RX NUM": rx_num, "DATE ENTERED": entered}
            lines.append(",".join(cells.get(h, "") for h in heads))
        with open(os.path.join(land, name), "w") as f:
            f.write("\n".join(lines) + "\n")

    write("20240105- BENEFIT SUMMARY.csv", [("7", "12", "2024-01-04 10:00:00"), ("", "x", "2024-01-04 11:00:00"), ("", "", "")], headers)
    write("20240106- BENEFIT SUMMARY.csv", [("8", "13", "1/5/2024 9:30")], ["EXTRA", *reversed(headers)])
    write("summary without date.csv", [("8", "1", "2024-01-04 10:00:00")], headers)
    write("RX_FEED_2024-01-05.csv", [("9", "1", "2024-01-04 10:00:00")], headers)
    handler = SummaryIngest(spark, os.path.join(tmp_dir, "summary_hist"), "BENEFIT SUMMARY", rx_prefix="RX_FEED")
    cells = cell_columns(64)
    run_available(csv_file_stream(spark, land, cells, header=False), os.path.join(tmp_dir, "ckpt2"), handler)
    got = sorted((r["PATID"], r["RX_NUM"], str(r["_snapshot_date"]), r["MED_CLAIM_PAYMENT"]) for r in handler.history().collect())
    assert got == [(0, 0, "2024-01-05", "no data"), (7, 12, "2024-01-05", "no data"), (8, 13, "2024-01-06", "no data")]
    handler(csv_file_batch(spark, land, cells, header=False), 1)
    assert handler.history().count() == 3
    write("20240107- BENEFIT SUMMARY.csv", [("9", "14", "2024-01-05")], headers[:-1])
    with pytest.raises(Exception, match="no column MED_PAT_COPAY_CO_INS"):
        handler(csv_file_batch(spark, land, cells, header=False), 2)
    with open(os.path.join(land, "20240107- BENEFIT SUMMARY.csv"), "w") as f:
        f.write(",".join(headers) + "\n" + "1," * len(headers) + "1\n")
    with pytest.raises(Exception, match="longer than its header"):
        handler(csv_file_batch(spark, land, cells, header=False), 2)
    write("20240107- BENEFIT SUMMARY.csv", [("9", "14", "2024-01-05"), ("9", "15", "1/5/2024")], headers)
    with pytest.raises(Exception, match="no one date format fits all values"):  # a column has one format per file
        handler(csv_file_batch(spark, land, cells, header=False), 2)


def test_cli_sql_script(spark, tmp_dir, capsys):
    from snapfeed.__main__ import main
    script = os.path.join(tmp_dir, "s.sql")
    with open(script, "w") as f:
        f.write("CREATE TEMPORARY VIEW v AS SELECT 1 AS a;\nSELECT a + 41 AS answer FROM v;")
    main(["sql", script, "--show", "1"])
    assert "42" in capsys.readouterr().out


def test_cli_ingest_rx(spark, tmp_dir):
    from snapfeed.__main__ import main
    land = os.path.join(tmp_dir, "cli_landing")
    os.makedirs(land)
    feed_file(os.path.join(land, "RX_FEED_2024-03-01.csv"), [("4", "1", "2024-03-02", "NM-4", "5")])
    main(["ingest", "rx", "--landing", land, "--checkpoint", os.path.join(tmp_dir, "cli_ckpt"),
          "--history", os.path.join(tmp_dir, "cli_hist"), "--prefix", "RX_FEED",
          "--staging-table", "cli_staging", "--staging-root", os.path.join(tmp_dir, "cli_staging"),
          "--ndc", "5", "--placeholder", "PH", "--base-amount", "100", "--statuses", "click"])
    assert spark.table("cli_staging").count() == 1
