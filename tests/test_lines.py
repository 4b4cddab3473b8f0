"""Files by lines and splits: numbering, headers, quarantine, and the merge."""

import pytest
from pyspark.sql import functions as F

from aerolith.operators import campaign
from aerolith.sources import icartt, lines

HEADER = ["15, 1001", "PI", "organisation", "Probe A (x)", "mission", "1, 1", "2021, 5, 13", "1", "seconds", "2", "1, 1", "-9999, -8888", "a, counts, std, the a", "b,none", "DATA_INFO: made"]


@pytest.fixture()
def tiny_splits(spark):
    """Splits of 300 bytes: headers span several."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, name, data, header=HEADER, end="\n"):
    (path / name).write_text(end.join([*header, *data]) + end, newline="")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_one_file_is_many_tasks_and_numbers_are_right(spark, tmp_path, tiny_splits):
    data = [f"{i}, {i * 0.5}, {-8888 if i % 7 == 0 else i}" for i in range(500)]
    write(tmp_path, "opt_HU25_20210513_R0.ict", data)
    write(tmp_path, "opt_HU25_20210514_R0.ict", data[:3] + ["", " "] + data[3:6], end="\r\n")
    read = lines.read_lines(spark, str(tmp_path), "*.ict")
    assert read.select(F.spark_partition_id()).distinct().count() > 4
    one = [r["value"] for r in read.where("file like '%0513%'").orderBy("line").collect()]
    assert one == [*HEADER, *data] and [r["line"] for r in read.where("file like '%0514%'").orderBy("line").collect()] == list(range(15 + 8))
    heads = lines.headers(read)
    assert rows(icartt.header_variables(heads), "file", "pos", "name", "units") == rows(icartt.header_variables(icartt.read_files(spark, str(tmp_path))), "file", "pos", "name", "units")
    found, whole = lines.scan(read, heads, True), icartt.scan(icartt.read_files(spark, str(tmp_path)), True)
    same = ("file", "instr", "flight_date", "seconds", "variable", "value")
    assert rows(found.values, *same) == rows(whole, *same) and found.quarantine.count() == 0
    assert found.counts["n_lines"] == 506 and found.counts["n_bad"] == 0
    assert rows(found.values.where("file like '%0514%' and seconds = 3"), "pos")[0] == (5,)  # blank lines count as places


def test_quarantine_names_the_first_reason(spark, tmp_path):
    bad = {"x, 1, 2": lines.NO_TIME, ", 1, 2": lines.NO_TIME, "1, 2": lines.TOO_FEW, "1": lines.TOO_FEW, "1, 2, 3, 4": lines.TOO_MANY, "1, two, 3": lines.NO_NUMBER, "1, 2, 3x": lines.NO_NUMBER, "nonsense": lines.NO_TIME}
    write(tmp_path, "opt_HU25_20210513_R0.ict", ["0, 1, 2", *bad, "9, , -8888"])
    (tmp_path / "opt_HU25_20210514_R0.ict").write_text("99999999, 1001\nno header\n")
    (tmp_path / "opt_HU25_20210515_R0.ict").write_text("not a header\n")
    (tmp_path / "readme.txt").write_text("1, 2, 3\n")
    read = lines.read_lines(spark, str(tmp_path))
    heads = lines.headers(read)
    done = lines.scan(read, heads)
    assert {r["value"]: r["reason"] for r in done.quarantine.collect()} == bad
    assert sorted(r["pos"] for r in done.quarantine.collect()) == list(range(1, 9))
    assert done.counts == {"n_lines": 10, "n_bad": 8, lines.NO_TIME: 3, lines.TOO_FEW: 2, lines.TOO_MANY: 1, lines.NO_NUMBER: 2}
    assert rows(done.values, "seconds", "variable", "value") == [(0.0, "a", 1.0), (0.0, "b", 2.0), (9.0, "a", None), (9.0, "b", None)]
    told = {str(r["flight_date"]): (r["n_files"], r["n_bad_files"], r["n_bad_rows"], r["failed"]) for r in lines.failures(heads, done.quarantine).collect()}
    assert told == {"2021-05-13": (1, 0, 8, False), "2021-05-14": (1, 1, 0, True), "2021-05-15": (1, 1, 0, True)}


def test_merge_finds_variables_and_keeps_the_timeline(spark, tmp_path):
    write(tmp_path, "opt_HU25_20210513_R0.ict", ["0, 1, 2", "30, 3, -8888", "90, 5, 6", "90000, 7, 7"])
    write(tmp_path, "aux_HU25_20210513_R0.ict", ["61, 8, 9"], [*HEADER[:3], "Probe B", *HEADER[4:]])
    done = campaign.merge_lines(lines.read_lines(spark, str(tmp_path)), 60, dropped=["_B_a$"])
    assert done.table.columns == ["flight_date", "slot_s", "Probe_A__x__a", "Probe_A__x__b", "Probe_B_b"] and done.table.count() == 1440
    assert rows(done.table.where("slot_s < 120"), "slot_s", "Probe_A__x__a", "Probe_A__x__b", "Probe_B_b") == [(0, 2.0, 2.0, None), (60, 5.0, 6.0, 9.0)]
    assert ("Probe B", "a.units", "counts") in rows(done.metadata, "title", "field", "value") and ("Probe A (x)", "DATA_INFO", "made") in rows(done.metadata, "title", "field", "value")
    assert done.failures.first()["n_files"] == 2 and done.quarantine.count() == 0
