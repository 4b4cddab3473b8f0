"""Text files, tables, products, spectra and the catalogue."""

import math

import pytest
from pyspark.sql import functions as F

from aerolith.operators import catalog, merge, retrieval, spectra
from aerolith.sources import icartt, products, tables

COMMENT = ["DATA_INFO: Standard temperature", "OTHER_COMMENTS: Bin Lower Edges (in um) = [1, 2]", "Bin Upper Edges (in um) = [2, 4.5]"]


def text(title="P OPT", variables=("A_Bin01, um, s_STP, bin_center_1.5 um", "B, none"), rows=("10, 1, 2", "11, -9999, 3"), comments=COMMENT):
    n = 12 + len(variables) + len(comments)
    lines = [f"{n}, 1001", "PI", "org", title, "mission", "1, 1", "d", "1", "t", str(len(variables)), "1, 1", "-9999, -8888", *variables, *comments, *rows]
    return "\n".join(lines)


@pytest.fixture()
def files(spark, tmp_path):
    (tmp_path / "opt_HU25_20210513_R0_L2.ict").write_text(text())
    (tmp_path / "opt_HU25_20210514_R0.ict").write_text(text(variables=("A_Bin01, nm, x, other", "C, m")))
    (tmp_path / "opt_HU25_20210515_R0.ict").write_text("nothing to see")
    (tmp_path / "readme.ict").write_text("no name")
    return icartt.read_files(spark, str(tmp_path))


def test_scan(files):
    rows = icartt.scan(files, prefix_title=True).where("file like '%0513%'").orderBy("pos", "variable").collect()
    assert [(r["seconds"], r["variable"], r["value"]) for r in rows] == [(10.0, "P_OPT_A_Bin01", 1.0), (10.0, "P_OPT_B", 2.0), (11.0, "P_OPT_A_Bin01", None), (11.0, "P_OPT_B", 3.0)]


def test_bad_files_are_listed_and_do_not_stop_others(files):
    assert sorted(r["file"] for r in icartt.bad_files(files).collect()) == ["opt_HU25_20210515_R0.ict", "readme.ict"]


def test_selection(files):
    assert icartt.select_files(files).count() == 3
    assert icartt.select_files(files, instruments=("opt",), dates=("2021-05-14", "2021-05-31"), year=2021).count() == 2
    assert icartt.select_files(files, instruments=("cdp",)).count() == 0


def test_header_and_comments(files):
    first = icartt.header_variables(files).where("file like '%0513%'").orderBy("pos").collect()
    assert [(r["name"], r["units"], r["standard"], r["description"]) for r in first] == [("A_Bin01", "um", "s_STP", "bin_center_1.5 um"), ("B", "none", "", "")]
    found = {r["key"]: r["text"] for r in icartt.header_comments(files).where("file like '%0513%'").collect()}
    assert found["DATA_INFO"] == "Standard temperature" and found["OTHER_COMMENTS"].count("\n") == 1


def test_union_of_first_and_last_header(files):
    variables = icartt.select_files(files).select("file", "instr", "flight_date").join(icartt.header_variables(files), "file")
    union = {r["name"]: r["units"] for r in icartt.schema_union(variables).collect()}
    assert union == {"A_Bin01": "um", "B": "none", "C": "m"}


def test_bins_from_headers(spark, files):
    assert icartt.bins_from_descriptions(icartt.header_variables(files)).first()["centre"] == 1.5
    comments = icartt.header_comments(files).where("key = 'OTHER_COMMENTS'")
    edges = comments.select(icartt.bins_from_edges(F.col("text")).alias("b")).first()["b"]
    assert [tuple(b) for b in edges] == [(pytest.approx(math.sqrt(2)), 1.0, 2.0), (3.0, 2.0, 4.5)]
    nm = spark.createDataFrame([("Lower Bounds: 10, 20\nMid points: 15, 30\nUpper Bounds: 20, 40",)], "t string")
    assert tuple(nm.select(icartt.bins_from_bounds(F.col("t")).alias("b")).first()["b"][1]) == (0.03, 0.02, 0.04)


def test_tables(spark, tmp_path):
    (tmp_path / "bins.csv").write_text("dpl,dpg,dpu\n2,3,4\n1,1.5,2\n")
    assert [r["dpg"] for r in tables.bin_table(spark, str(tmp_path / "bins.csv")).collect()] == [1.5, 3.0]
    (tmp_path / "bad.csv").write_text("dpl,dpg\n1,2\n")
    with pytest.raises(ValueError):
        tables.bin_table(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "map.json").write_text('{\n"family_order": ["x"],\n"title_to_family": {"T": "x"}}')
    assert tables.family_map(spark, str(tmp_path / "map.json")).collect() == [("T", "x")]


def test_products(spark, tmp_path):
    df = spark.createDataFrame([("2021-05-13", 1, 1.5), ("2021-05-14", 2, 2.5)], "flight_date string, rn long, x double")
    path = str(tmp_path / "stage")
    products.write_dates(df, path)
    products.write_dates(df.where("rn = 2").withColumn("x", F.lit(9.0)), path)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1.5, 9.0]
    products.write_observations(df, str(tmp_path / "obs"), {"f": ["x"]}, ["rn"], {"x": {"units": "m"}})
    back = spark.read.parquet(str(tmp_path / "obs/f"))
    assert dict(back.dtypes)["x"] == "float" and back.schema["x"].metadata["units"] == "m"
    products.write_results(df, {"w": 60}, str(tmp_path / "res"))
    assert products.read_results(spark, str(tmp_path / "res"))[1] == {"w": 60}
    wide = spark.createDataFrame([(1.0, 2.0, 3.0)], ["dry_cal_sca_coef_550_m-1", "wet_meas_sca_coef_550_m-1", "other"])
    assert products.rename_coefficients(wide).columns == ["dry_calculated_sca_coef_550nm", "other"]


def test_grid_rules():
    smps, las = [(1.0, 1.5, 2.0), (2.0, 2.5, 3.0)], [(3.0, 4.0, 5.0), (5.0, 5.5, 6.0)]
    assert spectra.combined_grid(smps, las, largest=4.0) == [0, 1, 2]
    assert spectra.combined_grid(smps, las, largest=9.0) == [0, 1, 2]
    assert spectra.combined_grid(smps, las, largest=9.0, smallest=2.0) == [1, 2]
    with pytest.raises(ValueError):
        spectra.combined_grid(smps, [(2.5, 4.0, 5.0)])
    with pytest.raises(ValueError):
        spectra.combined_grid(smps, las, largest=1.5)


def test_sums_and_cross_section(spark):
    df = spark.createDataFrame([([1.0, None, 3.0, None],), ([1.0, 2.0, 3.0, None],), ([None] * 4,)], "b array<double>")
    got = df.select(spectra.sum_if_half(F.col("b")), spectra.sum_if_any(F.col("b")), spectra.cross_section(F.col("b"), [1.0, 2.0, 3.0, 4.0])).collect()
    assert [tuple(r) for r in got] == [(None, 4.0, pytest.approx(math.pi * 1e-6 * 28)), (6.0, 6.0, pytest.approx(math.pi * 1e-6 * 36)), (None, None, None)]


def test_synthetic_bins(spark):
    df = spark.createDataFrame([([10.0, 20.0],)], "b array<double>")
    bins, radii = spectra.with_synthetic(F.col("b"), [50.0, 100.0])
    row = df.select(bins.alias("x")).first()["x"]
    assert len(row) == len(radii) == 7 and radii[0] == 1.0 and radii[4] == pytest.approx(49.5)
    assert row[0] == pytest.approx(10.0 / 50) and row[5:] == [10.0, 20.0]


def test_retrieval_flags_and_failures(spark):
    df = spark.createDataFrame([(0, 0, 2), (1, 0, 1), (2, 3, 2), (3, 0, None)], "w long, f int, a int")
    assert [r[0] for r in df.orderBy("w").select(retrieval.quality_flag(F.col("f"), F.col("a"))).collect()] == [0, 2, 1, 2]
    few = spark.createDataFrame([(0, [1.0, None]), (1, [1.0, 2.0])], "window_start long, psd array<double>")
    assert [r["attempt_flag_cri"] for r in retrieval.failures(few, "psd").orderBy("window_start").collect()] == [0, None]


def test_prefix_families(spark):
    names = spark.createDataFrame([("A_B_x",), ("A_y",), ("Z_q",)], "name string")
    titles = spark.createDataFrame([("A", "f"), ("A_B", "g")], "title string, family string")
    assert sorted((r["name"], r["family"], r["title"]) for r in catalog.families(names, titles).collect()) == [("A_B_x", "g", "A_B"), ("A_y", "f", "A"), ("Z_q", "other", "Z")]


def test_repeated_names_keep_their_rows(spark):
    names = spark.createDataFrame([("A_B_x", 1), ("A_B_x", 1), ("A_B_x", 2), (None, 3), ("plain", 4), ("_x", 5)], "name string, n int")
    titles = spark.createDataFrame([("A", "f"), ("A_B", None)], "title string, family string")
    found = sorted((r["n"], r["family"], r["title"]) for r in catalog.families(names, titles).collect() if r["n"] != 3)
    assert found == [(1, "A_B", "A_B"), (1, "A_B", "A_B"), (2, "A_B", "A_B"), (4, "other", "plain"), (5, "other", "")]
    assert catalog.families(names, titles).count() == 6


def test_bin_names_end_where_the_format_ends_them(spark):
    df = spark.createDataFrame([(n,) for n in ("X_CDP_Bin07", "dNdlogD_012_LAS", "dNdlogD_012_LAS_x", "X_bin07", "Bin3")], "n string")
    tag, number = spectra.bin_name(F.col("n"))
    assert [tuple(r) for r in df.select(tag, number).collect()] == [("cdp", 7), ("las", 12), (None, None), (None, None), (None, None)]


def test_loaders_and_product_helpers(spark, tmp_path):
    (tmp_path / "shift.csv").write_text("variable,shift_group,alignment_variable,apply_time_shift\na,g,x | y,YES\nb,g,z,YES\nc,h,q,NO\n")
    shifts = tables.shift_table(spark, str(tmp_path / "shift.csv"))
    assert [(r["variable"], r["pos"]) for r in shifts.orderBy("pos").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    names = tables.DIAGNOSTICS.split(", ")
    (tmp_path / "diag.csv").write_text(",".join(n.split()[0] for n in names) + "\n2020-01-01,g,v,400,4,0.5,,0.1,,,6,6,7,1,SHIFT,,2\n")
    d = tables.diagnostics(spark, str(tmp_path / "diag.csv")).first()
    assert (d["n_valid"], d["optimal_shift_s"], d["peak_r_raw"], d["decision"], d["reason"], d["n_vars_shifted"]) == (400, 4.0, None, "SHIFT", None, 2)
    df = spark.createDataFrame([("2021-05-13", float("nan"), 1.0), ("2021-05-14", 2.0, None)], "flight_date string, x double, y double")
    products.write_dates(df, str(tmp_path / "m"))
    assert tables.merged(spark, str(tmp_path / "m"), ["2021-05-13"]).select("x", "y").collect() == [(None, 1.0)]
    products.write_windows(df, df.select("x"), str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w/windows")).count() == 2 and spark.read.parquet(str(tmp_path / "w/psd_bin")).columns == ["x"]
    assert products.select_scaled(df, {"z": ("y", 1e-6)}, ["flight_date"]).orderBy("flight_date").first()["z"] == pytest.approx(1e-6)
    lost = spark.createDataFrame([(10, 3, 30.0)], "n_rows long, n_dropped long, percent_dropped double")
    r = products.provenance_row(lost, "T", 60, {"b": 1, "a": "x"}, "markers", "P, Q", "v1").first()
    assert (r["title"], r["window_s"], r["config_json"], r["n_dropped"], r["version"]) == ("T", 60, '{"a": "x", "b": 1}', 3, "v1")


def test_drop_and_metadata(spark):
    df = spark.createDataFrame([(1, 2)], "a_x int, b int")
    assert merge.drop_matching(df, ["^a_"]).columns == ["b"]
    facts = spark.createDataFrame([("t", "f", "v")], "title string, field string, value string")
    assert merge.merge_metadata([facts, facts]).count() == 1


def test_bins_by_name_then_position_then_package(spark):
    columns = spark.createDataFrame([(t, f"{t}{i}", i) for t in ("a", "b", "c", "d") for i in (0, 1)], "tag string, name string, pos int")
    headers = spark.createDataFrame([("a", "a1", 0, 1.0), ("b", "x", 0, 2.0), ("b", "y", 1, 3.0), ("c", "z", 0, 4.0)], "tag string, name string, pos int, centre double")
    packaged = spark.createDataFrame([("c", 0, 5.0), ("c", 1, 6.0)], "tag string, pos int, centre double")
    got = {r["name"]: r["centre"] for r in spectra.match_bins(columns, headers, packaged).collect()}
    assert got == {"a0": None, "a1": 1.0, "b0": 2.0, "b1": 3.0, "c0": 5.0, "c1": 6.0, "d0": None, "d1": None}
