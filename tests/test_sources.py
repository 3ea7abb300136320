"""Source edge cases on small hand-written files: line endings, per-file
header order, absent columns, quoted UNSW headers, zip member choice."""

import os
import zipfile

from flowlens.sources.csv_sources import read_cicflow_csv, read_unsw_csv
from flowlens.sources.files import dataset_files, list_files
from flowlens.sources.zip_source import read_zip_csv


def _local(path):
    return path[5:] if path.startswith("file:") else path


def _write(path, text, newline="\n"):
    path = _local(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text.replace("\n", newline))
    return path


def test_cicflow_header_order_and_line_endings(spark, workdir):
    d = f"{workdir}/CIC-IDS-2017"
    _write(f"{d}/a.csv", " Source IP, Destination Port, Label, SYN Flag Count\n"
           "10.0.0.1,80,BENIGN,0\n10.0.0.2,,DDoS,Infinity\n10.0.0.7\n", newline="\r\n")
    _write(f"{d}/b.csv", "Label,Source IP,Flow Bytes/s\nPortScan,10.0.0.3,NaN\n\"\",10.0.0.4, 12.5\n"
           '"Web Attack ""XSS""",10.0.0.5,"1,5"\nback\\slash,10.0.0.6,1\n')
    files = list_files(spark, d, (".csv",))
    assert [os.path.basename(f) for f in files] == ["a.csv", "b.csv"]
    rows = {r.src_ip: r for r in read_cicflow_csv(spark, files).collect()}
    assert rows["10.0.0.1"].label == "BENIGN" and rows["10.0.0.1"].dst_port == "80"
    assert rows["10.0.0.1"].syn_flag_count == "0"
    assert rows["10.0.0.2"].dst_port == "" and rows["10.0.0.2"].syn_flag_count is None
    assert rows["10.0.0.3"].label == "PortScan" and rows["10.0.0.3"].flow_bytes_s is None
    assert rows["10.0.0.3"].dst_port is None  # b.csv has no destination port column
    assert rows["10.0.0.4"].label == "" and rows["10.0.0.4"].flow_bytes_s == " 12.5"
    assert rows["10.0.0.5"].label == 'Web Attack "XSS"' and rows["10.0.0.5"].flow_bytes_s == "1,5"
    assert rows["10.0.0.6"].label == "back\\slash"
    # a short row: its missing cells are '' as pandas reads them
    assert (rows["10.0.0.7"].dst_port, rows["10.0.0.7"].label) == ("", "")


def test_unsw_quoted_header_and_skip(spark, workdir):
    from flowlens.schemas import UNSW_COLUMNS

    d = f"{workdir}/UNSW-NB15"
    header = ",".join(f'"{c}"' for c in UNSW_COLUMNS)
    row = ["0"] * 49
    row[0], row[1], row[47], row[48] = "10.1.1.1", "1234", "", "1"
    _write(f"{d}/UNSW-NB15_1.csv", header + "\n" + ",".join(row) + "\n")
    row2 = list(row)
    row2[0], row2[47] = "10.1.1.2", " Fuzzers"
    _write(f"{d}/UNSW-NB15_2.csv", ",".join(row2) + "\n", newline="\r\n")
    _write(f"{d}/NUSW-NB15_GT.csv", "Start time,Attack category\n1,Fuzzers\n")
    files = dataset_files(spark, workdir)["unsw"]
    assert [os.path.basename(f) for f in files] == ["UNSW-NB15_1.csv", "UNSW-NB15_2.csv"]
    rows = {r.src_ip: r for r in read_unsw_csv(spark, files).collect()}
    assert len(rows) == 2
    assert rows["10.1.1.1"].label == "1" and rows["10.1.1.1"].src_port == "1234"
    assert rows["10.1.1.2"].label == " Fuzzers"
    assert rows["10.1.1.2"].syn_flag_count is None


def test_zip_first_csv_member(spark, workdir):
    d = _local(f"{workdir}/CIC-IDS-2017")
    os.makedirs(d, exist_ok=True)
    with zipfile.ZipFile(f"{d}/MachineLearningCSV.zip", "w") as zf:
        zf.writestr("notes/readme.txt", "not a table\n")
        zf.writestr("first.csv", " Source IP, Label\r\n10.2.2.2,Bot\r\n10.2.2.3,\r\n10.2.2.4\r\n")
        zf.writestr("second.csv", " Source IP, Label\n10.9.9.9,Ignored\n")
    files = list_files(spark, d, (".zip",))
    rows = sorted((r.src_ip, r.label, r.dst_port) for r in read_zip_csv(spark, files).collect())
    assert rows == [("10.2.2.2", "Bot", None), ("10.2.2.3", "", None), ("10.2.2.4", "", None)]


def test_first_lines(spark, workdir):
    """Whole header lines, however long, in one job."""
    from flowlens.sources import files as F_

    d = f"{workdir}/heads"
    long = "srcip," + "x" * (1 << 20) + ",end"
    paths = ["file:" + _write(f"{d}/{n}.csv", t, newline=nl) for n, t, nl in (
        ("a", " Source IP, Label\n1,2\n", "\r\n"), ("b", "", "\n"), ("c", "srcip,sport\n", "\n"), ("d", long + "\n1\n", "\n"))]
    assert F_.first_lines(spark, paths) == dict(zip(paths, [" Source IP, Label", "", "srcip,sport", long]))


def test_plain_and_zipped_rows_agree(spark, workdir):
    """Blank lines, line breaks and quotes in cells, and cells beyond 131,072
    characters read the same from a CSV file and from a zip."""
    body = (' Source IP, Flow ID, Label\n10.0.0.1,x,Bot\n\n10.0.0.2,"a\nb",DoS\n  \n10.0.0.3,"say ""hi""\n\nthere",""\n'
            + "10.0.0.4," + "z" * 200_000 + ",DDoS\n10.0.0.5,y,\n\n")
    d = _local(f"{workdir}/both")
    plain = _write(f"{d}/flows.csv", body)
    with zipfile.ZipFile(f"{d}/flows.zip", "w") as zf:
        zf.writestr("flows.csv", body)
    a = sorted((r.src_ip, r.label) for r in read_cicflow_csv(spark, [plain]).collect())
    b = sorted((r.src_ip, r.label) for r in read_zip_csv(spark, [f"{d}/flows.zip"]).collect())
    assert a == b == [("10.0.0.1", "Bot"), ("10.0.0.2", "DoS"), ("10.0.0.3", ""), ("10.0.0.4", "DDoS"), ("10.0.0.5", "")]


def test_files_without_line_breaks_in_cells_are_split(spark, workdir):
    """Only a file that needs it goes by way of its quotes; Spark splits the other."""
    d = _local(f"{workdir}/mixed")
    files = [_write(f"{d}/a.csv", " Source IP, Label\n1,Bot\n"), _write(f"{d}/b.csv", ' Source IP, Label\n2,"a\nb"\n')]
    df = read_cicflow_csv(spark, files)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.src_ip, r.label) for r in df.collect()) == [("1", "Bot"), ("2", "a\nb")]
    assert plan.count("FileScan csv") == 1 and plan.count("MapInArrow") == 1


def test_headerless_files_are_one_group(spark, workdir):
    d = _local(f"{workdir}/unsw")
    files = [_write(f"{d}/UNSW-NB15_{i}.csv", ",".join([f"10.0.0.{i}"] + ["0"] * 48) + "\n") for i in range(4)]
    df = read_unsw_csv(spark, files, multi_line=False)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert df.count() == 4
