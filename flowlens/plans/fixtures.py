"""Dataset-shaped files written from ``events`` for the source checks.

Spark makes the CSV lines; each executor task writes its own partition as one
CSV (or zip) file with a chosen header and file name, streaming Arrow batches
of lines to the file system that the folder lies on, so the rows never pass
through the driver; only the list of written files does.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.sources.files import open_output, text_bytes
from flowlens.schemas import CICFLOW_COLUMN_MAP, UNSW_COLUMN_MAP, UNSW_COLUMNS

# Header layouts of the fixture files. Layout A is CICIDS-like (leading
# spaces, extra columns); layout B has another order and no SYN column.
CIC_HEADER_A = [" Flow ID", " Source IP", " Source Port", " Destination IP", " Destination Port",
                " Protocol", " Timestamp", " Flow Duration", " Total Fwd Packets",
                " Total Backward Packets", "Flow Bytes/s", " Flow Packets/s", " SYN Flag Count",
                " Label"]
CIC_HEADER_B = ["Label", "Flow Packets/s", "Flow Bytes/s", "Total Backward Packets",
                "Total Fwd Packets", "Flow Duration", "Protocol", "Destination Port",
                "Destination IP", "Source Port", "Source IP", "Flow ID"]


def write_files(df: DataFrame, directory: str, prefix: str, header: list[str] | None,
                zipped: bool = False, blank_lines: bool = True) -> list[str]:
    """Write ``df`` (text columns, in file column order) as one CSV file
    ``{prefix}{i}.csv`` a partition (or ``.zip`` holding a text member and
    then the CSV) under ``directory``, which is a qualified path. Files end
    with a blank line and one of blanks, which are no rows. Returns the
    written paths."""
    directory = directory.rstrip("/")

    def write(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        path = f"{directory}/{prefix}{TaskContext.get().partitionId()}.{'zip' if zipped else 'csv'}"
        with open_output(path) as out:
            archive = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED) if zipped else None
            if archive:
                archive.writestr("README.txt", "fixture\n")
            member = archive.open("flows.csv", "w", force_zip64=True) if archive else out
            rows = 0
            if header is not None:
                text = io.StringIO(newline="")
                csv.writer(text, lineterminator="\n").writerow(header)
                member.write(text.getvalue().encode())
            for batch in batches:
                rows += batch.num_rows
                member.write(text_bytes(batch.column(0)))
            if blank_lines:
                member.write(b"\n  \n")
            if archive:
                member.close()
                archive.close()
        yield pa.RecordBatch.from_pydict({"path": [path], "rows": [rows]})

    return sorted(r["path"] for r in csv_lines(df).mapInArrow(write, "path string, rows long").collect())


def csv_lines(df: DataFrame) -> DataFrame:
    """Text columns as CSV lines with their line feed, as Python's ``csv.writer``
    writes them: a cell with a comma, quote or line break is quoted, NULL is empty.
    Cells are looked at one by one only where the line holds such a character."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in df.columns]
    special = lambda x: reduce(or_, [F.contains(x, F.lit(c)) for c in ',"\n\r'])
    quoted = F.transform(F.array(*cells), lambda x: F.when(special(x), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
    plain = F.col("__plain")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    as_it_is = (commas == len(cells) - 1) & ~reduce(or_, [F.contains(plain, F.lit(c)) for c in '"\n\r'])
    line = F.when(as_it_is, plain).otherwise(F.concat_ws(",", quoted))
    if len(cells) == 1:  # else the row would be a blank line
        line = F.when(plain == "", F.lit('""')).otherwise(line)
    return df.withColumn("__plain", F.concat_ws(",", *cells)).select(F.concat(line, F.lit("\n")).alias("line"))


def _filler(text: str):
    """A cell that no flow field comes from; some hold a line break, a few are
    longer than 131,072 characters."""
    return (F.when(F.col("src_port") == "1500", F.repeat(F.lit(text), 140_000))
            .when(F.col("produced_at_ts") % 7 == 0, F.lit(f'{text}"\n{text}')).otherwise(F.lit(text)))


def cic_layout(raw: DataFrame, header: list[str]) -> DataFrame:
    """Raw messages in CICFlowMeter columns of ``header`` (text cells)."""
    fields = [CICFLOW_COLUMN_MAP.get(h.strip()) for h in header]
    return raw.select(*[(F.col(f) if f else _filler("x")).alias(f"c{i}") for i, f in enumerate(fields)])


def unsw_layout(raw: DataFrame) -> DataFrame:
    """Raw messages in the 49 UNSW columns; ``label`` is the 0/1 column."""
    out = []
    for name in UNSW_COLUMNS:
        field = "binary_label" if name == "label" else UNSW_COLUMN_MAP.get(name)
        out.append(F.col(field) if field else _filler("0") if name == "service" else F.lit("0"))
    return raw.select(*[c.alias(f"c{i}") for i, c in enumerate(out)])
