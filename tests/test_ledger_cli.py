"""The ledger of ingested files, and the command line's jobs."""

import os

import pytest

from flowlens import cli
from flowlens.sources.files import sort_dataset_files
from flowlens.streaming.ingest_files import start_ingest
from tests.test_sources import _local, _write


def test_sort_dataset_files():
    d = "file:/data"
    names = ["CIC-IDS-2017/a.csv", "CIC-IDS-2017/b.ZIP", "CIC-IDS-2017/x/c.csv", "UNSW-NB15/UNSW-NB15_1.csv", "UNSW-NB15/NUSW-NB15_GT.csv",
             "UNSW-NB15/UNSW-NB15_2.zip", "CIC-DDoS2019/01-12/d.csv", "CIC-DDoS2019/e.csv", "other/f.csv"]
    found = sort_dataset_files([f"{d}/{n}" for n in names])
    assert {k: [os.path.basename(p) for p in v] for k, v in found.items()} == {
        "cicids": ["a.csv", "b.ZIP"], "unsw": ["UNSW-NB15_1.csv"], "cicdos": ["d.csv"]}


def test_each_file_is_published_once(spark, workdir):
    data, out = f"{workdir}/data", f"{workdir}/out"

    def ingest():
        q = start_ingest(spark, data, f"{workdir}/ck", fmt="json", path=out, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        rows = spark.read.schema("key string, value string, topic string").json(out).select("key", "topic").collect()
        return sorted(map(tuple, rows))

    _write(f"{data}/CIC-IDS-2017/a.csv", " Source IP, Label\n1.1.1.1,Bot\n")
    assert ingest() == [("1.1.1.1", "raw-cicids")]
    late = _write(f"{data}/CIC-IDS-2017/b.csv", 'Label,Source IP\n"x\ny",2.2.2.2\n')  # its own column order
    os.utime(_local(late), (1_000_000_000, 1_000_000_000))  # copied with an old time
    _write(f"{data}/notes/readme.csv", "no,dataset\n1,2\n")
    both = [("1.1.1.1", "raw-cicids"), ("2.2.2.2", "raw-cicids")]
    assert ingest() == both
    assert ingest() == both


class _Query:
    def __init__(self, error=None, lives=10 ** 9):
        self.error, self.lives, self.stopped = error, lives, False

    @property
    def isActive(self):  # noqa: N802
        return self.lives > 0 and not self.stopped

    def awaitTermination(self, timeout=None):  # noqa: N802
        self.lives -= 1
        if not self.isActive and self.error:
            raise self.error

    def stop(self):
        self.stopped = True


def test_a_failed_query_ends_the_job():
    table, follower = _Query(), _Query(error=ValueError("lost"), lives=0)
    with pytest.raises(ValueError, match="lost"):
        cli.wait_for_all([table, follower])
    assert table.stopped
    done = [_Query(lives=2), _Query(lives=0)]
    cli.wait_for_all(done)
    assert not any(q.isActive for q in done)
