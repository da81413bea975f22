"""Landing files of the driver's tables: whole, compressed, bounded."""

from glob import glob

from checks import registry
from checks.adapters import Tables


def test_landing_files_are_compressed_and_hold_so_many_records_at_most(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(registry.LANDED, "maxRecordsPerFile", 50)
    t = Tables(spark, "/root/testdata/sf0.001")
    registry.landing(t, str(tmp_path), ["adt_events"])
    files = glob(f"{tmp_path}/landing/adt_events/part-*")
    counts = [spark.read.json(f).count() for f in files]
    assert all(f.endswith(".json.gz") for f in files) and max(counts) <= 50
    assert sum(counts) == t.adt_raw.count()
