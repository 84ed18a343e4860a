import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import booking, three_bookings
from roomtide import schema
from roomtide.config import CostConfig, load_config
from roomtide.sources import hashes, readers, writers


def write_csv(path, rows):
    lines = [",".join(schema.RAW_COLUMNS)]
    lines += [",".join("" if r[c] is None else str(r[c]) for c in schema.RAW_COLUMNS) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_reads_declared_types_and_missing_texts(spark, tmp_path):
    rows = [booking(country="NULL", agent="9.0", children="NA"), booking(company="", adr="n/a", lead_time="x")]
    found = readers.read_bookings_csv(spark, write_csv(tmp_path / "b.csv", rows)).collect()
    first, second = found
    assert (first.country, first.agent, first.children) == (None, 9, None)
    assert (second.company, second.adr, second.lead_time) == (None, None, None)
    assert str(first.reservation_status_date) == "2016-07-07"
    with pytest.raises(Exception):
        readers.read_bookings_csv(spark, str(tmp_path / "b.csv"), strict=True).collect()


def test_header_only(spark, tmp_path):
    assert readers.csv_columns(spark, write_csv(tmp_path / "h.csv", [])) == schema.RAW_COLUMNS


def test_checksum(spark, tmp_path):
    path = tmp_path / "f.txt"
    path.write_bytes(b"hello world")
    expected = hashlib.sha256(b"hello world").hexdigest()
    assert hashes.verify_checksum(spark, str(path), expected.upper()) == expected
    with pytest.raises(hashes.ChecksumMismatch):
        hashes.verify_checksum(spark, str(path), "0" * 64)


def test_fingerprint_ignores_order_and_partitions(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    same = hashes.fingerprint(rows).first()
    assert hashes.fingerprint(rows.orderBy(F.col("id").desc()).repartition(7)).first() == same
    assert hashes.fingerprint(rows.withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v")))).first() != same


def test_partitioned_sink_replaces_old_folders(spark, tmp_path):
    path = str(tmp_path / "weeks")
    rows = spark.range(20).select("id", (F.col("id") % 4).cast("int").alias("week"))
    writers.write_partitioned(rows, path, ["week"], ["id"])
    writers.write_partitioned(rows.filter("week < 2"), path, ["week"], ["id"])
    assert sorted(r.week for r in spark.read.parquet(path).select("week").distinct().collect()) == [0, 1]


def test_drift_documents_need_their_keys(spark, tmp_path):
    several = [f'{{"week": {week}, "retrain": true, "reasons": ["a"]}}' for week in range(3, 8)]
    (tmp_path / "good.json").write_text("\n".join(several))
    (tmp_path / "bad.json").write_text('{"week": 3, "reasons": []}')
    good = readers.read_drift_results(spark, str(tmp_path / "good.json")).collect()
    assert [(r.week, r.retrain, r.reasons) for r in good] == [(week, True, ["a"]) for week in range(3, 8)]
    with pytest.raises(Exception, match="lacks retrain"):
        readers.read_drift_results(spark, str(tmp_path / "bad.json")).collect()


def test_config_files(tmp_path):
    text = 'capacity:\n  "A": 5\ndefault_k: 3.0\nmonte_carlo:\n  o_max_pct: 0.5\n'
    path = tmp_path / "c.yaml"
    path.write_text(text)
    config = load_config(str(path))
    assert (config.capacity_of("A"), config.capacity_of("B"), config.default_k, config.o_max_pct) == (5, 300, 3.0, 0.5)
    assert CostConfig().capacity_of("City Hotel") == 190


def test_typed_round_trip(spark, make_raw, tmp_path):
    raw = make_raw(three_bookings()).drop("seq")
    path = writers.write_table(raw, str(tmp_path / "out"), "csv")
    again = readers.read_bookings_csv(spark, path, strict=True)
    assert again.schema == raw.schema
    assert sorted(map(str, again.collect())) == sorted(map(str, raw.collect()))


def test_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("hotel,adults,babies\nX,2,0\nX,3,1\n")
    (tmp_path / "f" / "b.csv").write_text('babies,adults,hotel\n1,4,"Y, ""old"""\n')
    (tmp_path / "f" / "c.csv").write_text("hotel,meal\nZ,BB\n")
    rows = readers.read_csv_text(spark, str(tmp_path / "f"))
    assert set(rows.columns) == {"hotel", "adults", "babies", "meal"}
    found = {(r.hotel, r.adults, r.babies, r.meal) for r in rows.collect()}
    assert found == {("X", "2", "0", None), ("X", "3", "1", None), ('Y, "old"', "4", "1", None), ("Z", None, None, "BB")}


def test_corrupt_records_are_kept(spark, tmp_path):
    (tmp_path / "c.csv").write_text('a,b\n1,2\n3,4,5\n6\n"7,7",8\n')
    rows = readers.read_csv_text(spark, str(tmp_path / "c.csv"), corrupt=readers.CORRUPT).collect()
    assert [r[readers.CORRUPT] for r in rows] == [None, "3,4,5", "6", None]
    assert rows[3].a == "7,7"


def test_blank_text_is_a_value(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b\n   ,NA\n")
    found = readers.read_csv_text(spark, str(tmp_path / "d.csv")).first()
    assert (found.a, found.b) == ("   ", None)


def test_checksums_of_files_of_any_size(spark, tmp_path):
    data = bytes(range(256)) * 5000
    (tmp_path / "a b.bin").write_bytes(data)
    (tmp_path / "empty.bin").write_bytes(b"")
    with open(tmp_path / "huge.bin", "wb") as file:  # more than an array of Java holds; sparse, so it takes no disk
        file.truncate((2 << 30) + (64 << 20))
        file.seek(1 << 30)
        file.write(b"x")
    want = {}
    for name in ("a b.bin", "huge.bin"):  # Spark lists no empty file
        with open(tmp_path / name, "rb") as file:
            want[name] = hashlib.file_digest(file, "sha256").hexdigest()
    for whole in (hashes.WHOLE_BYTES, 0):
        got = {r.path.split("/")[-1]: (r.bytes, r.sha256) for r in hashes.file_checksums(spark, str(tmp_path), whole).collect()}
        assert got == {n: ((tmp_path / n).stat().st_size, h) for n, h in want.items()}
    blocks = hashes.block_digests(spark, str(tmp_path / "a*"), 1000_000).orderBy("block").collect()
    assert [(r.block, r.start, r.bytes) for r in blocks] == [(0, 0, 1_000_000), (1, 1_000_000, 280_000)]
    assert [r.sha256 for r in blocks] == [hashlib.sha256(data[:1_000_000]).hexdigest(), hashlib.sha256(data[1_000_000:]).hexdigest()]
    assert hashes.verify_checksum(spark, str(tmp_path / "huge.bin"), want["huge.bin"].upper()) == want["huge.bin"]


def test_headers_come_from_the_first_lines_only(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 50_000)
    (tmp_path / "b.csv").write_bytes(b"x,y\r\n3,4\r\n")
    (tmp_path / "c.csv").write_text("y,z")  # a header alone, without a line break
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv.gz").write_bytes(gzip.compress(b"z,x\n5,6\n"))
    wide = ",".join(f"column_{k}" for k in range(20_000))  # longer than a block
    (tmp_path / "f.csv").write_text(wide + "\n")
    found = {tuple(names): [f.rsplit("/", 1)[1] for f in files] for names, files in readers.csv_headers(spark, str(tmp_path))}
    assert found[("x", "y")] == ["a.csv", "b.csv"] and found[("y", "z")] == ["c.csv"] and found[("z", "x")] == ["e.csv.gz"]
    assert found[tuple(wide.split(","))] == ["f.csv"] and len(found) == 4
