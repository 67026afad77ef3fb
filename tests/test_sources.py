import hashlib
import os
import random
import zipfile
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from panelwright.session import BROADCAST_ROWS, iterated, iterated_parts, new_folder, numbered, shared_folder, sized, stored
from panelwright.sources import codelist, landing, manifest, sinks
from panelwright.spec import labour_spec
from tests.fixtures import EDITS, raw_rows

SPEC = labour_spec()


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().analyzed().toString()


@pytest.fixture()
def landed(spark):
    """Two periods whose files differ in width, column order and how codes are rendered."""
    folder = new_folder(spark, "test-landing")
    first = raw_rows(spark, EDITS).drop("periodo_archivo")
    first.coalesce(1).write.option("header", True).csv(f"{folder}/2025T1")
    reordered = first.withColumn("EXTRA", F.lit("1")).select("EXTRA", *reversed(first.columns))
    reordered.coalesce(1).write.option("header", True).csv(f"{folder}/2025T4")
    typed = first.withColumn("P05C16", F.col("P05C16").cast("double")).withColumn("P02A03", F.expr("try_cast(P02A03 as double)"))
    typed.coalesce(1).write.parquet(f"{folder}/2026T1")
    return folder


def test_scan_is_by_name_whatever_the_layout(spark, landed):
    scanned = landing.scan_periods(spark, {p: f"{landed}/{p}" for p in ("2025T1", "2025T4")}, SPEC)
    assert scanned.columns == [*SPEC.source_columns, "archivo_origen", "periodo_archivo", "anio_archivo", "trimestre_calendario"]
    rows = {p: scanned.filter(F.col("periodo_archivo") == p).drop("archivo_origen", "periodo_archivo", "trimestre_calendario") for p in ("2025T1", "2025T4")}
    assert sorted(map(str, rows["2025T1"].collect())) == sorted(map(str, rows["2025T4"].collect()))
    assert {(r.anio_archivo, r.trimestre_calendario) for r in scanned.collect()} == {(2025, 1), (2025, 4)}
    assert all(t == "string" for c, t in scanned.dtypes if c in SPEC.source_columns)
    summary = landing.load_summary(scanned).collect()
    assert {(r.periodo_archivo, r.initial_rows) for r in summary} == {("2025T1", 10), ("2025T4", 10)}
    assert all(r.archivo_origen.endswith(".csv") for r in summary)
    assert landing.mixed_files(scanned).isEmpty()
    assert landing.width_of(spark, f"{landed}/2025T4") == 15


def test_numbers_and_text_become_the_same_codes(spark, landed):
    scanned = landing.scan_period(spark, f"{landed}/2026T1", "2026T1", SPEC, "parquet")
    row = scanned.filter("NUM_HOGAR = '1'").first()
    assert (row.P05C16, row.P02A03, row.anio_archivo) == ("1.0", "25.0", 2026)
    assert scanned.filter("NUM_HOGAR = '3'").first().P02A03 == "Infinity"


def test_missing_columns_are_listed(spark, landed):
    folder = new_folder(spark, "test-missing")
    spark.createDataFrame([("1",)], "ANIO string").write.option("header", True).csv(folder)
    with pytest.raises(ValueError, match="DOMINIO.*FACTOR"):
        landing.scan_period(spark, folder, "2025T1", SPEC)


def test_provenance_from_the_path(spark, landed):
    files = spark.read.schema(SPEC.schema).options(header=True).csv(f"{landed}/2025T1")
    row = landing.with_provenance(files).first()
    assert (row.periodo_archivo, row.anio_archivo, row.trimestre_calendario) == ("2025T1", 2025, 1)
    unlabelled = landing.with_provenance(files, r"(\d{9}X)")
    assert landing.mixed_files(unlabelled).count() == 1


def test_dimension_faults(spark):
    expected = spark.createDataFrame([("a", 5, 3), ("b", 5, 3), ("c", 1, 1)], "p string, rows int, columns int")
    observed = spark.createDataFrame([("a", 5, 3), ("b", 4, 3)], "p string, rows int, columns int")
    faults = landing.dimension_faults(observed, expected, ["p"]).collect()
    assert {(r.p, r.observed_rows) for r in faults} == {("b", 4), ("c", None)}


def test_fingerprints_of_all_files(spark, tmp_path):
    (tmp_path / "text.bin").write_bytes(b"x" * 1000)
    (tmp_path / "nothing.bin").write_bytes(b"")
    with zipfile.ZipFile(tmp_path / "book.zip", "w") as archive:
        archive.writestr("a", "b")
    for path in (tmp_path, tmp_path / "*"):
        found = {Path(r.path).name: r for r in manifest.fingerprints(spark, str(path)).collect()}
        assert set(found) == {"text.bin", "book.zip", "nothing.bin"}
        for name, row in found.items():
            content = (tmp_path / name).read_bytes()
            assert row.sha256 == hashlib.sha256(content).hexdigest() and row.bytes == len(content)
            assert row.is_zip == (name == "book.zip")


def test_fingerprint_of_a_file_that_no_row_can_hold(spark, tmp_path):
    """Files with holes, so they take no room on disk; the large one is beyond the 2 GiB of a byte array."""
    digests = {}
    for name, size in (("large.bin", 2**31 + 11), ("odd %41 #1?=[a].bin", 5000), ("three.bin", 3)):
        with open(tmp_path / name, "w+b") as file:
            file.truncate(size)
            file.write(b"PK\x03\x04"[:size])
            file.seek(size - 1)
            file.write(b"x")
            file.seek(0)
            digests[name] = size, hashlib.file_digest(file, "sha256").hexdigest(), size > 3
    found = manifest.fingerprints(spark, str(tmp_path)).collect()
    assert {Path(r.path).name: (r.bytes, r.sha256, r.is_zip) for r in found} == digests


def test_fingerprint_columns_taken_alone_and_filtered(spark, tmp_path):
    for k in range(20):
        (tmp_path / f"{k}.bin").write_bytes(b"PK\x03\x04" * (k % 2) + bytes([k]) * 70_000)
    files = manifest.fingerprints(spark, str(tmp_path))
    whole = {Path(r.path).name: r.sha256 for r in files.collect()}
    assert whole == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.iterdir()}
    assert {r.sha256 for r in files.filter("is_zip").select("sha256").collect()} == {whole[f"{k}.bin"] for k in range(1, 20, 2)}
    assert files.select("is_zip").filter("is_zip").count() == 10 and files.agg(F.sum("bytes")).first()[0] == 20 * 70_000 + 40


def test_merge_keeps_one_record_per_key(spark):
    columns = "p string, sha string, at string"
    fresh = spark.createDataFrame([("b", "2", "new"), ("a", "1", "new"), ("c", "3", "new")], columns)
    earlier = spark.createDataFrame([("a", "0", "1900"), ("a", "1", "1901"), ("b", "2", "1902"), ("b", "9", "1903")], columns)
    merged = manifest.merge_records(fresh, earlier, ["p"], "sha", "at").collect()
    assert [tuple(r) for r in merged] == [("a", "1", "1901"), ("b", "2", "new"), ("c", "3", "new")]


def test_manifest_scan_and_merge(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text("""{"esperado": {"2025T1": {"filas": 5, "columnas": 2}, "2025T2": {"filas": 7, "columnas": 2}, "2025T3": {"filas": 1, "columnas": 1}},
      "archivos": [{"periodo": "2025T1", "tipo": "personas", "archivo": "a", "filas_observadas": 5, "columnas_observadas": 2, "bytes": 3},
                   {"periodo": "2025T1", "tipo": "diccionario", "archivo": "d", "filas_observadas": 9, "columnas_observadas": 9, "encabezado_inicial": "x"},
                   {"periodo": "2025T2", "tipo": "personas", "archivo": "b", "filas_observadas": 6, "columnas_observadas": 2}]}""")
    document = manifest.read_manifest(spark, str(path))
    assert {r.periodo: r.consistent for r in manifest.self_consistency(document).collect()} == {
        "2025T1": True, "2025T2": False, "2025T3": False,
    }
    record = manifest.record_of(manifest.file_records(document), "2025T1", "diccionario").first()
    assert (record.archivo, record.encabezado_inicial) == ("d", "x")
    fresh = spark.createDataFrame([("p", "k", "1", "new"), ("q", "k", "2", "new"), ("r", "k", "3", "new")], "p string, k string, sha string, at string")
    earlier = spark.createDataFrame([("p", "k", "1", "old"), ("q", "k", "x", "old")], "p string, k string, sha string, at string")
    merged = manifest.merge_records(fresh, earlier, ["p", "k"], "sha", "at")
    assert {r.p: r["at"] for r in merged.collect()} == {"p": "old", "q": "new", "r": "new"}


SHEET = [
    (1, "V", "x", "old"), (2, "W", "1", "w"), (3, "V", "0", "NONE"), (4, None, "1.0", " PRIMARY "), (5, None, None, "n/a"),
    (6, None, "1", "LATER"), (7, "V", "2", None), (8, "Z", "9", "z"),
]


def test_code_list_takes_the_last_block(spark):
    rows = [("s1", *r) for r in SHEET[:6]] + [("s1", 7, "Z", "9", "z")] + [("s2", *r) for r in SHEET]
    sheet = spark.createDataFrame(rows, "sheet string, row_no int, c0 string, c1 string, c2 string")
    lists = codelist.code_lists(sheet, ["sheet"], ["V", "W"])
    assert {(r.sheet, r.variable, r.code, r.label) for r in lists.collect()} == {
        ("s1", "V", "0", "NONE"), ("s1", "V", "1", "LATER"),
    }
    # s2's last V block has no label, and W starts only once in both sheets.
    faults = {(r.sheet, r.variable, r.starts, r.codes) for r in codelist.incomplete(sheet, lists, ["sheet"], ["V", "W"]).collect()}
    assert faults == {("s1", "W", 1, 0), ("s2", "V", 3, 0), ("s2", "W", 1, 0)}


def test_code_lists_against_a_row_by_row_reading(spark):
    """Random sheets, read the way a person would: find the last block, walk it, let later rows win."""
    generator = random.Random(23)
    rows, expected = [], set()
    for sheet in range(150):
        cells = [
            (generator.choice([None, None, None, "V", " V ", "V.0", "W", ""]), generator.choice([None, "1", "1.0", " 2", "3.00"]),
             generator.choice([None, "x", " y ", ""]))
            for _ in range(generator.randrange(1, 14))
        ]
        rows += [(sheet, i, *c) for i, c in enumerate(cells)]

        def clean(text):
            text = "" if text is None else text.strip()
            return text[:-2] if text.endswith(".0") else text

        starts = [i for i, c in enumerate(cells) if clean(c[0]) == "V"]
        found = {}
        if len(starts) >= 2:
            for c0, c1, c2 in cells[starts[-1]:]:
                if c0 is not None and clean(c0) != "V":
                    break
                if c1 is not None and c2 is not None:
                    found[clean(c1)] = c2.strip()
        expected |= {(sheet, "V", code, label) for code, label in found.items()}
    frame = spark.createDataFrame(rows, "sheet int, row_no int, c0 string, c1 string, c2 string").repartition(5)
    lists = codelist.code_lists(frame, ["sheet"], ["V"])
    assert {tuple(r) for r in lists.collect()} == expected and len(expected) > 50


def test_layout_of_iterated_rows_follows_from_the_rows(spark, monkeypatch):
    monkeypatch.setattr("panelwright.session.PART_ROWS", 100)
    for parts in (1, 7):
        frame = iterated(spark.range(1000).repartition(parts), "test")
        assert frame.rdd.getNumPartitions() == 10 and frame.count() == 1000


def test_parts_of_iterated_rows_grow_slower_than_the_rows(spark, monkeypatch):
    assert [iterated_parts(n) for n in (0, 1, 10_000, 10_001, 335_663, 640_000)] == [1, 1, 1, 2, 34, 64]
    assert [iterated_parts(n) for n in (2_000_000, 12_000_000, 40_000_000, 10**12)] == [64, 64, 200, 4096]
    monkeypatch.setattr("panelwright.session.PART_ROWS", 1)
    frame = iterated(spark.range(1000), "test")
    assert frame.rdd.getNumPartitions() == 64 and frame.count() == 1000


def test_numbered_copies_are_smaller_than_stored_rows(spark):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda j: F.pmod(F.xxhash64("id", j), F.lit(997)).cast("string")))
    rows = spark.range(0, 400, 1, 2).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 40 != 0, words).alias("text"))

    def size(frame):
        return sum(os.path.getsize(urlparse(f).path) for f in frame.inputFiles())

    copy = numbered(rows.unionByName(rows), "test")
    plain = stored(copy, "test")
    assert copy.count() == copy.select("_place").distinct().count() == 800
    assert copy.exceptAll(plain).isEmpty() and plain.exceptAll(copy).isEmpty()
    assert sorted(map(str, copy.select("_row.*").collect())) == sorted(map(str, rows.unionByName(rows).collect()))
    assert size(copy) < 0.9 * size(plain)


def test_no_folder_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from panelwright import session

    monkeypatch.setattr(session, "_folder", [])
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    session.name_folder(bare)
    with pytest.raises(ValueError, match="shared by all executors"):
        shared_folder(bare)
    bare.sparkContext.master = "local-cluster[2,1,1024]"
    session.name_folder(bare)
    with pytest.raises(ValueError):
        shared_folder(bare)


def test_a_period_without_code_list_is_an_error(spark):
    from panelwright.operators.quality import CheckFailed
    from panelwright.operators.rules import judge
    from panelwright.plans import audit

    judged = judge(raw_rows(spark, EDITS).unionByName(raw_rows(spark, EDITS[:3], "2026T1")), SPEC)
    names = list(SPEC.recoded.values())
    lists = spark.createDataFrame([("2025T1", v, "0") for v in names], "period string, variable string, code string")
    with pytest.raises(CheckFailed, match="without a code list"):
        audit.prepare(judged, SPEC, lists)
    whole = lists.unionByName(lists.withColumn("period", F.lit("2026T1")))
    assert audit.prepare(judged, SPEC, whole).count() > 0


def test_write_and_read_back(spark):
    frame = raw_rows(spark, EDITS).unionByName(raw_rows(spark, EDITS[:3], "2026T1"))
    folder = new_folder(spark, "test-sink")
    assert sinks.write_table(frame, folder, SPEC.period) == 13
    again = sinks.read_back(spark, folder, frame, 13, SPEC.period)
    assert again.columns == frame.columns and sorted(map(str, again.collect())) == sorted(map(str, frame.collect()))
    pruned = again.filter("periodo_archivo = '2026T1'")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="13 rows"):
        sinks.read_back(spark, folder, frame, 12, SPEC.period)
    with pytest.raises(ValueError, match="schema"):
        sinks.read_back(spark, folder, frame.withColumn("ANIO", F.lit(1)), 13, SPEC.period)


def test_one_changed_cell_is_found(spark):
    schema = "k long, v double, t string, d date, p string"
    rows = [(k, k / 7 if k % 5 else None, f"t{k % 3}" if k % 4 else None, None, "xy"[k % 2]) for k in range(40)]
    frame = spark.createDataFrame([*rows, rows[0], rows[0]], schema)
    folder = new_folder(spark, "test-content")
    written = sinks.write_checked(frame, folder, "p", mixed=True)
    assert written.rows == 42 and written == sinks.contents(frame.repartition(7).orderBy("t"))
    assert sinks.read_back(spark, folder, frame, written, "p").count() == 42
    parts = [sinks.contents(frame.filter(F.col("p") == p)) for p in "xy"]
    assert parts[0] + parts[1] == written
    cells = {"k": F.col("k") + 1, "v": F.lit(None).cast("double"), "t": F.lit("t9"), "d": F.lit("2020-01-01").cast("date")}
    for column, value in cells.items():
        sinks.write_table(frame.withColumn(column, F.when(F.col("k") == 11, value).otherwise(F.col(column))), folder, "p")
        with pytest.raises(ValueError, match="content"):
            sinks.read_back(spark, folder, frame, written, "p")
    # As many rows, but one of three copies gave way to another row's copy.
    sinks.write_table(spark.createDataFrame([*rows, rows[0], rows[1]], schema), folder, "p")
    with pytest.raises(ValueError, match="content"):
        sinks.read_back(spark, folder, frame, written, "p")
    sinks.write_table(frame.limit(5), folder, "p")
    with pytest.raises(ValueError, match="42"):
        sinks.read_back(spark, folder, frame, written, "p")
    none = sinks.write_checked(frame.limit(0), new_folder(spark, "test-content"))
    assert none == sinks.Contents(0, (0, 0))


def test_broadcast_only_when_counted_small(spark):
    small, large = spark.range(10), spark.range(100)
    assert "broadcast" in plan_of(sized(small, "test", 10)).lower()
    assert "broadcast" not in plan_of(sized(large, "test", 10)).lower()
    assert sized(large, "test", 10).count() == 100 and BROADCAST_ROWS > 0


def test_recode_by_list_is_the_same_without_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("b", None)], "p string, c string")
    lists = spark.createDataFrame([("a", "V", "1"), ("b", "V", "2"), ("b", "V", "1"), ("a", "W", "2")], "period string, variable string, code string")

    def recoded():
        return sorted(tuple(r) for r in codelist.recode_by_list(rows, lists, "V", "c", {"p": "period"}, "U").collect())

    expected = [("a", "1"), ("a", "U"), ("b", "2"), ("b", "U")]
    assert recoded() == expected
    monkeypatch.setattr(codelist, "sized", lambda frame, label: sized(frame, label, 0))
    assert recoded() == expected


def test_shared_folder_is_the_configured_one(spark):
    assert new_folder(spark, "x").startswith(shared_folder(spark))
