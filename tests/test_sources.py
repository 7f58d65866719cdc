import gzip

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from wardlake.sources import bronze, ndjson, staging, tables


def lines_of(spark, folder):
    return ndjson.scan_lines(spark, folder)


def test_discovery_lists_only_gzip_ndjson(spark, folder, write_gz):
    write_gz(f"{folder}/B.ndjson.gz", [{"id": "1"}])
    write_gz(f"{folder}/A.ndjson.gz", [{"id": "2"}])
    open(f"{folder}/notes.txt", "w").write("x")
    rows = ndjson.source_files(spark, folder).orderBy("source_file").collect()
    assert [(r.source_file, r.resource_family) for r in rows] == [
        ("A.ndjson.gz", "A"),
        ("B.ndjson.gz", "B"),
    ]
    assert all(r.size_bytes > 0 for r in rows)


def test_missing_directory_is_an_error(spark, folder):
    with pytest.raises(AnalysisException):
        ndjson.source_files(spark, f"{folder}/absent")
    with pytest.raises(AnalysisException):
        lines_of(spark, f"{folder}/absent")


def test_empty_directory_has_no_rows(spark, folder):
    assert lines_of(spark, folder).count() == 0
    assert ndjson.source_files(spark, folder).count() == 0


def test_shard_numbers_are_not_part_of_the_family(spark, folder, write_gz):
    families = {
        "MimicPatient.part-7": "MimicPatient",
        "MimicPatient.part-1234567": "MimicPatient",
        "Ward-12345": "Ward-12345",
        "Ward-12345.part-0": "Ward-12345",
        "Beds": "Beds",
    }
    for name in families:
        write_gz(f"{folder}/{name}.ndjson.gz", [{"id": "1"}])
    rows = ndjson.source_files(spark, folder).collect()
    names = [f"{name}.ndjson.gz" for name in families]
    assert [r.source_file for r in rows] == sorted(names)
    assert [r.resource_family for r in rows] == [
        families[name.removesuffix(".ndjson.gz")] for name in sorted(names)
    ]


BAD_LINES = [
    ({"id": "1"}, None),
    ("{broken", "malformed_json"),
    ("   ", None),
    ('["list"]', "not_an_object"),
    ("5", "not_an_object"),
    ('{"a":1} tail', "malformed_json"),
    ('{"a":1}{"b":2}', "malformed_json"),
    ('{"a":1},{"b":2}', "malformed_json"),
    ('  {"a":1}  ', None),
    ("{}", None),
    ('{"a":01}', "malformed_json"),
]


def test_rejects_carry_file_and_physical_line(spark, folder, write_gz):
    write_gz(f"{folder}/Good.ndjson.gz", [{"id": str(i)} for i in range(50)])
    write_gz(f"{folder}/Mixed.ndjson.gz", [line for line, _ in BAD_LINES])
    rows = ndjson.scan_rejects(lines_of(spark, folder)).orderBy("line_number").collect()
    expected = [(n, why) for n, (_, why) in enumerate(BAD_LINES, start=1) if why]
    assert [(r.line_number, r.reason) for r in rows] == expected
    assert {r.source_file for r in rows} == {"Mixed.ndjson.gz"}
    kept = ndjson.scan_resources(lines_of(spark, folder))
    assert kept.count() == 50 + 3


def test_bad_line_fails_with_its_place(spark, folder, write_gz):
    write_gz(f"{folder}/A.ndjson.gz", [{"id": "1"}, "{broken"])
    with pytest.raises(ndjson.SourceReadError, match="Invalid JSON in A.ndjson.gz at line 2"):
        ndjson.fail_on_rejects(lines_of(spark, folder))
    write_gz(f"{folder}/A.ndjson.gz", [{"id": "1"}, "", "[1]"])
    with pytest.raises(ndjson.SourceReadError, match="Expected JSON object .* line 3"):
        ndjson.fail_on_rejects(lines_of(spark, folder))


def test_positions_count_resources_per_file_when_files_share_a_task(spark, folder, write_gz):
    sizes = {f"F{i}.ndjson.gz": 3 + 7 * i for i in range(30)}
    for name, size in sizes.items():
        items = []
        for i in range(size):
            items.append({"n": i + 1})
            if i % 3 == 0:
                items.append("  ")
        write_gz(f"{folder}/{name}", items)
    rows = ndjson.numbered_resources(spark, folder).collect()
    assert len(rows) == sum(sizes.values())
    for row in rows:
        assert row.value == f'{{"n": {row.position}}}'
        assert row.row_count == sizes[row.source_file]


def run_bronze(spark, folder, **options):
    return bronze.write_bronze(
        spark, folder, f"{folder}-out", "demo", "1.0", "2024-01-01", **options
    )


def test_bronze_rows_and_counts(spark, folder, write_gz):
    profile = {"profile": ["http://p/1", "http://p/2"]}
    write_gz(
        f"{folder}/MimicPatient.ndjson.gz",
        [{"resourceType": "Patient", "id": "p1", "meta": profile}, {"id": 7}],
    )
    write_gz(f"{folder}/MimicEncounter.ndjson.gz", [{"resourceType": "Encounter"}])
    done = run_bronze(spark, folder)
    assert (done.total_rows, done.rejected_rows) == (3, 0)
    out = bronze.read_bronze(spark, f"{folder}-out")
    assert out.columns == list(bronze.BRONZE_COLUMNS)
    assert {f.dataType.simpleString() for f in out.schema.fields} == {"string"}
    by_id = {r.resource_id: r for r in out.collect()}
    assert by_id["p1"].resource_type == "Patient"
    assert by_id["p1"].profile_url == "http://p/1"
    assert by_id["p1"].resource_family == "MimicPatient"
    assert by_id["7"].resource_type is None and by_id["7"].profile_url is None
    assert by_id[None].resource_type == "Encounter"
    assert by_id["p1"].source_dataset_name == "demo"


def test_bronze_part_size(spark, folder, write_gz):
    items = [{"resourceType": "Patient", "id": str(i)} for i in range(25)]
    write_gz(f"{folder}/P.ndjson.gz", items)
    run_bronze(spark, folder, max_records_per_file=10)
    files = bronze.written_files(spark, f"{folder}-out").count()
    assert files == 3


def test_bad_line_modes(spark, folder, write_gz):
    write_gz(f"{folder}/P.ndjson.gz", [{"resourceType": "Patient"}, "{broken"])
    with pytest.raises(ndjson.SourceReadError, match="P.ndjson.gz at line 2"):
        run_bronze(spark, folder)
    done = run_bronze(
        spark, folder, on_bad_line="quarantine", rejects_path=f"{folder}-bad"
    )
    assert (done.total_rows, done.rejected_rows) == (1, 1)
    assert spark.read.parquet(f"{folder}-bad").first()["line_number"] == 2
    with pytest.raises(ValueError, match="Unknown bad-line mode"):
        run_bronze(spark, folder, on_bad_line="ignore")


def test_bronze_is_rebalanced_by_type(spark, folder, write_gz):
    """Few files per type however the sources are cut, and all rows in them."""
    kinds = ["Patient", "Encounter", "Observation"]
    for i in range(20):
        rows = [{"resourceType": kinds[n % 3], "id": f"{i}-{n}"} for n in range(60)]
        write_gz(f"{folder}/F{i}.ndjson.gz", rows)
    done = run_bronze(spark, folder)
    assert done.total_rows == 1200
    assert bronze.written_files(spark, f"{folder}-out").count() <= 2 * len(kinds)


def test_manifest_comparison(spark, folder):
    manifest = spark.createDataFrame(
        [("A", 2, 3), ("B", 1, 3), ("Empty", 0, 3)],
        "source_file string, expected_rows bigint, total_rows bigint",
    )
    rows = spark.createDataFrame([("A",), ("A",), ("C",)], "source_file string")
    found = bronze.bronze_mismatches(manifest, rows).collect()
    assert {r.source_file for r in found} == {"B", "C", "Empty"}
    lenient = bronze.bronze_mismatches(manifest, rows, empty_files_fail=False).collect()
    assert {r.source_file for r in lenient} == {"B", "C"}


def test_canonical_json(spark):
    frame = spark.createDataFrame([('{"b": 1, "a": {"z": "é", "y": [1, 2]}}',)], "v string")
    found = frame.select(bronze.canonical_json(frame.v)).first()[0]
    assert found == '{"a":{"y":[1,2],"z":"\\u00e9"},"b":1}'


def test_table_name_is_quoted():
    assert tables.table_name("c", "s", "t") == "`c`.`s`.`t`"
    assert tables.table_name("c", "s", "t`x") == "`c`.`s`.`t``x`"


def test_empty_table_keeps_its_schema(spark, folder):
    from wardlake.plans.registry import silver_table

    empty = spark.createDataFrame([], silver_table("patient").schema)
    assert tables.write_silver(empty, folder, "patient") == 0
    assert tables.read_silver(spark, folder, "patient").columns == list(
        silver_table("patient").columns
    )
    assert spark.read.parquet(f"{folder}/patient").schema == silver_table("patient").schema


def test_unregistered_names_are_rejected(spark, folder):
    empty = spark.range(0)
    with pytest.raises(ValueError, match="Unsupported Silver table"):
        tables.write_silver(empty, folder, "nothing")
    with pytest.raises(ValueError, match="Unsupported Gold table"):
        tables.write_gold(empty, folder, "nothing")


def test_unicode_source_text(spark, folder):
    with gzip.open(f"{folder}/U.ndjson.gz", "wt", encoding="utf-8") as out:
        out.write('{"id":"ü"}\r\n')
    assert lines_of(spark, folder).first()["value"] == '{"id":"ü"}'


def test_payload_digest_is_that_of_the_source_lines(spark, folder, write_gz):
    import gzip

    write_gz(f"{folder}/P.ndjson.gz", [{"resourceType": "Patient", "id": str(i)} for i in range(9)])
    run_bronze(spark, folder)
    with gzip.open(f"{folder}/P.ndjson.gz", "rt") as file:
        lines = [(line.rstrip("\n"),) for line in file]
    source = spark.createDataFrame(lines, "value string")
    digest = bronze.payload_digest
    expected = source.agg(digest(F.xxhash64("value"))).first()[0]
    stored = bronze.read_bronze(spark, f"{folder}-out")
    assert stored.agg(digest(F.xxhash64("raw_json"))).first()[0] == expected


def test_interrupted_publication_is_undone(spark, folder):
    from wardlake.sources.staging import exists, replacing, undo_unfinished

    path = f"{folder}/t"
    spark.range(3).write.parquet(f"{path}-previous")  # as if it had ended between
    undo_unfinished(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert not exists(spark, f"{path}-previous")
    with pytest.raises(ZeroDivisionError):
        with replacing(spark, path) as ready:
            spark.range(5).write.parquet(ready)
            1 / 0
    assert spark.read.parquet(path).count() == 3 and not exists(spark, ready)
    with replacing(spark, path) as ready:
        spark.range(5).write.parquet(ready)
    assert spark.read.parquet(path).count() == 5


def test_large_sources_are_landed_without_a_shuffle(spark, folder, write_gz, monkeypatch):
    """Files of some size are written by the task that reads them, neither dealt out anew
    nor sorted, and all rows are in Bronze."""
    kinds = ["Patient", "Encounter", "Observation"]
    for i in range(20):
        rows = [{"resourceType": kinds[n % 3], "id": f"{i}-{n}"} for n in range(60)]
        write_gz(f"{folder}/F{i}.ndjson.gz", rows)
    monkeypatch.setattr(bronze, "LARGE_FILE", 1)
    seen = []
    write = DataFrameWriter.parquet

    def written(writer, path, *args, **kwargs):
        plan = writer._df._jdf.queryExecution().optimizedPlan().toString()
        seen.append((plan, spark.conf.get(staging.OPEN_WRITERS)))
        return write(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    before = spark.conf.get(staging.OPEN_WRITERS)
    done = run_bronze(spark, folder)
    assert spark.conf.get(staging.OPEN_WRITERS) == before
    assert "Rebalance" not in seen[0][0] and int(seen[0][1]) > 0
    out = bronze.read_bronze(spark, f"{folder}-out")
    counts = {r["resource_type"]: r["count"] for r in out.groupBy("resource_type").count().collect()}
    assert done.total_rows == 1200 and counts == {kind: 400 for kind in kinds}
