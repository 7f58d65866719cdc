from wardlake.operators import profiling
from wardlake.sources import ndjson


def sources(spark, folder, write_gz):
    write_gz(
        f"{folder}/MimicObservationLabevents.ndjson.gz",
        [
            {
                "id": "o1",
                "resourceType": "Observation",
                "meta": {"profile": ["http://p/obs"]},
                "subject": {"reference": "Patient/1"},
                "encounter": {"reference": "Encounter/1"},
                "effectiveDateTime": "2180-01-01",
            },
            {"id": "", "resourceType": "Observation", "meta": {"profile": []}},
            {"id": "o3", "subject": "Patient/1", "issued": "2180", "extra": False},
        ],
    )
    write_gz(f"{folder}/MimicPatient.ndjson.gz", [{"id": "p", "resourceType": "Patient"}])
    write_gz(f"{folder}/Empty.ndjson.gz", [])
    files = ndjson.source_files(spark, folder)
    lines = ndjson.scan_lines(spark, folder)
    return profiling.file_profiles(ndjson.scan_resources(lines)), files


def test_inventory_takes_type_and_profile_of_the_first_row(spark, folder, write_gz):
    profiles, files = sources(spark, folder, write_gz)
    inventory = profiling.resource_inventory(profiles, files)
    rows = {r.resource_family: r for r in inventory.collect()}
    labs = rows["MimicObservationLabevents"]
    assert (labs.resource_type, labs.profile_url, labs.row_count) == (
        "Observation",
        "http://p/obs",
        3,
    )
    assert (rows["Empty"].resource_type, rows["Empty"].row_count) == (None, 0)
    totals = profiling.inventory_totals(inventory).first()
    assert (totals.total_files, totals.total_resources) == (3, 4)
    summary = profiling.resource_type_summary(inventory).collect()
    assert [tuple(r) for r in summary] == [
        ("Observation", 1, 3),
        ("Patient", 1, 1),
        ("Unknown", 1, 0),
    ]
    top = profiling.largest_files(inventory, 2).collect()
    assert [r.row_count for r in top] == [3, 1]


def test_schema_profile_counts_present_fields(spark, folder, write_gz):
    profiles, files = sources(spark, folder, write_gz)
    rows = {
        r.resource_family: r
        for r in profiling.schema_profile(profiles, files).collect()
    }
    labs = rows["MimicObservationLabevents"]
    assert labs.sampled_rows == 3
    assert labs.top_level_keys == sorted(
        "id resourceType meta subject encounter effectiveDateTime issued extra".split()
    )
    assert labs.has_id == 2
    assert labs.has_meta_profile == 1
    assert labs.has_subject_reference == 1
    assert labs.has_encounter_reference == 1
    assert (labs.has_effectivedatetime, labs.has_issued, labs.has_authoredon) == (1, 1, 0)
    assert rows["Empty"].sampled_rows == 0 and rows["Empty"].top_level_keys == []


def test_sample_stops_at_the_limit(spark, folder, write_gz):
    profiles, files = sources(spark, folder, write_gz)
    first = profiling.sampled(ndjson.numbered_resources(spark, folder), 1)
    profiles = profiling.file_profiles(first)
    rows = profiling.schema_profile(profiles, files).collect()
    labs = next(r for r in rows if r.resource_family == "MimicObservationLabevents")
    assert labs.sampled_rows == 1
    assert "extra" not in labs.top_level_keys


def test_core_signals(spark, folder, write_gz):
    profiles, files = sources(spark, folder, write_gz)
    profile = profiling.schema_profile(profiles, files)
    rows = {r.source_file: r for r in profiling.core_schema_signals(profile).collect()}
    assert set(rows) == {
        "MimicObservationLabevents.ndjson.gz",
        "MimicPatient.ndjson.gz",
    }
    labs = rows["MimicObservationLabevents.ndjson.gz"]
    assert (labs.subject_refs, labs.encounter_refs, labs.timestamp_fields) == (1, 1, 2)


def test_many_shapes_fold_to_one_map(spark, folder, write_gz):
    keys = [f"k{i}" for i in range(12)]
    rows = [{k: 1 for j, k in enumerate(keys) if n >> j & 1} for n in range(1, 1 << 12)]
    write_gz(f"{folder}/A.ndjson.gz", [*rows, {}])
    lines = ndjson.scan_lines(spark, folder)
    row = profiling.file_profiles(ndjson.scan_resources(lines)).first()
    assert row["key_counts"] == dict.fromkeys(keys, 1 << 11)
    assert row["top_level_keys"] == sorted(keys) and row["row_count"] == 1 << 12
