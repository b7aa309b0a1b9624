import glob
import json

import pytest
from pyspark.sql import functions as F

from snapline.operators.export import csv_lines, write_csv
from snapline.operators.profile import column_profile, numeric_columns, validate_report
from snapline.operators.protect import decrypt_columns, encrypt_columns, key_from_file, mask
from snapline.plans.run import PipelineSpec, run_pipeline, run_sample
from snapline.plans.snapshot import (
    ContractError, Rules, mark_stale, prune_versions, read_manifest, read_snapshot, snapshot_views, table_counts, write_snapshot,
)
from snapline.sources import files
from snapline.sources.readers import SourceSpec, jdbc_options, read_source


@pytest.fixture
def key(spark, tmp_path):
    (tmp_path / "key.bin").write_bytes(bytes(range(32)))
    return key_from_file(spark, str(tmp_path / "key.bin"))


def test_snapshot_roundtrip_and_manifest(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(1000).selectExpr("id", "string(id) AS name", "timestamp_ntz'2024-01-01 00:00:00' AS at")
    manifest = write_snapshot(df.orderBy("name"), path, sources={"raw": spark.range(7)}, source_versions={"pipeline": "p"})
    assert (manifest.row_count, manifest.status, manifest.encrypted) == (1000, "ok", False)
    assert manifest.generated_at.endswith("+05:00")
    assert manifest.columns == [
        {"name": "id", "type": "bigint"}, {"name": "name", "type": "string"}, {"name": "at", "type": "timestamp_ntz"}
    ]
    assert manifest.source_tables_info == [{"name": "raw", "row_count": 7}]
    assert read_manifest(spark, path) == manifest
    assert read_snapshot(spark, path).exceptAll(df).isEmpty()
    assert glob.glob(f"{path}/versions/*/data/*.zstd.parquet")
    frames = snapshot_views(spark, path)
    assert spark.sql("SELECT count(*) FROM data, raw").first()[0] == 7000
    assert {tuple(r) for r in table_counts(frames).collect()} == {("data", 1000), ("raw", 7)}


def test_empty_snapshots_are_published(spark, tmp_path, seed):
    """The count arrives even where the optimizer replaces the plan by nothing."""
    table = spark.read.parquet(seed)
    empty = {"folded": table.where("false"), "limit": table.limit(0), "filter": table.where("id < 0"),
             "sorted": table.where("id < 0").orderBy("id"), "joined": table.where("id < 0").join(table, "id").orderBy("id")}
    for name, df in empty.items():
        path = str(tmp_path / name)
        assert write_snapshot(df, path, sources={"s": df}).source_tables_info == [{"name": "s", "row_count": 0}]
        assert read_snapshot(spark, path).count() == 0


def test_a_source_that_fails_is_left_out_and_one_that_vanished_is_skipped(spark, tmp_path):
    path = str(tmp_path / "s")
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    manifest = write_snapshot(spark.range(3), path, sources={"broken": broken, "good": spark.range(1)})
    assert manifest.source_tables == ["good"]
    manifest.source_tables.append("gone")
    files.replace_text(spark, f"{path}/manifest.json", manifest.to_json())
    assert set(snapshot_views(spark, path)) == {"data", "good"}


def _spec(rows, rules=Rules(), **extra):
    shape = lambda df: df.selectExpr(f"explode(sequence(1, {rows})) AS id", "'p' AS platform", "'5' AS cnt")
    return PipelineSpec("p", (SourceSpec("one", "parquet", extra.pop("location"), shape=shape),), rules=rules, **extra)


@pytest.fixture
def seed(spark, tmp_path):
    location = str(tmp_path / "seed")
    spark.range(1).write.parquet(location)
    return location


def test_failed_build_keeps_the_last_good_snapshot(spark, tmp_path, seed):
    path = str(tmp_path / "s")
    good = run_pipeline(spark, _spec(5, Rules(("id",), 1, 5), location=seed), path)
    assert (good.status, good.row_count) == ("ok", 5)
    for spec in (
        _spec(6, Rules(("id",), 1, 5), location=seed),
        _spec(5, Rules(("nope",)), location=seed),
        _spec(5, Rules(min_rows=6), location=seed),
        _spec(5, location=seed + "-missing"),
        PipelineSpec("p", (), rules=Rules()),
    ):
        stale = run_pipeline(spark, spec, path)
        assert stale.status == "stale" and stale.error and stale.stale_at
        assert (stale.generated_at, stale.version) == (good.generated_at, good.version)
        assert stale.state != good.state
        assert read_snapshot(spark, path).count() == 5
    again = run_pipeline(spark, _spec(4, location=seed), path)
    assert again.status == "ok" and again.error is None and read_snapshot(spark, path).count() == 4
    assert json.loads((tmp_path / "s" / "manifest.json").read_text())["row_count"] == 4


def test_stale_without_a_snapshot(spark, tmp_path):
    manifest = mark_stale(spark, str(tmp_path / "none"), "why")
    assert (manifest.row_count, manifest.columns, manifest.error) == (0, [], "why")


def test_assembly_needs_a_known_driver(spark, tmp_path, seed):
    source = SourceSpec("one", "parquet", seed)
    for driver in (None, "other"):
        spec = PipelineSpec("p", (source,), driver=driver, assemble=lambda f: f["one"])
        assert "driver" in run_pipeline(spark, spec, str(tmp_path / "s")).error
    keyed = SourceSpec("two", "parquet", seed, keys=("id", "nope"))
    spec = PipelineSpec("p", (source, keyed), driver="one", assemble=lambda f: f["two"])
    assert "nope" in run_pipeline(spark, spec, str(tmp_path / "s")).error


def test_sources_with_keys_are_restricted(spark, tmp_path, seed):
    wide = str(tmp_path / "wide")
    spark.range(10).selectExpr("double(id) AS k", "id AS v").write.parquet(wide)
    spec = PipelineSpec(
        "p", (SourceSpec("d", "parquet", seed), SourceSpec("w", "parquet", wide, keys=("k", "id"))),
        driver="d", assemble=lambda f: f["w"], export=lambda f: f,
    )
    manifest = run_pipeline(spark, spec, str(tmp_path / "s"))
    assert manifest.row_count == 1
    assert manifest.source_tables_info == [{"name": "d", "row_count": 1}, {"name": "w", "row_count": 1}]


def test_sample_build(spark, tmp_path):
    catalogue = spark.createDataFrame([("P", "m", 3), ("P", "n", 4)], "platform string, metrics string, seed int")
    manifest = run_sample(spark, catalogue, str(tmp_path / "s"), "2024-03-01", 10)
    assert manifest.row_count == 20 and [c["name"] for c in manifest.columns] == ["platform", "metrics", "entry_date", "cnt"]


def test_encrypted_build(spark, tmp_path, seed, key):
    path = str(tmp_path / "s")
    spec = _spec(3, location=seed, encrypt=("platform", "cnt"), export=lambda f: f)
    assert "key" in run_pipeline(spark, spec, path).error
    manifest = run_pipeline(spark, spec, path, key)
    assert manifest.encrypted and manifest.encrypted_columns["data"] == {"platform": "string", "cnt": "bigint"}
    assert dict(read_snapshot(spark, path).dtypes)["platform"] == "binary"
    clear = read_snapshot(spark, path, key)
    assert [tuple(r) for r in clear.orderBy("id").collect()] == [(i, "p", 5) for i in (1, 2, 3)]
    assert dict(snapshot_views(spark, path, key)["one"].dtypes)["cnt"] == "string"


def test_prune_keeps_the_current_version(spark, tmp_path):
    path = str(tmp_path / "s")
    versions = [write_snapshot(spark.range(i), path).version for i in range(1, 5)]
    prune_versions(spark, path, keep=2)
    kept = {p.name for p in (tmp_path / "s" / "versions").iterdir()}
    assert len(kept) in (2, 3) and versions[-1] in kept
    assert read_snapshot(spark, path).count() == 4


def test_cell_layout_and_wrong_key(spark, tmp_path, key):
    df = spark.createDataFrame([("abc",), (None,)], "s string")
    closed = encrypt_columns(df, ["s"], key)
    cells = [r.s for r in closed.collect()]
    assert len(cells[0]) == 12 + 3 + 16 and cells[1] is None
    assert closed.first().s != closed.first().s
    (tmp_path / "other.bin").write_bytes(bytes(32))
    other = key_from_file(spark, str(tmp_path / "other.bin"))
    assert decrypt_columns(closed, ["s"], other, strict=False).first().s is None
    with pytest.raises(Exception, match="AES|Tag|mismatch"):
        decrypt_columns(closed, ["s"], other).collect()
    assert "000102030405" not in closed._jdf.queryExecution().toString().lower()


def test_mask(spark, key):
    df = spark.createDataFrame([("a", "b", "c", 1)], "x string, y string, z string, n int")
    masked = mask(df, {"x": "drop", "y": "hash", "z": "encrypt"}, key)
    assert masked.columns == ["y", "z", "n"] and len(masked.first().y) == 64 and dict(masked.dtypes)["z"] == "binary"
    with pytest.raises(ValueError):
        mask(df, {"x": "blur"})
    with pytest.raises(ValueError):
        mask(df, {"x": "encrypt"})


def test_csv_dialect(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'c"d', None, "e;f", "g\nh", "plain")], "a string, b string, `c;c` string, d string, e string, f string")
    assert csv_lines(df).first().value == '"a,b";"c""d";;"e;f";"g\nh";plain'
    path = str(tmp_path / "csv")
    write_csv(df.repartition(1), path)
    (part,) = glob.glob(f"{path}/part-*")
    text = open(part, "rb").read().decode("utf-8")
    assert text == '\ufeffa;b;"c;c";d;e;f\n"a,b";"c""d";;"e;f";"g\nh";plain\n'


def test_every_csv_file_has_one_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.range(100).repartition(3).sortWithinPartitions("id"), path)
    parts = [open(p, "rb").read().decode("utf-8") for p in glob.glob(f"{path}/part-*")]
    assert len(parts) == 3 and all(p.startswith("\ufeffid\n") and p.count("id") == 1 for p in parts)
    assert sorted(int(line) for p in parts for line in p.split("\n")[1:-1]) == list(range(100))


def test_empty_csv_still_has_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.range(0), path, bom=False)
    assert "".join(open(p).read() for p in glob.glob(f"{path}/part-*")) == "id\n"


def test_validate_report(spark):
    df = spark.range(3)
    report = {r.rule: (r.passed, r["value"]) for r in validate_report(df, ["id", "x", "y"], 0, 2).collect()}
    assert report == {"expected_columns": (False, "x,y"), "min_rows": (True, "3"), "max_rows": (False, "3")}
    empty = {r.rule: r.passed for r in validate_report(spark.range(0), ["id"], 1).collect()}
    assert empty == {"expected_columns": True, "min_rows": False}
    assert all(r.passed for r in validate_report(spark.range(0), ["id"], 0).collect())
    with pytest.raises(ContractError):
        Rules(max_rows=2).check_rows(3)


def test_column_profile_and_numeric_columns(spark):
    df = spark.createDataFrame(
        [(1, "", None, 1.0), (2, "12.5", "a", None), (3, "x", "1", 1.0)], "id int, t string, u string, n double"
    )
    expected = {("id", "int", 0, 3), ("t", "string", 0, 3), ("u", "string", 1, 2), ("n", "double", 1, 1)}
    assert {tuple(r)[1:] for r in column_profile(df).collect()} == expected
    assert {tuple(r)[1:] for r in column_profile(df, approximate=True).collect()} == expected
    flags = {r.column_name: r.is_numeric for r in numeric_columns(df, ["id"]).collect()}
    assert flags == {"id": True, "t": True, "u": False, "n": True}


def test_relational_options():
    spec = SourceSpec("s", "jdbc", "SELECT 1 AS x;", {"url": "jdbc:postgresql://h/d"}, one_task=True)
    assert jdbc_options(spec) == {"fetchsize": "10000", "url": "jdbc:postgresql://h/d", "dbtable": "(SELECT 1 AS x) q"}
    assert jdbc_options(SourceSpec("s", "jdbc", "a.b", {"url": "u"}, predicates=("x = 1",)))["dbtable"] == "a.b"
    with pytest.raises(ValueError):
        jdbc_options(SourceSpec("s", "jdbc", "a.b", {"url": "u", "numPartitions": "4"}))
    with pytest.raises(ValueError):
        jdbc_options(SourceSpec("s", "jdbc", "a.b"))


def test_table_source(spark):
    spark.range(4).createOrReplaceTempView("warehouse_table")
    assert read_source(spark, SourceSpec("s", "table", "warehouse_table")).count() == 4


def test_a_relation_is_not_read_by_one_task_unasked():
    with pytest.raises(ValueError, match="one task"):
        jdbc_options(SourceSpec("s", "jdbc", "a.b", {"url": "u"}))


def test_unreadable_source_files_are_left_out(spark, tmp_path):
    torn = tmp_path / "torn"
    spark.range(5).write.parquet(str(torn))
    broken = spark.read.schema("id long").parquet(str(torn))
    for part in torn.glob("*.parquet"):
        part.write_bytes(b"no parquet")
    path = str(tmp_path / "s")
    manifest = write_snapshot(spark.range(3), path, sources={"broken": broken, "good": spark.range(1)})
    assert manifest.source_tables == ["good"]
    assert files.children(spark, f"{path}/versions/{manifest.version}/sources") == ["good"]


def test_failed_versions_leave_nothing_and_pruning_counts_published_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    good = [write_snapshot(spark.range(n), path).version for n in (1, 2)]
    for _ in range(2):
        with pytest.raises(ContractError):
            write_snapshot(spark.range(1), path, rules=Rules(min_rows=5))
    assert sorted(files.children(spark, f"{path}/versions")) == sorted(good)
    (tmp_path / "s" / "versions" / "99990101T000000-crashed").mkdir()
    assert prune_versions(spark, path, keep=2) == ["99990101T000000-crashed"]
    assert read_manifest(spark, path).published == good
    third = write_snapshot(spark.range(3), path).version
    assert prune_versions(spark, path, keep=2) == [good[0]]
    assert read_manifest(spark, path).published == [good[1], third] and read_snapshot(spark, path).count() == 3


def test_builds_keep_as_many_versions_as_asked(spark, tmp_path, seed):
    path = str(tmp_path / "s")
    for rows in (1, 2, 3, 4):
        manifest = run_pipeline(spark, _spec(rows, location=seed), path, keep=2)
    assert files.children(spark, f"{path}/versions") == sorted(manifest.published) and len(manifest.published) == 2


def test_data_is_built_from_the_written_sources(spark, tmp_path):
    seen = {}

    def build(written):
        seen.update(written)
        return written["one"].join(written["two"], "id")

    path = str(tmp_path / "s")
    write_snapshot(build, path, sources={"one": spark.range(5), "two": spark.range(3, 9)}, spark=spark)
    assert all("versions" in df.inputFiles()[0] for df in seen.values())
    assert read_snapshot(spark, path).count() == 2
