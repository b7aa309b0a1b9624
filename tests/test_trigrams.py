import pytest

from snapline.operators import trigrams as G
from snapline.operators.grid import grid_search
from snapline.plans.snapshot import read_snapshot, search_snapshot, write_snapshot


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("indexed"))
    df = spark.range(4000).selectExpr(
        "id", "concat('Name', lpad(id, 6, '0')) AS name", "if(id % 500 = 7, 'Straße Ünïcode', null) AS place", "id * 0.5D AS half",
        "if(id = 3999, 'zz', 'ab') AS short",
    )
    df.repartitionByRange(8, "id").write.parquet(f"{top}/data")
    G.write_index(spark, f"{top}/data", f"{top}/index")
    return spark.read.parquet(f"{top}/data"), spark.read.parquet(f"{top}/index")


TERMS = ["Name000123", "name003999", "e00012_", "%name00%9", "straße", "ÜNÏ", "1999.5", "zz", "ab", "nothing like it", "a_b%c", "", "  ", "%%%", "x%nothing%y", "\\", "006000"]


@pytest.mark.parametrize("term", TERMS)
def test_same_rows_as_the_search_of_all_files(indexed, rows, term):
    data, index = indexed
    assert rows(G.indexed_search(data, index, term)) == rows(grid_search(data, term))


def test_files_that_cannot_hold_the_term_are_not_opened(indexed):
    data, index = indexed
    every = data.inputFiles()
    assert len(every) == 8
    assert 1 <= len(G.files_for(index, every, "Name000123")) < 8  # digits share trigrams
    assert G.files_for(index, every, "nothing like it") == [] and len(G.files_for(index, every, "zz")) == 8
    assert len(G.indexed_search(data, index, "name003999").inputFiles()) < 4
    # One that the index does not know is read.
    assert G.files_for(index, [*every, "file:/new.parquet"], "nothing like it") == ["file:/new.parquet"]


def test_wildcards_fall_back_to_their_longest_literal():
    assert [G.literal_of(t) for t in (" AbC ", "ab%cdef_g", "%_", "x")] == ["abc", "cdef", "", "x"]


def test_a_full_bitmap_leaves_out_nothing(spark, indexed, rows):
    data, _ = indexed
    index = G.file_trigrams(data, bits=64)
    assert rows(G.indexed_search(data, index, "Name000123", bits=64)) == rows(grid_search(data, "Name000123"))


def test_the_index_is_folded_before_the_exchange(indexed):
    plan = G.file_trigrams(indexed[0])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and plan.count("Exchange hashpartitioning") == 1


def test_snapshots_with_an_index(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    df = spark.range(300).selectExpr("id", "concat('row ', id) AS t")
    write_snapshot(df, path)
    assert search_snapshot(spark, path, "row 29").count() == 11
    write_snapshot(df.repartitionByRange(5, "id"), path, search_index=True)
    found = search_snapshot(spark, path, "row 29")
    assert rows(found) == rows(grid_search(read_snapshot(spark, path), "row 29")) and len(found.inputFiles()) < 5


