from lodestrata.sources.partitioned import PartitionedTable


def rows(spark, given):
    return spark.createDataFrame(given, "k string, n int")


def test_versions_touch_only_their_parts(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "k string, n int", ("k",), parts=8)
    assert table.read().count() == 0 and table.current() == {}
    names = [f"k{i}" for i in range(40)]
    first = rows(spark, [(k, 1) for k in names])
    table.replace(first, first, ("k",))
    assert sorted(map(tuple, table.read().collect())) == sorted((k, 1) for k in names)
    before = table.current()
    table.replace(rows(spark, [("k3", 2)]), rows(spark, [("k3", 0)]), ("k",))
    after = table.current()
    assert sum(after[p] != before[p] for p in before) == 1
    assert {r["k"]: r["n"] for r in table.read().collect()} == {k: 2 if k == "k3" else 1 for k in names}
    again = PartitionedTable(spark, str(tmp_path / "t"), "k string, n int", ("k",), parts=64)
    assert again.parts == 8 and again.read().count() == 40  # the first write settled the parts


def test_unfinished_versions_do_not_count(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "k string, n int", ("k",), parts=2)
    one = rows(spark, [("a", 1), ("b", 1)])
    table.replace(one, one, ("k",))
    (tmp_path / "t" / "v=1" / "part=0").mkdir(parents=True)  # a write that failed before its last file
    (tmp_path / "t" / "v=1" / "part=0" / "x.parquet").write_bytes(b"broken")
    assert table.read().count() == 2 and set(table.versions()) == {0}
    gone = rows(spark, [("a", 0), ("b", 0)])
    table.replace(rows(spark, []), gone, ("k",))  # written over the failed one
    assert set(table.versions()) == {0, 1} and table.read().count() == 0
    assert table.vacuum() >= 1 and table.read().count() == 0
