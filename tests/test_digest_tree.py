from waybill.functions import digests


def test_trees_name_the_days_that_differ(spark, ts):
    make = lambda rows: spark.createDataFrame(rows, "id int, t timestamp, v string")
    base = [(1, ts(day=1), "a"), (2, ts(day=1), "b"), (3, ts(day=2), None), (4, None, "u"), (5, ts(day=31), "z")]
    tree = digests.digest_tree(make(base), "t")
    assert {(r.level, r.label, r.n_rows) for r in tree.collect()} == {
        ("day", "2024-01-01", 2), ("day", "2024-01-02", 1), ("day", "2024-01-31", 1), ("day", "undated", 1),
        ("month", "2024-01", 4), ("month", "undated", 1), ("year", "2024", 4), ("year", "undated", 1),
    }
    told = lambda rows: {(r.label, r.change, r.rows_before, r.rows_after) for r in digests.changed_days(tree, digests.digest_tree(make(rows), "t")).collect()}
    assert told(base[::-1]) == set()
    assert told([*base[:1], (2, ts(day=1), "c"), base[3], base[4], (9, ts(day=3), "n"), (10, None, "u")]) == {
        ("2024-01-01", "changed", 2, 2), ("2024-01-02", "removed", 1, None), ("2024-01-03", "added", None, 1), ("undated", "changed", 1, 2),
    }
    assert told([]) == {("2024-01-01", "removed", 2, None), ("2024-01-02", "removed", 1, None), ("2024-01-31", "removed", 1, None), ("undated", "removed", 1, None)}
