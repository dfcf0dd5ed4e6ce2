from collections import Counter

from quillstream.operators import profile


def rows_with_hot_group(spark):
    """A third of the rows share one text; nulls and near copies are mixed in."""
    rows = []
    for i in range(300):
        if i % 3 == 0:
            text, label = "hot text", 0
        elif i % 10 == 1:
            text, label = None, i % 2
        else:
            text, label = f"text {i % 70}", None if i % 11 == 0 else i % 2
        rows.append((f"{i:04d}", text, label, i))
    return rows, spark.createDataFrame(rows, "id string, text string, label int, extra int").repartition(7)


def test_duplicate_groups_against_brute_force(spark):
    rows, df = rows_with_hot_group(spark)
    want = {k: n for k, n in Counter((t, c) for _, t, c, _ in rows).items() if n > 1}
    got = {(r.text, r.label): r["count"] for r in
           profile.duplicate_groups(df, ["text", "label"]).collect()}
    assert got == want
    total = profile.duplicate_total(df, ["text", "label"]).first()[0]
    assert total == sum(want.values())


def test_duplicate_groups_without_a_broadcast(spark, monkeypatch):
    rows, df = rows_with_hot_group(spark)
    want = sorted(map(str, profile.duplicate_groups(df, ["text", "label"]).collect()))
    monkeypatch.setattr(profile, "MAX_HASHES", 0)
    got = profile.duplicate_groups(df, ["text", "label"])
    assert sorted(map(str, got.collect())) == want
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_duplicate_total_without_duplicates(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    assert profile.duplicate_total(df, ["text"]).first()[0] == 0


def test_drop_duplicates_keeps_lowest_id_with_its_row(spark):
    rows, df = rows_with_hot_group(spark)
    want = {}
    for row in sorted(rows):
        want.setdefault((row[1], row[2]), row)
    kept = profile.drop_duplicates(df, ["text", "label"], "id")
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want.values(), key=str)
    again = profile.drop_duplicates(kept, ["text", "label"], "id")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(want.values(), key=str)


def test_drop_duplicates_without_a_broadcast_and_without_shuffled_unique_rows(spark, monkeypatch):
    _, df = rows_with_hot_group(spark)
    kept = profile.drop_duplicates(df, ["text", "label"], "id")
    wanted = sorted(map(str, kept.collect()))
    # The side of the unique texts is a filter on the scan; only the other one is grouped.
    unique, repeated = kept._jdf.queryExecution().optimizedPlan().children().apply(0), kept._jdf.queryExecution().optimizedPlan().children().apply(1)
    assert "LeftAnti" in unique.toString() and "Aggregate" not in unique.toString()
    assert "LeftSemi" in repeated.toString() and "Aggregate" in repeated.toString()
    monkeypatch.setattr(profile, "MAX_HASHES", 0)
    assert sorted(map(str, profile.drop_duplicates(df, ["text", "label"], "id").collect())) == wanted


def test_drop_duplicates_merges_redelivered_ids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b")], "id long, text string")
    got = profile.drop_duplicates(df, ["text"], "id").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (3, "b")]


def test_drop_nulls_and_classes(spark):
    rows, df = rows_with_hot_group(spark)
    assert profile.drop_nulls(df, ["text", "label"]).count() == sum(
        t is not None and c is not None for _, t, c, _ in rows)
    share = {r.label: (r.n, r.percent) for r in profile.class_share(df).collect()}
    ones = sum(c == 1 for _, _, c, _ in rows)
    assert share[1] == (ones, 100.0 * ones / len(rows))
    assert profile.of_class(df, 1).count() == ones


def test_class_share_of_nothing(spark):
    df = spark.createDataFrame([], "label int")
    assert [(r.n, r.percent) for r in profile.class_share(df).collect()] == [(0, None), (0, None)]


def test_describe_equals_builtin(spark):
    _, df = rows_with_hot_group(spark)
    mine = profile.describe(df, ["extra"]).first()
    builtin = {r.summary: r.extra for r in df.describe("extra").collect()}
    assert mine.n == int(builtin["count"])
    assert abs(mine.mean - float(builtin["mean"])) < 1e-9
    assert abs(mine.stddev - float(builtin["stddev"])) < 1e-9
    assert (mine.min, mine.max) == (float(builtin["min"]), float(builtin["max"]))
