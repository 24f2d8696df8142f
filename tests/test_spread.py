import checks.queries as queries


def test_landed_files_grow_with_the_rows_not_a_fixed_count(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 10)
    rows = spark.range(200)
    assert queries._spread(rows).rdd.getNumPartitions() == 20
    assert queries._spread(rows.limit(30)).rdd.getNumPartitions() == queries.FILES
    assert queries._spread(rows.limit(30), 3).rdd.getNumPartitions() == 3
