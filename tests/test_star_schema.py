from marquee.sources import star_schema as S


def test_a_catalog_or_audience_of_one_file_is_spread(spark, tmp_path):
    tables = {
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int",
                 [(i, "hot bolt", "Brand#1", "LARGE", i) for i in range(40)]),
        "customer": ("c_custkey long, c_nationkey int, c_mktsegment string", [(i, 0, "FURNITURE") for i in range(40)]),
        "nation": ("n_nationkey int, n_regionkey int", [(0, 0)]),
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows, key in ((S.items(spark, str(tmp_path)), "item_id"), (S.users(spark, str(tmp_path)), "user_id")):
        assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert rows.select(key).distinct().count() == rows.count() == 40
