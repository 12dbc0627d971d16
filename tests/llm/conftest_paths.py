SF_SMOKE = "/root/testdata/sf0.001"


def documents_of(spark, sf):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
