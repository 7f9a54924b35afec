"""Explicit schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("lin", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("s2", T.LongType()),
        T.StructField("change_types", T.ArrayType(T.StringType())),
    ]
)

NESTED_INDEX_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("path", T.StringType()),
                    T.StructField("lin", T.LongType()),
                    T.StructField("file_type", T.StringType()),
                    T.StructField("change_types", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField(
                        "snapshots", T.StructType([T.StructField("s2", T.LongType())])
                    )
                ]
            ),
        ),
    ]
)

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("app", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("snapshot", T.LongType()),
    ]
)

DATASET_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("predicate", T.StringType()),
    ]
)
