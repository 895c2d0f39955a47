"""Explicit schemas of the entities; stored tables are read with them."""

from pyspark.sql import types as T

RATING = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("weight", T.LongType(), False),
    T.StructField("score", T.DoubleType(), True),
])

CATALOG_ITEM = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
])

ITEM_VECTOR = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("v", T.ArrayType(T.DoubleType()), True),
])

SIMILARITY = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("nb_mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), True),
])

CLICK = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("ts", T.LongType(), False),
])

REJECT = T.StructType([
    T.StructField("line", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
])
