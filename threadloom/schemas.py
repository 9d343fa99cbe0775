"""Fixed schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


ANSWER = _struct(
    ("user_name", T.StringType()),
    ("status", T.StringType()),
    ("rating", T.DoubleType()),
    ("text", T.StringType()),
)

THREAD = _struct(
    ("id", T.LongType()),
    ("title", T.StringType()),
    ("description", T.StringType()),
    ("answers", T.ArrayType(ANSWER)),
)

QA_RECORD = _struct(
    ("description", T.StringType()), ("answers_max", ANSWER), ("id", T.LongType())
)

PAYLOAD = _struct(
    ("id", T.LongType()),
    ("question", T.StringType()),
    ("answer", T.StringType()),
    ("rating", T.DoubleType()),
)

DENSE = T.ArrayType(T.FloatType())
SPARSE = T.MapType(T.StringType(), T.DoubleType())

POINT = T.StructType(
    PAYLOAD.fields + [T.StructField("dense", DENSE), T.StructField("text_sparse", SPARSE)]
)

ENCODED = _struct(("dense", DENSE), ("lexical", SPARSE))

SAMPLED_IDS = _struct(("points", T.LongType()), ("cat", T.StringType()))

MESSAGE = _struct(("role", T.StringType()), ("content", T.StringType()))
MESSAGES = T.ArrayType(MESSAGE)

VERDICT = _struct(
    ("russian_language", T.StringType()),
    ("matching_target_answer", T.StringType()),
    ("correctness", T.StringType()),
    ("score", T.IntegerType()),
)

ROLLOUT = _struct(
    ("group_id", T.LongType()),
    ("gen_no", T.LongType()),
    ("reward_name", T.StringType()),
    ("reward", T.DoubleType()),
)
