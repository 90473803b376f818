"""Row shapes of the inputs and outputs."""

from pyspark.sql import types as T

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

# Optional columns a prompt carries along for reward functions (fixed values).
METADATA_COLUMNS = (
    "answer_key",
    "reference_solution",
    "options",
    "original_user_content",
    "source_file",
)

CHAT_EXAMPLE = T.StructType(
    [
        T.StructField("messages", MESSAGES),
        T.StructField("answer_key", T.StringType()),
        T.StructField("reference_solution", T.StringType()),
        T.StructField("options", T.ArrayType(T.StringType())),
        T.StructField("original_user_content", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("completion", T.StringType()),
    ]
)

JUDGE_RESULT = T.StructType(
    [
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("reasons", T.MapType(T.StringType(), T.StringType())),
        T.StructField("id", T.LongType()),
        T.StructField("overall", T.DoubleType()),
    ]
)

SUMMARY = T.StructType(
    [
        T.StructField("category_means", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("overall_mean", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("suggestions", T.ArrayType(T.StringType())),
        T.StructField("algorithm_choices", T.ArrayType(T.StringType())),
        T.StructField("next_algorithm", T.StringType()),
        T.StructField("next_algorithm_index", T.IntegerType()),
        T.StructField("decision_reason", T.StringType()),
    ]
)
