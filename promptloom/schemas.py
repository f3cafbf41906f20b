"""Row shapes shared by the operators. Nothing here is inferred from data."""

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

ARTICLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("article", T.StringType())])

INSTRUCTION = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

PROMPT_RESPONSE = T.StructType(
    [T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType())]
)

GENERATION = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

COMPLETION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("object", T.StringType()),
        T.StructField("created", T.LongType()),
        T.StructField("model", T.StringType()),
        T.StructField(
            "choices",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("index", T.IntegerType()),
                        T.StructField("message", MESSAGE),
                        T.StructField("finish_reason", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "usage",
            T.StructType(
                [
                    T.StructField("prompt_tokens", T.LongType()),
                    T.StructField("completion_tokens", T.LongType()),
                    T.StructField("total_tokens", T.LongType()),
                ]
            ),
        ),
    ]
)

CHAT_REQUEST = T.StructType(
    [
        T.StructField("messages", MESSAGES),
        T.StructField("enable_safety_filter", T.BooleanType()),
        T.StructField("enable_pii_filter", T.BooleanType()),
        T.StructField("chat_endpoint", T.StringType()),
        T.StructField("filter_endpoint", T.StringType()),
        T.StructField("unsafe_categories", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("max_tokens", T.LongType()),
    ]
)
