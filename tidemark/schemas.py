"""Declared schemas: raw inputs are typed on read, outputs have a fixed contract."""

from pyspark.sql import types as T

RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("registration_date", T.DateType()),
    ]
)

# sale_date stays text on read: bad date text must become a null date, not a
# rejected file, so it is parsed with try_to_date in clean_sales.
RAW_SALES = T.StructType(
    [
        T.StructField("sale_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("amount", T.DecimalType(28, 10)),
        T.StructField("sale_date", T.StringType()),
    ]
)

# Output contract of the customer job: (name, Spark SQL type), in order.
PROCESSED_CUSTOMER_COLUMNS = (
    ("customer_id", "string"),
    ("full_name", "string"),
    ("email", "string"),
    ("email_domain", "string"),
    ("phone", "string"),
    ("age", "int"),
    ("age_group", "string"),
    ("city", "string"),
    ("state", "string"),
    ("registration_year", "int"),
    ("processed_timestamp", "timestamp"),
    ("data_source", "string"),
    ("etl_job_name", "string"),
)

# File-arrival notification: Records[].s3.{bucket.name, object.key}
MANIFEST = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField(
                                        "bucket", T.StructType([T.StructField("name", T.StringType())])
                                    ),
                                    T.StructField(
                                        "object", T.StructType([T.StructField("key", T.StringType())])
                                    ),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

# Bus event: one wide struct covering file, schedule and job-state events.
BUS_EVENT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("detail-type", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("resources", T.ArrayType(T.StringType())),
        T.StructField(
            "detail",
            T.StructType(
                [
                    T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
                    T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
                    T.StructField("jobName", T.StringType()),
                    T.StructField("jobRunId", T.StringType()),
                    T.StructField("state", T.StringType()),
                ]
            ),
        ),
    ]
)

JOB_RUNS = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("job_run_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("started_on", T.TimestampNTZType()),
        T.StructField("execution_time_seconds", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

PIPELINE_EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
    ]
)
