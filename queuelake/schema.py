"""Message schema and fixed protocol values."""

from __future__ import annotations

from pyspark.sql import types as T

# IBM MQ message types (MQMT_*) and report options used on
# dead letters, as published in the IBM MQ constants reference.
MQMT_REQUEST = 1
MQMT_REPLY = 2
MQMT_REPORT = 4
MQMT_DATAGRAM = 8
REPORT_CONFIRM_ON_ARRIVAL = "COA"
REPORT_CONFIRM_ON_DELIVERY = "COD"

# Format names accepted by the ``fileFormat`` option.
FIXED_WIDTH_FORMAT = "FIXED_WIDTH"
JSON_FORMAT = "JSON"
XML_FORMAT = "XML"

# Fixed value: timestamp layout of archive names.
ARCHIVE_TS_FORMAT = "yyyyMMddHHmmss"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("msg_id", T.StringType()),
        T.StructField("msg_type", T.IntegerType()),
        T.StructField("correl_id", T.BinaryType()),
        T.StructField("group_id", T.StringType()),
        T.StructField("seg_offset", T.IntegerType()),
        T.StructField("last_segment", T.BooleanType()),
        # put time as UTC wall clock, the way a queue manager stamps it
        T.StructField("put_ts", T.TimestampNTZType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
MESSAGE_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]

# A message's place in a message group (see operators.groups).
GROUP_FIELDS = [
    T.StructField("msg_seq", T.IntegerType()),
    T.StructField("last_in_group", T.BooleanType()),
]

# Queue-log partition columns (see sources.queue_log).
LOG_PARTITION_FIELDS = [
    T.StructField("producer", T.StringType()),
    T.StructField("seq", T.LongType()),
]
LOG_SCHEMA = T.StructType(MESSAGE_SCHEMA.fields + LOG_PARTITION_FIELDS)
GROUP_LOG_SCHEMA = T.StructType(MESSAGE_SCHEMA.fields + GROUP_FIELDS + LOG_PARTITION_FIELDS)

# Raw output of the registered ``mq`` source.
VALUE_SCHEMA = T.StructType([T.StructField("value", T.BinaryType())])

# Columns every splitter appends.
SPLIT_FIELDS = [
    T.StructField("pos", T.IntegerType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("error", T.StringType()),
]

# Dead-letter messages: the message plus why it failed and the ack request.
DEAD_LETTER_FIELDS = [
    T.StructField("error", T.StringType()),
    T.StructField("reply_to_qmgr", T.StringType()),
    T.StructField("reply_to_queue", T.StringType()),
    T.StructField("report", T.ArrayType(T.StringType())),
]
DEAD_LETTER_LOG_SCHEMA = T.StructType(MESSAGE_SCHEMA.fields + DEAD_LETTER_FIELDS + LOG_PARTITION_FIELDS)
