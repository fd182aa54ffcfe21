"""queuelake: message-queue ingestion on Spark.

Public API (see README for the full picture)::

    from queuelake import (
        QueueOptions, dead_letter_target,                       # options
        message_value, archive_name,                            # column functions
        split_records, split_xml, split_json, split_lines,      # splitters
        register_splitter, expression_splitter, python_splitter, udtf_splitter,
        parse_xml, parse_json, parse_fixed_width,               # typed views
        assemble_segments, route_failures, with_ack_request,    # message operators
        read_queue, read_queue_stream, write_queue, archive,    # queue log and sinks
        read_mq, process_mq, drain, run_foreach_batch,          # streams
        QueueBatchWriter, assemble_segments_stream,
    )
"""

from .functions.message import archive_name, message_value
from .functions.parse import parse_fixed_width, parse_json, parse_xml
from .operators.groups import complete_messages, in_group_order, release_groups
from .operators.routing import route_failures, with_ack_request
from .operators.segments import assemble_segments
from .operators.splitters import (
    expression_splitter,
    python_splitter,
    register_splitter,
    split_json,
    split_lines,
    split_records,
    split_xml,
    udtf_splitter,
)
from .options import QueueOptions, dead_letter_target
from .session import stateful_session
from .sources.archive import archive
from .sources.files import read_files, read_files_stream
from .sources.kafka import kafka_shape
from .sources.queue_log import read_queue, read_queue_stream, write_queue
from .sources.xml_files import read_xml_files
from .streaming.confirmations import confirmations
from .streaming.drain import drain, process_mq, read_mq, run_foreach_batch, to_sink
from .streaming.groups import release_groups_stream
from .streaming.segments import assemble_segments_stream
from .streaming.writer import QueueBatchWriter

__all__ = [
    "QueueOptions",
    "dead_letter_target",
    "message_value",
    "archive_name",
    "split_records",
    "split_xml",
    "split_json",
    "split_lines",
    "register_splitter",
    "expression_splitter",
    "python_splitter",
    "udtf_splitter",
    "parse_xml",
    "parse_json",
    "parse_fixed_width",
    "assemble_segments",
    "route_failures",
    "with_ack_request",
    "read_queue",
    "read_queue_stream",
    "write_queue",
    "archive",
    "kafka_shape",
    "read_mq",
    "process_mq",
    "drain",
    "run_foreach_batch",
    "to_sink",
    "QueueBatchWriter",
    "assemble_segments_stream",
    "release_groups",
    "release_groups_stream",
    "complete_messages",
    "in_group_order",
    "read_files",
    "read_files_stream",
    "read_xml_files",
    "confirmations",
    "stateful_session",
]
