import pytest

from conftest import messages
from queuelake.operators.routing import route_failures, with_ack_request
from queuelake.operators.splitters import split_xml
from queuelake.options import QueueOptions, dead_letter_target


def test_required_and_defaults():
    with pytest.raises(ValueError):
        QueueOptions.from_dict({"queue": "Q"})
    o = QueueOptions.from_dict({"queue": "Q", "QUEUEMANAGER": "QM", "encoding": "UTF8", "movePath": " /a , /b "})
    assert o.file_format == "XML" and o.encoding == "UTF-8" and o.move_paths == ("/a", "/b")
    assert o.backout_queue == "Q.BACKOUT" and o.data_source == "Q"
    assert QueueOptions.from_dict({"queue": "Q", "queueManager": "QM", "fileFormat": "json"}).file_format == "JSON"
    with pytest.raises(ValueError):
        QueueOptions.from_dict({"queue": "Q", "queueManager": "QM", "headers": "h,h"})


@pytest.mark.parametrize(
    "extra,target",
    [
        ({}, ("QM", "Q.BACKOUT", "backout")),
        ({"backoutQueue": "BO"}, ("QM", "BO", "backout")),
        ({"error.queue": "ERR"}, ("QM", "ERR", "error")),
        ({"error queue": "ERR"}, ("QM", "ERR", "error")),
        ({"error.queue": "ERR", "error.queueManager": "QE", "backoutQueue": "BO"}, ("QE", "ERR", "error")),
        ({"error.queueManager": "QE"}, ("QM", "Q.BACKOUT", "backout")),
    ],
)
def test_dead_letter_target_table(extra, target):
    t = dead_letter_target({"queue": "Q", "queueManager": "QM", **extra})
    assert (t.queue_manager, t.queue, t.kind) == target


def test_no_target_fails():
    with pytest.raises(ValueError):
        dead_letter_target(QueueOptions(queue="Q", queue_manager="QM", backout_queue=None))


def test_route_failures_whole_messages(spark):
    df = messages(spark, ["<r><i>1</i><i>2</i></r>", "<r><i>1</i><i>", "<r></r>"])
    good, dead = route_failures(split_xml(df, split="i"), {"queue": "Q", "queueManager": "QM", "ackQueue": "ACK"})
    assert sorted(r.msg_id for r in good.collect()) == ["0", "0"]
    d = dead.collect()
    assert len(d) == 1 and d[0].msg_id == "1" and bytes(d[0].value) == b"<r><i>1</i><i>"
    assert (d[0].target_qmgr, d[0].target_queue, d[0].reply_to_qmgr, d[0].reply_to_queue, d[0].report) == (
        "QM",
        "Q.BACKOUT",
        "QM",
        "ACK",
        ["COA", "COD"],
    )


def test_no_ack_queue_gives_nulls(spark):
    out = with_ack_request(messages(spark, ["x"]), {"queue": "Q", "queueManager": "QM"}).collect()[0]
    assert out.reply_to_queue is None and out.report is None
