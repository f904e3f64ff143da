import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("skein-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skein-test-ckpt-"))
    yield spark


@pytest.fixture(scope="session")
def chain_fixture(spark):
    """The corrected unit fixture: two chats, replies and one forward, plus edge cases."""
    edges = {
        1: [(0, None), (1, None), (2, 1), (3, None), (4, 3), (5, 4), (6, 5), (7, 3), (8, 1), (9, 4)],
        2: [(0, None), (1, None)],
        3: [(5, 4)],                 # orphan: parent 4 missing
        4: [(1, None), (2, 1)],      # text of 1 is null; sender of 1 is the linked chat
    }
    rows = []
    for chat, msgs in edges.items():
        for mid, parent in msgs:
            text = None if (chat, mid) == (4, 1) else f"{chat},{mid}"
            fwd_chat, fwd_msg = (1, 2) if (chat, mid) == (2, 0) else (None, None)
            sender = 99 if (chat, mid) == (4, 1) else 10 + mid
            rows.append((chat, mid, parent, fwd_chat, fwd_msg, text, sender,
                         f"2024-01-0{1 + mid % 9} 00:00:00"))
    schema = ("chat_id long, message_id long, reply_to_message_id long, forward_from_chat_id long, "
              "forward_from_message_id long, text string, sender_id long, date string")
    from pyspark.sql import functions as F
    m = spark.createDataFrame(rows, schema).withColumn("date", F.col("date").cast("timestamp_ntz"))
    chats = spark.createDataFrame([(1, None), (2, None), (3, None), (4, 99)], "chat_id long, linked_chat_id long")
    return m, chats
