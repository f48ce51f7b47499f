"""Pairs of a stream: events out of order within the delay, over several files, against a plain pass."""

import datetime
import random

from lodestrata.streaming.transitions import action_pairs


def test_pairs_of_a_stream_equal_a_plain_pass(spark, tmp_path):
    rng, start = random.Random(3), datetime.datetime(2024, 1, 1)
    events = [(rng.choice("ab"), start + datetime.timedelta(seconds=20 * k), k, rng.choice(["Created", "Sent", "Failed"])) for k in range(60)]
    order = sorted(events, key=lambda e: e[1] + datetime.timedelta(seconds=rng.randrange(300)))  # at most five minutes late
    end = [(k, start + datetime.timedelta(days=1), 10**6, "End") for k in "abc"]
    kind = "key string, ts timestamp, seq long, action string"
    for n, part in enumerate((order[:20], order[20:40], order[40:], end, end[2:])):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = action_pairs(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(150)
    want = []
    for key in "ab":
        mine = [e for e in events if e[0] == key]
        want += [(key, b[2], f"{a[3]} → {b[3]}") for a, b in zip(mine, mine[1:])]
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(want)
