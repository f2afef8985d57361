"""Plan for the landing copy (S7): files of events, some of them broken."""

from __future__ import annotations

import gzip
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.registry import plan
from strata.session import scratch_path
from strata.sources.landing import _uri, land_dataset
from strata.sources.tables import Tables

SCHEMA = "event_id long, user_id long, event_type string, value double, props string"


def _stand_in(events: DataFrame, root: str) -> None:
    """Files as a source system leaves them: gzipped JSON lines, every 97th line cut off, and one file cut short."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    cut = F.expr("event_id % 97 = 0")
    events.select(F.when(cut, F.left(line, F.length(line) - 3)).otherwise(line).alias("value")).write.option(
        "compression", "gzip").text(root)
    from pyarrow.fs import FileSystem

    whole = gzip.compress(b"".join(b'{"event_id": %d, "user_id": 1, "event_type": "x", "value": 1.5, "props": "{}"}\n' % -i for i in range(1, 1000)))
    fs, path = FileSystem.from_uri(_uri(f"{root}/cut-short.txt.gz"))
    with fs.open_output_stream(path, compression=None) as f:
        f.write(whole[:len(whole) // 2])


@plan("landing_copy", """
SELECT event_type AS kind, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total
FROM events WHERE event_id % 97 <> 0 GROUP BY event_type
UNION ALL
SELECT 'malformed record', count(*), NULL, NULL FROM events WHERE event_id % 97 = 0 HAVING count(*) > 0
UNION ALL SELECT 'failed: cut-short.txt.gz', 1, NULL, NULL
UNION ALL SELECT 'failed: ALL_FILES', 1, NULL, NULL
""")
def landing_copy(spark, sf_dir):
    """Land the events' files: rows by type, records that do not parse, files that failed, a folder that is not there."""
    root = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    _stand_in(Tables(spark, sf_dir).events, f"{root}/source")
    schema = spark.createDataFrame([], SCHEMA).schema
    got = land_dataset(spark, "events", f"{root}/source", schema, f"{root}/landed", f"{root}/log")
    gone = land_dataset(spark, "gone", f"{root}/nowhere", schema, f"{root}/landed", f"{root}/log-gone")
    rows = got.good.groupBy(F.col("event_type").alias("kind")).agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total"))
    dead = got.dead_letter.unionByName(gone.dead_letter)
    kind = F.when(F.col("record").isNotNull(), F.col("error")).otherwise(F.concat(F.lit("failed: "), F.col("file_path")))
    failed = dead.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return rows.unionByName(failed, allowMissingColumns=True)
