"""The corpus pipeline: language ID, near-duplicates, repeated passages, test items, then the mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's result as Parquet to the shared folder
and reads it back for the next one. No SQL is given: the network, the groups and the cuts are beyond
it; the tests hold each stage against a brute-force version. Null and letterless texts leave with the first
stage (unless no document is labelled, when all stay), repeated rows are copies of each other, ties follow the order of the
rows, other columns pass through, and an empty table gives an empty mix. ``run`` gives the mix alone; the cleaned texts
are the table ``decontamination-*`` in the shared folder.
"""

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, langid, minhash, mixing, suffix_dedup
from strata.llm.common import settle, table

STAGES = [
    ("language_id", langid.stage),
    ("near_duplicates", minhash.stage),
    ("suffix_dedup", suffix_dedup.stage),
    ("decontamination", decontam.stage),
    ("mixing", mixing.stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, taken) of what the stages leave of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
