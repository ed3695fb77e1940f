"""Keep an index as parquet, so that a reader prunes to the parts and columns it needs.

Most tables have one folder per intent. The postings lie in buckets of their join keys, sorted, and
the manifest says how many: a scoring join shuffles the queries only. Beside them are the shards that
larger searches read, and the words and counts that ``tfidf.merge_cases`` adds new cases to.
"""

from __future__ import annotations

import dataclasses
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from deskloom.operators.tfidf import TfidfIndex, TfidfSpec, all_totals

TABLES = ("vocab", "vectors", "members", "parts", "words", "totals", "shards")
KEYS = ("part", "term", "salt")
LEAST_BUCKETS = 16


def save_index(index: TfidfIndex, cases: DataFrame, path: str, part_col: str = "intent", buckets: int | None = None) -> None:
    """``buckets`` should be at least the shuffle partitions of the sessions that will read it; by
    default it is that of this session."""
    spark = cases.sparkSession
    whole = dataclasses.replace(index, totals=all_totals(index), shards=index.sharded())
    for name in TABLES:
        writer = getattr(whole, name).write.mode("overwrite")
        if name != "parts":
            writer = writer.partitionBy("part")
        writer.parquet(f"{path}/{name}")
    cases.write.mode("overwrite").partitionBy(part_col).parquet(f"{path}/cases")
    buckets = buckets or max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    postings = index.salted_postings()
    name = f"postings_{uuid.uuid4().hex}"
    # dealt like the buckets, so that each is one file
    writer = postings.repartition(buckets, *KEYS).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", f"{path}/postings").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    manifest = {
        "spec": dataclasses.asdict(index.spec), "vocab_bound": index.vocab_bound, "buckets": buckets,
        "postings": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in postings.schema),
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load_index(spark: SparkSession, path: str) -> tuple[TfidfIndex, DataFrame]:
    """The index and its cases. The postings become an external table of the session's catalog under
    a name of their own."""
    saved = json.loads(spark.read.text(f"{path}/spec").first()[0])
    # folder names are read back as strings whatever they look like
    keep = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}
        cases = spark.read.parquet(f"{path}/cases")
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", keep)
    name, keys = f"postings_{uuid.uuid4().hex}", ", ".join(KEYS)
    spark.sql(
        f"CREATE TABLE {name} ({saved['postings']}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {saved['buckets']} BUCKETS LOCATION '{path}/postings'"
    )
    spec = TfidfSpec(**saved["spec"])
    return TfidfIndex(spec=spec, vocab_bound=saved["vocab_bound"], salted=spark.table(name), **tables), cases
