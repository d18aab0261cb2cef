"""Structured Streaming forms of the fetch and extraction loops.

* ``start_fetch_stream``  (T1): request queue dir -> fetch (stream-static
  right join to the page snapshot) -> response queue dir.
* ``start_extract_stream`` (T2, T5): response queue dir -> one workflow
  step per micro-batch (``run_steps``) -> next requests, items and
  articles. Articles are de-duplicated first-wins against the stored table
  inside ``foreachBatch`` (the table is the state, T5), and every sink write
  is keyed by the batch id so a replayed batch after a restart is skipped
  (exactly-once on top of Spark's at-least-once, T7).

Progress and frontier survive restarts through the checkpoint location
(T3). ``trigger`` takes ``availableNow=True`` (drain and stop) or
``processingTime='5 seconds'`` (idle polling, T6). Parallel consumers (T8)
are the tasks over file partitions.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schemas
from pagemill.config import Workflow
from pagemill.functions.hashing import link_hash
from pagemill.operators.data import article_projection, item_json
from pagemill.operators.fetch import fetch
from pagemill.operators.store import ArticleStore, save_articles
from pagemill.operators.snapshot import ClusteredSnapshot
from pagemill.plans.workflow import REQUEST_COLS, normalised, run_steps
from pagemill.session import cut_lineage, drop_tables, ensure_checkpoint_dir
from pagemill.streaming.ledger import EXACTLY_ONCE, Ledger

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Most rows and bytes of an Arrow batch between a stream and its Python workers: by default 10,000 rows and 64 MB.
STREAM_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 512, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}

RESPONSE_COLS = ["url", "status", "http_status", "headers", "body", "meta", "requested_at",
                 "error", "encoding", "encoding_confidence", "encoding_source", "body_reencoded",
                 "encoding_error", "seq"]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder (shared storage)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _started_with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the queries started inside, which keep them to their end; the session gets its own back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _small_batches(spark: SparkSession) -> dict[str, str]:
    """The settings of ``STREAM_BATCH`` where the session allows larger batches. Each worker holds the batch that came
    in, and the one with state also two data frames a key until as many keys as a batch has rows are done: a task's
    rows grow with the input until a batch is full, and the memory of all its workers with them."""
    small = {}
    for key, most in STREAM_BATCH.items():
        now = re.fullmatch(r"(\d+)([kmgt]?)b?", (spark.conf.get(key) or "").strip().lower())  # bytes may come with their unit
        if not now or not 0 < int(now[1]) * 1024 ** " kmgt".index(now[2] or " ") <= most:
            small[key] = str(most)
    return small


def read_request_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.REQUEST)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def start_fetch_stream(spark: SparkSession, request_dir: str, response_dir: str,
                       snapshot: DataFrame | ClusteredSnapshot, checkpoint: str, trigger: dict | None = None,
                       as_of: str | None = None, max_files: int | None = None, delivery: str = EXACTLY_ONCE,
                       on_written: Callable[[int], None] | None = None):
    """Continuous fetch; failures are written too (Q3). ``delivery``: see ``Ledger``. ``on_written`` is called
    with the batch's id when its responses are written, before its end is noted."""
    reqs = read_request_stream(spark, request_dir, max_files)
    if isinstance(snapshot, DataFrame):
        snapshot = cut_lineage(snapshot)  # built once, read by every micro-batch
    ledger = Ledger(spark, f"{checkpoint}/ledger", delivery)

    def sink(batch: DataFrame, batch_id: int):
        written: list = []
        asked = cut_lineage(batch, written)  # read for the hits and for the misses
        responses = fetch(asked, snapshot, as_of=as_of).select(*RESPONSE_COLS)

        def work():
            _put(responses, batch_id, response_dir)
            if on_written:
                on_written(batch_id)

        ledger.run(batch_id, work)
        drop_tables(spark, written)

    return (reqs.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _put(df: DataFrame, batch_id: int, path: str, form: str = "parquet") -> None:
    """Write a micro-batch under its own partition; a replay overwrites it."""
    (df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").format(form).save(path))


def extract_batch(wf: Workflow, responses: DataFrame, batch_id: int, request_dir: str,
                  item_dir: str | None, store: ArticleStore | None, profile: str = "worker",
                  as_of: str | None = None, dead_letter_dir: str | None = None) -> None:
    """T2 body: one micro-batch of responses through their workflow steps, as a batch run does it:
    generators feed the requests, items go where their step's route says (the queue, or the store of
    a last step; without a store all go to the queue), rows that cannot be processed to the dead letters.
    The parsed pages of the batch are written once and dropped at the end."""
    spark, written = responses.sparkSession, []
    pages = cut_lineage(normalised(wf, responses, profile), written)
    requests, items, dead = run_steps(wf, pages, profile, has_store=store is not None, written=written)
    if requests:
        _put(reduce(DataFrame.unionByName, requests), batch_id, request_dir)
    if dead and dead_letter_dir:
        _put(reduce(DataFrame.unionByName, dead), batch_id, dead_letter_dir, "json")
    if items:
        # extracted once; data structs of several steps differ: union by name
        items = cut_lineage(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), items).drop("body"), written)
        if item_dir:
            _put(item_json(items.filter(F.col("route") == "queue")), batch_id, item_dir, "json")
        if store is not None and not store.committed(batch_id):
            mine = article_projection(items.filter(F.col("route") == "store"), profile)
            store.append(save_articles(store.load(), mine, batch_id=batch_id, as_of=as_of), batch_id)
    drop_tables(spark, written)


def start_extract_stream(spark: SparkSession, wf: Workflow, response_dir: str, request_dir: str,
                         checkpoint: str, item_dir: str | None = None, store: ArticleStore | None = None,
                         profile: str = "worker", trigger: dict | None = None, as_of: str | None = None,
                         max_files: int | None = None, dead_letter_dir: str | None = None,
                         delivery: str = EXACTLY_ONCE):
    """Continuous extraction over the response queue. ``delivery``: see ``Ledger``."""
    ledger = Ledger(spark, f"{checkpoint}/ledger", delivery)
    schema = ("url string, status int, http_status int, headers map<string,string>, body string, "
              f"meta {schemas.META.simpleString()}, requested_at string, error string, "
              "encoding string, encoding_confidence double, encoding_source string, "
              "body_reencoded boolean, encoding_error string, seq array<bigint>, batch long")
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    stream = r.parquet(response_dir)
    return (stream.writeStream
            .foreachBatch(lambda df, bid: ledger.run(bid, lambda: extract_batch(
                wf, df.drop("batch"), bid, request_dir, item_dir, store, profile, as_of, dead_letter_dir)))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


#: Keys that a task remembers while it thins its rows before they are shuffled.
THINNED_KEYS = 1 << 16


def _thinned(batches):
    """Rows of a task without those that an earlier row of the task beats for certain: the same key with a smaller
    ``seq``. A link that a third of all rows name reaches the shuffle a few times a task. Which keys are remembered
    is bounded and decides how many rows go on, not which one wins."""
    best: dict = {}
    for pdf in batches:
        order = sorted(range(len(pdf)), key=lambda i: tuple(pdf["seq"].iat[i]))
        keep = []
        for i in order:
            key, seq = pdf["link_hash"].iat[i], tuple(pdf["seq"].iat[i])
            if key not in best or seq < best[key]:
                if len(best) >= THINNED_KEYS:
                    best.clear()
                best[key] = seq
                keep.append(i)
        yield pdf.iloc[keep]


def _first_of_key(key, batches, state):
    """The row of a new key with the smallest ``seq`` of its micro-batch; nothing for a key that came before."""
    first = min(((tuple(seq), row) for pdf in batches for seq, row in zip(pdf["seq"], pdf["row"])), default=None)
    if first is not None and not state.exists:
        state.update((True,))
        yield pd.DataFrame({"link_hash": [key[0]], "row": [first[1]]})


def start_link_dedup_stream(spark: SparkSession, requests: DataFrame, sink_dir: str, checkpoint: str,
                            trigger: dict | None = None):
    """T5 on a request stream: first-wins by link hash within each micro-batch and against all earlier ones.

    The state is a key-value store keyed by the link hash (RocksDB, which spills to disk and is checkpointed by its
    changes), so a micro-batch reads and writes its own keys and no earlier output. The file sink names the files of
    each batch in its log: a batch that is run again after a crash replaces its files. Rows without a url go.
    """
    columns = [f for f in requests.schema.fields]
    row = T.StructType(columns)
    keyed = (requests.withColumn("link_hash", link_hash(F.col("url"))).filter(F.col("link_hash") != "")
             .select("link_hash", "seq", F.to_json(F.struct(*[F.col(f.name) for f in columns])).alias("row"))
             .mapInPandas(_thinned, "link_hash string, seq array<bigint>, row string"))
    won = keyed.groupBy("link_hash").applyInPandasWithState(
        _first_of_key, "link_hash string, row string", "seen boolean", "append", "NoTimeout")
    won = won.select("link_hash", F.from_json("row", row).alias("r")).select(*[F.col("r")[f.name].alias(f.name) for f in columns],
                                                                             "link_hash")
    with _started_with(spark, {STATE_STORE: ROCKSDB, **_small_batches(spark)}):
        return (won.writeStream.format("parquet").option("path", sink_dir).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


__all__ = ["start_fetch_stream", "start_extract_stream", "start_link_dedup_stream",
           "extract_batch", "scratch_dir", "REQUEST_COLS"]
