"""Article store: save with first-wins de-dup, delete, document form.

The relational form is two tables, ``articles`` and ``article_contents``
(content only when non-empty); the document form is one table with the
content inline and ``updated_at``. Saving a batch:

  1. project + hash: link_hash = md5(link) ('' for no link), content_hash;
  2. a bitmap of the link hashes that repeat in the batch or are stored (of the batch and the store
     only this column is read): rows that it does not mark are new and are not moved;
  3. of the marked ones, those whose key is not stored: in-batch first-wins per link_hash by ``seq``
     (``dedup.first_wins``) and a ``left_anti`` against the stored link hashes, both exact; a second bitmap,
     of the keys that pass them, thins the rows (unless they are ``FEW``) before they are moved with their content;
  4. rows with an empty link hash are never matched and always inserted.

Ids are deterministic (``hashing.article_id``), so a duplicate's outcome
carries the id of the row that holds its link, as the reference returns
the existing id. All steps are joins/aggregations planned by Catalyst; no
row is collected.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schemas
from pagemill.functions.common import HashBitmap
from pagemill.functions.hashing import article_id, content_hash, link_hash
from pagemill.functions.timefn import local_now_literal
from pagemill.operators.dedup import first_wins
from pagemill.session import cut_lineage, drop_tables
from pagemill.sources.files import delete, names, path_exists, publish_text, read_text, write_text


@dataclass
class ArticleTables:
    articles: DataFrame
    contents: DataFrame
    content_files: DataFrame | None = None  # of a stored table: article_id and the file that holds its content

    @staticmethod
    def empty(spark: SparkSession) -> "ArticleTables":
        return ArticleTables(spark.createDataFrame([], schemas.ARTICLES),
                             spark.createDataFrame([], schemas.ARTICLE_CONTENTS))


@dataclass
class SaveResult:
    rows: DataFrame          # the new articles, with content (one frame for both tables)
    outcomes: DataFrame      # per input row: seq, article_id, status inserted|existing

    @property
    def articles(self) -> DataFrame:
        """Rows to append to ``articles``."""
        return self.rows.select(*[f.name for f in schemas.ARTICLES.fields])

    @property
    def contents(self) -> DataFrame:
        """Rows to append to ``article_contents`` (only non-empty content)."""
        return self.rows.filter(F.col("content") != "").select(
            F.col("id").alias("article_id"), "content", "content_hash", "created_at")

    def materialized(self) -> "SaveResult":
        """The same result with the new rows written once to the checkpoint
        folder, so writing both tables does not recompute the batch."""
        return SaveResult(cut_lineage(self.rows), self.outcomes)


def _seq_key(seq: Column) -> Column:
    return F.concat_ws(":", F.transform(seq, lambda x: x.cast("string")))


def prepare(batch: DataFrame, batch_id: int | str = 0, as_of: str | None = None) -> DataFrame:
    """Hashes, ids and created_at for projected articles.

    ``batch`` needs task_id, title, link, content, source_url, extra, seq;
    a ``created_at`` column is used when present, else ``as_of`` local time.
    """
    created = (F.col("created_at").cast("timestamp_ntz") if "created_at" in batch.columns
               else local_now_literal(as_of))
    lh = link_hash(F.col("link"))
    return batch.select(
        F.coalesce(F.col("task_id").cast("string"), F.lit("None")).alias("task_id"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("link"), F.lit("")).alias("link"),
        lh.alias("link_hash"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        content_hash(F.col("content")).alias("content_hash"),
        F.coalesce(F.col("source_url"), F.lit("")).alias("source_url"),
        F.coalesce(F.col("extra"), F.lit("{}")).alias("extra"),
        created.alias("created_at"),
        F.col("seq"),
        article_id(lh, F.concat(F.lit(f"#{batch_id}#"), _seq_key(F.col("seq")))).alias("id"),
    )


def _not_stored(winners: DataFrame, stored_keys: DataFrame, key: str) -> DataFrame:
    """Winners whose key is not stored yet."""
    return winners.join(stored_keys, winners[key] == stored_keys["_k"], "left_anti")


#: Rows that are moved with their content without looking whether they may be new.
FEW = 10_000


def _new_rows(prepared: DataFrame, stored_keys: DataFrame, key: str) -> DataFrame:
    """First rows per key that are not stored, and all rows without a key. Content moves only for rows whose key
    repeats in the batch and is not stored."""
    keyed = prepared.select(key, "seq").filter(F.col(key) != "")
    repeated = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(key).alias("_k"))
    suspects = HashBitmap(repeated.unionByName(stored_keys), "_k")
    asked = F.col("_suspect") & (F.col(key) != "")
    mine = suspects.mark(keyed, key, "_suspect").where(asked)
    marked = suspects.mark(prepared, key, "_suspect")
    open_ = marked.where(asked).drop("_suspect")
    if mine.count() > FEW:
        first = mine.groupBy(key).agg(F.min("seq").alias("seq"))
        alive = HashBitmap(_not_stored(first, stored_keys, key).select(key), key)
        open_ = alive.mark(open_, key, "_alive").where("_alive").drop("_alive")
    decided = _not_stored(first_wins(open_, key, "seq"), stored_keys, key)
    return decided.unionByName(marked.where(~asked).drop("_suspect"))


def save_articles(store: ArticleTables, batch: DataFrame, batch_id: int | str = 0,
                  as_of: str | None = None, dedup_on: str = "link_hash") -> SaveResult:
    """K6: first-wins by link hash within the batch and against the store."""
    prepared = prepare(batch, batch_id, as_of)
    # the stored keys live in articles (link_hash) or article_contents (content_hash)
    source = store.contents if dedup_on == "content_hash" else store.articles
    stored_keys = source.select(F.col(dedup_on).alias("_k")).filter(F.col("_k") != "")
    new = _new_rows(prepared, stored_keys, dedup_on)
    inserted = new.select(F.col("seq").alias("_seq"), F.lit(True).alias("_ins"))
    marked = prepared.join(inserted, prepared["seq"] == inserted["_seq"], "left")
    if dedup_on == "link_hash":  # the id is the link hash, so a duplicate has the id of its link
        holder = F.col("id")
    else:  # the id of the row that holds the key: a new one of this batch or a stored one
        held = (new.filter(F.col(dedup_on) != "").select(F.col(dedup_on).alias("_hk"), F.col("id").alias("_hid"))
                .unionByName(source.filter(F.col(dedup_on) != "").groupBy(F.col(dedup_on).alias("_hk"))
                             .agg(F.min("article_id").alias("_hid"))))
        marked = marked.join(held, marked[dedup_on] == held["_hk"], "left")
        holder = F.when(F.col("_ins"), F.col("id")).otherwise(F.coalesce("_hid", "id"))
    outcomes = marked.select("seq", holder.alias("article_id"),
                             F.when(F.col("_ins"), F.lit("inserted")).otherwise(F.lit("existing")).alias("status"))
    return SaveResult(new, outcomes)


def apply_save(store: ArticleTables, result: SaveResult) -> ArticleTables:
    """The store after a save (lazy union; persist with ``ArticleStore``)."""
    return ArticleTables(store.articles.unionByName(result.articles),
                         store.contents.unionByName(result.contents))


# ---- deletes (K14, K15, J4, A8) --------------------------------------------
def delete_article(store: ArticleTables, article_id_value: str):
    """Drop one article and its content. Returns (tables, deleted_count_df)."""
    aid = F.lit(str(article_id_value))
    deleted = store.articles.filter(F.col("id") == aid).agg(F.count("*").alias("deleted"))
    return (ArticleTables(store.articles.filter(F.col("id") != aid),
                          store.contents.filter(F.col("article_id") != aid)), deleted)


def delete_by_task(store: ArticleTables, task_id: str):
    """Drop a task's articles and (cascade) their contents.

    Contents have no task column: the task's ids are a semi-join set and the
    remaining contents a ``left_anti`` join on it (J4). Returns
    (tables, deleted_count_df)."""
    t = F.lit(str(task_id))
    ids = store.articles.filter(F.col("task_id") == t).select(F.col("id").alias("_id"))
    contents = store.contents.join(ids, store.contents["article_id"] == ids["_id"], "left_anti")
    deleted = ids.agg(F.count("*").alias("deleted"))
    return ArticleTables(store.articles.filter(F.col("task_id") != t), contents), deleted


# ---- document form (K7, K16) -----------------------------------------------
def to_documents(store: ArticleTables, as_of: str | None = None) -> DataFrame:
    """One record per article with content inline, extra nested, updated_at."""
    c = store.contents.select(F.col("article_id"), F.col("content"), F.col("content_hash"))
    return (store.articles.join(c, store.articles["id"] == c["article_id"], "left")
            .select("id", "task_id", "title", "link", "link_hash",
                    F.coalesce("content", F.lit("")).alias("content"),
                    F.coalesce("content_hash", F.lit("")).alias("content_hash"),
                    "source_url", F.try_parse_json("extra").alias("extra"), "created_at",
                    F.col("created_at").alias("updated_at")))


def _is_bad_extra(extra: Column) -> Column:
    return F.try_parse_json(F.coalesce(extra, F.lit("{}"))).isNull()


def document_dead_letters(batch: DataFrame) -> DataFrame:
    """Items whose ``extra`` is not JSON (error, stage, item); ``save_documents`` leaves them out,
    so one bad item costs no other."""
    return batch.filter(_is_bad_extra(F.col("extra"))).select(
        F.lit("extra is not JSON").alias("error"), F.lit("store").alias("stage"),
        F.to_json(F.struct(*batch.columns)).alias("item"))


def save_documents(documents: DataFrame, batch: DataFrame, batch_id: int | str = 0,
                   as_of: str | None = None):
    """K7: same de-dup as K6 into the single-table form. Returns (new_docs, outcomes); items whose
    ``extra`` is not JSON take no part (see ``document_dead_letters``)."""
    prepared = prepare(batch.filter(~_is_bad_extra(F.col("extra"))), batch_id, as_of)
    stored = documents.select(F.col("link_hash").alias("_k")).filter(F.col("_k") != "")
    new = _new_rows(prepared, stored, "link_hash")
    docs = new.select("id", "task_id", "title", "link", "link_hash",
                      "content", "content_hash", "source_url", F.try_parse_json("extra").alias("extra"),
                      "created_at", F.col("created_at").alias("updated_at"))
    ins = new.select(F.col("seq").alias("_seq"), F.lit(True).alias("_ins"))
    outcomes = (prepared.join(ins, prepared["seq"] == ins["_seq"], "left")
                .select("seq", F.col("id").alias("article_id"),
                        F.when(F.col("_ins"), "inserted").otherwise("existing").alias("status")))
    return docs, outcomes


def delete_document(documents: DataFrame, document_id: str):
    """K16, one document by id. Returns (documents', deleted_count_df)."""
    same = F.col("id") == F.lit(str(document_id))
    return documents.filter(~same), documents.filter(same).agg(F.count("*").alias("deleted"))


def delete_documents_by_task(documents: DataFrame, task_id: str):
    """One-table delete. Returns (documents', deleted_count_df)."""
    t = F.lit(str(task_id))
    return (documents.filter(F.col("task_id") != t),
            documents.filter(F.col("task_id") == t).agg(F.count("*").alias("deleted")))


# ---- persistence ------------------------------------------------------------
#: Deletes that readers apply; one more folds them into a new version. It bounds what they broadcast.
MAX_TOMBSTONES = 10_000

TOMBSTONE = "kind string, value string, at long"


class _LoggedTables:
    """Parquet tables that grow by numbered commits.

    Every change has a sequence number: its files lie under ``seq=<n>``, and it takes place when the log
    entry ``n`` is published (at one stroke; of two writers one fails). Readers take the rows of all
    numbers up to the last entry, so what a crash left behind is invisible and is overwritten by the next
    change. Batches leave a marker beside the versions: a replayed batch is skipped, also after deletes.

    Deletes rewrite nothing. A delete writes one tombstone (an id or a task) with its number; readers leave out the
    rows of smaller numbers that it names (an anti-join with at most ``MAX_TOMBSTONES`` rows, broadcast, so a task
    that holds a third of all rows is not moved), and rows saved again later have larger numbers. ``compact`` writes
    the visible rows as a new version and switches the ``CURRENT`` pointer; a version being read is not
    touched, and the one before it is dropped.

    ``buckets=n`` keeps the tables as catalog tables over the same folders, bucketed by their key: joins on the key
    then read the stored side without a shuffle.
    """

    TABLES: dict[str, T.StructType] = {}
    KEYS: dict[str, str] = {}    # bucketed by
    IDS: dict[str, str] = {}     # the column that a tombstone of kind 'id' names

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None,
                 table_prefix: str = "pagemill"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.prefix = table_prefix

    # --- versions, log, markers ------------------------------------------------
    def _version(self) -> int:
        return int(read_text(self.spark, f"{self.root}/CURRENT").strip() or 0)

    def _last(self, version: int) -> int:
        """The number of the last change, -1 before the first."""
        found = names(self.spark, f"{self.root}/v{version}/log")
        return int(found[-1].split(".")[0]) if found else -1

    def _publish(self, version: int, seq: int, entry: dict) -> None:
        if not publish_text(self.spark, f"{self.root}/v{version}/log/{seq:012d}.json", json.dumps(entry)):
            raise RuntimeError(f"another writer changed {self.root}")

    def committed(self, batch_id) -> bool:
        marker = f"{self.root}/_commits/{batch_id}"
        if path_exists(self.spark, marker):
            return True
        # a writer that died between the log and the marker: only the last entry can lack its marker
        version = self._version()
        last = self._last(version)
        entry = json.loads(read_text(self.spark, f"{self.root}/v{version}/log/{last:012d}.json") or "{}")
        if entry.get("batch") != str(batch_id):
            return False
        write_text(self.spark, marker, "")
        return True

    # --- reading ---------------------------------------------------------------
    def _dir(self, table: str, version: int | None = None) -> str:
        return f"{self.root}/v{self._version() if version is None else version}/{table}"

    def _table(self, table: str, version: int | None = None) -> str:
        """Catalog table over the folder (bucketed mode), created if missing."""
        v = self._version() if version is None else version
        name = f"{self.prefix}_{table}_v{v}"
        if not self.spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.TABLES[table].fields)
            key = self.KEYS[table]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({cols}, seq BIGINT) USING parquet "
                f"PARTITIONED BY (seq) CLUSTERED BY ({key}) SORTED BY ({key}) "
                f"INTO {int(self.buckets)} BUCKETS LOCATION '{self._dir(table, v)}'")
            if path_exists(self.spark, self._dir(table, v)):  # data written before: register it
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _tombstones(self, version: int, last: int) -> DataFrame | None:
        path = f"{self.root}/v{version}/tombstones"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(TOMBSTONE).json(path).where(F.col("at") <= last)

    def _visible(self, table: str, with_file: bool = False) -> DataFrame:
        """The stored rows that are committed and not deleted; ``with_file``: with the path of their file, ``_file``."""
        version = self._version()
        last, schema = self._last(version), self.TABLES[table]
        if self.buckets:
            rows = self.spark.table(self._table(table, version))
        elif path_exists(self.spark, self._dir(table, version)):
            rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("seq", T.LongType())])).parquet(
                self._dir(table, version))
        else:
            none = self.spark.createDataFrame([], schema)
            return none.withColumn("_file", F.lit(None).cast("string")) if with_file else none
        if with_file:
            rows = rows.withColumn("_file", F.col("_metadata.file_path"))
        rows = rows.where(F.col("seq") <= last)
        dead = self._tombstones(version, last)
        for kind, column in (("id", self.IDS[table]), ("task", "task_id")) if dead is not None else ():
            mine = F.broadcast(dead.where(F.col("kind") == kind).groupBy("value").agg(F.max("at").alias("at")))
            rows = rows.join(mine, (F.col(column) == F.col("value")) & (F.col("seq") < F.col("at")), "left_anti")
        return rows.select(*schema.fieldNames(), *(["_file"] if with_file else []))

    # --- changes ---------------------------------------------------------------
    def _write(self, table: str, df: DataFrame, seq: int | str, version: int | None = None) -> None:
        """The rows of one change; what a dead writer left under its number is replaced."""
        if not self.buckets:
            df.write.mode("overwrite").parquet(f"{self._dir(table, version)}/seq={int(seq)}")
            return
        cols = self.TABLES[table].fieldNames()
        view = f"_pm_write_{table}_{uuid.uuid4().hex}"
        df.select(*cols).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self._table(table, version)} "
                       f"PARTITION (seq = {int(seq)}) SELECT {', '.join(cols)} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def _next(self, version: int) -> int:
        """The number of the next change, free of what a writer that died left under it."""
        seq = self._last(version) + 1
        delete(self.spark, f"{self.root}/v{version}/tombstones/{seq:012d}.json")
        for table in self.TABLES:
            if self.buckets:
                self.spark.sql(f"ALTER TABLE {self._table(table, version)} DROP IF EXISTS PARTITION (seq = {seq})")
            delete(self.spark, f"{self._dir(table, version)}/seq={seq}")
        return seq

    def _commit(self, frames: dict[str, DataFrame], batch_id) -> None:
        version = self._version()
        seq = self._next(version)
        for table, rows in frames.items():
            self._write(table, rows, seq, version)
        self._publish(version, seq, {"batch": str(batch_id)})
        write_text(self.spark, f"{self.root}/_commits/{batch_id}", "")

    def _delete(self, kind: str, value: str) -> int:
        table = next(iter(self.TABLES))
        column = self.IDS[table] if kind == "id" else "task_id"
        gone = self._visible(table).where(F.col(column) == F.lit(str(value))).count()
        if not gone:
            return 0
        version = self._version()
        seq = self._next(version)
        write_text(self.spark, f"{self.root}/v{version}/tombstones/{seq:012d}.json",
                   json.dumps({"kind": kind, "value": str(value), "at": seq}) + "\n")
        self._publish(version, seq, {"delete": kind})
        if len(names(self.spark, f"{self.root}/v{version}/tombstones")) > MAX_TOMBSTONES:
            self.compact()
        return gone

    def delete_task(self, task_id) -> int:
        """The rows of a task; how many there were."""
        return self._delete("task", task_id)

    def compact(self) -> int:
        """The visible rows as a new version without tombstones; its number."""
        return self._replace({t: self._visible(t) for t in self.TABLES})

    def _replace(self, frames: dict[str, DataFrame]) -> int:
        old = self._version()
        for table, rows in frames.items():
            self._write(table, rows, 0, old + 1)
        if self._last(old + 1) < 0:
            self._publish(old + 1, 0, {"from": old})
        write_text(self.spark, f"{self.root}/CURRENT", str(old + 1))
        if old and not self.buckets:  # readers may still be at the version before, not at older ones
            delete(self.spark, f"{self.root}/v{old - 1}")
        return old + 1


class ArticleStore(_LoggedTables):
    """The two-table form (see ``_LoggedTables``). Stored contents carry their article's task, so a task is
    deleted from both tables without a join between them."""

    TABLES = {"articles": schemas.ARTICLES,
              "article_contents": T.StructType([*schemas.ARTICLE_CONTENTS.fields, T.StructField("task_id", T.StringType())])}
    REFUSAL = ""
    KEYS = {"articles": "link_hash", "article_contents": "article_id"}
    IDS = {"articles": "id", "article_contents": "article_id"}

    def load(self) -> ArticleTables:
        return ArticleTables(self._visible("articles"), self._visible("article_contents").drop("task_id"),
                             self._visible("article_contents", with_file=True).select("article_id", "_file"))

    def append(self, result: SaveResult, batch_id) -> bool:
        if self.committed(batch_id):
            return False
        written: list = []
        rows = cut_lineage(result.rows, written)  # both tables from one computation
        contents = rows.filter(F.col("content") != "").select(
            F.col("id").alias("article_id"), "content", "content_hash", "created_at", "task_id")
        self._commit({"articles": rows.select(*schemas.ARTICLES.fieldNames()), "article_contents": contents}, batch_id)
        drop_tables(self.spark, written)
        return True

    def refused(self, batch: DataFrame) -> DataFrame | None:
        """Items that this store cannot take: none."""
        return None

    def delete_article(self, article_id_value) -> bool:
        """One article and its content; whether there was one."""
        return self._delete("id", article_id_value) > 0

    def replace(self, tables: ArticleTables) -> int:
        """A new version that holds ``tables``."""
        owner = tables.articles.select(F.col("id").alias("_id"), "task_id")
        contents = tables.contents.join(owner, tables.contents["article_id"] == owner["_id"], "left").drop("_id")
        return self._replace({"articles": tables.articles, "article_contents": contents})


class DocumentStore(_LoggedTables):
    """The one-table (document) form: content inline, ``extra`` as JSON text in the files."""

    TABLES = {"documents": T.StructType([
        *[T.StructField(n, T.StringType()) for n in ("id", "task_id", "title", "link", "link_hash", "content",
                                                     "content_hash", "source_url", "extra")],
        T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType())])}
    REFUSAL = "extra is not JSON"
    KEYS = {"documents": "link_hash"}
    IDS = {"documents": "id"}

    def load(self) -> DataFrame:
        """Documents with ``extra`` parsed back to VARIANT."""
        return self._visible("documents").withColumn("extra", F.try_parse_json("extra"))

    def save(self, batch: DataFrame, batch_id, as_of: str | None = None):
        """K7 + persist: returns the outcomes, or None when the batch was already saved."""
        if self.committed(batch_id):
            return None
        docs, outcomes = save_documents(self.load(), batch, batch_id=batch_id, as_of=as_of)
        self._commit({"documents": docs.withColumn("extra", F.to_json("extra"))}, batch_id)
        return outcomes

    def refused(self, batch: DataFrame) -> DataFrame | None:
        """Items whose ``extra`` is not JSON."""
        return batch.filter(_is_bad_extra(F.col("extra")))

    def delete_document(self, document_id) -> bool:
        """One document; whether there was one."""
        return self._delete("id", document_id) > 0


def save_to_targets(batch: DataFrame, targets: list, batch_id, dead_letter_path: str | None = None,
                    as_of: str | None = None, fallback: bool = True) -> str:
    """Save projected articles to the first target that works, item by item.

    ``targets`` are ``DocumentStore`` / ``ArticleStore`` objects in priority
    order (document store first, as the item pipeline prefers). Items that a target refuses
    (``refused``), and all items when its write fails, go on to the next target (``fallback=True``, the
    pipeline) or straight to the dead letters (``fallback=False``, the worker's
    direct saves). Dead letters keep the error text and each item as JSON.
    Returns the name of the first target that took items ('dead_letter' if none).
    """
    errors, took, left = [], None, batch
    for target in targets:
        name = type(target).__name__
        try:
            if isinstance(target, DocumentStore):
                target.save(left, batch_id, as_of=as_of)
            else:
                target.append(save_articles(target.load(), left, batch_id=batch_id, as_of=as_of), batch_id)
            took = took or name
            refused = target.refused(left)
            if refused is None or refused.isEmpty():
                return took
            left = refused
            errors.append(f"{name} refused the item: {target.REFUSAL}")
        except Exception as exc:  # noqa: BLE001 - any store failure routes the items on
            errors.append(f"{name} save failed: {exc}")
        if not fallback:
            break
    if dead_letter_path:
        _write_dead(left.select(F.lit("; ".join(errors)).alias("error"), F.lit("store").alias("stage"),
                                F.to_json(F.struct(*left.columns)).alias("item")), dead_letter_path, str(batch_id))
    return took or "dead_letter"


def _write_dead(rows: DataFrame, path: str, batch: str) -> None:
    (rows.withColumn("batch", F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").json(path))
