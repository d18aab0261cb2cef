"""Article queries.

All are lazy DataFrames. Content is joined only when asked for (F12), as
one equi-join instead of a lookup per row (J2); pages use
``orderBy(...).offset(o).limit(n)`` which Catalyst plans as a top-k
(TakeOrderedAndProject), so no full sort is materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators.store import ArticleTables

LIST_COLUMNS = ["id", "task_id", "title", "link", "source_url", "extra", "created_at"]
# fixed values: sortable columns and directions of the all-articles listing
ORDER_FIELDS = ("id", "task_id", "title", "created_at")
ORDER_DIRECTIONS = ("ASC", "DESC")


def _with_content(store: ArticleTables, articles: DataFrame) -> DataFrame:
    c = store.contents.select(F.col("article_id"), F.col("content"))
    return (articles.join(c, articles["id"] == c["article_id"], "left")
            .drop("article_id")
            .withColumn("content", F.coalesce(F.col("content"), F.lit(""))))


def _page_with_content(store: ArticleTables, rows: DataFrame, order: list, limit: int,
                       offset: int) -> DataFrame:
    """A sorted page with its content joined.

    ``orderBy().offset().limit()`` followed by a left join and a sort loses the
    final sort under adaptive execution (seen on Spark 4.1.2), so the page is
    taken as the top (offset + limit) rows, numbered (a window over those
    bounded rows only), trimmed, joined, and sorted by the number.
    """
    top = rows.orderBy(*order).limit(int(offset) + int(limit))
    numbered = top.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
    page = numbered.filter(F.col("_rn") > int(offset))
    return _with_content(store, page).orderBy("_rn").drop("_rn")


def _extra(c: Column) -> Column:
    # stored JSON text; a null/empty value reads back as {}
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("{}"))


def _listing(df: DataFrame) -> DataFrame:
    return df.select(*[(_extra(F.col(c)).alias(c) if c == "extra" else F.col(c)) for c in LIST_COLUMNS])


def get_article_by_id(store: ArticleTables, article_id, include_content: bool = True) -> DataFrame:
    """0 or 1 row."""
    a = _listing(store.articles.filter(F.col("id") == F.lit(str(article_id))))
    return _with_content(store, a) if include_content else a


def get_articles_by_ids(store: ArticleTables, ids: DataFrame, id_col: str = "id",
                        include_content: bool = True) -> DataFrame:
    """S10 for a set of ids at once (semi-join instead of n point lookups)."""
    keys = ids.select(F.col(id_col).alias("_id"))
    a = _listing(store.articles.join(keys, store.articles["id"] == keys["_id"], "left_semi"))
    return _with_content(store, a) if include_content else a


def get_document_by_id(documents: DataFrame, doc_id) -> DataFrame:
    """String id; an id of another form finds nothing."""
    return documents.filter(F.col("id") == F.lit(str(doc_id)))


def get_articles_by_task(store: ArticleTables, task_id, include_content: bool = False,
                         limit: int = 100, offset: int = 0) -> DataFrame:
    """O1: newest first; id breaks ties (ties are unspecified in the source)."""
    order = [F.col("created_at").desc(), F.col("id").desc()]
    rows = _listing(store.articles.filter(F.col("task_id") == F.lit(str(task_id))))
    if include_content:
        # the page is small: content is joined to its rows only
        return _page_with_content(store, rows, order, limit, offset)
    return rows.orderBy(*order).offset(int(offset)).limit(int(limit))


def get_articles_after(store: ArticleTables, task_id=None, after: tuple | None = None, limit: int = 100) -> DataFrame:
    """O1 / O3 by keyset: the ``limit`` newest rows after the cursor ``(created_at, id)`` of the last row seen
    (None: from the start). A page costs the same however deep it lies; an offset costs its depth."""
    rows = _listing(store.articles if task_id is None else store.articles.filter(F.col("task_id") == F.lit(str(task_id))))
    if after is not None:
        at, last = F.lit(after[0]).cast("timestamp_ntz"), F.lit(str(after[1]))
        rows = rows.filter((F.col("created_at") < at) | ((F.col("created_at") == at) & (F.col("id") < last)))
    return rows.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(int(limit))


def get_documents_by_task(documents: DataFrame, task_id, limit: int = 100, skip: int = 0) -> DataFrame:
    """O2: document form, same order."""
    return (documents.filter(F.col("task_id") == F.lit(str(task_id)))
            .orderBy(F.col("created_at").desc(), F.col("id").desc())
            .offset(int(skip)).limit(int(limit)))


def get_all_articles(store: ArticleTables, include_content: bool = False, limit: int = 100,
                     offset: int = 0, order_by: str = "created_at",
                     order_direction: str = "DESC") -> DataFrame:
    """O3: whitelisted order column (else created_at) and direction (else DESC)."""
    if order_by not in ORDER_FIELDS:
        order_by = "created_at"
    direction = order_direction.upper() if order_direction.upper() in ORDER_DIRECTIONS else "DESC"
    key = F.col(order_by).asc() if direction == "ASC" else F.col(order_by).desc()
    tie = F.col("id").asc() if direction == "ASC" else F.col("id").desc()
    rows = _listing(store.articles)
    if include_content:
        return _page_with_content(store, rows, [key, tie], limit, offset)
    return rows.orderBy(key, tie).offset(int(offset)).limit(int(limit))


def count_articles_by_task(articles: DataFrame, task_id) -> DataFrame:
    """A1 / A2: one row, 0 when the task has none."""
    return articles.filter(F.col("task_id") == F.lit(str(task_id))).agg(
        F.count("*").alias("article_count"))


def count_all_articles(articles: DataFrame) -> DataFrame:
    """A3."""
    return articles.agg(F.count("*").alias("article_count"))


def task_statistics(articles: DataFrame) -> DataFrame:
    """A4: per task count and latest created_at, latest first (nulls last)."""
    return (articles.groupBy("task_id")
            .agg(F.count("*").alias("article_count"),
                 F.max("created_at").alias("latest_created_at"))
            .orderBy(F.col("latest_created_at").desc_nulls_last()))


def queue_depth(messages: DataFrame, queue_col: str = "queue") -> DataFrame:
    """A5: messages per queue."""
    return messages.groupBy(queue_col).agg(F.count("*").alias("depth"))


def distinct_links(articles: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct link hashes (exact, or HyperLogLog++ at scale)."""
    lh = F.col("link_hash")
    agg = F.approx_count_distinct(lh) if approx else F.count_distinct(lh)
    return articles.filter(lh != "").agg(agg.alias("distinct_links"))


def content_duplicates(contents: DataFrame) -> DataFrame:
    """Content hashes stored more than once (content_hash is stored, never compared)."""
    return (contents.filter(F.col("content_hash") != "")
            .groupBy("content_hash")
            .agg(F.count("*").alias("copies"), F.min("article_id").alias("first_article_id"))
            .filter(F.col("copies") > 1))
