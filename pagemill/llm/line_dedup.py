"""Removal of repeated runs of lines by winnowing, in DataFrame functions alone.

Lines are compared by the MD5 of the trimmed line; blank lines take no part.
A gram is the shortest stretch of lines, from a given line on, with at least
``gram_words`` words; a window is such a stretch with ``window_words`` words. Of the
grams that lie in a window the one with the smallest hash is selected as a
fingerprint. Equal windows select equal grams, so two documents that share any
run of whole lines with ``window_words`` words share a fingerprint for certain, and a
single line of that many words is its own fingerprint.

Each selected gram is joined with the first place (document order, then line)
that selected it, never with all others, so a gram in a third of all documents costs its
occurrences and not their square. A match is extended both ways while the lines
are equal, and the run at the later place is deleted. Document order is the id
(null last), then a hash of the text.

Cases: a null text has no lines and stays null; texts below ``gram_words`` words have no
grams. Rows repeated with the same id and text are one document and get the
same result. Ties cannot arise: equal hashes are equal grams. Empty tables give
empty results; other columns pass through ``drop_repeated_runs`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, hash_marked, text_or_empty, tmp_name

GRAM_WORDS = 25
WINDOW_WORDS = 50
SPACE = r"[\x20\x09-\x0D]+"


def _key(id_col: Column, text: Column) -> Column:
    return F.struct(id_col.isNull().alias("z"), id_col.alias("id"), F.xxhash64(text).alias("h"))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, line, n, hash, words, at): the lines that are not blank. ``line`` counts all lines,
    ``n`` these, ``at`` the words before."""
    text = text_or_empty(docs[text_col])
    rows = docs.select(_key(docs[id_col], text).alias("doc"), text.alias("text")).select(
        "doc", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    trimmed = F.trim(F.regexp_replace("text", SPACE, " "))
    rows = rows.select("doc", "line", trimmed.alias("text")).where(F.col("text") != "").select(
        "doc", "line", F.md5(F.col("text").cast("binary")).alias("hash"),
        F.size(F.split("text", " ")).cast("long").alias("words")).distinct()
    order = Window.partitionBy("doc").orderBy("line")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({"n": F.row_number().over(order),
                             "at": F.coalesce(F.sum("words").over(before), F.lit(0).cast("long"))})


def fingerprints(rows: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """(doc, n, gram): the selected grams, by the number of their first line."""
    by_words = Window.partitionBy("doc").orderBy("at")
    stretch = by_words.rangeBetween(0, gram_words - 1)  # lines with fewer words before them: the shortest stretch
    grams = rows.withColumns({"gram": F.md5(F.concat_ws("", F.collect_list("hash").over(stretch)).cast("binary")),
                              "size": F.sum("words").over(stretch)})
    grams = grams.withColumn("end", F.col("at") + F.col("size"))
    window = by_words.rangeBetween(0, window_words - 1)  # at most one gram a word
    chosen = grams.withColumns({
        "some": F.collect_list(F.struct("gram", "n", "end", "size")).over(window), "span": F.sum("words").over(window)})
    inside = F.filter("some", lambda g: (g["size"] >= gram_words) & (g["end"] <= F.col("at") + F.col("span")))
    return (chosen.where(F.col("span") >= window_words).select("doc", F.array_min(inside).alias("g"))
            .where("g is not null").select("doc", F.col("g.n").alias("n"), F.col("g.gram").alias("gram")).distinct())


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS,
                  window_words: int = WINDOW_WORDS) -> DataFrame:
    """(doc, runs, removed): for documents with repeated runs, the first and last line of each, and the
    number of lines that are not blank in them."""
    table = cut_lineage(lines(docs, id_col, text_col))
    marks = cut_lineage(fingerprints(table, gram_words, window_words))
    first = marks.groupBy("gram").agg(F.min(F.struct("doc", "n")).alias("first"), F.count(F.lit(1)).alias("places"))
    matches = (marks.join(first.where("places > 1"), "gram")
               .where((F.col("doc") != F.col("first.doc")) | (F.col("n") != F.col("first.n")))
               .groupBy("doc", F.col("first.doc").alias("from"), (F.col("n") - F.col("first.n")).alias("shift"))
               .agg(F.collect_set("n").alias("seeds")))  # lines of one document
    arrays = table.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "hash", "line"))),
                                                  lambda x: F.struct(x["hash"].alias("hash"), x["line"].alias("line")))
                                      .alias("own"))
    both = (matches.join(arrays, "doc")
            .join(arrays.select(F.col("doc").alias("from"), F.col("own").alias("other")), "from"))
    none = F.array().cast("array<struct<a:int,b:int>>")

    def step(acc: Column, same: Column, k: Column) -> Column:
        """Stretches of equal lines as (first, last) line numbers; the last one grows while it goes on."""
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), k.alias("b"))))
        new = F.concat(acc, F.array(F.struct(k.alias("a"), k.alias("b"))))
        return F.when(~same, acc).when((F.size(acc) > 0) & F.coalesce(last["b"] == k - 1, F.lit(False)), grown).otherwise(new)

    low, high = F.greatest(F.lit(1), 1 + F.col("shift")), F.least(F.size("own"), F.size("other") + F.col("shift"))
    equal = F.transform(F.sequence(low, high), lambda k: F.struct(k.alias("k"), (
        F.element_at("own", k)["hash"] == F.element_at("other", k - F.col("shift"))["hash"]).alias("same")))
    stretches = F.aggregate(equal, none, lambda acc, x: step(acc, x["same"], x["k"]))
    runs = both.select("doc", "own", F.explode(F.filter(stretches, lambda r: F.exists(
        "seeds", lambda s: s.between(r["a"], r["b"])))).alias("r"))
    # overlapping runs of one document become one
    runs = runs.select("doc", F.col("r.a").alias("a"), F.col("r.b").alias("b"),
                       F.element_at("own", F.col("r.a"))["line"].alias("from_line"),
                       F.element_at("own", F.col("r.b"))["line"].alias("to_line"))
    reach = F.max("b").over(Window.partitionBy("doc").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    order = Window.partitionBy("doc").orderBy("a", "b")
    runs = runs.distinct().withColumn("starts", F.coalesce(F.col("a") > reach, F.lit(True)).cast("int")).withColumn(
        "island", F.sum("starts").over(order))
    whole = runs.groupBy("doc", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"),
                                              F.min("from_line").alias("from_line"), F.max("to_line").alias("to_line"))
    return whole.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("from_line", "to_line"))).alias("runs"),
                                    F.sum(F.col("b") - F.col("a") + 1).alias("removed"))


def without_runs(df: DataFrame, runs: DataFrame, out: str, removed: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``df`` with the text without its runs in column ``out`` and the number of removed lines in
    ``removed``. Texts that surely have no runs do not leave their scan."""
    kd, kh, km = tmp_name(df, "doc"), tmp_name(df, "hash"), tmp_name(df, "may")
    runs = cut_lineage(runs)
    keyed = df.withColumn(kd, _key(df[id_col], text_or_empty(df[text_col]))).withColumn(kh, F.col(kd)["h"])
    marked = hash_marked(keyed, runs.select(F.col("doc.h").alias(kh)), kh, km)
    same = (marked.where(~F.col(km)).withColumn(out, F.col(text_col)).withColumn(removed, F.lit(0).cast("long")))
    cut = marked.where(km).join(runs.select(F.col("doc").alias(f"{kd}d"), F.col("runs").alias(f"{kd}r"),
                                            F.col("removed").alias(f"{kd}n")),
                                F.col(kd).eqNullSafe(F.col(f"{kd}d")), "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.exists(
        f"{kd}r", lambda r: i.between(r["from_line"], r["to_line"]))), "\n")
    cut = (cut.withColumn(out, F.when(F.col(f"{kd}r").isNull(), F.col(text_col)).otherwise(kept))
           .withColumn(removed, F.coalesce(f"{kd}n", F.lit(0)).cast("long")))
    columns = [*df.columns, *(c for c in (out, removed) if c not in df.columns)]
    return same.select(*columns).unionByName(cut.select(*columns))


def drop_repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS,
                       window_words: int = WINDOW_WORDS) -> DataFrame:
    """``df`` with later repeated runs deleted from the texts; all rows and columns stay."""
    count = tmp_name(df, "removed")
    return without_runs(df, repeated_runs(df, id_col, text_col, gram_words, window_words), text_col, count, id_col,
                        text_col).drop(count)
