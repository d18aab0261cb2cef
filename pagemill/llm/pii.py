"""Information-theoretic sanitisation of personal data, in DataFrame functions alone.

Protected entities are the e-mail addresses, IP addresses, card numbers and
phone numbers in the texts. A term of a text that holds an entity can reveal it
after the entity itself is gone. How strongly is estimated from the corpus: with
probabilities as shares of the different texts,

    information of entity e:  I(e)    = -log2 p(e)
    disclosure by term t:     PMI(e;t) = log2 p(e|t) / p(e)

PMI never exceeds I(e), so ``PMI / I`` is the share of the entity's information that
the term gives away. Every term of every text with an entity is judged, wherever
it stands and whatever its length; no count is a cut. Few observations are shrunk
instead: p(e|t) is the lower Wilson bound at one standard deviation, and with c texts
that hold both, the score is the mean of the entity's own share (weight c) and of
a prior (weight ``PRIOR``). The prior pools the entity's class - mail domain, network,
issuer or dialling prefix - over the texts without the entity itself, and is shrunk
towards 0 in the same way; so one text is no evidence alone, two are, and so are several
addresses of a domain that come with one term. A term whose score reaches
``disclosure`` is replaced at all its places in the texts that hold the entity: by its stem
class (first letters and a star) if the class scores less than that, else by nothing.

Plan: one scan finds the base spans and the words of texts that have some (written
once). Texts with a term are counted in a second scan, with partial sums a task; only
texts that occur more than once are counted by their hash. Entities and terms meet on
the text, after terms too frequent and classes too rare to reach the threshold are left
out (both bounds are exact). A text without base spans never leaves its scan and is never
changed.

Cases: a null text is empty (no spans, stays null in ``sanitise``). Ids may be
null or repeated: what is found belongs to the text, and rows with equal texts get
the same spans; copies of a text count once. A term inside an address is part of its span,
not a term. Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted_marked, cut_lineage, text_or_empty, tmp_name

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE = 0.58
PRIOR = 1.0
STEM = 3
#: Rows with equal texts are dealt over this many keys in the joins on the text.
SALTS = 16

# The patterns of the kinds, in a form that the regex engine runs in linear time: possessive
# repeats, and a match starts where a run starts or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# An address or a word outside of addresses.
TOKEN = rf"{PATTERNS['email']}|(?:(?!{PATTERNS['email']})\p{{L}})++"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    from_right = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(F.filter(from_right, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int")))),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    count = F.length(digits)
    if kind == "ip":  # leading zeros do not make a part larger
        return F.forall(F.split(hit, r"\."), lambda p: F.coalesce(
            F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.ltrim(p, F.lit("0"))).otherwise("999")
            .try_cast("int"), F.lit(0)) <= 255)
    if kind == "card":
        return F.when(count.between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(10, 15)
    return F.lit(True)


def kind_spans(text: Column, kind: str) -> Column:
    """array<struct<start, kind, end, value>> of one kind: the pieces between the matches and the
    matches themselves, whose lengths add up to the positions."""
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(hits.alias("hit"), F.transform(F.split(text, pattern, -1), F.length).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
                     .alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                        x["hit"].alias("value"))
        return F.struct(end.alias("at"), F.when(
            x["hit"].isNotNull() & _valid(kind, x["hit"]), F.concat(acc["found"], F.array(span)))
            .otherwise(acc["found"]).alias("found"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    found = F.aggregate(zipped, start, step)["found"]
    has = text.contains(HINTS[kind]) & text.rlike(pattern) if HINTS[kind] else text.rlike(pattern)
    return F.when(has, found).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans, by start and then by kind as listed."""
    return F.array_sort(F.concat(*(kind_spans(text, k) for k in KINDS)))


def _entity(span: Column) -> Column:
    """Key of the protected value of a span."""
    return F.concat_ws(":", span["kind"].cast("string"), F.when(span["kind"] == 0, F.lower(span["value"]))
                       .otherwise(F.regexp_replace(span["value"], "[^0-9.]", "")))


def _class(entity: Column) -> Column:
    """Key of the class that an entity's statistics are pooled with: domain, network, issuer, dialling prefix."""
    kind, value = F.substring(entity, 1, 1), F.substring(entity, 3, F.length(entity))
    return F.concat(kind, F.lit("@"), F.when(kind == "0", F.substring_index(value, "@", -1))
                    .when(kind == "1", F.substring_index(value, ".", 2)).when(kind == "2", F.substring(value, 1, 6))
                    .otherwise(F.substring(F.regexp_replace(value, r"\.", ""), 1, 5)))


def _stem(term: Column) -> Column:
    return F.concat(F.substring(term, 1, STEM), F.lit("*"))


def _terms(words: Column) -> Column:
    """Distinct terms of a text and their classes, which are judged like terms."""
    lower = F.array_distinct(F.transform(F.filter(words, lambda w: (w != "") & ~w.contains("@")), F.lower))
    return F.array_distinct(F.concat(lower, F.transform(F.filter(lower, lambda w: F.length(w) > STEM), _stem)))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (id, text_hash, base, tokens, gaps): one row per input row. Tokens (words and addresses, in
    order) and the lengths of what lies between them are null where there are no base spans."""
    text = text_or_empty(docs[text_col])
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    has = F.size("base") > 0
    return cut_lineage(rows.select(
        "id", "text_hash", "base",
        F.when(has, F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("tokens"),
        F.when(has, F.transform(F.split("text", TOKEN, -1), F.length)).alias("gaps")))


def _term_docs(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(term, docs_term): the number of different texts with each term, over all texts."""
    text = text_or_empty(docs[text_col])
    repeated = cut_lineage(found.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_hash"))
    # a text without an @ has no address to leave out
    words = F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))).otherwise(
        F.split(text, r"\P{L}+"))
    rows = counted_marked(docs.select(F.xxhash64(text).alias("text_hash"), _terms(words).alias("terms")), repeated,
                          "text_hash", "may_repeat")
    each = rows.select(F.when(F.col("may_repeat"), F.col("text_hash")).alias("copy"), F.explode("terms").alias("term"))
    return (each.groupBy("term", "copy").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("term").agg(F.sum(F.when(F.col("copy").isNull(), F.col("n")).otherwise(1)).alias("docs_term")))


def _share(both: Column, with_term: Column, with_entity: Column, total: Column) -> Column:
    """Share of the entity's information that the term discloses, from 0 to 1; p(e|t) is the lower Wilson bound."""
    p, n = both / with_term, with_term
    low = (p + 0.5 / n - F.sqrt(p * (1 - p) / n + 0.25 / (n * n))) / (1 + 1 / n)
    bits, of = F.log2(low * total / with_entity), F.log2(total / with_entity)
    return F.when((both > 0) & (low > 0) & (of > 0), F.greatest(F.least(bits / of, F.lit(1.0)), F.lit(0.0))).otherwise(0.0)


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text",
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, score, generalised): pairs that reach the threshold. ``generalised`` is the stem
    class of the term where that stays below, else null."""
    if not 1 / (1 + PRIOR) < disclosure <= 1:
        raise ValueError(f"disclosure must lie above {1 / (1 + PRIOR)}, which one text alone reaches, and be 1 at most")
    with_base = found.where(F.size("base") > 0)
    entities = cut_lineage(with_base.select("text_hash", F.explode(F.array_distinct(F.transform("base", _entity)))
                                            .alias("entity")).distinct())
    both = entities.withColumn("class", _class(F.col("entity")))
    docs_class = both.select("text_hash", "class").distinct().groupBy("class").agg(F.count(F.lit(1)).alias("docs_class"))
    # one text of a class is less evidence than the threshold asks for
    known = cut_lineage(both.groupBy("entity", "class").agg(F.count(F.lit(1)).alias("docs_entity"))
                        .join(docs_class.where("docs_class > 1"), "class"))
    total = found.select("text_hash").distinct().count()
    holders = entities.join(known, "entity").select("text_hash", "entity", "class", "docs_class")
    holders = (holders.select("text_hash", F.col("entity").alias("of"), "docs_class")
               .unionByName(holders.select("text_hash", F.col("class").alias("of"), "docs_class")).distinct())
    terms = with_base.select("text_hash", F.explode(_terms(F.col("tokens"))).alias("term")).distinct()
    # so is a term of one such text
    shared = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("term")
    counted = cut_lineage(_term_docs(docs, found, text_col).join(shared, "term"))
    n = F.lit(float(total))
    # the score is at most I(term) / I(class), as PMI is at most I(term)
    pairs = (terms.join(counted, "term").join(holders, "text_hash")
             .where(F.log2(n / F.col("docs_term")) >= disclosure * F.log2(n / F.col("docs_class")) - 1e-9)
             .groupBy("of", "term", "docs_term").agg(F.count(F.lit(1)).alias("docs_both")))
    pairs = cut_lineage(pairs)
    pooled = pairs.select(F.col("of").alias("class"), "term", F.col("docs_both").alias("class_both"))
    c, r = F.col("docs_both"), F.col("class_both") - F.col("docs_both")
    prior = r / (r + PRIOR) * _share(r, F.greatest(F.col("docs_term") - c, F.lit(1)),
                                     F.greatest(F.col("docs_class") - F.col("docs_entity"), F.lit(1)),
                                     n - F.col("docs_entity"))
    own = _share(c, F.col("docs_term"), F.col("docs_entity"), n)
    beyond = (pairs.withColumnRenamed("of", "entity").join(known, "entity").join(pooled, ["class", "term"])
              .select("entity", "term", ((c * own + PRIOR * prior) / (c + PRIOR)).alias("score"))
              .where(F.col("score") >= disclosure))
    beyond = cut_lineage(beyond)
    classes = beyond.where("term like '%*'").select("entity", F.col("term").alias("stem"), F.lit(True).alias("told"))
    return (beyond.where("term not like '%*'").withColumn("stem", _stem(F.col("term")))
            .join(classes, ["entity", "stem"], "left")
            .select("entity", "term", "score", F.when(F.col("told").isNull() & (F.length("term") > STEM), F.col("stem"))
                    .alias("generalised")))


def term_spans(found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """(text_hash, terms), one row per text that has some: array<struct<start, kind, end, value>> of terms to
    sanitise, where ``value`` is the class that takes the term's place, or empty."""
    with_base = found.where(F.size("base") > 0)
    entities = with_base.select("text_hash", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    asked = entities.distinct().join(disclosing, "entity").groupBy("text_hash", "term").agg(
        # removed as soon as one entity asks for it
        F.max(F.col("generalised").isNull()).alias("gone"), F.min("generalised").alias("generalised"))
    # of one text: at most as many as it has different words
    asked = cut_lineage(asked.groupBy("text_hash").agg(F.map_from_entries(F.collect_list(F.struct(
        "term", F.when(F.col("gone"), "").otherwise(F.col("generalised")))))
        .alias("asked")))
    texts = (counted_marked(with_base, asked, "text_hash", "may").where("may")
             .groupBy("text_hash").agg(F.first("tokens").alias("tokens"), F.first("gaps").alias("gaps")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(F.length(x["token"]), F.lit(0))
        value = F.try_element_at(F.col("asked"), F.lower(x["token"]))
        return F.struct(end.alias("at"), F.when(value.isNotNull(), F.concat(acc["found"], F.array(F.struct(
            begin.alias("start"), F.lit(len(KINDS)).alias("kind"), end.alias("end"), value.alias("value")))))
            .otherwise(acc["found"]).alias("found"))

    zipped = F.arrays_zip(F.col("tokens").alias("token"), F.col("gaps").alias("gap"))
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return texts.join(asked, "text_hash").select(
        "text_hash", F.aggregate(zipped, start, step)["found"].alias("terms"))


def _with_terms(rows: DataFrame, terms: DataFrame, hash_col: str, out_col: str) -> DataFrame:
    """``rows`` with the term spans of their texts; rows with equal texts are dealt over ``SALTS`` keys."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    kh, ks, kt, salt = (tmp_name(rows, s) for s in ("term_hash", "term_salt", "term_spans", "salt"))
    keys = terms.select(F.col("text_hash").alias(kh), F.col("terms").alias(kt),
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(ks))
    dealt = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = dealt.join(keys, (F.col(hash_col) == F.col(kh)) & (F.col(salt) == F.col(ks)), "left")
    return joined.withColumn(out_col, F.coalesce(kt, none)).drop(kh, ks, kt, salt)


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per input row: id, base and terms (arrays of spans), spans (both, by start and kind)."""
    found = found_spans(docs, id_col, text_col)
    terms = cut_lineage(term_spans(found, disclosing_terms(docs, found, text_col, disclosure)))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    rows = found.select("id", "text_hash", "base")
    both = _with_terms(rows.where(F.size("base") > 0), terms, "text_hash", "terms").unionByName(
        rows.where(F.size("base") == 0).withColumn("terms", none))
    return both.select("id", "text_hash", "base", "terms", F.array_sort(F.concat("base", "terms")).alias("spans"))


def digest_columns(spans: DataFrame) -> DataFrame:
    """Counts by kind, base_sha256 and spans as text."""
    def of_kind(i: int):
        return lambda s: s["kind"] == i

    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return spans.select("id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"),
                        F.size("terms").cast("long").alias("n_term"))


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             disclosure: float = DISCLOSURE) -> DataFrame:
    """``df`` with base spans replaced by their kind in brackets and disclosing terms by their class
    or nothing. All rows and columns stay; texts without base spans are passed on as they are."""
    found = found_spans(df, id_col, text_col)
    terms = cut_lineage(term_spans(found, disclosing_terms(df, found, text_col, disclosure)))
    kh, kt, kb = (tmp_name(df, s) for s in ("hash", "terms", "base"))
    text = df[text_col]
    wide = df.withColumn(kb, base_spans(text_or_empty(text)))
    clean = wide.where(F.size(kb) == 0).drop(kb)
    marked = wide.where(F.size(kb) > 0).withColumn(kh, F.xxhash64(text_or_empty(text)))
    marked = _with_terms(marked, terms, kh, kt)
    spans = F.array_sort(F.concat(F.col(kb), F.col(kt)))
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    source = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        mark = F.when(s["kind"] < len(KINDS), F.element_at(marks, F.least(s["kind"] + 1, F.lit(len(KINDS)))))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])  # overlaps the span before: already covered
            .otherwise(F.concat(acc["out"], F.substring(source, acc["at"] + 1, s["start"] - acc["at"]),
                                F.coalesce(mark, s["value"]))).alias("out"))

    made = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.substring(source, made["at"] + 1, F.length(source))
    marked = marked.withColumn(text_col, F.concat(made["out"], rest))
    return clean.unionByName(marked.select(*df.columns))
