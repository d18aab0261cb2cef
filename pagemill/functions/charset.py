"""Charset detection and decoding as columns.

Order of evidence: Content-Type header (confidence 1.0) > HTML meta tag in
the first 2 KB (0.95) > statistical guess > utf-8 (0.0). Header and meta
are regex expressions (JVM). UTF-8 decoding is native
(``make_valid_utf8``, same replacement rule as Python's ``errors='replace'``), and so is
Latin-1, in which every byte is a character;
only rows in other charsets, and only rows still undecided for the
statistical guess, reach a UDF with their content – it sees nulls for the rest. The guess is that of a ``CharsetModel`` where one is given, else of an
installed detector.
"""

from __future__ import annotations

import encodings
import encodings.aliases
import pkgutil
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.charset_model import CharsetModel, guessed as model_guess

# ---- fixed values ------------------------------------------------------------
ENCODING_ALIASES = {
    "utf8": "utf-8",
    "utf_8": "utf-8",
    "gb2312": "gb2312",
    "gbk": "gbk",
    "big5": "big5",
    "big5hkscs": "big5",
    "iso8859-1": "iso-8859-1",
    "latin1": "iso-8859-1",
}
HEADER_CHARSET = r"(?i)charset\s*=\s*([^\s;]+)"
META_PATTERNS = (
    (r"(?i)<meta\s+charset\s*=\s*[\"']?([^\s\"'>;]+)", 1),
    (r"(?i)<meta\s+http-equiv\s*=\s*[\"']?content-type[\"']?\s+content\s*=\s*[\"']?"
     r"([^\"'>;]*charset=([^\s\"'>;]+))", 2),
    (r"(?i)charset\s*=\s*([^\s\"'>;]+)", 1),
)
META_SCAN_BYTES = 2048
SOURCE_HEADER = "Content-Type header"
SOURCE_META = "HTML meta tag"
SOURCE_STAT = "chardet detection"
SOURCE_DEFAULT = "default"
SOURCE_MANUAL = "manual"
# -----------------------------------------------------------------------------


def _codec_keys() -> list[str]:
    """Every spelling of a text encoding that can encode (built from the codec registry);
    byte transforms such as base64 and the codec that always fails are none."""
    keys = set(encodings.aliases.aliases) | set(encodings.aliases.aliases.values())
    keys |= {m.name for m in pkgutil.iter_modules(encodings.__path__)}
    ok = []
    for k in sorted(keys):
        try:
            "".encode(k)
            ok.append(k)
        except (LookupError, UnicodeError):
            pass
    return ok


CODEC_KEYS = _codec_keys()


def _codec_key(name: Column) -> Column:
    # the registry's own normalisation: runs of other characters -> '_'
    k = F.regexp_replace(F.lower(name), r"[^a-z0-9.]+", "_")
    return F.regexp_replace(k, r"^_+|_+$", "")


_CODEC_ARRAY: dict = {}


def _codec_array() -> Column:
    """The codec names as one array literal, built once per Spark context
    (one expression instead of hundreds of literal columns per use)."""
    from pyspark import SparkContext

    ctx = id(SparkContext._active_spark_context)
    if ctx not in _CODEC_ARRAY:
        quoted = ", ".join("'" + k.replace("'", "") + "'" for k in CODEC_KEYS)
        _CODEC_ARRAY.clear()
        _CODEC_ARRAY[ctx] = F.expr(f"array({quoted})")
    return _CODEC_ARRAY[ctx]


def normalize_encoding(name: Column) -> Column:
    """lower/strip, alias map, unknown codec -> null."""
    n = F.lower(F.trim(name))
    alias = F.create_map(*[F.lit(x) for kv in ENCODING_ALIASES.items() for x in kv])
    key = _codec_key(n)
    codecs_ = _codec_array()
    valid = (F.array_contains(codecs_, key)
             | F.array_contains(codecs_, F.regexp_replace(key, r"\.", "_")))
    return (F.when((n.isNull()) | (n == ""), F.lit(None).cast("string"))
            .when(alias[n].isNotNull(), alias[n])
            .when(valid, n))


def _header_name(headers: Column) -> Column:
    ct = F.get(F.map_values(F.map_filter(
        F.coalesce(headers, F.create_map().cast("map<string,string>")),
        lambda k, v: F.lower(k) == "content-type")), 0)
    raw = F.regexp_extract(ct, HEADER_CHARSET, 1)
    raw = F.regexp_replace(raw, r"^['\"]+|['\"]+$", "")
    return F.nullif(raw, F.lit(""))


def charset_from_headers(headers: Column) -> Column:
    """X11: charset of the Content-Type header (key case-insensitive)."""
    return normalize_encoding(_header_name(headers))


def _head(content: Column) -> Column:
    return F.make_valid_utf8(F.substring(content, 1, META_SCAN_BYTES).cast("string"))


def _meta_name(head: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(head, p, g), F.lit("")) for p, g in META_PATTERNS])


def charset_from_meta(content: Column) -> Column:
    """Charset from a meta tag within the first 2 KB of the bytes."""
    return normalize_encoding(_meta_name(_head(content)))


@F.pandas_udf(T.StructType([T.StructField("encoding", T.StringType()),
                             T.StructField("confidence", T.DoubleType())]))
def _guess(content: pd.Series) -> pd.DataFrame:
    try:
        from charset_normalizer import from_bytes
    except ImportError:  # no detector installed: nothing is guessed
        from_bytes = None
    out = []
    for b in content:
        enc, conf = None, None
        if b is not None and len(b) and from_bytes is not None:
            best = from_bytes(bytes(b)).best()
            if best is not None:
                enc, conf = best.encoding, float(1.0 - best.chaos)
        out.append((enc, conf))
    return pd.DataFrame(out, columns=["encoding", "confidence"])


def _info(enc: Column, conf: Column, source: Column, method: Column) -> Column:
    return F.struct(enc.alias("encoding"), conf.cast("double").alias("confidence"),
                    source.alias("source"),
                    F.when(method.isNull(), F.array().cast("array<string>"))
                    .otherwise(F.array(method)).alias("methods"))


def with_encoding_info(df: DataFrame, content: str = "content", headers: str = "headers",
                       manual: Column | None = None, statistical: bool = True,
                       out: str = "encoding_info") -> DataFrame:
    """Add ``out`` = struct(encoding, confidence, source, methods).

    ``manual``: an encoding name column (request meta or step config); a
    valid one wins with source 'manual'.
    """
    none = F.lit(None).cast("string")
    # each piece of evidence is a column of its own, looked for only where nothing before it decides: in one
    # expression every use of a name would search it again
    found = df.withColumn("_manual", none if manual is None else F.lower(F.trim(manual)))
    found = found.withColumn("_man", normalize_encoding(F.col("_manual")))
    open_ = F.col("_man").isNull()
    found = found.withColumn("_hname", F.when(open_, _header_name(F.col(headers))) if headers in df.columns else none)
    found = found.withColumn("_h", normalize_encoding(F.col("_hname")))
    open_ = open_ & F.col("_h").isNull()
    found = found.withColumn("_head", F.when(open_, _head(F.col(content))))
    found = found.withColumn("_mname", F.when(F.col("_head").isNotNull(), _meta_name(F.col("_head"))))
    found = found.withColumn("_m", normalize_encoding(F.col("_mname")))
    decided = (F.when(F.col("_man").isNotNull(), _info(F.col("_manual"), F.lit(1.0), F.lit(SOURCE_MANUAL),
                                                       F.lit("manual_config")))
               .when(F.col("_h").isNotNull(), _info(F.col("_h"), F.lit(1.0), F.lit(SOURCE_HEADER), F.lit("header")))
               .when(F.col("_m").isNotNull(), _info(F.col("_m"), F.lit(0.95), F.lit(SOURCE_META), F.lit("meta"))))
    df = found.withColumn(out, decided).drop("_manual", "_man", "_hname", "_h", "_head", "_mname", "_m")
    default = _info(F.lit("utf-8"), F.lit(0.0), F.lit(SOURCE_DEFAULT), F.lit(None).cast("string"))
    if not statistical:
        return df.withColumn(out, F.coalesce(F.col(out), default))
    known = df.filter(F.col(out).isNotNull())
    rest = df.filter(F.col(out).isNull())
    g = _guess(F.col(content))
    rest = rest.withColumn("_g", g).withColumn(out, F.when(
        F.col("_g.encoding").isNotNull(),
        _info(F.col("_g.encoding"), F.col("_g.confidence"), F.lit(SOURCE_STAT), F.lit("chardet")))
        .otherwise(default)).drop("_g")
    return known.unionByName(rest)


@F.pandas_udf(T.StringType())
def _decode_other(content: pd.Series, enc: pd.Series) -> pd.Series:
    out = []
    for b, e in zip(content, enc):
        if b is None:
            out.append(None)
            continue
        b = bytes(b)
        try:
            out.append(b.decode(e, errors="replace"))
        except (LookupError, TypeError, ValueError):  # UnicodeError is a ValueError
            out.append(b.decode("utf-8", errors="replace"))
    return pd.Series(out)


def decode_as(content: Column, charset: Column) -> Column:
    """``content`` read in ``charset``; null content gives null."""
    return _decode_other(content, charset)


def _is_utf8(enc: Column) -> Column:
    return F.lower(enc).isin("utf-8", "utf8", "utf_8", "u8", "utf")


def _is_latin1(enc: Column) -> Column:
    return F.lower(enc).isin("iso-8859-1", "iso8859-1", "iso_8859_1", "latin-1", "latin1", "latin_1", "l1", "cp819")


def decode_utf8(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def decode_native(content: Column, enc: Column) -> Column:
    """``content`` in UTF-8 or Latin-1, without Python."""
    return F.when(_is_latin1(enc), F.decode(content, "ISO-8859-1")).otherwise(decode_utf8(content))


def with_decoded_body(df: DataFrame, content: str = "content", info: str = "encoding_info",
                      out: str = "body") -> DataFrame:
    """Decode with the detected charset (replacement on bad bytes).

    UTF-8 and Latin-1 rows decode natively; the other rows go through the pandas UDF.
    """
    enc = F.col(f"{info}.encoding")
    simple = _is_utf8(enc) | _is_latin1(enc)
    native = df.filter(simple | F.col(content).isNull()).withColumn(
        out, F.coalesce(decode_native(F.col(content), enc), F.lit("")))
    other = df.filter(~simple & F.col(content).isNotNull()).withColumn(
        out, _decode_other(F.col(content), enc))
    return native.unionByName(other)


_READ = T.StructType([T.StructField("encoding", T.StringType()),
                      T.StructField("confidence", T.DoubleType()),
                      T.StructField("body", T.StringType()),
                      T.StructField("error", T.StringType())])
_ARROW_READ = pa.struct([("encoding", pa.string()), ("confidence", pa.float64()), ("body", pa.string()), ("error", pa.string())])

#: Characters and rows after which decoded texts go back to the JVM, whatever the size of the batch that came in.
SLICE_CHARS, SLICE_ROWS = 1 << 21, 1000


def _read(b: bytes | None, e: str | None, statistical: bool) -> tuple:
    if b is None:
        return e or "utf-8", None, None, None
    conf, error = None, None
    if e is None:
        e, conf = "utf-8", 0.0
        try:
            from charset_normalizer import from_bytes
        except ImportError:
            from_bytes = None
        if statistical and len(b) and from_bytes is not None:
            best = from_bytes(b).best()
            if best is not None:
                e, conf = best.encoding, float(1.0 - best.chaos)
    try:
        text = b.decode(e, errors="replace")
    except (LookupError, TypeError, ValueError) as exc:  # UnicodeError is a ValueError
        text, error = b.decode("utf-8", errors="replace"), f"{e}: {exc}"
    return e, conf, text, error


def _read_slices(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Guessed and decoded rows in slices: a worker holds one batch as it came and one slice of texts."""
    for batch in batches:
        out, chars = [], 0
        for row in zip(*batch):
            out.append(_read(*(v.as_py() for v in row)))
            chars += len(out[-1][2] or "")
            if chars >= SLICE_CHARS or len(out) >= SLICE_ROWS:
                yield _read_array(out)
                out, chars = [], 0
        if out:
            yield _read_array(out)


def _read_array(rows: list) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW_READ)], fields=list(_ARROW_READ))


@F.arrow_udf(_READ)
def _guess_and_decode(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    return _read_slices(batches)


def decode_content(df: DataFrame, content: str = "content", headers: str = "headers",
                   manual: Column | None = None, statistical: bool = True,
                   info: str = "encoding_info", out: str = "body", model: CharsetModel | None = None) -> DataFrame:
    """X14-X17 in one pass: rows whose charset is decided by manual /
    header / meta evidence and is UTF-8 or Latin-1 decode JVM-side and are null for the
    UDF that guesses (if undecided) and decodes all others. A charset that
    fails to decode leaves its message in ``encoding_error`` and the UTF-8 reading as text.
    ``model``: undecided rows are guessed by it, and what it leaves open is UTF-8."""
    decided = with_encoding_info(df, content, headers, manual, statistical=False, out="_dec")
    src = F.col("_dec.source")
    if model is not None:
        found = decided.withColumn("_g", F.when(src == SOURCE_DEFAULT, model_guess(F.when(src == SOURCE_DEFAULT, F.col(content)), model)))
        decided = found.withColumn("_dec", F.when(F.col("_g.encoding").isNull(), F.col("_dec")).otherwise(
            _info(F.col("_g.encoding"), F.col("_g.confidence"), F.lit(SOURCE_STAT), F.lit("model")))).drop("_g")
        undecided = F.lit(False)
    else:
        undecided = src == SOURCE_DEFAULT
    enc = F.col("_dec.encoding")
    # flags and guess are columns, not filters: those would move below the projections and search the evidence again
    read = decided.withColumn("_undecided", undecided)
    read = read.withColumn("_simple", ~F.col("_undecided") & (_is_utf8(enc) | _is_latin1(enc)))
    read = read.withColumn("_g", _guess_and_decode(F.when(~F.col("_simple"), F.col(content)),
                                                   F.when(~F.col("_undecided"), enc), F.lit(bool(statistical))))
    guessed = F.col("_undecided") & (F.col("_g.confidence") > 0)
    return (read.withColumn("_dec", F.when(guessed, _info(F.col("_g.encoding"), F.col("_g.confidence"),
                                                          F.lit(SOURCE_STAT), F.lit("chardet"))).otherwise(F.col("_dec")))
            .withColumn(out, F.coalesce(F.when(F.col("_simple"), decode_native(F.col(content), enc))
                                        .otherwise(F.col("_g.body")), F.lit("")))
            .withColumn("encoding_error", F.when(~F.col("_simple"), F.col("_g.error")))
            .drop("_g", "_simple", "_undecided").withColumnRenamed("_dec", info))


def header_value(headers: Column, name: str) -> Column:
    """A header as text, key matched case-insensitively (first match)."""
    return F.get(F.map_values(F.map_filter(
        F.coalesce(headers, F.create_map().cast("map<string,string>")),
        lambda k, v: F.lower(k) == name.lower())), 0)
