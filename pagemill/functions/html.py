"""Column functions over HTML: the normaliser UDF and the DOM column.

``with_dom`` adds one ``dom`` struct column per page; rules then read it
JVM-side (``pagemill.functions.rules``). The normaliser is the only Python
that touches page bytes in the extraction path; it runs on Arrow batches, slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.htmlnorm import normalize

DOM_TYPE = T.StructType([
    T.StructField("xhtml", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("lens", T.ArrayType(T.IntegerType())),
])
ARROW_DOM = pa.struct([("xhtml", pa.string()), ("html", pa.string()),
                       ("starts", pa.list_(pa.int32())), ("lens", pa.list_(pa.int32()))])

#: Characters and pages after which parsed pages go back to the JVM, whatever the size of the batch that came in.
SLICE_CHARS, SLICE_PAGES = 1 << 21, 256


def _parsed(batches: Iterator[pa.Array], with_spans: bool) -> Iterator[pa.Array]:
    """The pages of each batch, parsed, in slices: a worker holds one batch as it came and one slice of Python
    objects, not a batch of texts and of trees."""
    for batch in batches:
        out, chars = [], 0
        for page in batch:
            html = page.as_py()
            out.append(normalize(html, with_spans) if html is not None else (None, None, None, None))
            chars += len(out[-1][0] or "") + len(out[-1][1] or "")
            if chars >= SLICE_CHARS or len(out) >= SLICE_PAGES:
                yield _dom_array(out)
                out, chars = [], 0
        if out:
            yield _dom_array(out)


def _dom_array(rows: list) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW_DOM)], fields=list(ARROW_DOM))


@F.arrow_udf(DOM_TYPE)
def _normalize_spans(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _parsed(html, True)


@F.arrow_udf(DOM_TYPE)
def _normalize_plain(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _parsed(html, False)


def normalize_html(html: Column, with_spans: bool = True) -> Column:
    """struct<xhtml, html, starts, lens>; spans only when element rules need them."""
    return (_normalize_spans if with_spans else _normalize_plain)(html)


def with_dom(df: DataFrame, html_col: str = "body", with_spans: bool = True,
             dom_col: str = "dom") -> DataFrame:
    """Add the normalised page once; every rule of the step shares it."""
    return df.withColumn(dom_col, normalize_html(F.col(html_col), with_spans))


def content_length(body: Column) -> Column:
    """Characters in the body (0 for null)."""
    return F.coalesce(F.length(body), F.lit(0))
