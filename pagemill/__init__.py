"""pagemill: page-corpus extraction and article curation on Spark.

Tables (or streams) of requests and fetched pages go in; declarative
XPath/CSS rules are evaluated as column expressions; extracted links are
zipped with their sibling fields and expanded into the next frontier;
items are projected, hashed, de-duplicated first-wins and written to
article tables. The article tables come with list / lookup / count /
statistics / delete queries.
"""

__version__ = "0.1.0"
