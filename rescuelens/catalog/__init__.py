"""Every operator as a query over the given tables, with the same result in SQL."""

from rescuelens.catalog import (file_queries, filter_queries, label_queries, record_queries,
                                stream_queries)

_PARTS = (filter_queries, label_queries, record_queries, file_queries, stream_queries)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: text for part in _PARTS for name, text in part.ORACLES.items()}
