"""All registered queries."""

from coterie.plans import (
    clustering_queries,
    itemset_queries,
    similarity_queries,
    source_queries,
)

ALL_QUERIES = {}
for module in (itemset_queries, similarity_queries, clustering_queries, source_queries):
    repeated = ALL_QUERIES.keys() & module.QUERIES.keys()
    if repeated:
        raise ValueError(f"registered twice: {sorted(repeated)}")
    ALL_QUERIES.update(module.QUERIES)
