"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm.centroids import OP13_SQL, op13_centroid_clusters
from tidemark.llm.collocations import OP11_SQL, op11_collocations
from tidemark.llm.embeddings import op4_embedding_near_dedup
from tidemark.llm.mixing import op3_source_mix
from tidemark.llm.outliers import op10_quality_outliers
from tidemark.llm.packing import op7_packing
from tidemark.llm.quality import op2_quality_classifier
from tidemark.llm.secrets import op5_secret_scan
from tidemark.llm.simhash import op6_simhash_near_dedup
from tidemark.llm.toolcalls import op1_tool_calls
from tidemark.llm.toxicity import op8_toxicity
from tidemark.llm.urlfilter import OP9_SQL, op9_url_filter
from tidemark.llm.warc import OP12_SQL, op12_warc

QUERIES = {
    "op1_tool_calls": op1_tool_calls,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_source_mix": op3_source_mix,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_url_filter": op9_url_filter,
    "op10_quality_outliers": op10_quality_outliers,
    "op11_collocations": op11_collocations,
    "op12_warc": op12_warc,
    "op13_centroid_clusters": op13_centroid_clusters,
}

SQL = {"op9_url_filter": OP9_SQL, "op11_collocations": OP11_SQL, "op12_warc": OP12_SQL, "op13_centroid_clusters": OP13_SQL}
