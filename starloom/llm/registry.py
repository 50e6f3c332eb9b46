"""The registered queries of this subpackage and their DuckDB SQL (where SQL can express the operator)."""

from starloom.llm.centroids import op12_centroids
from starloom.llm.decontaminate import op1_decontaminate
from starloom.llm.extract import op3_extract
from starloom.llm.language import op9_language
from starloom.llm.licenses import op13_licenses
from starloom.llm.mixing import op10_mix
from starloom.llm.oracle import ORACLE  # noqa: F401
from starloom.llm.phrase_dedup import op8_phrase_dedup
from starloom.llm.prefix_trie import op11_prefix_trie
from starloom.llm.search import op5_search
from starloom.llm.secrets import op6_secrets
from starloom.llm.simhash import op4_simhash
from starloom.llm.suffix_dedup import op2_suffix_dedup
from starloom.llm.token_counts import op7_token_counts

QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_suffix_dedup, op3_extract, op4_simhash, op5_search, op6_secrets, op7_token_counts, op8_phrase_dedup, op9_language, op10_mix,
    op11_prefix_trie, op12_centroids, op13_licenses)}

