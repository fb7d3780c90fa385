"""The registered queries of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

from vaultwright.llm.common import Query
from vaultwright.llm.disclosure import personal_query
from vaultwright.llm.fixity import fixity_query
from vaultwright.llm.learned_partitions import nearest_query
from vaultwright.llm.lexical_search import SEARCH_SQL, search_query
from vaultwright.llm.ngram_join import NGRAM_SQL, ngram_query
from vaultwright.llm.perplexity import quality_query
from vaultwright.llm.positional_index import CONTAMINATION_SQL, contamination_query
from vaultwright.llm.secrets import secrets_query
from vaultwright.llm.simhash import near_duplicates_query
from vaultwright.llm.soft_mixing import mixing_query
from vaultwright.llm.spelling import spelling_query
from vaultwright.llm.suffix_levels import repeats_query
from vaultwright.llm.token_records import token_stream_query

QUERIES: dict[str, Query] = {
    "op1_token_records": Query(token_stream_query),
    "op2_fixity": Query(fixity_query),
    "op3_secrets": Query(secrets_query),
    "op4_simhash": Query(near_duplicates_query),
    "op5_learned_partitions": Query(nearest_query),
    "op6_decontamination": Query(contamination_query, CONTAMINATION_SQL),
    "op7_soft_mixing": Query(mixing_query),
    "op8_disclosure": Query(personal_query),
    "op9_perplexity": Query(quality_query),
    "op10_suffix_levels": Query(repeats_query),
    "op11_spelling": Query(spelling_query),
    "op12_ngram_join": Query(ngram_query, NGRAM_SQL),
    "op13_lexical_search": Query(search_query, SEARCH_SQL),
}
