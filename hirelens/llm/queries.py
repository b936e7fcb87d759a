"""Driver queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from hirelens.llm.bpe import op8_byte_bpe
from hirelens.llm.langid import op7_language
from hirelens.llm.mixing import op9_mixing
from hirelens.llm.perplexity import op3_perplexity
from hirelens.llm.prefixtrie import op11_prefix_trie
from hirelens.llm.quality import op2_quality
from hirelens.llm import metric, secrets, sharding
from hirelens.llm.simjoin import op1_ngram_join
from hirelens.llm.substrings import op6_substrings
from hirelens.llm.toxicity import op10_toxicity
from hirelens.llm.whitening import op13_whitening

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality": op2_quality,
    "op3_perplexity": op3_perplexity,
    "op4_mtree": metric.op4_mtree,
    "op5_secrets": secrets.op5_secrets,
    "op6_substrings": op6_substrings,
    "op7_language": op7_language,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_rendezvous": sharding.op12_rendezvous,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_mtree": metric.SQL,
    "op5_secrets": secrets.SQL,
    "op12_rendezvous": sharding.SQL,
}
