"""The queries of this package, and SQL for those that SQL can express."""

from lodestat.llm.decontaminate import op8_decontaminate
from lodestat.llm.fingerprints import op4_fingerprints
from lodestat.llm.katz import op1_katz
from lodestat.llm.language_id import op10_language_id
from lodestat.llm.line_dedup import OP9_SQL, op9_line_dedup
from lodestat.llm.mixing import op7_mixing
from lodestat.llm.ngram_join import op2_ngram_join
from lodestat.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from lodestat.llm.quality_rules import op11_quality_rules
from lodestat.llm.sharding import op3_sharding
from lodestat.llm.url_rules import op6_url_rules
from lodestat.llm.warc import op5_warc
from lodestat.llm.whitening import op13_whitening

QUERIES = {
    "op1_katz": op1_katz,
    "op2_ngram_join": op2_ngram_join,
    "op3_sharding": op3_sharding,
    "op4_fingerprints": op4_fingerprints,
    "op5_warc": op5_warc,
    "op6_url_rules": op6_url_rules,
    "op7_mixing": op7_mixing,
    "op8_decontaminate": op8_decontaminate,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_quality_rules": op11_quality_rules,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
SQL = {"op9_line_dedup": OP9_SQL, "op12_prefix_trie": OP12_SQL}
