"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from caliper.llm.bm25_search import OP6_SQL, op6_bm25_search
from caliper.llm.decontaminate import OP4_SQL, op4_decontaminate
from caliper.llm.jaccard_join import OP8_SQL, op8_jaccard_join
from caliper.llm.language_id import op5_language_id
from caliper.llm.lexical_search import OP13_SQL, op13_lexical_search
from caliper.llm.line_dedup import OP9_SQL, op9_line_dedup
from caliper.llm.mixing import OP10_SQL, op10_mix
from caliper.llm.periodic_runs import op11_periodic_runs
from caliper.llm.simhash_dedup import op12_simhash_dedup
from caliper.llm.substring_dedup import OP7_SQL, op7_substring_dedup
from caliper.llm.suffix_dedup import OP1_SQL, op1_suffix_dedup
from caliper.llm.url_filter import OP3_SQL, op3_url_filter
from caliper.llm.warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_warc": op2_warc,
    "op3_url_filter": op3_url_filter,
    "op4_decontaminate": op4_decontaminate,
    "op5_language_id": op5_language_id,
    "op6_bm25_search": op6_bm25_search,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_mix": op10_mix,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_lexical_search": op13_lexical_search,
}

SQL = {
    "op1_suffix_dedup": OP1_SQL.strip(),
    "op2_warc": OP2_SQL.strip(),
    "op3_url_filter": OP3_SQL.strip(),
    "op4_decontaminate": OP4_SQL.strip(),
    "op6_bm25_search": OP6_SQL.strip(),
    "op7_substring_dedup": OP7_SQL.strip(),
    "op8_jaccard_join": OP8_SQL.strip(),
    "op9_line_dedup": OP9_SQL.strip(),
    "op10_mix": OP10_SQL.strip(),
    "op13_lexical_search": OP13_SQL.strip(),
}
