"""The registered queries of the training-data operators, and SQL for those that it can express."""

from siltstone.llm.archive import OP2_SQL, op2_archive
from siltstone.llm.chat_format import OP1_SQL, op1_chat_format
from siltstone.llm.collocations import OP13_SQL, op13_collocations
from siltstone.llm.decontaminate import OP8_SQL, op8_decontaminate
from siltstone.llm.html_density import op10_html_text
from siltstone.llm.minmax import OP7_SQL, op7_near_duplicates
from siltstone.llm.ngram_quality import op11_ngram_quality
from siltstone.llm.packing import op6_packing
from siltstone.llm.prefix_tree import OP12_SQL, op12_prefix_tree
from siltstone.llm.quality import OP9_SQL, op9_quality
from siltstone.llm.sharding import OP3_SQL, op3_sharding
from siltstone.llm.toxicity import op4_toxicity
from siltstone.llm.url_filter import OP5_SQL, op5_url_filter

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_archive": op2_archive,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_packing": op6_packing,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_html_text": op10_html_text,
    "op11_ngram_quality": op11_ngram_quality,
    "op12_prefix_tree": op12_prefix_tree,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_chat_format": OP1_SQL,
    "op2_archive": OP2_SQL,
    "op3_sharding": OP3_SQL,
    "op5_url_filter": OP5_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_quality": OP9_SQL,
    "op12_prefix_tree": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
