"""The corpus operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.conversation_repair import op11_conversation_repair
from skyledger.llm.decontamination import op5_decontamination
from skyledger.llm.html_text import op10_html_text
from skyledger.llm.jaccard import op3_jaccard_join
from skyledger.llm.language import op7_language
from skyledger.llm.mixing import OP6_SQL, op6_mixing
from skyledger.llm.periodic_runs import op13_periodic_runs
from skyledger.llm.secret_scan import op8_secret_scan
from skyledger.llm.suffix_tree import op4_suffix_tree
from skyledger.llm.surrogates import op1_surrogates
from skyledger.llm.syncmers import op2_syncmers
from skyledger.llm.token_files import op9_token_files
from skyledger.llm.toxicity import op12_toxicity
from skyledger.llm.workers import with_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_syncmers": op2_syncmers,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_suffix_tree": op4_suffix_tree,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_files": op9_token_files,
    "op10_html_text": op10_html_text,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}
QUERIES = {name: with_package(query) for name, query in QUERIES.items()}
ORACLES: dict[str, str] = {"op6_mixing": OP6_SQL}
