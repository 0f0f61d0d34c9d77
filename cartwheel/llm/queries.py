"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.alignment import op11_tokenizer_alignment
from cartwheel.llm.byte_bpe import op13_byte_bpe
from cartwheel.llm.chunks import op8_chunk_dedup
from cartwheel.llm.common import ship
from cartwheel.llm.decontamination import OP10_SQL, op10_decontamination
from cartwheel.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from cartwheel.llm.html import op4_html_extraction
from cartwheel.llm.near_dups import OP9_SQL, op9_near_duplicates
from cartwheel.llm.pieces import op3_sentencepiece
from cartwheel.llm.repeats import op7_suffix_repeats
from cartwheel.llm.sharding import op5_sharding
from cartwheel.llm.spelling import op12_spelling_variants
from cartwheel.llm.toxicity import op2_toxicity
from cartwheel.llm.warc import op1_warc_derivatives

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: _shipped(f) for f in (op1_warc_derivatives, op2_toxicity, op3_sentencepiece, op4_html_extraction, op5_sharding,
                                             op6_exact_dedup, op7_suffix_repeats, op8_chunk_dedup, op9_near_duplicates, op10_decontamination, op11_tokenizer_alignment,
                                             op12_spelling_variants, op13_byte_bpe)}
ORACLE = {"op6_exact_dedup": OP6_SQL, "op9_near_duplicates": OP9_SQL, "op10_decontamination": OP10_SQL}
