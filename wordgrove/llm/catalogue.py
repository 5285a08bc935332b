"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordgrove.llm.bpe import op8_bpe_round_trip
from wordgrove.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from wordgrove.llm.licences import op1_licence_scan
from wordgrove.llm.decontaminate import op4_decontaminate
from wordgrove.llm.language_id import op9_language_id
from wordgrove.llm.nearest import op5_nearest
from wordgrove.llm.secrets import op6_secret_spans
from wordgrove.llm.simhash import op2_simhash
from wordgrove.llm.suffix_dedup import op10_suffix_dedup
from wordgrove.llm.token_counts import op3_token_counts
from wordgrove.llm.url_filter import OP7_SQL, op7_url_filter
from wordgrove.llm.whitening import op13_whitening
from wordgrove.llm.window_dedup import OP12_SQL, op12_window_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_licence_scan,
        op2_simhash,
        op3_token_counts,
        op4_decontaminate,
        op5_nearest,
        op6_secret_spans,
        op7_url_filter,
        op8_bpe_round_trip,
        op9_language_id,
        op10_suffix_dedup,
        op11_hard_negatives,
        op12_window_dedup,
        op13_whitening,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {"op7_url_filter": OP7_SQL, "op11_hard_negatives": OP11_SQL, "op12_window_dedup": OP12_SQL}
