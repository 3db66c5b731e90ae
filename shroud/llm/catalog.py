"""Registered queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from shroud.llm import compression_quality, decontamination, hard_negatives, language_id, maxent_lm, media_jpeg, packing, periodic_runs, simhash, token_counts, toxicity, url_filter, warc

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def tokenizer(name: str) -> str:
    """Path of a tokenizer's file: from the public_tokenizers module where it is installed, else from TOKENIZERS."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def queries() -> dict[str, Callable]:
    return {
        "op1_media": media_jpeg.query(),
        "op2_packing": packing.query(tokenizer("word_bpe_49k.json")),
        "op3_simhash": simhash.query(),
        "op4_token_counts": token_counts.query(tokenizer("piece_bpe_32k.model")),
        "op5_quality": compression_quality.query(),
        "op6_warc": warc.query(),
        "op7_decontamination": decontamination.query(),
        "op8_url_filter": url_filter.query(),
        "op9_toxicity": toxicity.query(),
        "op10_language": language_id.query(),
        "op11_maxent_lm": maxent_lm.query(),
        "op12_hard_negatives": hard_negatives.query(),
        "op13_periodic_runs": periodic_runs.query(),
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": warc.SQL, "op8_url_filter": url_filter.SQL, "op12_hard_negatives": hard_negatives.SQL}
