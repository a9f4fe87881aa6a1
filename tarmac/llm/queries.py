"""The queries of the operators by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tarmac.llm import (
    conversation_repair, decontaminate, exact_dedup, language_id, lexical_search, nn_descent, order_minhash, secrets,
    sentencepiece_codec, template, toxicity, url_filter, warc,
)

QUERIES = {
    "op1_html_template": template.query,
    "op2_url_filter": url_filter.query,
    "op3_secrets": secrets.query,
    "op4_nn_descent": nn_descent.query,
    "op5_language_id": language_id.query,
    "op6_sentencepiece": sentencepiece_codec.query,
    "op7_decontaminate": decontaminate.query,
    "op8_toxicity": toxicity.query,
    "op9_near_duplicates": order_minhash.query,
    "op10_warc": warc.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_lexical_search": lexical_search.query,
    "op13_exact_dedup": exact_dedup.query,
}

ORACLES = {
    "op2_url_filter": url_filter.SQL,
    "op3_secrets": secrets.SQL,
    "op10_warc": warc.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_lexical_search": lexical_search.SQL,
    "op13_exact_dedup": exact_dedup.SQL,
}
