"""The registered queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from docweave.llm import chat, html, mixing, orderminhash, pieces, quality, repeats, sharding, simhash, warc


def queries() -> dict:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_warc": warc.op2_warc,
        "op3_quality": quality.op3_quality,
        "op4_order_minhash": orderminhash.op4_order_minhash,
        "op5_sentencepiece": pieces.op5_sentencepiece,
        "op6_repeats": repeats.op6_repeats,
        "op7_html": html.op7_html,
        "op8_chat_format": chat.op8_chat_format,
        "op9_simhash": simhash.op9_simhash,
        "op10_sharding": sharding.op10_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": mixing.OP1_SQL,
        "op2_warc": warc.OP2_SQL,
        "op6_repeats": repeats.OP6_SQL,
        "op8_chat_format": chat.OP8_SQL,
    }
