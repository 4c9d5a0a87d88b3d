"""The registered queries of this package and their SQL, where SQL can express them."""

from . import align, bpe, chat, hmm, jaccard, merkle, mixing, pii, quality_model, quality_rules, secrets, topk, warc

QUERIES = {
    "op3_mixing": mixing.op3_mixing,
    "op1_jaccard": jaccard.op1_jaccard,
    "op10_hmm": hmm.op10_hmm,
    "op2_pii": pii.op2_pii,
    "op4_warc": warc.op4_warc,
    "op5_topk": topk.op5_topk,
    "op8_secrets": secrets.op8_secrets,
    "op9_bpe": bpe.op9_bpe,
    "op6_quality_model": quality_model.op6_quality_model,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op11_merkle": merkle.op11_merkle,
    "op12_align": align.op12_align,
    "op13_chat": chat.op13_chat,
}

ORACLE: dict[str, str] = {
    "op4_warc": warc.OP4_SQL,
    "op5_topk": topk.OP5_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op13_chat": chat.OP13_SQL,
}
