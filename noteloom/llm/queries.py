"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from noteloom.llm import alignment, huffman, lexical, lm, mixing, multi_index, packing, pii, sharding, simhash, toxicity, warc, winnowing

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_winnowing": winnowing.op2_winnowing,
    "op3_mixing": mixing.op3_mixing,
    "op4_multi_index": multi_index.op4_multi_index,
    "op5_simhash": simhash.op5_simhash,
    "op6_lm": lm.op6_lm,
    "op7_packing": packing.op7_packing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_huffman": huffman.op9_huffman,
    "op10_warc": warc.op10_warc,
    "op11_alignment": alignment.op11_alignment,
    "op12_sharding": sharding.op12_sharding,
    "op13_lexical": lexical.op13_lexical,
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.oracle(),
    "op10_warc": warc.ORACLE,
    "op13_lexical": lexical.ORACLE,
}
