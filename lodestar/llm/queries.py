"""The queries of this subpackage and the SQL that they are held against."""

from lodestar.llm import bpe, decontaminate, language_model, pii, quality, simhash, substring_tree, suffix_array, token_store, warc

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_simhash": simhash.op2_simhash,
    "op3_suffix_array": suffix_array.op3_suffix_array,
    "op4_quality": quality.op4_quality,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_warc": warc.op6_warc,
    "op7_token_store": token_store.op7_token_store,
    "op8_language_model": language_model.op8_language_model,
    "op9_substring": substring_tree.op9_substring,
    "op10_bpe": bpe.op10_bpe,
}

ORACLE_SQL = {"op3_suffix_array": suffix_array.ORACLE_SQL, "op6_warc": warc.ORACLE_SQL, "op9_substring": substring_tree.ORACLE_SQL}
