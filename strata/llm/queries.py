"""The numbered queries over the driver's tables, and their SQL where SQL can say it."""

from strata.llm import ann, byte_bpe, decontam, filter_audit, fim, hpylm, html_text, langid, licences, minhash, mixing, suffix_dedup, warc

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_warc": warc.op3_warc,
    "op4_ann": ann.op4_ann,
    "op5_minhash": minhash.op5_minhash,
    "op6_hpylm": hpylm.op6_hpylm,
    "op7_language_id": langid.op7_language_id,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_html_text": html_text.op9_html_text,
    "op10_licences": licences.op10_licences,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLE = {"op2_mixing": mixing.ORACLE_SQL.strip(), "op3_warc": warc.ORACLE_SQL.strip(),
          "op12_fill_in_middle": fim.ORACLE_SQL.strip(), "op13_filter_audit": filter_audit.ORACLE_SQL.strip()}
