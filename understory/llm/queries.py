"""The registered queries of the training-data operators, and SQL where it can express them."""

from . import ann, bpe, gif, html_extract, line_dedup, mixing, ngram_join, quality, secrets, toxicity

QUERIES = {
    "op1_html_extraction": html_extract.op1_html_extraction,
    "op2_mixing": mixing.op2_mixing,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_ann": ann.op7_ann,
    "op8_media_columns": gif.op8_media_columns,
    "op9_bpe": bpe.op9_bpe,
    "op10_quality": quality.op10_quality,
}

ORACLE_SQL = {"op4_line_dedup": line_dedup.OP4_SQL}
